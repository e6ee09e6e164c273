"""A bounded sample of labelled rows, for the operators that fit a model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(key: Column, folds: int) -> Column:
    """crc32 of the key as text, modulo ``folds``."""
    return F.crc32(key.cast("string").cast("binary")) % folds


def training_sample(docs: DataFrame, labels: DataFrame, label: str, held: Column, per_class: int, max_chars: int,
                    id_col: str = "doc_id", text_col: str = "text") -> list[tuple[str, int]]:
    """(text, label) of at most ``per_class`` labelled rows of each of the labels 0 and 1.

    Rows are drawn by a hash of the id among those that ``held`` leaves; texts of
    over ``max_chars`` characters are passed over whole.  Ids are drawn from the
    narrow label table first, so the id list that is broadcast and the rows that
    reach the driver are bounded by the two parameters.
    """
    drawn = None
    known = labels.where(F.col(id_col).isNotNull() & ~held).groupBy(F.col(id_col).alias("__id")).agg(F.max(label).alias("__label"))
    for value in (0, 1):
        some = known.where(F.col("__label") == value).orderBy(F.xxhash64("__id"), "__id").limit(per_class)
        drawn = some if drawn is None else drawn.unionByName(some)
    texts = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
    rows = (texts.join(F.broadcast(drawn), "__id").where(F.length("__text").between(1, max_chars))
            .dropDuplicates(["__id"]).select("__id", "__text", "__label").collect())
    return [(r["__text"], int(r["__label"])) for r in sorted(rows, key=lambda r: r["__id"])]
