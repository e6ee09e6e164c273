"""The source model: one DataFrame per group of files that share a header.

Every ``Source`` frame carries the canonical id column (trimmed text) and a
``_file`` column naming the file each row came from.  A ``SourceSet`` is the
list of such frames for one registry build; its size is the number of distinct
headers, not the number of files or rows, so iterating over it on the driver
only builds the plan.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.functions.refs import ref
from wardline.functions.labels import contains_ci

FILE_COL = "_file"


@dataclass(frozen=True)
class Source:
    """Rows of one or more files with an identical header.

    ``files`` lists the file names held by ``df`` when they are known up
    front (file reads); it is ``None`` when ``_file`` comes from a data column
    (table adapters), in which case keyword checks run as row filters.
    """

    df: DataFrame
    id_column: str
    files: tuple[str, ...] | None = None
    # Re-reads just the given file names (set by file readers), so a keyword
    # selection prunes files before the scan instead of filtering rows after it.
    reopen: Callable[[tuple[str, ...]], "Source"] | None = field(default=None, compare=False, repr=False)

    @property
    def columns(self) -> list[str]:
        return [c for c in self.df.columns if c not in (self.id_column, FILE_COL)]

    def with_df(self, df: DataFrame) -> "Source":
        return Source(df, self.id_column, self.files)

    def subset(self, names: tuple[str, ...]) -> "Source":
        """The same source restricted to the files ``names``."""
        if names == self.files:
            return self
        if self.reopen is not None:
            return self.reopen(names)
        return Source(self.df.filter(ref(FILE_COL).isin(list(names))), self.id_column, names)


@dataclass
class SourceSet:
    """All sources of one registry build, keyed by one shared id column."""

    sources: list[Source] = field(default_factory=list)
    id_column: str = "patient_id"

    def __iter__(self):
        return iter(self.sources)

    def __len__(self):
        return len(self.sources)

    def select_keyword(self, keyword: str) -> "SourceSet":
        """Sources whose file name contains ``keyword``, case-insensitively.

        Known file lists are pruned before any read; column-tagged sources get
        a row filter on ``_file``.
        """
        kept = []
        for s in self.sources:
            if s.files is not None:
                names = tuple(f for f in s.files if keyword.lower() in f.lower())
                if names:
                    kept.append(s.subset(names))
            else:
                kept.append(s.with_df(s.df.filter(contains_ci(FILE_COL, keyword))))
        return SourceSet(kept, self.id_column)


def union_sources(sources: SourceSet | list[Source], require: bool = True, keyword: str | None = None) -> DataFrame:
    """Outer union by column name; missing columns become null.

    Raises when nothing is left to union, naming the keyword if one was used.
    """
    items = list(sources)
    if not items:
        if require:
            raise ValueError(f"No files match keyword {keyword!r}" if keyword else "No sources to union")
        return None
    frames = [s.df for s in items]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
