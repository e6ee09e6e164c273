"""Patient basics (A12) and insert-if-absent (K3).

One pass over every source, two partially aggregated shuffles on the id
(see ``wardline.operators.resolve``), no join: age, gender, COVID status,
death and critical-care flags for every entity seen in any file.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.functions.labels import normalise_gender, number
from wardline.operators.columns import AGE_TERMS, COVID_TERMS, GENDER_TERMS
from wardline.operators.resolve import (AnyMatch, Presence, Single, ValueEquals, classes, entity_aggregates,
                                        tri_state)
from wardline.operators.validate import assert_none, duplicate_keys
from wardline.schemas import conform
from wardline.sources.model import SourceSet

# Default value patterns for COVID status (prefix match, any case)
# and for death.
COVID_STATUS_TERMS = {
    "positive": [r"\+ve", "^p$", "^pos$", "^positive$"],
    "negative": ["-ve", "^n$", "^neg$", "^negative$"],
    "suspected": ["suspected"],
}
DEATH_TERMS = ["dead", "died", "death"]


def build_patients(sources: SourceSet, conflicts: str = "raise", **options) -> DataFrame:
    """One row per entity in the ``patients`` schema (A12); ``options`` are those of ``patient_rules``.

    * age: one value per entity (A4) under ``conflicts``, as an integer;
    * gender: one value (A4), then normalised (F4) -- an unmapped number fails;
    * covid: P/N/U from all values of the COVID columns (A8);
    * died: 1 when a row of a ``death_file`` file has ``death_column`` matching
      ``death_search_terms`` (A6);
    * critical_care_stay: presence in a ``critical_care_file`` file, or a row
      with ``critical_care_column == critical_care_pos_value`` (A7).
    """
    variables, basics = patient_rules(**options)
    return basics(entity_aggregates(sources, variables, conflicts=conflicts, id_alias="patient_id"))


def patient_rules(age_search_terms: Sequence[str] | None = None,
                  gender_search_terms: Sequence[str] | None = None,
                  covid_search_terms: Sequence[str] | None = None,
                  covid_status_search_terms: Mapping[str, Sequence[str]] | None = None,
                  death_search_terms: Sequence[str] | None = None,
                  death_column: str = "destination", death_file: str = "outcome",
                  gender_int_mappings: Mapping[int, str] | None = None,
                  critical_care_file: str = "outcome",
                  critical_care_presence_infers_positivity: bool = False,
                  critical_care_column: str | None = "CRITICAL_CARE",
                  critical_care_pos_value: str | None = "Y",
                  suspected_blocks_negative: bool = True) -> tuple[dict, Callable[[DataFrame], DataFrame]]:
    """The variables that patient basics resolve, and the projection of their decisions onto the ``patients`` schema."""
    status = dict(COVID_STATUS_TERMS if covid_status_search_terms is None else covid_status_search_terms)
    for needed in ("positive", "negative", "suspected"):
        status.setdefault(needed, [])
    if critical_care_presence_infers_positivity:
        cc = Presence(critical_care_file)
    else:
        if critical_care_pos_value is None or critical_care_column is None:
            raise ValueError("without presence mode, give critical_care_column and critical_care_pos_value")
        cc = ValueEquals(critical_care_file, critical_care_column, str(critical_care_pos_value))
    variables = {
        "age": Single(tuple(age_search_terms or AGE_TERMS)),
        "gender": Single(tuple(gender_search_terms or GENDER_TERMS)),
        "covid": classes(covid_search_terms or COVID_TERMS, positive=status["positive"],
                         negative=status["negative"], suspected=status["suspected"]),
        "died": AnyMatch(death_file, death_column, tuple(death_search_terms or DEATH_TERMS)),
        "critical_care_stay": cc,
    }

    def basics(decided: DataFrame) -> DataFrame:
        age = number("age")
        unreadable = F.raise_error(F.concat(F.lit("Age is not a number for patient "), F.col("patient_id"), F.lit(": "), F.col("age"))).cast("int")
        out = decided.select(
            "patient_id",
            F.when(F.col("age").isNotNull() & age.isNull(), unreadable).otherwise(age.cast("int")).alias("age"),
            normalise_gender("gender", gender_int_mappings, entity="patient_id").alias("gender"),
            tri_state(F.col("covid__positive"), F.col("covid__negative"), F.col("covid__suspected"),
                      suspected_blocks_negative).alias("covid"),
            F.col("died"), F.col("critical_care_stay"))
        return conform(out, "patients")

    return variables, basics


def insert_if_absent(existing: DataFrame, new: DataFrame, key: str = "patient_id") -> DataFrame:
    """``existing`` plus the rows of ``new`` whose key is not there yet (K3).

    Existing rows are never overwritten.  The anti join reads only the key of
    ``existing``.  A key that ``new`` holds twice is an error (one aggregation).
    """
    assert_none(duplicate_keys(new, [key]), f"Keys repeated in the rows to insert ({key})")
    fresh = new.join(existing.select(key), key, "left_anti")
    return existing.unionByName(fresh, allowMissingColumns=True)
