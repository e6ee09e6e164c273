"""Folder → registry workflow (the public entry point a user calls).

``Loader`` lists and scans a folder once, then each ``add_*`` call builds one
lazy plan over the scanned sources and appends its result to the registry
with one write per table.  Calls mirror the reference's workflow: patients
first, then facts, whose ids must already be registered (J2).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.operators.resolve import Single, conflict_report
from wardline.plans.correction import apply_correction, corrected_values, write_sources
from wardline.plans.facts import (build_comorbidities, build_critical_care, build_events, build_measurements,
                                  load_keyword)
from wardline.plans.incremental import ResolvedStore
from wardline.plans.patients import build_patients, patient_rules
from wardline.plans.registry import Registry
from wardline.sources.files import load_directory
from wardline.sources.model import SourceSet


class Loader:
    def __init__(self, spark: SparkSession, target_directory: str, id_column: str, registry: Registry | str,
                 conflicts: str = "raise", multiline: bool | str = "auto", sources: SourceSet | None = None):
        if conflicts not in ("raise", "ignore"):
            raise AssertionError(f"unknown conflicts policy {conflicts!r}; known: raise, ignore")
        self.spark = spark
        self.id_column = id_column
        self.conflicts = conflicts
        self.sources = sources or load_directory(spark, target_directory, id_column, multiline=multiline)
        self.registry = registry if isinstance(registry, Registry) else Registry(spark, registry)
        try:
            self.registry.current("patients")
        except FileNotFoundError:
            self.registry.create()

    # -- patients -----------------------------------------------------------
    def add_patients(self, conflicts: str | None = None, log_conflicts: bool = False, **options) -> DataFrame:
        """Register every entity of every file with its basics (A12 + K3); returns the new rows.

        ``log_conflicts`` also appends every conflicting age and gender value
        to the audit table (one extra pass over the matched columns).
        """
        patients = build_patients(self.sources, conflicts=conflicts or self.conflicts, **options)
        fresh = self.registry.add_patients(patients)
        self.registry.log("add_patient", fresh.select("patient_id"), "New patient written to patients table")
        if log_conflicts:
            from wardline.operators.columns import AGE_TERMS, GENDER_TERMS

            report = self.conflicts_report({"age": options.get("age_search_terms") or AGE_TERMS,
                                            "gender": options.get("gender_search_terms") or GENDER_TERMS})
            message = F.concat(F.lit("Conflicting "), F.col("variable"), F.lit(" value "), F.col("value"),
                               F.lit(" in "), F.col("_file"),
                               F.when(F.col("level") == "file", F.lit(" (within the file)"))
                               .otherwise(F.lit(" (across files)")))
            self.registry.log_rows("conflict", report, "patient_id", message)
        return fresh

    def update_patients(self, store: str, **options) -> DataFrame:
        """Resolve the files of the folder that ``store`` has not seen; returns the change set (A12 over repeated loads).

        ``store`` is the folder of a ``ResolvedStore``; only new files are
        scanned, and only the entities in them are decided again.
        """
        variables, basics = patient_rules(**options)
        resolved = ResolvedStore(self.spark, store, variables, basics, self.conflicts)
        seen = resolved.loaded_files()
        fresh = SourceSet([s.subset(tuple(f for f in s.files if f not in seen)) for s in self.sources
                           if s.files is not None and any(f not in seen for f in s.files)], self.id_column)
        if not len(fresh):
            return resolved.current().withColumn("change", F.lit(None).cast("string")).limit(0)
        return resolved.add(fresh)

    def conflicts_report(self, variables: Mapping[str, Sequence[str]]) -> DataFrame:
        """Every conflicting value for the given column patterns (A5)."""
        return conflict_report(self.sources, {k: Single(tuple(v)) for k, v in variables.items()},
                               id_alias="patient_id")

    # -- facts --------------------------------------------------------------
    def add_events(self, event_datetime: str | Sequence[str], filename: str, mappings: Mapping[str, str],
                   exclude_columns: Sequence[str] | None = None) -> None:
        rows = load_keyword(self.sources, filename)
        events = build_events(rows, self.id_column, event_datetime, dict(mappings), exclude_columns,
                              patients=self.registry.read("patients"))
        self.registry.append("events", events)
        self.registry.log("add_events", None, f"Outcome events added from files matching {filename!r}")

    def add_measurements(self, filename: str, result_datetime: str | Sequence[str] | None,
                         results_columns: Sequence[str], results_types: Sequence[str],
                         ref_ranges: Sequence[Sequence[float] | None] | None = None,
                         request_source: str | None = None, complex_result_split_char: str = " ") -> None:
        rows = load_keyword(self.sources, filename)
        m = build_measurements(rows, self.id_column, results_columns, results_types, result_datetime, ref_ranges,
                               request_source, complex_result_split_char, patients=self.registry.read("patients"))
        self.registry.append("measurements", m)
        self.registry.log("add_measurements", None, f"Measurements added from files matching {filename!r}")

    def add_critical_care(self, filename: str, admission_datetime=None, discharge_datetime=None,
                          request_location: str | None = None, icu_days: str | None = None,
                          ventilated: str | None = None, covid_status: str | None = None) -> None:
        rows = load_keyword(self.sources, filename)
        cc = build_critical_care(rows, self.id_column, admission_datetime, discharge_datetime, request_location,
                                 icu_days, ventilated, covid_status, patients=self.registry.read("patients"))
        self.registry.append("critical_care", cc)
        self.registry.log("add_critical_care", None, f"Critical care stays added from files matching {filename!r}")

    def add_comorbidities(self, filename: str, exclude_columns: Sequence[str] | None = None,
                          conflicts: str = "ignore", edit_threshold: int = 2, policy: str = "tabular") -> None:
        rows = load_keyword(self.sources, filename).drop("_file")
        built = build_comorbidities(rows, self.id_column, exclude_columns, conflicts, edit_threshold,
                                    existing_keys=self.registry.read("comorb_key"), policy=policy,
                                    patients=self.registry.read("patients"))
        if built is None:
            return
        links, new_keys, _ = built
        self.registry.add_comorb_keys(new_keys)
        existing = self.registry.read("comorbidities").select("patient_id", "comorb_name")
        # links are distinct (patient, name) pairs: unique by construction.
        self.registry.append("comorbidities", links.join(existing, ["patient_id", "comorb_name"], "left_anti"),
                             check_keys=False)
        self.registry.log("add_comorbidities", None, f"Comorbidities added from files matching {filename!r}")

    # -- correction ---------------------------------------------------------
    def age_correction(self, correction: Callable, column_search_terms: Sequence[str] | None = None,
                       new_path: str | None = None, kind: str = "spark") -> SourceSet:
        """Reduce each entity's ages with ``correction`` (see ``corrected_values``) and rewrite the sources.

        The corrected sources replace ``self.sources``; with ``new_path`` they
        are also written there as CSV, one folder per source file.
        """
        fixed = corrected_values(self.sources, correction, column_search_terms, kind=kind)
        self.sources = apply_correction(self.sources, fixed, column_search_terms)
        if new_path is not None:
            write_sources(self.sources, new_path)
        return self.sources
