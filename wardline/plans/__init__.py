"""Composite builders: patients, facts, correction and the registry store."""
from wardline.plans.correction import apply_correction, corrected_values, python_correction, read_sources, write_sources
from wardline.plans.facts import (build_comorbidities, build_critical_care, build_events, build_measurements,
                                  load_keyword, measurements_of_type)
from wardline.plans.history import HistoryTable
from wardline.plans.incremental import ResolvedStore
from wardline.plans.pages import numbered_children, patient_pages
from wardline.plans.patients import build_patients, insert_if_absent, patient_rules
from wardline.plans.populate import Loader
from wardline.plans.registry import (BucketedRegistry, Registry, cascade_delete, child_summary, patient_children,
                                     patient_documents)

__all__ = ["apply_correction", "corrected_values", "python_correction", "read_sources", "write_sources", "build_comorbidities",
           "build_critical_care", "build_events", "build_measurements", "load_keyword", "measurements_of_type",
           "HistoryTable", "ResolvedStore", "numbered_children", "patient_pages", "build_patients", "insert_if_absent", "patient_rules", "Loader", "BucketedRegistry", "Registry", "cascade_delete", "child_summary",
           "patient_children", "patient_documents"]
