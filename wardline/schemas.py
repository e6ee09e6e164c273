"""Output contracts of the registry tables, their defaults and allowed values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

S, I, D, DT = T.StringType(), T.IntegerType(), T.DoubleType(), T.DateType()
EXTRA = T.MapType(T.StringType(), T.StringType())

PATIENTS = T.StructType([
    T.StructField("patient_id", S, False), T.StructField("age", I), T.StructField("gender", S),
    T.StructField("covid", S), T.StructField("died", I), T.StructField("critical_care_stay", I)])

EVENTS = T.StructType([
    T.StructField("patient_id", S, False), T.StructField("component", S), T.StructField("event_type", S, False),
    T.StructField("event_date", DT, False), T.StructField("event_time", D), T.StructField("covid_status", S),
    T.StructField("death", I), T.StructField("critical_care_admission", I), T.StructField("source", S),
    T.StructField("source_type", S), T.StructField("destination", S), T.StructField("wimd", I),
    T.StructField("extra", EXTRA)])

MEASUREMENTS = T.StructType([
    T.StructField("patient_id", S, False), T.StructField("result_name", S, False),
    T.StructField("result_type", S, False), T.StructField("result_double", D), T.StructField("result_string", S),
    T.StructField("result_array", T.ArrayType(S)), T.StructField("result_date", DT), T.StructField("result_time", D),
    T.StructField("request_source", S), T.StructField("ref_range", T.ArrayType(D)), T.StructField("notes", S),
    T.StructField("flags", T.ArrayType(S)), T.StructField("extra", EXTRA)])

CRITICAL_CARE = T.StructType([
    T.StructField("patient_id", S, False), T.StructField("admission_date", DT), T.StructField("admission_time", D),
    T.StructField("discharge_date", DT), T.StructField("discharge_time", D), T.StructField("request_location", S),
    T.StructField("icu_days", D), T.StructField("ventilated", S), T.StructField("covid_status", S),
    T.StructField("extra", EXTRA)])

COMORBIDITIES = T.StructType([T.StructField("patient_id", S, False), T.StructField("comorb_name", S, False)])
COMORB_KEY = T.StructType([T.StructField("comorb_name", S, False)])
AUDIT = T.StructType([T.StructField("ts", T.TimestampType()), T.StructField("op", S),
                      T.StructField("entity_id", S), T.StructField("message", S)])

TABLES = {"patients": PATIENTS, "events": EVENTS, "measurements": MEASUREMENTS,
          "critical_care": CRITICAL_CARE, "comorbidities": COMORBIDITIES, "comorb_key": COMORB_KEY,
          "audit": AUDIT}

# Defaults and allowed values of the registry columns.
DEFAULTS = {
    "patients": {"gender": "U", "covid": "U", "died": 0, "critical_care_stay": 0},
    "events": {"covid_status": "U", "death": 0, "critical_care_admission": 0},
    "critical_care": {"ventilated": "U", "covid_status": "U"},
}
CHOICES = {
    "patients": {"gender": ("M", "F", "U"), "covid": ("P", "N", "U"), "died": (0, 1), "critical_care_stay": (0, 1)},
    "events": {"covid_status": ("P", "N", "U"), "death": (0, 1), "critical_care_admission": (0, 1)},
    "measurements": {"result_type": ("continuous", "discrete", "complex")},
    "critical_care": {"ventilated": ("Y", "N", "U"), "covid_status": ("P", "N", "U")},
}
REQUIRED = {
    "patients": ("patient_id",),
    "events": ("patient_id", "event_type", "event_date"),
    "measurements": ("patient_id", "result_name", "result_type"),
    "critical_care": ("patient_id",),
    "comorbidities": ("patient_id", "comorb_name"),
    "comorb_key": ("comorb_name",),
}
KEYS = {"patients": ("patient_id",), "comorbidities": ("patient_id", "comorb_name"), "comorb_key": ("comorb_name",)}


def conform(df: DataFrame, table: str) -> DataFrame:
    """Project ``df`` onto the table's schema: casts, missing columns null, defaults filled."""
    schema = TABLES[table]
    defaults = DEFAULTS.get(table, {})
    cols = []
    for f in schema.fields:
        c = F.col(f.name) if f.name in df.columns else F.lit(None)
        if f.name in defaults:
            c = F.coalesce(c.cast(f.dataType), F.lit(defaults[f.name]).cast(f.dataType))
        cols.append(c.cast(f.dataType).alias(f.name))
    return df.select(*cols)
