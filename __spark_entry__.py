"""

The test tables stand in for the registry's source files (see FIXTURES.md §4):
``customer`` is one file of the entity spine, ``orders`` is a set of outcome
files (``o_orderpriority`` names the file of each row), ``events`` a file of
multi-valued status rows, ``lineitem`` wide measurements, ``labels`` one-hot
conditions and ``part.p_name`` the condition names of the dictionary.

Every query reads whole tables.  Array results are rendered as joined text and
map values are projected so both engines hash plain scalars.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from wardline.functions import (join_datetime, label_map, normalise_gender, null_tokens, render_date, split_literal,
                                with_parsed_datetime)
from wardline.operators import (AnyMatch, Presence, Single, UserAggregate, ValueEquals, classes, conflict_report, drop_columns,
                                duplicate_keys, entity_aggregates, entity_index, entity_spine, gather_values,
                                invalid_choices, match_columns, melt_onehot, missing_parents, missing_required, multi_values,
                                not_a_number, resolve_names, route_rows, similar_pairs, table_checks, tri_state, unreadable_numbers)
from wardline.plans import (apply_correction, build_comorbidities, build_critical_care, build_events,
                            build_measurements, build_patients, cascade_delete, corrected_values,
                            HistoryTable, ResolvedStore, insert_if_absent, load_keyword, measurements_of_type,
                            patient_children, patient_documents, patient_pages, patient_rules, read_sources, write_sources)
from wardline.session import checkpoint_dir
from wardline.sources import FILE_COL, PresenceIndex, SourceSet, from_table, load_directory, read_table, union_sources
from wardline.sources.files import list_folder

SMOKE_DIR = "/root/testdata/sf0.001"


# ---------------------------------------------------------------- sources
def _customer(spark, d, file="customer"):
    return from_table(read_table(spark, d, "customer"), "patient_id", source_id="c_custkey", file=file)


def _orders(spark, d, columns=None):
    return from_table(read_table(spark, d, "orders"), "patient_id", source_id="o_custkey",
                      file_column="o_orderpriority", columns=columns)


def _events(spark, d):
    return from_table(read_table(spark, d, "events"), "patient_id", source_id="user_id", file="events",
                      columns=["event_type"])


# ---------------------------------------------------------------- queries
def q_filter_columns(spark, d):
    li = read_table(spark, d, "lineitem")
    keep = ["l_orderkey", "l_linenumber"]
    picked = match_columns(li.columns, ["l_ship", r"l_.*price$", "l_tax"], exclude=keep)
    return drop_columns(li.select(*keep, *picked), ["l_tax"])


def q_source_union(spark, d):
    nation = from_table(read_table(spark, d, "nation"), "patient_id", source_id="n_nationkey", file="nation_codes.csv")
    cust = _customer(spark, d, "customer_accounts.csv")
    supp = from_table(read_table(spark, d, "supplier"), "patient_id", source_id="s_suppkey", file="supplier_accounts.csv")
    sources = SourceSet([cust, supp, nation]).select_keyword("ACCOUNTS")
    return union_sources(sources, keyword="accounts").withColumnRenamed(FILE_COL, "source_file")


def q_entity_index(spark, d):
    idx = entity_index(SourceSet([_customer(spark, d), _orders(spark, d, columns=[])]))
    return idx.withColumnRenamed(FILE_COL, "source_file")


_EVENT_TEXT = {
    "view": "d/M/yyyy H:mm:ss",
    "click": "dd.MM.yyyy HH:mm",
    "signup": "d-M-yy h:mma",
    "purchase": "d MMM yyyy HH:mm",
    "error": "d/M/yyyy",
}


def q_parse_datetime(spark, d):
    ev = read_table(spark, d, "events")
    text = None
    for kind, fmt in _EVENT_TEXT.items():
        rendered = F.date_format("ts", fmt)
        text = F.when(F.col("event_type") == kind, rendered) if text is None else text.when(F.col("event_type") == kind, rendered)
    parsed = with_parsed_datetime(ev.select("event_id", text.alias("text")), "text", "event_date", "event_time")
    return parsed.select("event_id", "event_date", "event_time", render_date("event_date").alias("date_text"))


def q_concat_datetime(spark, d):
    ev = read_table(spark, d, "events").select(
        "event_id", F.date_format("ts", "d/M/yyyy").alias("event_day"), F.date_format("ts", "HH:mm").alias("event_clock"))
    ev = ev.select("event_id", join_datetime(["event_day", "event_clock"]).alias("event_datetime"))
    return with_parsed_datetime(ev, "event_datetime", "event_date", "event_time")


def q_entity_spine(spark, d):
    return entity_spine(SourceSet([_customer(spark, d), _orders(spark, d, columns=[]), _events(spark, d)]))


def q_gather_values(spark, d):
    vals = gather_values(SourceSet([_orders(spark, d, columns=["o_orderstatus"])]), ["o_orderstatus"])
    return vals.withColumnRenamed(FILE_COL, "source_file")


def _orders_extract(spark, d):
    """Orders as an outcome extract: text day-first dates, as a registry source file holds."""
    return read_table(spark, d, "orders").select(
        F.col("o_custkey").alias("patient"), "o_orderkey", "o_orderstatus", "o_orderpriority",
        F.date_format("o_orderdate", "d/M/yyyy").alias("admit_date"))


def q_csv_ingest(spark, d):
    """End-to-end file path: orders written as a CSV extract folder, then discovered,
    header-checked, scanned as text and loaded as events."""
    import uuid

    folder = f"{checkpoint_dir(spark).rstrip('/')}/wardline_extracts/{uuid.uuid4().hex}"
    _orders_extract(spark, d).write.option("header", True).csv(folder)
    sources = load_directory(spark, folder, "patient")
    outcome = load_keyword(sources, ".csv")
    ev = build_events(outcome, "patient", "admit_date", {"event_type": "o_orderpriority", "component": "o_orderstatus"})
    return ev.select(*[c for c in ev.columns if c != "extra"], F.col("extra")["o_orderkey"].alias("order_key"))


def q_events_stream(spark, d):
    """File-drop ingestion: an orders extract dropped as CSV is loaded by an
    availableNow stream whose micro-batches go through the batch event builder."""
    import uuid

    from wardline.streaming import csv_stream, ingest

    base = f"{checkpoint_dir(spark).rstrip('/')}/wardline_stream/{uuid.uuid4().hex}"
    extract = _orders_extract(spark, d)
    extract.write.option("header", True).csv(f"{base}/drop")
    header = extract.columns

    def to_events(batch):
        ev = build_events(batch, "patient", "admit_date", {"event_type": "o_orderpriority", "component": "o_orderstatus"})
        return ev.select(*[c for c in ev.columns if c != "extra"], F.col("extra")["o_orderkey"].alias("order_key"))

    query = ingest(csv_stream(spark, f"{base}/drop", header, "patient"), to_events, f"{base}/sink", f"{base}/ckpt")
    query.awaitTermination()
    return spark.read.parquet(f"{base}/sink").drop("batch_id")


def q_registry_patients(spark, d):
    """Registry store end to end: a customer extract written as CSV is loaded by
    ``Loader``; patients are added twice (the second insert adds nothing) and the
    registry's patients table is read back."""
    import uuid

    from wardline.plans import Loader

    base = f"{checkpoint_dir(spark).rstrip('/')}/wardline_registry/{uuid.uuid4().hex}"
    read_table(spark, d, "customer").select(
        F.col("c_custkey").alias("pid"), F.col("c_nationkey").alias("age"), F.col("c_mktsegment").alias("sex"),
        "c_name").write.option("header", True).csv(f"{base}/extracts")
    loader = Loader(spark, f"{base}/extracts", "pid", f"{base}/registry", conflicts="ignore")
    loader.add_patients()
    if loader.add_patients().count():
        raise AssertionError("insert-if-absent added a patient twice")
    return loader.registry.read("patients")


def _publish(spark, lines, folder, stem, header):
    """Write a frame of text lines (one column) as files ``<stem>_<n>.csv`` of ``folder``, each with ``header``."""
    import uuid

    def with_header(batches):
        import pandas as pd

        yield pd.DataFrame({"value": [header]})
        for pdf in batches:
            yield pdf

    scratch = f"{checkpoint_dir(spark).rstrip('/')}/wardline_lines/{uuid.uuid4().hex}"
    lines.toDF("value").mapInPandas(with_header, "value string").write.text(scratch)
    hadoop = spark._jvm.org.apache.hadoop.fs
    fs = hadoop.Path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(hadoop.Path(folder))
    parts = [f for f in list_folder(spark, scratch) if f.name.startswith("part-")]
    for i, part in enumerate(sorted(parts, key=lambda f: f.name)):
        fs.rename(hadoop.Path(part.path), hadoop.Path(f"{folder}/{stem}_{i}.csv"))


def _scratch(spark, name):
    import uuid

    return f"{checkpoint_dir(spark).rstrip('/')}/{name}/{uuid.uuid4().hex}"


def _awkward(spark, d):
    """Customers as CSV lines with blank lines, null tokens, short rows, a `_` column and, for odd keys, quoted breaks."""
    key = F.col("c_custkey")
    flag = F.when(key % 5 == 0, "NA").otherwise(F.concat(F.lit(" "), F.col("c_nationkey").cast("string")))
    note = F.when(key % 7 == 0, F.concat(F.lit('"say ""'), "c_name", F.lit('"", twice"'))).otherwise(F.col("c_name"))
    broken = F.when((key % 2 == 1) & (key % 7 == 0), F.concat(F.lit('"'), "c_name", F.lit('\nsecond line"'))).otherwise(note)
    line = F.when(key % 3 == 0, F.concat_ws(",", key, flag)).otherwise(F.concat_ws(",", key, flag, broken))
    line = F.when(key % 11 == 0, F.concat(line, F.lit("\n   \n"))).otherwise(line)
    return read_table(spark, d, "customer").select((key % 2).alias("odd"), line.alias("value"))


def q_csv_awkward(spark, d):
    """Awkward CSV files, read by the batch scan: files with quoted breaks multi-line, the others split."""
    folder = _scratch(spark, "wardline_awkward")
    lines = _awkward(spark, d)
    for odd in (0, 1):
        _publish(spark, lines.where(F.col("odd") == odd).select("value"), folder, f"odd{odd}", "pid,_flag,note")
    return load_keyword(load_directory(spark, folder, "pid"), "odd").drop(FILE_COL)


def q_csv_quoted_split(spark, d):
    """Orders as a CSV file with quoted line breaks, larger than a split, put together from its lines."""
    folder = _scratch(spark, "wardline_quoted")
    quoted = lambda c: F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))
    note = F.concat_ws("\n", "o_orderpriority", F.concat(F.lit('"'), "o_orderstatus", F.lit('",')), F.col("o_custkey").cast("string"))
    lines = read_table(spark, d, "orders").select(F.concat_ws(",", "o_orderkey", F.when(F.col("o_orderkey") % 3 == 0, quoted(note)).otherwise(F.col("o_orderpriority")), "o_custkey"))
    _publish(spark, lines.coalesce(1), folder, "notes", "pid,note,owner")
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, str(1 << 16))
    try:
        return spark.read.parquet(_written(load_keyword(load_directory(spark, folder, "pid"), "notes").drop(FILE_COL), _scratch(spark, "wardline_quoted_rows")))
    finally:
        spark.conf.set(name, before)


def _written(df, path):
    df.write.parquet(path)
    return path


def q_csv_awkward_stream(spark, d):
    """The same files through the stream."""
    from wardline.streaming import csv_stream, ingest

    base = _scratch(spark, "wardline_awkward")
    lines = _awkward(spark, d)
    for odd in (0, 1):
        _publish(spark, lines.where(F.col("odd") == odd).select("value"), f"{base}/drop", f"odd{odd}", "pid,_flag,note")
    stream = csv_stream(spark, f"{base}/drop", ["pid", "_flag", "note"], "pid")
    ingest(stream, lambda batch: batch.drop(FILE_COL), f"{base}/sink", f"{base}/ckpt").awaitTermination()
    return spark.read.parquet(f"{base}/sink").drop("batch_id")


def _load_registry(spark, d, make):
    """The registry that ``make(folder)`` opens, loaded from CSV extracts of customers and orders."""
    from wardline.plans import Loader

    base = _scratch(spark, "wardline_registry")
    cust = read_table(spark, d, "customer").select(F.concat_ws(",", "c_custkey", "c_nationkey", "c_mktsegment"))
    orders = read_table(spark, d, "orders").select(F.concat_ws(
        ",", "o_custkey", F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'"), "o_orderpriority", "o_orderstatus", "o_orderkey"))
    _publish(spark, cust, f"{base}/extracts", "customers", "pid,age,sex")
    _publish(spark, orders, f"{base}/extracts", "orders", "pid,when,kind,status,order_key")
    loader = Loader(spark, f"{base}/extracts", "pid", make(f"{base}/registry"), conflicts="ignore")
    loader.add_patients()
    loader.add_events("when", "orders", {"event_type": "kind", "component": "status"})
    return loader.registry


_REGISTRIES: dict = {}


def _registry(spark, d):
    """(events as loaded, the registry after a delete): built once per session and folder, and read by three queries."""
    at = (spark.sparkContext.applicationId, d)
    if at not in _REGISTRIES:
        from wardline.plans import Registry

        reg = _load_registry(spark, d, lambda folder: Registry(spark, folder))
        events = reg.read("events")                      # of this snapshot: the delete writes the next one
        reg.delete_patients(reg.read("patients").where(F.col("patient_id").cast("long") % 10 == 0).select("patient_id"))
        _REGISTRIES[at] = events, reg
    return _REGISTRIES[at]


def q_registry_events(spark, d):
    ev = _registry(spark, d)[0]
    return ev.select("patient_id", "event_type", "component", "event_date", "event_time", F.col("extra")["order_key"].alias("order_key"))


def q_registry_delete(spark, d):
    """Documents after a delete: patients, and the children that are left."""
    return _registry(spark, d)[1].documents().select("patient_id", "age", "gender", "n_events", "first_events", "last_events")


def q_registry_bucketed(spark, d):
    """The same load and delete in bucketed tables, with a second load of the patients, which adds none."""
    from wardline.plans import BucketedRegistry

    reg = _load_registry(spark, d, lambda folder: BucketedRegistry(spark, folder, buckets=8, parts=2))
    if reg.add_patients(reg.read("patients")).count():
        raise AssertionError("insert-if-absent added a patient twice")
    reg.delete_patients(reg.read("patients").where(F.col("patient_id").cast("long") % 10 == 0).select("patient_id"))
    return reg.documents().select("patient_id", "age", "gender", "n_events", "first_events", "last_events")


def q_audit_rows(spark, d):
    return _registry(spark, d)[1].read("audit").select("op", "entity_id", "message")


def q_rejects(spark, d):
    """Cells that are not numbers, suffixes that other parsers accept included."""
    key = F.col("o_orderkey")
    code = F.when(key % 5 == 0, "Y").when(key % 7 == 0, F.concat(key, F.lit("d"))).when(key % 11 == 0, F.concat(key, F.lit("F"))).otherwise(key.cast("string"))
    rows = read_table(spark, d, "orders").select(key.alias("order"), code.alias("code"), F.col("o_totalprice").alias("total.price"))
    return unreadable_numbers(rows, "order", ["code", "total.price"])


def q_number_keys(spark, d):
    """Comparison keys: numbers as numbers, text with number suffixes as text, long whole numbers exactly."""
    key = F.col("o_orderkey")
    files = [("plain", key.cast("string")), ("other", F.when(key % 3 == 0, F.concat(F.lit(" "), key, F.lit(".0")))
             .when(key % 3 == 1, F.concat(key, F.lit("d"))).otherwise(key.cast("string")))]
    big = F.concat(F.lit("90071992547409"), F.lpad((key % 100).cast("string"), 2, "0"))
    files += [("big", big), ("bigger", F.when(key % 2 == 0, F.concat(F.lit("0"), big)).otherwise((big.cast("long") + 1).cast("string")))]
    sources = [from_table(read_table(spark, d, "orders").select("o_orderkey", v.alias("big_v" if n.startswith("big") else "v")),
                          "patient_id", source_id="o_orderkey", file=n) for n, v in files]
    agg = entity_aggregates(SourceSet(sources), {"v": Single(("v$",)), "big": Single(("big_v$",))}, conflicts="ignore")
    return agg.select("patient_id", F.col("v__entity_conflict").alias("differs"), F.col("big__entity_conflict").alias("big_differs"))


def _children(spark, d):
    events = read_table(spark, d, "orders").select("o_custkey", F.date_format("o_orderdate", "d/M/yyyy HH:mm").alias("when"), "o_orderpriority", "o_orderstatus")
    ev = build_events(events, "o_custkey", "when", {"event_type": "o_orderpriority", "destination": "o_orderstatus"})
    m = build_measurements(read_table(spark, d, "lineitem").select("l_suppkey", "l_quantity", "l_returnflag"), "l_suppkey",
                           ["l_quantity", "l_returnflag"], ["continuous", "discrete"])
    stays = read_table(spark, d, "supplier").select("s_suppkey", "s_name", (F.col("s_nationkey") / 2).alias("days"))
    cc = build_critical_care(stays, "s_suppkey", request_location="s_name", icu_days="days")
    links, _, _ = build_comorbidities(read_table(spark, d, "labels"), "doc_id", conflicts="merge")
    return {"events": ev, "measurements": m, "critical_care": cc, "comorbidities": links}


def q_patient_children(spark, d):
    return patient_children(**_children(spark, d))


def q_patient_pages(spark, d):
    """Documents of at most 40 children a page: events, measurements, stays and conditions in order of time."""
    pages = patient_pages(patient_children(**_children(spark, d)), page_size=40)
    shown = F.transform("children", lambda c: F.concat_ws("/", F.coalesce(F.date_format(c["date"], "yyyy-MM-dd"), F.lit("-")), c["child"], c["name"], F.coalesce(c["value"], F.lit("-"))))
    return pages.select("patient_id", "page", "first_position", "n_children", "first_date", "last_date", F.array_join(shown, ";").alias("children"))


def _median_of_modes():
    """The middle (or the mean of the two in the middle) of the values that come most often."""
    def reduce(state, values):
        for v in values:
            state[v] = state.get(v, 0) + 1
        return state

    def merge(a, b):
        for v, n in b.items():
            a[v] = a.get(v, 0) + n
        return a

    def finish(state):
        most = max(state.values())
        modes = sorted(v for v, n in state.items() if n == most)
        return (modes[(len(modes) - 1) // 2] + modes[len(modes) // 2]) / 2

    return UserAggregate(dict, reduce, merge, finish)


def q_custom_correction(spark, d):
    """A correction in Python, as states that merge: the median of the most frequent price classes over a customer's files."""
    orders = read_table(spark, d, "orders").select("o_custkey", "o_orderpriority", F.floor(F.col("o_totalprice") / 50000).alias("price_class"))
    sources = SourceSet([from_table(orders, "patient_id", source_id="o_custkey", file_column="o_orderpriority")])
    return corrected_values(sources, _median_of_modes(), ["price_class$"])


def q_fuzzy_existing(spark, d):
    """A second load: half of the names are dictionary keys already, the others are matched to them."""
    part = read_table(spark, d, "part")
    known = part.where(F.col("p_partkey") % 2 == 0).select(F.concat("p_name", F.lit("s")).alias("name")).unionByName(
        part.where(F.col("p_partkey") % 3 == 0).select(F.col("p_name").alias("name"))).distinct()
    r = resolve_names(part, 0, existing=known, conflicts="merge", name_col="p_name")
    return r.select(F.col("name").alias("p_name"), "comorb_key", "action")


def _typo(c):
    """Names of a line, every second with its first letter twice."""
    return F.when(F.col("p_partkey") % 2 == 0, c).otherwise(F.concat(F.substring(c, 1, 1), c))


def q_fuzzy_document(spark, d):
    """Document policy: a name with one similar key is merged into it; names that start alike stay apart."""
    names = read_table(spark, d, "part").select(_typo(F.col("p_brand")).alias("name"), "p_brand").distinct()
    r = resolve_names(names, 1, existing=names.select(F.col("p_brand").alias("name")).distinct(), conflicts="merge", policy="document")
    return r.select("name", "comorb_key", "action")


def q_fuzzy_document_ignore(spark, d):
    names = read_table(spark, d, "part").select(_typo(F.col("p_name")).alias("name"))
    return resolve_names(names, 1, conflicts="ignore", policy="document").select("name", "comorb_key", "action")


def q_fuzzy_customers(spark, d):
    """Names that share a long prefix: only those one edit apart pair up."""
    return similar_pairs(read_table(spark, d, "customer"), 1, "c_name").withColumn("distance", F.col("distance").cast("bigint"))


def q_validate_required(spark, d):
    orders = read_table(spark, d, "orders")
    text = F.when(F.col("o_orderkey") % 6 == 0, " N/A ").when(F.col("o_orderkey") % 7 == 0, "nan").when(F.col("o_orderkey") % 8 == 0, "").otherwise(F.col("o_orderstatus"))
    rows = orders.select("o_orderkey", null_tokens(text).alias("status"))
    return missing_required(rows, ["status"]).select("o_orderkey")


def q_measurement_continuous(spark, d):
    return measurements_of_type(_typed(spark, d), "continuous").select("patient_id", "result_name", "result")


def q_measurement_complex(spark, d):
    m = measurements_of_type(_typed(spark, d), "complex")
    return m.select("patient_id", "result_name", F.array_join("result", "|").alias("result"))


def q_corrected_reload(spark, d):
    """Ages as text, corrected to each patient's greatest (as numbers), written, read again and selected by file name."""
    base = _scratch(spark, "wardline_corrected")
    for stem, step in (("ages_first", 1), ("ages_second", 90)):
        rows = read_table(spark, d, "customer").select(F.concat_ws(",", "c_custkey", (F.col("c_nationkey") * step).cast("string"), "c_name"))
        _publish(spark, rows, f"{base}/extracts", stem, "pid,age,name")
    sources = load_directory(spark, f"{base}/extracts", "pid")
    fixed = apply_correction(sources, corrected_values(sources, F.max))
    write_sources(fixed, f"{base}/out")
    back = load_keyword(read_sources(spark, f"{base}/out", "pid"), "SECOND")
    return back.select("pid", F.col("age").cast("double").alias("age"), "name")


def q_comorbidities_similar(spark, d):
    """Headers that resemble each other: a later one is linked to the first key it resembles."""
    wide = read_table(spark, d, "labels").select("doc_id", F.col("quality").alias("asthma"), F.col("toxic").alias("asthmas"),
                                                 F.col("toxic").alias("diabetes"), (1 - F.col("quality")).alias("_fracture"))
    links, _, _ = build_comorbidities(wide, "doc_id", edit_threshold=1, conflicts="merge")
    return links


def q_label_normalise(spark, d):
    cust = read_table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("patient_id"),
                                                   F.lit("customer").alias("source"),
                                                   F.col("c_mktsegment").alias("raw"))
    lab = read_table(spark, d, "labels").select(F.col("doc_id").cast("string").alias("patient_id"),
                                                F.lit("labels").alias("source"),
                                                F.col("quality").cast("string").alias("raw"))
    both = cust.unionByName(lab)
    return both.withColumn("label", normalise_gender("raw", {0: "M", 1: "F"}, entity="patient_id"))


def q_single_value_ignore(spark, d):
    sources = SourceSet([_customer(spark, d), _orders(spark, d, columns=["o_orderstatus"])])
    agg = entity_aggregates(sources, {"status": Single(("o_orderstatus",))}, conflicts="ignore")
    return agg.select("patient_id", "status", F.col("status__file_conflicts").alias("n_conflicting_files"),
                      F.col("status__entity_conflict").alias("entity_conflict"))


def q_conflict_report(spark, d):
    sources = SourceSet([_orders(spark, d, columns=["o_orderstatus"])])
    rep = conflict_report(sources, {"status": Single(("o_orderstatus",))})
    return rep.withColumnRenamed(FILE_COL, "source_file")


def q_multi_value(spark, d):
    return multi_values(SourceSet([_events(spark, d)]), ["event_type"])


_STATUS = dict(positive=["^purchase$"], negative=["^view$", "^click$"], suspected=["signup"])


def q_tri_state(spark, d):
    agg = entity_aggregates(SourceSet([_events(spark, d)]), {"covid": classes(["event_type"], **_STATUS)})
    return agg.select("patient_id", tri_state(F.col("covid__positive"), F.col("covid__negative"),
                                              F.col("covid__suspected")).alias("covid"))


def q_flag_any_match(spark, d):
    sources = SourceSet([_customer(spark, d), _orders(spark, d, columns=["o_orderstatus"])])
    return entity_aggregates(sources, {"died": AnyMatch("urgent", "o_orderstatus", ("f",))})


def q_flag_presence(spark, d):
    sources = SourceSet([_customer(spark, d), _orders(spark, d, columns=["o_orderstatus"])])
    return entity_aggregates(sources, {"cc_presence": Presence("high"),
                                       "cc_value": ValueEquals("low", "o_orderstatus", "O")})


_BASICS = dict(age_search_terms=["c_nationkey$"], gender_search_terms=["o_orderstatus$"], covid_search_terms=["event_type$"],
               covid_status_search_terms=_STATUS, death_search_terms=["f"], death_column="o_orderstatus", death_file="urgent",
               critical_care_file="high", critical_care_column="o_orderstatus", critical_care_pos_value="O")


def q_patients_basics(spark, d):
    sources = SourceSet([_customer(spark, d), _orders(spark, d, columns=["o_orderstatus"]), _events(spark, d)])
    return build_patients(sources, conflicts="ignore", **_BASICS)


def q_patients_incremental(spark, d):
    """The flagship over three drops of files: only the entities of a drop are decided again."""
    variables, basics = patient_rules(**_BASICS)
    store = ResolvedStore(spark, _scratch(spark, "wardline_resolved"), variables, basics, buckets=16)
    orders = _orders(spark, d, columns=["o_orderstatus"])
    files = lambda *names: orders.with_df(orders.df.where(F.col(FILE_COL).isin(*names)))
    store.add(SourceSet([_customer(spark, d), files("1-URGENT", "2-HIGH")]))
    store.add(SourceSet([files("3-MEDIUM", "4-NOT SPECIFIED")]))
    store.add(SourceSet([files("5-LOW"), _events(spark, d)]))
    return store.current()


def q_stream_resolve(spark, d):
    """Order rows arrive in micro-batches: the decision per entity after the last one, and the batch that last changed it."""
    from wardline.streaming import resolve_stream

    base = _scratch(spark, "wardline_stream")
    orders = read_table(spark, d, "orders").select("o_custkey", "o_orderpriority", "o_orderstatus")
    orders.repartition(6, "o_custkey", "o_orderpriority", "o_orderstatus").write.parquet(f"{base}/drop")
    rows = spark.readStream.schema(orders.schema).option("maxFilesPerTrigger", 2).parquet(f"{base}/drop")
    source = from_table(rows, "patient_id", source_id="o_custkey", file_column="o_orderpriority")
    store = ResolvedStore(spark, f"{base}/store", {"status": Single(("o_orderstatus",))}, buckets=16)
    resolve_stream(source, store, f"{base}/ckpt").awaitTermination()
    return store.current().withColumnsRenamed({"status__file_conflicts": "n_conflicting_files", "status__entity_conflict": "entity_conflict"})


def q_patients_as_of(spark, d):
    """Customers loaded at three times, field by field, then some deleted: what was valid at a time between the loads and after them."""
    import datetime as dt

    table = HistoryTable(spark, _scratch(spark, "wardline_history"), "patient_id string, age int, gender string, covid string",
                         unknown={"gender": ["U"]})
    cust, key = read_table(spark, d, "customer"), F.col("c_custkey")
    pid = key.cast("string").alias("patient_id")
    gender = F.when(key % 4 == 0, "M").when(key % 4 == 1, "F").when(key % 4 == 2, "U")
    table.upsert(cust.where(key % 3 != 0).select(pid, F.col("c_nationkey").alias("age"), gender.alias("gender")), dt.datetime(2024, 1, 1))
    age = F.when(key % 5 != 0, F.col("c_nationkey") + key % 2)
    table.upsert(cust.where(key % 4 < 2).select(pid, age.alias("age"), F.when(key % 6 == 0, "U").otherwise("F").alias("gender")), dt.datetime(2024, 2, 1))
    seen = read_table(spark, d, "orders").groupBy(F.col("o_custkey").cast("string").alias("patient_id"))
    table.upsert(seen.agg(F.when(F.max("o_orderstatus") == "P", "P").alias("covid")), dt.datetime(2024, 3, 1))
    table.delete(cust.where(key % 11 == 0).select(pid), dt.datetime(2024, 4, 1))
    at = lambda *day: table.as_of(dt.datetime(*day)).withColumn("as_of", F.lit("-".join(map(str, day))))
    rows = at(2024, 1, 15).unionByName(at(2024, 2, 15)).unionByName(at(2024, 5, 1))
    return rows.withColumn("valid_from", F.col("valid_from").cast("date"))


def q_entity_lookup(spark, d):
    """Orders as CSV files of neighbouring customers; the suppliers' ids are looked up, and only files that can hold one are opened."""
    base = _scratch(spark, "wardline_lookup")
    orders = read_table(spark, d, "orders").select(F.col("o_custkey").alias("pid"), F.col("o_orderkey").alias("order_key"), F.col("o_orderstatus").alias("status"))
    orders.repartitionByRange(12, "pid").write.option("header", True).csv(f"{base}/extracts")
    sources = load_directory(spark, f"{base}/extracts", "pid")
    index = PresenceIndex(spark, f"{base}/presence", bits=20)
    index.add(sources)
    return union_sources(index.lookup(sources, read_table(spark, d, "supplier").select("s_suppkey"))).drop(FILE_COL)


def q_load_with_rejects(spark, d):
    """Orders checked once: accepted and rejected rows, the latter with every reason."""
    key = F.col("o_orderkey")
    rows = read_table(spark, d, "orders").select(
        F.when(key % 13 != 0, F.col("o_custkey").cast("string")).alias("patient_id"), F.col("o_orderpriority").alias("event_type"),
        F.when(key % 10 != 0, F.col("o_orderdate").cast("date")).alias("event_date"),
        F.when(key % 3 == 0, F.col("o_orderstatus")).alias("covid_status"),
        F.concat(F.col("o_totalprice").cast("decimal(12,2)").cast("string"), F.when(key % 7 == 0, "d").otherwise("")).alias("price"), key.alias("order_key"))
    checks = table_checks("events", rows.columns) | {"price is no number": not_a_number("price")}
    accepted, rejected, counts = route_rows(rows, checks, _scratch(spark, "wardline_rejects"))
    if counts["rejected"] + counts["accepted"] < 1:
        raise AssertionError("no row was counted")
    return accepted.withColumn("reasons", F.lit("")).unionByName(rejected.withColumn("reasons", F.array_join("reasons", "; ")))


def q_insert_if_absent(spark, d):
    existing = read_table(spark, d, "supplier").select(F.col("s_suppkey").cast("string").alias("patient_id"),
                                                       F.col("s_name").alias("name"), F.lit("existing").alias("origin"))
    new = read_table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("patient_id"),
                                                  F.col("c_name").alias("name"), F.lit("new").alias("origin"))
    return insert_if_absent(existing, new)


def q_missing_parents(spark, d):
    return missing_parents(read_table(spark, d, "events"), read_table(spark, d, "supplier"), "user_id", "s_suppkey")


def q_events_build(spark, d):
    orders = read_table(spark, d, "orders").withColumn("event_day", render_date(F.col("o_orderdate").cast("date")))
    customers = read_table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("patient_id"))
    ev = build_events(orders, "o_custkey", "event_day",
                      {"event_type": "o_orderpriority", "component": "o_orderstatus"},
                      exclude_columns=["o_totalprice"], patients=customers)
    return ev.select(*[c for c in ev.columns if c != "extra"], F.col("extra")["o_orderkey"].alias("order_key"))


_REF = {"l_quantity": (1.0, 50.0), "l_extendedprice": (0.0, 100000.0)}


def q_measurements_long(spark, d):
    li = read_table(spark, d, "lineitem").withColumn("shipped", F.date_format("l_shipdate", "d/M/yyyy HH:mm"))
    m = build_measurements(li, "l_orderkey", list(_REF), ["continuous", "continuous"], result_datetime="shipped",
                           ref_ranges=list(_REF.values()), request_source="l_linestatus")
    return m.select("patient_id", "result_name", "result_type", "result_double", "result_date", "result_time",
                    "request_source", F.col("ref_range")[0].alias("ref_low"), F.col("ref_range")[1].alias("ref_high"))


def _typed(spark, d):
    li = read_table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_returnflag")
    part = read_table(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    wide = li.join(part, "l_partkey")
    return build_measurements(wide, "l_orderkey", ["l_quantity", "l_returnflag", "p_name"],
                              ["continuous", "discrete", "complex"], complex_result_split_char=" ")


def q_measurements_typed(spark, d):
    m = _typed(spark, d)
    return m.select("patient_id", "result_name", "result_type", "result_double", "result_string",
                    F.array_join("result_array", "|").alias("result_parts"),
                    F.array_size("result_array").cast("bigint").alias("n_parts"))


def q_measurement_subtype(spark, d):
    return measurements_of_type(_typed(spark, d), "discrete").select("patient_id", "result_name", "result")


def q_measurement_split(spark, d):
    part = read_table(spark, d, "part")
    parts = split_literal("p_name", " ")
    return part.select("p_partkey", F.array_join(parts, "|").alias("parts_joined"),
                       F.array_size(parts).cast("bigint").alias("n_parts"))


def q_critical_care_build(spark, d):
    orders = read_table(spark, d, "orders")
    shipped = (read_table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.max("l_shipdate").alias("last_ship")))
    stays = orders.join(shipped, orders.o_orderkey == shipped.l_orderkey).select(
        "o_custkey", "o_orderpriority",
        F.date_format("o_orderdate", "d/M/yyyy HH:mm").alias("admitted"),
        F.date_format("last_ship", "d/M/yyyy HH:mm").alias("discharged"),
        F.datediff(F.col("last_ship").cast("date"), F.col("o_orderdate").cast("date")).cast("string").alias("days"),
        F.coalesce(label_map(F.col("o_orderstatus"), {"F": "Y", "O": "N"}), F.lit("U")).alias("vent"))
    cc = build_critical_care(stays, "o_custkey", "admitted", "discharged", request_location="o_orderpriority",
                             icu_days="days", ventilated="vent")
    return cc.drop("extra")


def q_onehot_melt(spark, d):
    return melt_onehot(read_table(spark, d, "labels"), "doc_id")


def q_fuzzy_pairs(spark, d):
    pairs = similar_pairs(read_table(spark, d, "part"), 2, "p_name")
    return pairs.withColumn("distance", F.col("distance").cast("bigint"))


def _resolve(spark, d, conflicts):
    r = resolve_names(read_table(spark, d, "part"), 3, conflicts=conflicts, name_col="p_name")
    return r.select(F.col("name").alias("p_name"), "comorb_key", "n_similar")


def q_fuzzy_resolve_merge(spark, d):
    return _resolve(spark, d, "merge")


def q_fuzzy_resolve_ignore(spark, d):
    return _resolve(spark, d, "ignore")


def q_cascade_delete(spark, d):
    customer = read_table(spark, d, "customer").withColumn("patient_id", F.col("c_custkey").cast("string"))
    orders = read_table(spark, d, "orders").withColumn("patient_id", F.col("o_custkey").cast("string"))
    doomed = customer.where(F.col("c_mktsegment") == "MACHINERY").select("patient_id")
    kept = cascade_delete({"patients": customer, "events": orders}, doomed)
    return kept["events"].select("o_orderkey", "patient_id")


def q_patient_document(spark, d):
    patients = read_table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("patient_id"), "c_name")
    events = read_table(spark, d, "orders").select(F.col("o_custkey").cast("string").alias("patient_id"),
                                                   F.col("o_orderdate").cast("date").alias("event_date"))
    return patient_documents(patients, events)


def q_value_correction(spark, d):
    orders = from_table(read_table(spark, d, "orders"), "patient_id", source_id="o_custkey", file="orders",
                        columns=["o_orderkey", "o_totalprice"])
    sources = SourceSet([orders])
    fixed = corrected_values(sources, F.max, ["o_totalprice$"])
    out = apply_correction(sources, fixed, ["o_totalprice$"]).sources[0].df
    return out.select("o_orderkey", "patient_id", F.col("o_totalprice").cast("double").alias("o_totalprice"))


def q_comorbidities_build(spark, d):
    links, _, _ = build_comorbidities(read_table(spark, d, "labels"), "doc_id", edit_threshold=2, conflicts="merge")
    return links


def q_validate_choices(spark, d):
    return invalid_choices(read_table(spark, d, "orders"), "o_orderstatus", ["F", "O"]).select("o_orderkey", "o_orderstatus")


def q_validate_unique(spark, d):
    return duplicate_keys(read_table(spark, d, "part"), ["p_name"])


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "filter_columns": q_filter_columns,
    "source_union": q_source_union,
    "entity_index": q_entity_index,
    "parse_datetime": q_parse_datetime,
    "concat_datetime": q_concat_datetime,
    "entity_spine": q_entity_spine,
    "gather_values": q_gather_values,
    "csv_ingest": q_csv_ingest,
    "events_stream": q_events_stream,
    "registry_patients": q_registry_patients,
    "label_normalise": q_label_normalise,
    "single_value_ignore": q_single_value_ignore,
    "conflict_report": q_conflict_report,
    "multi_value": q_multi_value,
    "tri_state": q_tri_state,
    "flag_any_match": q_flag_any_match,
    "flag_presence": q_flag_presence,
    "patients_basics": q_patients_basics,
    "patients_incremental": q_patients_incremental,
    "stream_resolve": q_stream_resolve,
    "patients_as_of": q_patients_as_of,
    "entity_lookup": q_entity_lookup,
    "load_with_rejects": q_load_with_rejects,
    "insert_if_absent": q_insert_if_absent,
    "missing_parents": q_missing_parents,
    "events_build": q_events_build,
    "measurements_long": q_measurements_long,
    "measurements_typed": q_measurements_typed,
    "measurement_subtype": q_measurement_subtype,
    "measurement_split": q_measurement_split,
    "critical_care_build": q_critical_care_build,
    "onehot_melt": q_onehot_melt,
    "fuzzy_pairs": q_fuzzy_pairs,
    "fuzzy_resolve_merge": q_fuzzy_resolve_merge,
    "fuzzy_resolve_ignore": q_fuzzy_resolve_ignore,
    "cascade_delete": q_cascade_delete,
    "patient_document": q_patient_document,
    "value_correction": q_value_correction,
    "comorbidities_build": q_comorbidities_build,
    "validate_choices": q_validate_choices,
    "validate_unique": q_validate_unique,
    "csv_awkward": q_csv_awkward,
    "csv_quoted_split": q_csv_quoted_split,
    "csv_awkward_stream": q_csv_awkward_stream,
    "registry_events": q_registry_events,
    "registry_delete": q_registry_delete,
    "registry_bucketed": q_registry_bucketed,
    "audit_rows": q_audit_rows,
    "rejects": q_rejects,
    "number_keys": q_number_keys,
    "patient_children": q_patient_children,
    "patient_pages": q_patient_pages,
    "custom_correction": q_custom_correction,
    "fuzzy_existing": q_fuzzy_existing,
    "fuzzy_document": q_fuzzy_document,
    "fuzzy_document_ignore": q_fuzzy_document_ignore,
    "fuzzy_customers": q_fuzzy_customers,
    "validate_required": q_validate_required,
    "measurement_continuous": q_measurement_continuous,
    "measurement_complex": q_measurement_complex,
    "corrected_reload": q_corrected_reload,
    "comorbidities_similar": q_comorbidities_similar,
}


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: patient basics over customer, orders-by-priority and events at sf0.001."""
    return q_patients_basics(spark, SMOKE_DIR)


def _llm() -> tuple[dict, dict]:
    """Queries and SQL of the training-data operators; none where their folder is absent."""
    try:
        import corpus_pipeline
        from wardline.llm import queries as llm
    except ModuleNotFoundError as e:
        if e.name not in ("corpus_pipeline", "wardline.llm", "wardline.llm.queries"):
            raise
        return {}, {}
    sql = dict(llm.SQL)
    if corpus_pipeline.ORACLE_SQL is not None:
        sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return {**llm.QUERIES, "pipeline": corpus_pipeline.run}, sql


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**_QUERIES, **_llm()[0]}


# ---------------------------------------------------------------- oracles
_SPINE3 = """spine as (select cast(c_custkey as varchar) pid from customer
                union select cast(o_custkey as varchar) from orders
                union select cast(user_id as varchar) from events)"""
_SPINE2 = """spine as (select cast(c_custkey as varchar) pid from customer
                union select cast(o_custkey as varchar) from orders)"""

_DICT = """with recursive n as (select p_name, row_number() over (order by p_name) i
                     from (select distinct p_name from part)),
st as (select 0::bigint i, []::varchar[] keys, null::varchar p_name, []::varchar[] sim
  union all
  select n.i,
         case when len(list_filter(st.keys, lambda k: levenshtein(k, n.p_name) <= 3)) = 0
              then list_append(st.keys, n.p_name) else st.keys end,
         n.p_name,
         list_filter(st.keys, lambda k: levenshtein(k, n.p_name) <= 3)
  from st join n on n.i = st.i + 1)
select p_name, {key} as comorb_key, len(sim)::bigint as n_similar from st where i > 0"""

_SQL = {
    "filter_columns": "select l_orderkey, l_linenumber, l_extendedprice, l_shipdate from lineitem",
    "source_union": """
        select cast(c_custkey as varchar) as patient_id, c_name, c_nationkey, c_acctbal, c_mktsegment,
               'customer_accounts.csv' as source_file, null::varchar as s_name, null::integer as s_nationkey,
               null::double as s_acctbal from customer
        union all
        select cast(s_suppkey as varchar), null, null, null, null, 'supplier_accounts.csv', s_name, s_nationkey,
               s_acctbal from supplier""",
    "entity_index": """
        select cast(c_custkey as varchar) as patient_id, 'customer' as source_file, count(*) as n_rows
        from customer group by 1
        union all
        select cast(o_custkey as varchar), o_orderpriority, count(*) from orders group by 1, 2""",
    "parse_datetime": """
        select event_id, cast(ts as date) as event_date,
               case when event_type = 'error' then null
                    else cast(hour(ts) * 60 + minute(ts) as double) end as event_time,
               strftime(ts, '%-d/%-m/%Y') as date_text
        from events""",
    "concat_datetime": """
        select event_id, strftime(ts, '%-d/%-m/%Y') || ' ' || strftime(ts, '%H:%M') as event_datetime,
               cast(ts as date) as event_date, cast(hour(ts) * 60 + minute(ts) as double) as event_time
        from events""",
    "entity_spine": """
        select cast(c_custkey as varchar) as patient_id from customer
        union select cast(o_custkey as varchar) from orders
        union select cast(user_id as varchar) from events""",
    "gather_values": """
        select distinct cast(o_custkey as varchar) as patient_id, o_orderpriority as source_file,
               o_orderstatus as value from orders""",
    "csv_ingest": """
        select cast(o_custkey as varchar) as patient_id, o_orderstatus as component,
               trim(o_orderpriority) as event_type, cast(o_orderdate as date) as event_date,
               null::double as event_time, 'U' as covid_status, 0 as death, 0 as critical_care_admission,
               null::varchar as source, null::varchar as source_type, null::varchar as destination,
               null::integer as wimd, cast(o_orderkey as varchar) as order_key
        from orders""",
    "events_stream": """
        select cast(o_custkey as varchar) as patient_id, o_orderstatus as component,
               trim(o_orderpriority) as event_type, cast(o_orderdate as date) as event_date,
               null::double as event_time, 'U' as covid_status, 0 as death, 0 as critical_care_admission,
               null::varchar as source, null::varchar as source_type, null::varchar as destination,
               null::integer as wimd, cast(o_orderkey as varchar) as order_key
        from orders""",
    "registry_patients": """
        select cast(c_custkey as varchar) as patient_id, c_nationkey as age,
               case when regexp_matches(c_mktsegment, '^m', 'i') then 'M'
                    when regexp_matches(c_mktsegment, '^f', 'i') then 'F' else 'U' end as gender,
               'U' as covid, 0 as died, 0 as critical_care_stay
        from customer""",
    "label_normalise": """
        select cast(c_custkey as varchar) as patient_id, 'customer' as source, c_mktsegment as raw,
               case when regexp_matches(c_mktsegment, '^m', 'i') then 'M'
                    when regexp_matches(c_mktsegment, '^f', 'i') then 'F' else 'U' end as label
        from customer
        union all
        select cast(doc_id as varchar), 'labels', cast(quality as varchar),
               case quality when 0 then 'M' when 1 then 'F' end
        from labels""",
    "single_value_ignore": f"""
        with {_SPINE2},
        f as (select cast(o_custkey as varchar) pid, o_orderpriority, min(o_orderstatus) lo, max(o_orderstatus) hi
              from orders group by 1, 2),
        e as (select pid, min(case when lo = hi then lo end) lo, max(case when lo = hi then hi end) hi,
                     sum(case when lo <> hi then 1 else 0 end)::bigint nf
              from f group by pid)
        select spine.pid as patient_id, case when e.lo = e.hi then e.lo end as status,
               coalesce(e.nf, 0)::bigint as n_conflicting_files, coalesce(e.lo <> e.hi, false) as entity_conflict
        from spine left join e using (pid)""",
    "conflict_report": """
        with r as (select distinct cast(o_custkey as varchar) pid, o_orderpriority f, o_orderstatus v from orders),
        c as (select *, count(*) over (partition by pid, f) n from r),
        clean as (select *, min(v) over (partition by pid) lo, max(v) over (partition by pid) hi
                  from c where n = 1)
        select pid as patient_id, 'file' as level, f as source_file, 'status' as variable, v as value
        from c where n > 1
        union all
        select pid, 'entity', f, 'status', v from clean where lo <> hi""",
    "multi_value": "select distinct cast(user_id as varchar) as patient_id, trim(event_type) as value from events",
    "tri_state": """
        select cast(user_id as varchar) as patient_id,
               case when bool_or(lower(event_type) = 'purchase') then 'P'
                    when bool_or(lower(event_type) in ('view', 'click'))
                         and not bool_or(regexp_matches(event_type, '^signup', 'i')) then 'N'
                    else 'U' end as covid
        from events group by 1""",
    "flag_any_match": f"""
        with {_SPINE2},
        d as (select cast(o_custkey as varchar) pid,
                     max(case when regexp_matches(o_orderstatus, '^f', 'i') then 1 else 0 end) died
              from orders where lower(o_orderpriority) like '%urgent%' group by 1)
        select spine.pid as patient_id, coalesce(d.died, 0) as died from spine left join d using (pid)""",
    "flag_presence": f"""
        with {_SPINE2}
        select spine.pid as patient_id,
               case when exists (select 1 from orders o where cast(o.o_custkey as varchar) = spine.pid
                                 and lower(o.o_orderpriority) like '%high%') then 1 else 0 end as cc_presence,
               case when exists (select 1 from orders o where cast(o.o_custkey as varchar) = spine.pid
                                 and lower(o.o_orderpriority) like '%low%' and o.o_orderstatus = 'O')
                    then 1 else 0 end as cc_value
        from spine""",
    "patients_basics": f"""
        with {_SPINE3},
        age as (select cast(c_custkey as varchar) pid, min(c_nationkey) lo, max(c_nationkey) hi from customer group by 1),
        gf as (select cast(o_custkey as varchar) pid, o_orderpriority, min(o_orderstatus) lo, max(o_orderstatus) hi
               from orders group by 1, 2),
        g as (select pid, min(case when lo = hi then lo end) lo, max(case when lo = hi then hi end) hi
              from gf group by pid),
        cv as (select cast(user_id as varchar) pid, bool_or(lower(event_type) = 'purchase') pos,
                      bool_or(lower(event_type) in ('view', 'click')) neg,
                      bool_or(regexp_matches(event_type, '^signup', 'i')) susp
               from events group by 1),
        d as (select cast(o_custkey as varchar) pid,
                     max(case when regexp_matches(o_orderstatus, '^f', 'i') then 1 else 0 end) died
              from orders where lower(o_orderpriority) like '%urgent%' group by 1),
        cc as (select cast(o_custkey as varchar) pid, max(case when o_orderstatus = 'O' then 1 else 0 end) cc
               from orders where lower(o_orderpriority) like '%high%' group by 1)
        select spine.pid as patient_id,
               (case when age.lo = age.hi then age.lo end)::integer as age,
               case when g.lo = g.hi then
                    case when regexp_matches(g.lo, '^m', 'i') then 'M'
                         when regexp_matches(g.lo, '^f', 'i') then 'F' else 'U' end
                    else 'U' end as gender,
               case when cv.pos then 'P' when cv.neg and not cv.susp then 'N' else 'U' end as covid,
               coalesce(d.died, 0)::integer as died, coalesce(cc.cc, 0)::integer as critical_care_stay
        from spine left join age using (pid) left join g using (pid) left join cv using (pid)
             left join d using (pid) left join cc using (pid)""",
    "insert_if_absent": """
        select cast(s_suppkey as varchar) as patient_id, s_name as name, 'existing' as origin from supplier
        union all
        select cast(c_custkey as varchar), c_name, 'new' from customer c
        where not exists (select 1 from supplier s where s.s_suppkey = c.c_custkey)""",
    "missing_parents": """
        select cast(user_id as varchar) as patient_id, count(*) as n_rows from events e
        where not exists (select 1 from supplier s where s.s_suppkey = e.user_id) group by 1""",
    "events_build": """
        select cast(o_custkey as varchar) as patient_id, o_orderstatus as component,
               trim(o_orderpriority) as event_type, cast(o_orderdate as date) as event_date,
               null::double as event_time, 'U' as covid_status, 0 as death, 0 as critical_care_admission,
               null::varchar as source, null::varchar as source_type, null::varchar as destination,
               null::integer as wimd, cast(o_orderkey as varchar) as order_key
        from orders""",
    "measurements_long": """
        select cast(l_orderkey as varchar) as patient_id, result_name, 'continuous' as result_type, result_double,
               cast(l_shipdate as date) as result_date,
               cast(hour(l_shipdate) * 60 + minute(l_shipdate) as double) as result_time,
               l_linestatus as request_source,
               case result_name when 'l_quantity' then 1.0::double else 0.0::double end as ref_low,
               case result_name when 'l_quantity' then 50.0::double else 100000.0::double end as ref_high
        from (unpivot (select l_orderkey, l_shipdate, l_linestatus, l_quantity, l_extendedprice from lineitem)
              on l_quantity, l_extendedprice into name result_name value result_double)""",
    "measurements_typed": """
        with w as (select l_orderkey, l_quantity, l_returnflag, p_name from lineitem join part on l_partkey = p_partkey)
        select cast(l_orderkey as varchar) as patient_id, 'l_quantity' as result_name, 'continuous' as result_type,
               l_quantity as result_double, null::varchar as result_string, null::varchar as result_parts,
               null::bigint as n_parts from w
        union all
        select cast(l_orderkey as varchar), 'l_returnflag', 'discrete', null, l_returnflag, null, null from w
        union all
        select cast(l_orderkey as varchar), 'p_name', 'complex', null, null,
               array_to_string(string_split(p_name, ' '), '|'), len(string_split(p_name, ' '))::bigint from w""",
    "measurement_subtype": """
        select cast(l_orderkey as varchar) as patient_id, 'l_returnflag' as result_name, l_returnflag as result
        from lineitem join part on l_partkey = p_partkey""",
    "measurement_split": """
        select p_partkey, array_to_string(string_split(p_name, ' '), '|') as parts_joined,
               len(string_split(p_name, ' '))::bigint as n_parts from part""",
    "critical_care_build": """
        with s as (select l_orderkey, max(l_shipdate) ship from lineitem group by 1)
        select cast(o_custkey as varchar) as patient_id, cast(o_orderdate as date) as admission_date,
               cast(hour(o_orderdate) * 60 + minute(o_orderdate) as double) as admission_time,
               cast(s.ship as date) as discharge_date,
               cast(hour(s.ship) * 60 + minute(s.ship) as double) as discharge_time,
               o_orderpriority as request_location,
               cast(date_diff('day', cast(o_orderdate as date), cast(s.ship as date)) as double) as icu_days,
               case o_orderstatus when 'F' then 'Y' when 'O' then 'N' else 'U' end as ventilated,
               'U' as covid_status
        from orders join s on o_orderkey = s.l_orderkey""",
    "onehot_melt": """
        select distinct cast(doc_id as varchar) as patient_id, comorb_name
        from (unpivot labels on quality, toxic into name comorb_name value status) where status = 1""",
    "fuzzy_pairs": """
        with n as (select distinct p_name from part)
        select a.p_name as name_a, b.p_name as name_b, levenshtein(a.p_name, b.p_name) as distance
        from n a join n b on a.p_name < b.p_name where levenshtein(a.p_name, b.p_name) <= 2""",
    "fuzzy_resolve_merge": _DICT.format(key="case len(sim) when 0 then p_name when 1 then sim[1] end"),
    "fuzzy_resolve_ignore": _DICT.format(key="case len(sim) when 0 then p_name end"),
    "cascade_delete": """
        select o_orderkey, cast(o_custkey as varchar) as patient_id from orders o
        where not exists (select 1 from customer c where c.c_custkey = o.o_custkey and c.c_mktsegment = 'MACHINERY')""",
    "patient_document": """
        select cast(c_custkey as varchar) as patient_id, c_name, count(o_orderkey) as n_events,
               min(cast(o_orderdate as date)) as first_events, max(cast(o_orderdate as date)) as last_events
        from customer left join orders on o_custkey = c_custkey group by 1, 2""",
    "value_correction": """
        select o_orderkey, cast(o_custkey as varchar) as patient_id,
               max(o_totalprice) over (partition by o_custkey) as o_totalprice
        from orders""",
    "comorbidities_build": """
        select distinct cast(doc_id as varchar) as patient_id, comorb_name
        from (unpivot labels on quality, toxic into name comorb_name value status) where status = 1""",
    "validate_choices": "select o_orderkey, o_orderstatus from orders where o_orderstatus not in ('F', 'O')",
    "csv_awkward": """
        select cast(c_custkey as varchar) as pid, case when c_custkey % 5 = 0 then null else ' ' || c_nationkey end as _flag,
               case when c_custkey % 3 = 0 then null
                    when c_custkey % 2 = 1 and c_custkey % 7 = 0 then c_name || chr(10) || 'second line'
                    when c_custkey % 7 = 0 then 'say "' || c_name || '", twice' else c_name end as note
        from customer""",
    "csv_quoted_split": """
        select cast(o_orderkey as varchar) as pid, cast(o_custkey as varchar) as owner,
               case when o_orderkey % 3 = 0 then o_orderpriority || chr(10) || '"' || o_orderstatus || '",' || chr(10) || o_custkey
                    else o_orderpriority end as note from orders""",
    "csv_awkward_stream": """
        select cast(c_custkey as varchar) as pid, case when c_custkey % 5 = 0 then null else ' ' || c_nationkey end as _flag,
               case when c_custkey % 3 = 0 then null
                    when c_custkey % 2 = 1 and c_custkey % 7 = 0 then c_name || chr(10) || 'second line'
                    when c_custkey % 7 = 0 then 'say "' || c_name || '", twice' else c_name end as note
        from customer""",
    "registry_events": """
        select cast(o_custkey as varchar) as patient_id, o_orderpriority as event_type, o_orderstatus as component,
               cast(o_orderdate as date) as event_date, cast(hour(o_orderdate) * 60 + minute(o_orderdate) as double) as event_time,
               cast(o_orderkey as varchar) as order_key from orders""",
    "registry_delete": """
        select cast(c_custkey as varchar) as patient_id, c_nationkey as age, case upper(c_mktsegment[1]) when 'M' then 'M' when 'F' then 'F' else 'U' end as gender,
               count(o_orderkey) as n_events, min(cast(o_orderdate as date)) as first_events, max(cast(o_orderdate as date)) as last_events
        from customer left join orders on o_custkey = c_custkey where c_custkey % 10 <> 0 group by 1, 2, 3""",
    "audit_rows": """
        select 'add_patient' as op, cast(c_custkey as varchar) as entity_id, 'New patient written to patients table' as message from customer
        union all select 'add_events', null, 'Outcome events added from files matching ' || chr(39) || 'orders' || chr(39)
        union all select 'delete', cast(c_custkey as varchar), 'Deleted patient and associated documents' from customer where c_custkey % 10 = 0""",
    "rejects": """
        select cast(o_orderkey as varchar) as patient_id, 'code' as "column",
               case when o_orderkey % 5 = 0 then 'Y' when o_orderkey % 7 = 0 then o_orderkey || 'd' else o_orderkey || 'F' end as value
        from orders where o_orderkey % 5 = 0 or o_orderkey % 7 = 0 or o_orderkey % 11 = 0""",
    "number_keys": """
        select cast(o_orderkey as varchar) as patient_id, o_orderkey % 3 = 1 as differs, o_orderkey % 2 <> 0 as big_differs from orders""",
    "patient_children": """
        select cast(o_custkey as varchar) as patient_id, 'event' as child, o_orderpriority as name, cast(o_orderdate as date) as date,
               cast(hour(o_orderdate) * 60 + minute(o_orderdate) as double) as time, o_orderstatus as value from orders
        union all select cast(l_suppkey as varchar), 'measurement', 'l_quantity', null, null, cast(l_quantity as varchar) from lineitem
        union all select cast(l_suppkey as varchar), 'measurement', 'l_returnflag', null, null, l_returnflag from lineitem
        union all select cast(s_suppkey as varchar), 'critical_care', s_name, null, null, cast(s_nationkey / 2.0::double as varchar) from supplier
        union all select distinct cast(doc_id as varchar), 'comorbidity', comorb_name, null::date, null::double, null
                  from (unpivot labels on quality, toxic into name comorb_name value status) where status = 1""",
    "fuzzy_existing": """
        select distinct p_name, p_name as comorb_key,
               case when p_name in (select p_name from part where p_partkey % 3 = 0) or p_name in (select p_name || 's' from part where p_partkey % 2 = 0)
                    then 'existing' else 'new_key' end as action from part""",
    "fuzzy_document": """
        select distinct case when p_partkey % 2 = 0 then p_brand else p_brand[1] || p_brand end as name, p_brand as comorb_key,
               case when p_partkey % 2 = 0 then 'existing' else 'merged' end as action from part""",
    "fuzzy_document_ignore": """
        with n as (select distinct case when p_partkey % 2 = 0 then p_name else p_name[1] || p_name end as name from part)
        select name, name as comorb_key, 'new_key' as action from n""",
    "fuzzy_customers": """
        with n as (select distinct c_name from customer)
        select a.c_name as name_a, b.c_name as name_b, levenshtein(a.c_name, b.c_name) as distance
        from n a join n b on a.c_name < b.c_name where levenshtein(a.c_name, b.c_name) <= 1""",
    "validate_required": "select o_orderkey from orders where o_orderkey % 6 = 0 or o_orderkey % 7 = 0 or o_orderkey % 8 = 0",
    "measurement_continuous": "select cast(l_orderkey as varchar) as patient_id, 'l_quantity' as result_name, l_quantity as result from lineitem join part on l_partkey = p_partkey",
    "measurement_complex": "select cast(l_orderkey as varchar) as patient_id, 'p_name' as result_name, replace(p_name, ' ', '|') as result from lineitem join part on l_partkey = p_partkey",
    "corrected_reload": "select cast(c_custkey as varchar) as pid, c_nationkey * 90.0::double as age, c_name as name from customer",
    "comorbidities_similar": """
        select distinct cast(doc_id as varchar) as patient_id, case name when 'asthmas' then 'asthma' else name end as comorb_name
        from (unpivot (select doc_id, quality as asthma, toxic as asthmas, toxic as diabetes, 1 - quality as _fracture from labels)
              on asthma, asthmas, diabetes, _fracture into name name value status) where status = 1""",
    "validate_unique": "select p_name, count(*) as n_rows from part group by p_name having count(*) > 1",
    "entity_lookup": """
        select cast(o_custkey as varchar) as pid, cast(o_orderkey as varchar) as order_key, o_orderstatus as status from orders
        where o_custkey in (select s_suppkey from supplier)""",
    "load_with_rejects": """
        with r as (select case when o_orderkey % 13 <> 0 then cast(o_custkey as varchar) end as patient_id, o_orderpriority as event_type,
                          case when o_orderkey % 10 <> 0 then o_orderdate::date end as event_date,
                          case when o_orderkey % 3 = 0 then o_orderstatus end as covid_status,
                          o_totalprice::decimal(12,2)::varchar || case when o_orderkey % 7 = 0 then 'd' else '' end as price, o_orderkey as order_key from orders)
        select *, concat_ws('; ', case when patient_id is null then 'missing patient_id' end, case when event_date is null then 'missing event_date' end,
                            case when covid_status not in ('P', 'N', 'U') then 'invalid covid_status' end,
                            case when price like '%d' then 'price is no number' end) as reasons from r""",
    "patients_as_of": """
        with l1 as (select cast(c_custkey as varchar) pid, c_nationkey age, case c_custkey % 4 when 0 then 'M' when 1 then 'F' when 2 then 'U' end gender,
                           null::varchar covid from customer where c_custkey % 3 <> 0),
        l2 as (select cast(c_custkey as varchar) pid, case when c_custkey % 5 <> 0 then c_nationkey + c_custkey % 2 end age,
                      case when c_custkey % 6 = 0 then 'U' else 'F' end gender, null::varchar covid from customer where c_custkey % 4 < 2),
        l3 as (select cast(o_custkey as varchar) pid, null::int age, null::varchar gender, case when max(o_orderstatus) = 'P' then 'P' end covid from orders group by 1),
        s1 as (select *, date '2024-01-01' vf from l1),
        m2 as (select coalesce(o.pid, n.pid) pid, coalesce(n.age, o.age) age, coalesce(nullif(n.gender, 'U'), o.gender, n.gender) gender,
                      coalesce(n.covid, o.covid) covid, o.pid op, o.age oa, o.gender og, o.covid oc, o.vf from s1 o full join l2 n on o.pid = n.pid),
        s2 as (select pid, age, gender, covid, case when op is null or age is distinct from oa or gender is distinct from og or covid is distinct from oc
                      then date '2024-02-01' else vf end vf from m2),
        m3 as (select coalesce(o.pid, n.pid) pid, coalesce(n.age, o.age) age, coalesce(nullif(n.gender, 'U'), o.gender, n.gender) gender,
                      coalesce(n.covid, o.covid) covid, o.pid op, o.age oa, o.gender og, o.covid oc, o.vf from s2 o full join l3 n on o.pid = n.pid),
        s3 as (select pid, age, gender, covid, case when op is null or age is distinct from oa or gender is distinct from og or covid is distinct from oc
                      then date '2024-03-01' else vf end vf from m3),
        u as (select *, '2024-1-15' as t from s1 union all select *, '2024-2-15' from s2
              union all select *, '2024-5-1' from s3 where not (pid::bigint % 11 = 0 and pid::bigint in (select c_custkey from customer)))
        select pid as patient_id, age::int as age, gender, covid, vf as valid_from, t as as_of from u""",
    "stream_resolve": """
        with f as (select cast(o_custkey as varchar) pid, min(o_orderstatus) lo, max(o_orderstatus) hi from orders group by 1, o_orderpriority),
        e as (select pid, min(case when lo = hi then lo end) lo, max(case when lo = hi then hi end) hi,
                     sum(case when lo <> hi then 1 else 0 end)::bigint nf from f group by pid)
        select pid as patient_id, case when lo = hi then lo end as status, nf as n_conflicting_files, coalesce(lo <> hi, false) as entity_conflict from e""",
}
_SQL["patients_incremental"] = _SQL["patients_basics"]
_SQL["registry_bucketed"] = _SQL["registry_delete"]
_SQL["patient_pages"] = f"""
    with c as ({_SQL["patient_children"]}),
    n as (select *, row_number() over (partition by patient_id order by date nulls first, time nulls first, child, name, value nulls first) as position from c)
    select patient_id, (position - 1) // 40 + 1 as page, min(position) as first_position, count(*) as n_children, min(date) as first_date, max(date) as last_date,
           string_agg(coalesce(strftime(date, '%Y-%m-%d'), '-') || '/' || child || '/' || name || '/' || coalesce(value, '-'), ';' order by position) as children
    from n group by 1, 2"""
_SQL["custom_correction"] = """
    with g as (select distinct cast(o_custkey as varchar) as patient_id, o_orderpriority, floor(o_totalprice / 50000)::double as v from orders),
    n as (select patient_id, v, count(*) as n from g group by 1, 2),
    m as (select *, max(n) over (partition by patient_id) as most from n)
    select patient_id, median(v) as corrected from m where n = most group by 1"""


def oracle_sql() -> dict[str, str]:
    return {**{k: v for k, v in _SQL.items() if k in _QUERIES}, **_llm()[1]}
