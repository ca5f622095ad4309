"""Registered queries: name → callable(spark, sf_dir) → DataFrame.

Every query reads the given tables (through ``sources.fixtures``) and runs
over them whole.  The session is configured (UTC, dynamic overwrite, AQE)
before each one.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicflow import session
from civicflow.functions import dates as D
from civicflow.functions import quality as Q
from civicflow.functions import reports as R
from civicflow.operators import constraints as C
from civicflow.operators import path_index
from civicflow.operators import validate as V
from civicflow.operators.spatial_join import region_table
from civicflow.plans import analytics
from civicflow.plans import ingest
from civicflow.plans import loads
from civicflow.plans import reports
from civicflow.plans.spatial import to_spatial
from civicflow.schemas import PIPELINE_METRICS, REGION_SOURCE
from civicflow.sinks import landing
from civicflow.sinks.snapshots import Snapshot
from civicflow.sources import events_files, json_reports
from civicflow.sources import fixtures
from civicflow.streaming import incremental

AS_OF = fixtures.AS_OF

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            session.configure(spark)
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return run
    return deco


def spatial_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_spatial(fixtures.ev_geo(spark, sf_dir))


def regions(spark: SparkSession) -> DataFrame:
    return region_table(fixtures.region_source(spark))


@register("daily_avg")
def q_daily_avg(spark, sf_dir):
    """A1/O1: daily mean value per category, last 30 days."""
    return analytics.daily_avg(spatial_events(spark, sf_dir), AS_OF)


@register("hotspots_top5")
def q_hotspots(spark, sf_dir):
    """Top-5 0.1° cells by total value, last 7 days."""
    return analytics.hotspots(spatial_events(spark, sf_dir), AS_OF)


@register("events_per_region")
def q_events_per_region(spark, sf_dir):
    """Events inside each region, last 30 days (reference semantics)."""
    return analytics.events_per_region(spatial_events(spark, sf_dir), regions(spark), AS_OF)


# --------------------------------------------------------------------------
# validation, partitioned write, run metrics


# an instant within a day: the window's first day counts in part
HOTSPOTS_AS_OF = "2024-01-31 09:30:00"
# first attempts of the runs before this landing day failed and were retried
RETRY_BEFORE = "2024-01-20"


def checked_events(spark, sf_dir):
    return V.check(fixtures.raw_ev(spark, sf_dir))


@register("validate_events")
def q_validate_events(spark, sf_dir):
    """Range checks and reject reasons for every bronze row."""
    c = checked_events(spark, sf_dir)
    return c.select("id", "lat_ok", "lon_ok", "value_ok", "is_valid",
                    Q.reason_text(F.col("reasons")).alias("reasons"))


@register("validate_numbers")
def q_validate_numbers(spark, sf_dir):
    """Texts that look like numbers to a cast but are none (5d, 6.1f), and numbers beyond a decimal (inf, 1e30)."""
    raw = fixtures.raw_ev(spark, sf_dir)
    k = F.col("id").cast("long") % 8
    raw = raw.withColumns({
        "value": F.when(k == 0, F.concat("value", F.lit("d"))).when(k == 1, F.lit("inf")).when(k == 2, F.lit("1e30")).otherwise(F.col("value")),
        "latitude": F.when(k == 3, F.lit("6.1f")).otherwise(F.col("latitude").cast("string"))})
    c = V.check(raw)
    return c.select("id", "lat_ok", "lon_ok", "value_ok", "is_valid", Q.reason_text(F.col("reasons")).alias("reasons"))


@register("valid_events")
def q_valid_events(spark, sf_dir):
    """Rows passing all checks, typed."""
    return V.valid(checked_events(spark, sf_dir))


@register("reject_events")
def q_reject_events(spark, sf_dir):
    """Reject rows with run id, reasons and log line."""
    return ingest.reject_rows(checked_events(spark, sf_dir)).drop("run_date")


@register("run_metrics")
def q_run_metrics(spark, sf_dir):
    """Per-run counters, error rate and the 5 % flag."""
    return ingest.run_metrics(checked_events(spark, sf_dir))


@register("partition_counts")
def q_partition_counts(spark, sf_dir):
    """Write clean Parquet by date/category, read it back, count."""
    root = session.scratch(spark, "ingest")
    ingest.validate_and_partition(spark, fixtures.raw_ev(spark, sf_dir), f"{root}/clean/events",
                                  f"{root}/rejects", with_metrics=False)
    written = spark.read.option("basePath", f"{root}/clean/events").parquet(f"{root}/clean/events")
    return written.groupBy("date", "category").agg(F.count(F.lit(1)).alias("n_rows"))


# days from here on are landed again, corrected and with fewer rows
RERUN_FROM = "2024-01-20"


@register("partition_rerun")
def q_partition_rerun(spark, sf_dir):
    """K2/K7: days landed again with fewer rows; clean rows, rejects and metrics are those of the last run."""
    root = session.scratch(spark, "rerun")
    raw = fixtures.raw_ev(spark, sf_dir)
    ingest.validate_and_partition(spark, raw, f"{root}/clean/events", f"{root}/rejects", with_metrics=False)
    again = raw.where((F.col("ds") >= F.lit(RERUN_FROM).cast("date")) & (F.col("id").cast("long") % 3 != 1))
    result = ingest.validate_and_partition(spark, again, f"{root}/clean/events", f"{root}/rejects")
    clean = events_files.scan_clean(spark, f"{root}/clean/events").groupBy(F.col("ingest_ds").alias("ds")).agg(F.count("*").alias("clean"))
    bad = (spark.read.schema("run_id string, id string, reasons string, message string, run_date date")
           .parquet(f"{root}/rejects").groupBy(F.col("run_date").alias("ds")).agg(F.count("*").alias("rejects")))
    counted = result.metrics.select(F.to_date("execution_date").alias("ds"), "rows_read", "rows_written", "bad_records_count")
    return (clean.join(bad, "ds", "full").join(counted, "ds", "left")
            .select("ds", F.coalesce("clean", F.lit(0)).alias("clean"), F.coalesce("rejects", F.lit(0)).alias("rejects"),
                    "rows_read", "rows_written", "bad_records_count"))


def _metrics_attempts(spark, sf_dir):
    """Two attempts of every daily run: the first ones before RETRY_BEFORE
    failed (nothing written), the retries of all days succeeded."""
    raw = fixtures.raw_ev(spark, sf_dir)
    first = ingest.run_metrics(V.check(raw.where(F.col("ds") < F.lit(RETRY_BEFORE).cast("date"))))
    first_rows = ingest.metrics_rows(
        first, F.lit(ingest.STATUS_FAILED), F.lit("attempt 1 failed"),
        F.col("execution_date") + F.expr("INTERVAL 1 HOUR"), rows_written=F.lit(0))
    target = first_rows.withColumn("started_at", F.col("finished_at")).select(
        *[F.col(f.name).cast(f.dataType) for f in PIPELINE_METRICS.fields])
    retry = ingest.metrics_rows(
        ingest.run_metrics(V.check(raw)), F.lit(ingest.STATUS_SUCCESS), F.lit(None),
        F.col("execution_date") + F.expr("INTERVAL 2 HOURS"))
    return target, retry


@register("metrics_upsert")
def q_metrics_upsert(spark, sf_dir):
    """ON CONFLICT (run_id, table_target) partial update."""
    target, retry = _metrics_attempts(spark, sf_dir)
    return ingest.upsert_metrics(target, retry)


@register("metrics_daily")
def q_metrics_daily(spark, sf_dir):
    """Run health per day and status over the metrics table."""
    target, retry = _metrics_attempts(spark, sf_dir)
    return ingest.metrics_daily(ingest.upsert_metrics(target, retry))


# --------------------------------------------------------------------------
# citizen reports


# reports of files before this day were loaded by a first run
REPORT_SPLIT_DAY = "date=2024-01-16"
FIRST_LOAD_AT = "2024-01-16 00:00:00"
SECOND_LOAD_AT = "2024-02-01 00:00:00"


def report_docs(spark, sf_dir, files=None):
    """Documents as a scan yields them: generated rows of (file, pos, variant), of the files that ``files`` holds for.

    Going through a generator (as the file scan's posexplode does) keeps
    filters on normalised fields from being pushed into, and inlined with,
    the text that builds each document.  Files are chosen before it, so the
    documents of others are not built and parsed.
    """
    d = fixtures.docs(spark, sf_dir)
    if files is not None:
        d = d.where(files)
    row = F.struct(F.col("file_key"), F.col("pos"), F.try_parse_json("doc").alias("doc"))
    return d.select(F.inline(F.array(row)))


def _flat(table):
    return table.select("external_id", "source_timestamp", "category", "commune", "quartier", "status",
                        F.col("geom.lon").alias("lon"), F.col("geom.lat").alias("lat"),
                        *[c for c in ("ingested_at",) if c in table.columns])


@register("reports_format")
def q_reports_format(spark, sf_dir):
    """Document shape by first matching key-presence test."""
    d = report_docs(spark, sf_dir)
    return d.select("file_key", "pos", R.shape(F.col("doc")).alias("shape"))


@register("reports_dates")
def q_reports_dates(spark, sf_dir):
    """Date normalisation of every document."""
    d = report_docs(spark, sf_dir)
    s = R.shape(F.col("doc"))
    return d.select("file_key", "pos", D.normalize_date(R.date_field(F.col("doc"), s)).alias("source_timestamp"))


@register("reports_normalize")
def q_reports_normalize(spark, sf_dir):
    """Every document in the unified schema."""
    return reports.normalize(report_docs(spark, sf_dir)).drop("original_doc")


@register("reports_dedupe")
def q_reports_dedupe(spark, sf_dir):
    """Reports with an id, last version per id."""
    return reports.dedupe(reports.normalize(report_docs(spark, sf_dir))).drop("original_doc", "shape")


def reports_table(spark, sf_dir, normalized=None):
    """Two loads into the bucketed table: files before REPORT_SPLIT_DAY, then the rest (K5 twice).

    ``normalized``: a written table of all normalised documents, if there is one.
    """
    table = incremental.reports_table(spark, session.scratch(spark, "citizen-reports"))
    for part, at in ((F.col("file_key") < REPORT_SPLIT_DAY, FIRST_LOAD_AT), (F.col("file_key") >= REPORT_SPLIT_DAY, SECOND_LOAD_AT)):
        docs = normalized.where(part) if normalized is not None else reports.normalize(report_docs(spark, sf_dir, part))
        rows = reports.to_table_rows(reports.dedupe(docs))
        table.merge(rows, reports.REPORT_KEY, partial(reports.upsert_reports, ingested_at=F.lit(at).cast("timestamp_ntz")))
    return table.read()


def _indexed_reports(spark, sf_dir):
    """The two loads into the bucketed table and its path index."""
    root = session.scratch(spark, "indexed-reports")
    table, index = incremental.reports_table(spark, f"{root}/table"), path_index.index_table(spark, f"{root}/index")
    for part, at in ((F.col("file_key") < REPORT_SPLIT_DAY, FIRST_LOAD_AT), (F.col("file_key") >= REPORT_SPLIT_DAY, SECOND_LOAD_AT)):
        rows = reports.to_table_rows(reports.dedupe(reports.normalize(report_docs(spark, sf_dir, part))))
        reports.merge_reports(table, rows, F.lit(at).cast("timestamp_ntz"), index)
    return table, index


@register("reports_index_search")
def q_reports_index_search(spark, sf_dir):
    """The search of reports_json_search through the path index, which reads the buckets of its path and value only."""
    table, index = _indexed_reports(spark, sf_dir)
    return path_index.search(table, index, "$.status", "open").select("external_id", "category", "status")


@register("reports_containing")
def q_reports_containing(spark, sf_dir):
    """Reports whose document contains a JSON value, through the path index."""
    table, index = _indexed_reports(spark, sf_dir)
    found = path_index.find_containing(table, index, {"event": {"payload": {"quartier": "Q1"}}})
    return found.select("external_id", "category", "commune", "quartier")


@register("reports_processed")
def q_reports_processed(spark, sf_dir):
    """Reports processed by a load, per file (an id in two files counts in both)."""
    return reports.processed_per_file(reports.normalize(report_docs(spark, sf_dir)))


@register("reports_upsert")
def q_reports_upsert(spark, sf_dir):
    """Upsert by external_id, ingested_at kept from the first load."""
    return _flat(reports_table(spark, sf_dir))


@register("reports_json_search")
def q_reports_json_search(spark, sf_dir):
    """Search the stored original documents by a JSON path value."""
    t = reports_table(spark, sf_dir)
    return reports.search(t, "$.status", "open").select("external_id", "category", "status")


@register("reports_per_region")
def q_reports_per_region(spark, sf_dir):
    """Citizen reports inside each region (all regions kept)."""
    t = reports_table(spark, sf_dir).where(F.col("geom").isNotNull())
    pts = t.select(F.col("geom.lon").alias("lon"), F.col("geom.lat").alias("lat"))
    return analytics.points_per_region(pts, regions(spark))


# --------------------------------------------------------------------------
# file round trips: bronze CSV, clean Parquet, raw_events, spatial events


# two landings: the days before SECOND_LANDING, then the rest
SECOND_LANDING = "2024-01-16"
LOAD_IDS = ("2024-01-16T00:00:00", "2024-02-01T00:00:00")
# a second source re-sends the events of these days with its own values
RESEND_FROM = "2024-01-25"


def _land_and_load(spark, sf_dir, with_loads=True, with_totals=False):
    """Validate + partition each landing, then (``with_loads``) run the
    full-history clean load after each one.  Returns (root, [totals])."""
    root = session.scratch(spark, "loads")
    raw = fixtures.raw_ev(spark, sf_dir)
    split = F.lit(SECOND_LANDING).cast("date")
    totals = []
    for part, load_id in ((raw.where(F.col("ds") < split), LOAD_IDS[0]),
                          (raw.where(F.col("ds") >= split), LOAD_IDS[1])):
        ingest.validate_and_partition(spark, part, f"{root}/clean/events", f"{root}/rejects", with_metrics=False)
        if with_loads:
            totals.append(loads.clean_load(spark, f"{root}/clean/events", f"{root}/raw_events", load_id,
                                           with_totals=with_totals))
    return root, totals


def _flat_events(df):
    return df.select("id", "ts", F.col("geom.lon").alias("lon"), F.col("geom.lat").alias("lat"),
                     F.col("value").cast("double").alias("value"), "category", "source")


@register("scan_clean_events")
def q_scan_clean_events(spark, sf_dir):
    """Recursive scan of the clean partitions (category from path)."""
    root, _ = _land_and_load(spark, sf_dir, with_loads=False)
    return events_files.scan_clean(spark, f"{root}/clean/events")


@register("raw_events_append")
def q_raw_events_append(spark, sf_dir):
    """K3: full-history append per load (one copy of a row per load)."""
    root, _ = _land_and_load(spark, sf_dir)
    return spark.read.parquet(f"{root}/raw_events").drop("ingest_ds")


@register("clean_load_foreign")
def q_clean_load_foreign(spark, sf_dir):
    """A load of validated files beside files of other writers, whose category is in the file, NULL there, or in the path only."""
    root = session.scratch(spark, "foreign")
    raw = fixtures.raw_ev(spark, sf_dir)
    split = F.lit(SECOND_LANDING).cast("date")
    ingest.validate_and_partition(spark, raw.where(F.col("ds") < split), f"{root}/clean/events", f"{root}/rejects", with_metrics=False)
    others = V.valid(V.check(raw.where(F.col("ds") >= split))).where(F.col("category").isNotNull() & F.col("ts").isNotNull())
    # a folder for each category, a few: its files name it, have it NULL, or have no such column
    names = sorted(r["category"] for r in others.select("category").distinct().collect())
    for i, name in enumerate(names):
        rows = others.where(F.col("category") == name).withColumnRenamed("ts", "timestamp").select(
            "id", "timestamp", "latitude", "longitude", "value", "source", "category")
        if i % 3 == 0:
            rows = rows.withColumn("category", F.upper("category"))
        elif i % 3 == 1:
            rows = rows.withColumn("category", F.lit(None).cast("string"))
        else:
            rows = rows.drop("category")
        rows.write.parquet(f"{root}/clean/events/other/category={name}")
    loads.clean_load(spark, f"{root}/clean/events", f"{root}/raw_events", LOAD_IDS[0], with_totals=False)
    return spark.read.parquet(f"{root}/raw_events").drop("ingest_ds", "load_id")


@register("load_totals")
def q_load_totals(spark, sf_dir):
    """Files and rows loaded by each clean load."""
    _, totals = _land_and_load(spark, sf_dir, with_totals=True)
    return totals[0].unionByName(totals[1])


@register("raw_to_spatial")
def q_raw_to_spatial(spark, sf_dir):
    """raw_events → one typed spatial row per id."""
    root, _ = _land_and_load(spark, sf_dir)
    return _flat_events(loads.raw_to_spatial(spark.read.parquet(f"{root}/raw_events")))


@register("events_upsert")
def q_events_upsert(spark, sf_dir):
    """Upsert by id; a re-sent event replaces all five columns."""
    root, _ = _land_and_load(spark, sf_dir)
    table = loads.raw_to_spatial(spark.read.parquet(f"{root}/raw_events"))
    resend = (fixtures.ev_geo(spark, sf_dir)
              .where(F.col("ts") >= F.lit(RESEND_FROM).cast("timestamp_ntz"))
              .select("id", "ts", "longitude", "latitude", (F.col("value") * 10).alias("value"),
                      F.upper("category").alias("category"), F.lit("resend").alias("source")))
    return _flat_events(loads.upsert_events(table, to_spatial(resend)))


@register("scan_csv_events")
def q_scan_csv_events(spark, sf_dir):
    """Bronze CSV per landing day, read back as text, typed by the checks."""
    root = session.scratch(spark, "csv")
    events_files.write_csv_export(fixtures.raw_ev(spark, sf_dir), f"{root}/raw/events", partition_col="ds")
    raw = events_files.scan_csv(spark, f"{root}/raw/events")
    checked = V.check(raw)
    return checked.select("id", F.col("_ts").alias("ts"), F.col("_lat").alias("latitude"),
                          F.col("_lon").alias("longitude"), "value", "category", "source", "ds")


@register("scan_csv_mixed_headers")
def q_scan_csv_mixed_headers(spark, sf_dir):
    """Exports with another column order, further columns, quotes and line breaks lie beside plain ones."""
    root = session.scratch(spark, "csv")
    raw = fixtures.raw_ev(spark, sf_dir)
    odd = F.dayofmonth("ds") % 2 == 1
    events_files.write_csv_export(raw.where(~odd), f"{root}/raw/events", partition_col="ds")
    note = F.concat(F.lit('said "'), F.col("id"), F.lit('",\nthen left'))
    (raw.where(odd).select(
        F.col("longitude").cast("string").alias("longitude"), F.col("latitude").cast("string").alias("latitude"), note.alias("note"),
        "source", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("timestamp"), "category",
        F.col("value").cast("string").alias("value"), "id", F.date_format("ds", "yyyy-MM-dd").alias("date"))
     .write.mode("append").option("header", True).option("escape", '"').partitionBy("date").csv(f"{root}/raw/events"))
    checked = V.check(events_files.scan_csv(spark, f"{root}/raw/events"))
    return checked.select("id", F.col("_ts").alias("ts"), F.col("_lat").alias("latitude"),
                          F.col("_lon").alias("longitude"), "value", "category", "source", "ds")


# files beyond this are read in ranges by the two queries of large files
RANGE_BYTES = 16_384


@register("scan_csv_large")
def q_scan_csv_large(spark, sf_dir):
    """Large exports whose quoted fields span lines, read in byte ranges."""
    root = session.scratch(spark, "csv")
    raw = fixtures.raw_ev(spark, sf_dir)
    note = F.when(F.col("id").cast("long") % 3 == 0, F.concat(F.lit('said "'), F.col("id"), F.lit('",\nthen\n\nleft'))).otherwise(F.lit("quiet"))
    (raw.select(note.alias("note"), "id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("timestamp"),
                F.col("latitude").cast("string").alias("latitude"), F.col("longitude").cast("string").alias("longitude"),
                F.col("value").cast("string").alias("value"), "category", "source", F.date_format("ds", "yyyy-MM-dd").alias("date"))
     .repartition("date").write.option("header", True).option("escape", '"').partitionBy("date").csv(f"{root}/raw/events"))
    checked = V.check(events_files.scan_csv(spark, f"{root}/raw/events", split=RANGE_BYTES))
    return checked.select("id", F.col("_ts").alias("ts"), F.col("_lat").alias("latitude"),
                          F.col("_lon").alias("longitude"), "value", "category", "source", "ds")


@register("scan_json_large")
def q_scan_json_large(spark, sf_dir):
    """S3: one list file a day, whatever its size, read in byte ranges: documents with their position in the file."""
    root = session.scratch(spark, "json")
    docs = fixtures.docs(spark, sf_dir).select(F.substring("file_key", 6, 10).alias("date"), "pos", "doc")
    landing.write_day_lists(docs, f"{root}/raw/demandes_services")
    scanned = json_reports.scan(spark, f"{root}/raw/demandes_services", split=RANGE_BYTES)
    s = R.shape(F.col("doc"))
    return scanned.select(F.regexp_extract("file_path", r"/date=([0-9-]+)/", 1).cast("date").alias("file_date"),
                          F.col("pos").cast("long").alias("pos"), s.alias("shape"),
                          R.field(F.col("doc"), s, "external_id").alias("external_id"))


@register("bronze_land")
def q_bronze_land(spark, sf_dir):
    """Land every configured source under name/date=ds/, count what landed."""
    root = session.scratch(spark, "bronze")
    events_files.write_csv_export(fixtures.raw_ev(spark, sf_dir), f"{root}/exports/events.csv")
    docs = fixtures.docs(spark, sf_dir).select(F.substring("file_key", 6, 10).alias("date"), "pos", "doc")
    landing.write_json_lists(docs, f"{root}/exports/demandes_services.json")
    config = F.to_json(F.array(
        F.struct(F.lit("events").alias("name"), F.lit(f"{root}/exports/events.csv").alias("path")),
        F.struct(F.lit("Demandes Services").alias("name"),
                 F.lit(f"{root}/exports/demandes_services.json").alias("path"))))
    spark.range(1).select(config.alias("value")).coalesce(1).write.text(f"{root}/sources.json")
    landing.land_all(spark, f"{root}/sources.json", f"{root}/raw", ds="2024-02-01")
    events = events_files.scan_csv(spark, f"{root}/raw/events")
    reports_docs = json_reports.scan(spark, f"{root}/raw/demandes_services")
    return (events.groupBy("ds").agg(F.count(F.lit(1)).alias("records")).select(
                F.lit("events").alias("source"), F.col("ds").cast("date").alias("ds"), "records")
            .unionByName(reports_docs.select(F.regexp_extract("file_path", r"/date=([0-9-]+)/", 1).alias("ds"))
                         .groupBy("ds").agg(F.count(F.lit(1)).alias("records"))
                         .select(F.lit("demandes_services").alias("source"), F.col("ds").cast("date").alias("ds"),
                                 "records")))


@register("scan_json_reports")
def q_scan_json_reports(spark, sf_dir):
    """JSON list files → documents with file and in-file position."""
    root = session.scratch(spark, "json")
    docs = fixtures.docs(spark, sf_dir).select(F.substring("file_key", 6, 10).alias("date"), "pos", "doc")
    landing.write_json_lists(docs, f"{root}/raw/demandes_services")
    scanned = json_reports.scan(spark, f"{root}/raw/demandes_services")
    s = R.shape(F.col("doc"))
    return scanned.select(
        F.regexp_extract("file_path", r"/date=([0-9-]+)/", 1).cast("date").alias("file_date"),
        F.regexp_extract("file_path", r"/chunk=([0-9]+)/", 1).cast("long").alias("chunk"),
        F.col("pos").cast("long").alias("pos"), s.alias("shape"),
        R.field(F.col("doc"), s, "external_id").alias("external_id"))


# --------------------------------------------------------------------------
# constraint checks, incremental streaming load


@register("constraint_checks")
def q_constraint_checks(spark, sf_dir):
    """NOT NULL / UNIQUE violations of report, metrics and region tables."""
    root = session.scratch(spark, "checks")

    def once(name, df):
        """Every check of a table reads the written table: it is built once."""
        df.write.parquet(f"{root}/{name}")
        return spark.read.schema(df.schema).parquet(f"{root}/{name}")

    batch = once("batch", reports.normalize(report_docs(spark, sf_dir)))
    table = reports_table(spark, sf_dir, batch)
    target, retry = (once(f"metrics{i}", df) for i, df in enumerate(_metrics_attempts(spark, sf_dir)))
    attempts = target.unionByName(retry, allowMissingColumns=True)
    metrics = once("metrics", ingest.upsert_metrics(target, retry))
    regs = regions(spark)
    return C.report(
        C.table_checks(batch, "citizen_reports_batch", ["external_id"], ["external_id"]),
        C.table_checks(table, "citizen_reports", ["external_id"], ["external_id"]),
        C.table_checks(attempts, "pipeline_metrics_inserts", [], ["run_id", "table_target"]),
        C.table_checks(metrics, "pipeline_metrics", ["dag_id", "run_id", "table_target", "execution_date", "status"],
                       ["run_id", "table_target"]),
        C.table_checks(regs, "regions", ["name"], ["name"]),
    )


def _corrected_events(spark, sf_dir, rollup):
    """Two landings and a re-sent, corrected window into the events table, with the sums refreshed after each."""
    root = session.scratch(spark, "rollup")
    table = incremental.events_table(spark, f"{root}/events")
    sums = rollup(table, f"{root}/sums")
    events = fixtures.ev_geo(spark, sf_dir)
    split, resent = F.lit(SECOND_LANDING).cast("timestamp_ntz"), F.lit(RESEND_FROM).cast("timestamp_ntz")
    # corrected rows move a day ahead, and their values change
    fixed = events.where(F.col("ts") >= resent).withColumns({"value": F.col("value") * 10, "category": F.upper("category"),
                                                            "ts": F.col("ts") - F.expr("INTERVAL 1 DAY")})
    for part in (events.where(F.col("ts") < split), events.where(F.col("ts") >= split), fixed):
        table.merge(to_spatial(part), loads.EVENT_KEY, partial(loads.upsert_events, unique=True))
        sums.refresh()
    return sums


@register("daily_avg_maintained")
def q_daily_avg_maintained(spark, sf_dir):
    """A1: daily means from sums that three batches brought up to date, retracting what the last one corrected."""
    return analytics.daily_avg_maintained(_corrected_events(spark, sf_dir, analytics.daily_sums), AS_OF)


@register("hotspots_maintained")
def q_hotspots_maintained(spark, sf_dir):
    """A3: the top cells from maintained sums; the window begins within a day."""
    return analytics.hotspots_maintained(_corrected_events(spark, sf_dir, analytics.cell_sums), HOTSPOTS_AS_OF)


@register("metrics_daily_maintained")
def q_metrics_daily_maintained(spark, sf_dir):
    """Run health from sums that follow the metrics table through failed attempts and retries."""
    root = session.scratch(spark, "health")
    table = Snapshot(spark, f"{root}/metrics", PIPELINE_METRICS, buckets=ingest.METRICS_KEY)
    sums = ingest.health_sums(table, f"{root}/sums")
    for rows in _metrics_attempts(spark, sf_dir):
        table.merge(rows, ingest.METRICS_KEY, ingest.upsert_metrics)
        sums.refresh()
    return ingest.metrics_daily_maintained(sums)


@register("regions_load")
def q_regions_load(spark, sf_dir):
    """Regions of all kinds into their table; unusable ones set aside; all events inside each, overlapping parts once."""
    table = Snapshot(spark, session.scratch(spark, "regions"), REGION_SOURCE, buckets=["id"], unique=[["name"]])
    rejected = loads.regions_load(table, fixtures.event_regions(spark, sf_dir))
    points = spatial_events(spark, sf_dir).select(F.col("geom.lon").alias("lon"), F.col("geom.lat").alias("lat"))
    counted = analytics.points_per_region(points, region_table(table.read()))
    return (counted.select(F.col("region_name").alias("name"), F.lit("").alias("reasons"), F.col("report_count").cast("long").alias("events"))
            .unionByName(rejected.select("name", F.array_join("reasons", ", ").alias("reasons"), F.lit(None).cast("long").alias("events"))))


# points of a boundary cell beyond which the adaptive query divides it
HOT_POINTS = 200


@register("regions_adaptive")
def q_regions_adaptive(spark, sf_dir):
    """All events inside each derived region, over a grid that is finer where the events are dense."""
    regs = region_table(fixtures.event_regions(spark, sf_dir))
    points = spatial_events(spark, sf_dir).select(F.col("geom.lon").alias("lon"), F.col("geom.lat").alias("lat"))
    counted = analytics.points_per_region(points, regs, cell=1.0, hot_points=HOT_POINTS, sample_rate=1.0)
    return counted.select(F.col("region_name").alias("name"), F.col("report_count").cast("long").alias("events"))


@register("constraint_enforce")
def q_constraint_enforce(spark, sf_dir):
    """Reports that nobody deduplicated go into their table: what its constraints refuse, by rule, and what it holds then."""
    table = incremental.reports_table(spark, session.scratch(spark, "enforced"))
    rows = reports.to_table_rows(reports.normalize(report_docs(spark, sf_dir)))
    stamp = F.lit(FIRST_LOAD_AT).cast("timestamp_ntz")
    table.merge(rows, reports.REPORT_KEY, partial(reports.upsert_reports, ingested_at=stamp))
    held = table.read()
    checks = C.table_checks(held, "citizen_reports", ["external_id"], ["external_id"])
    return (table.quarantined().groupBy("rule").agg(F.count("*").alias("n")).select(F.lit("refused").alias("what"), "rule", "n")
            .unionByName(checks.select(F.lit("broken").alias("what"), "rule", F.col("violations").alias("n")))
            .unionByName(held.agg(F.count("*").alias("n")).select(F.lit("held").alias("what"), F.lit("rows").alias("rule"), "n")))


@register("events_corrections")
def q_events_corrections(spark, sf_dir):
    """Ids landed again a day later with an earlier ts and another value: the later landing wins in batch and stream."""
    root = session.scratch(spark, "corrections")
    raw = fixtures.raw_ev(spark, sf_dir)
    fixed = raw.where(F.col("id").cast("long") % 5 == 0).select(
        "id", (F.col("ts") - F.expr("INTERVAL 2 HOURS")).alias("ts"), "latitude", "longitude", F.lit("7.25").alias("value"),
        "category", F.lit("corrected").alias("source"), F.date_add("ds", 1).alias("ds"))
    ingest.validate_and_partition(spark, raw.unionByName(fixed), f"{root}/clean/events", f"{root}/rejects", with_metrics=False)
    loads.clean_load(spark, f"{root}/clean/events", f"{root}/raw_events", LOAD_IDS[0], with_totals=False)
    batch = loads.raw_to_spatial(spark.read.parquet(f"{root}/raw_events"))
    incremental.run_available(spark, f"{root}/clean/events", f"{root}/tables/events", f"{root}/_checkpoints/events_load")
    stream = incremental.events_table(spark, f"{root}/tables/events").read()
    return (_flat_events(batch).withColumn("load", F.lit("batch"))
            .unionByName(_flat_events(stream).withColumn("load", F.lit("stream"))))


@register("incremental_load")
def q_incremental_load(spark, sf_dir):
    """File stream over the clean partitions, availableNow, upsert per batch."""
    root = session.scratch(spark, "stream")
    raw = fixtures.raw_ev(spark, sf_dir)
    split = F.lit(SECOND_LANDING).cast("date")
    for part in (raw.where(F.col("ds") < split), raw.where(F.col("ds") >= split)):
        ingest.validate_and_partition(spark, part, f"{root}/clean/events", f"{root}/rejects", with_metrics=False)
        incremental.run_available(spark, f"{root}/clean/events", f"{root}/tables/events",
                                  f"{root}/_checkpoints/events_load")
    return _flat_events(incremental.events_table(spark, f"{root}/tables/events").read())
