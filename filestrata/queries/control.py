"""Control-table operators on whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

from ..operators import control as K
from ..operators import summaries as M
from ..plans.bronze import manifest_records
from ..functions.text import contains_text
from ..schemas import MANIFEST_KEYS
from ..storage import scratch_dir
from .inputs import table
from .values import RUN_TIME

QUERIES, ORACLES = {}, {}


def _orders_as_files(spark, sf):
    """Each order as a landed file; some have no hash."""
    return table(spark, sf, "orders").select(
        F.concat(F.lit("pedido_"), F.col("o_orderkey").cast("string"), F.lit(".csv"))
        .alias("source_file"),
        F.col("o_orderpriority").alias("snapshot_date"),
        F.when(F.col("o_orderkey") % 7 != 0, F.sha2(F.col("o_orderkey").cast("string"), 256))
        .alias("file_hash"),
        "o_orderstatus")


def idempotence_split(spark, sf):
    """Orders finished earlier form the manifest, listed twice over."""
    files = _orders_as_files(spark, sf)
    known = files.where(F.col("o_orderstatus") == "F").select(*MANIFEST_KEYS)
    marked = K.mark_processed(files, known.unionByName(known))
    return marked.select(
        "source_file", "file_hash",
        F.when(F.col("processed"), "SKIPPED").otherwise("TODO").alias("status"))


QUERIES["idempotence_split"] = idempotence_split
ORACLES["idempotence_split"] = """
select 'pedido_' || o_orderkey || '.csv' as source_file,
  case when o_orderkey % 7 <> 0 then sha256(o_orderkey::varchar) end as file_hash,
  case when o_orderstatus = 'F' and o_orderkey % 7 <> 0 then 'SKIPPED' else 'TODO' end as status
from orders"""

EVENT_STATE = StructType([
    StructField("user_id", LongType()), StructField("event_type", StringType()),
    StructField("ts", TimestampType()), StructField("event_id", LongType()),
    StructField("turn", LongType()),
])


def manifest_upsert(spark, sf):
    """Two upserts of event halves; each key keeps what arrived last, although its
    order column says otherwise: the earlier half has the higher numbers. Errors
    have no user, so one null-keyed group holds many rows."""
    events = table(spark, sf, "events").select(
        F.when(F.col("event_type") != "error", F.col("user_id")).alias("user_id"),
        "event_type", "ts", "event_id", (-F.col("event_id")).alias("turn"))
    root = scratch_dir(spark, "event-state")
    middle = F.lit("2024-01-16").cast("timestamp")
    for half in (events.where(F.col("ts") < middle), events.where(F.col("ts") >= middle)):
        K.upsert_manifest(half, root, ["user_id", "event_type"], "turn", EVENT_STATE)
    state = K.read_manifest(spark, root, EVENT_STATE)
    return state.select("user_id", "event_type", "event_id")


QUERIES["manifest_upsert"] = manifest_upsert
ORACLES["manifest_upsert"] = """
with e as (
  select case when event_type <> 'error' then user_id end as user_id, event_type, ts, event_id
  from events)
select user_id, event_type, event_id from e
qualify row_number() over (
  partition by user_id, event_type order by ts >= timestamp '2024-01-16' desc, event_id) = 1"""


def success_records(spark, sf):
    """Manifest rows of the successful executions only."""
    status = F.when(F.col("o_orderstatus") == "F", "SUCCESS").when(
        F.col("o_orderstatus") == "O", "SKIPPED").otherwise("FAILED")
    executions = _orders_as_files(spark, sf).select(
        *MANIFEST_KEYS, status.alias("status"), F.lit("csv").alias("source_type"),
        F.lit("pedidos").alias("dataset_name"),
        F.concat(F.lit("/bronze/"), "source_file").alias("bronze_path"))
    return manifest_records(executions, RUN_TIME).drop("processed_at")


QUERIES["success_records"] = success_records
ORACLES["success_records"] = """
select 'pedido_' || o_orderkey || '.csv' as source_file, o_orderpriority as snapshot_date,
  'csv' as source_type, 'pedidos' as dataset_name,
  case when o_orderkey % 7 <> 0 then sha256(o_orderkey::varchar) end as file_hash,
  '/bronze/pedido_' || o_orderkey || '.csv' as bronze_path, 'bronze_v1' as pipeline_version
from orders where o_orderstatus = 'F'"""


def append_log(spark, sf):
    """Three appends, one of them empty, of frames with different columns."""
    customers = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), "c_mktsegment")
    suppliers = table(spark, sf, "supplier").select(
        F.col("s_name").alias("name"), F.col("s_suppkey").alias("key"))
    path = scratch_dir(spark, "log")
    both = K.union_by_name(customers, suppliers)
    K.append_log(both.where(F.col("c_mktsegment").isNotNull()), path)
    K.append_log(both.where(F.lit(False)), path)
    K.append_log(both.where(F.col("c_mktsegment").isNull()), path)
    return spark.read.schema(both.schema).parquet(path)


QUERIES["append_log"] = append_log
ORACLES["append_log"] = """
select c_custkey as key, c_name as name, c_mktsegment from customer
union all by name select s_suppkey as key, s_name as name from supplier"""


def value_counts(spark, sf):
    events = table(spark, sf, "events").select(
        F.when(F.col("event_type") != "error", F.col("event_type")).alias("event_type"))
    return M.value_counts(events, "event_type")


QUERIES["value_counts"] = value_counts
ORACLES["value_counts"] = """
select event_type, count(*) as count from events where event_type <> 'error'
group by event_type"""


def status_totals(spark, sf):
    status = F.when(F.col("event_type") == "error", "FAILED").when(
        F.col("event_type") == "signup", "SKIPPED").otherwise("SUCCESS")
    return M.status_totals(table(spark, sf, "events").select(status.alias("upload_status")))


QUERIES["status_totals"] = status_totals
ORACLES["status_totals"] = """
select count(*) as total_files,
  count(*) filter (where event_type not in ('error', 'signup')) as success,
  count(*) filter (where event_type = 'error') as failed
from events"""


def distinct_values(spark, sf):
    return table(spark, sf, "documents").select("lang", "source").distinct()


QUERIES["distinct_values"] = distinct_values
ORACLES["distinct_values"] = "select distinct lang, source from documents"


def text_filters(spark, sf):
    """Substring filter in which null is no match, with an extension test."""
    pages = table(spark, sf, "pages").select(
        "page_id", F.when(~F.col("url").contains("utm_source"), F.col("url")).alias("url"))
    return pages.where(contains_text(F.col("url"), "example.org") | F.col("url").isNull()) \
        .select("page_id", contains_text(F.col("url"), "/en/").alias("english"),
                F.coalesce(F.col("url").endswith(".html"), F.lit(False)).alias("html_file"))


QUERIES["text_filters"] = text_filters
ORACLES["text_filters"] = """
with p as (
  select page_id, case when not contains(url, 'utm_source') then url end as url from pages)
select page_id, coalesce(contains(url, '/en/'), false) as english,
  coalesce(ends_with(url, '.html'), false) as html_file
from p where coalesce(contains(url, 'example.org'), false) or url is null"""


def latest_snapshot(spark, sf):
    events = table(spark, sf, "events").select("user_id", "event_id", "event_type", "ts", "value")
    return M.latest(events, ["ts", "event_id"], ["user_id"]).drop("ts")


QUERIES["latest_snapshot"] = latest_snapshot
ORACLES["latest_snapshot"] = """
select user_id, event_id, event_type, value from events
qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1"""


def latest_file(spark, sf):
    """The newest of all rows that meet a condition."""
    files = table(spark, sf, "orders").select(
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("snapshot_date"),
        F.concat(F.lit("/raw/NACT/"), F.col("o_orderkey").cast("string")).alias("source_path"),
        "o_orderkey", "o_orderstatus")
    return M.latest_file(files, F.col("source_path").contains("NACT")
                         & (F.col("o_orderstatus") == "P"))


QUERIES["latest_file"] = latest_file
ORACLES["latest_file"] = """
select strftime(o_orderdate, '%Y-%m-%d') as snapshot_date,
  '/raw/NACT/' || o_orderkey as source_path, o_orderkey, o_orderstatus
from orders where o_orderstatus = 'P'
order by o_orderdate::date desc, '/raw/NACT/' || o_orderkey desc limit 1"""


def top_rows(spark, sf):
    return M.first_rows(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), 10,
                        [F.desc("o_totalprice"), "o_orderkey"])


QUERIES["top_rows"] = top_rows
ORACLES["top_rows"] = """
select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 10"""


def tail_rows(spark, sf):
    return M.last_rows(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), 10,
                       ["o_custkey", "o_orderkey"])


QUERIES["tail_rows"] = tail_rows
ORACLES["tail_rows"] = """
select o_orderkey, o_custkey from orders order by o_custkey desc, o_orderkey desc limit 10"""


def parquet_round_trip(spark, sf):
    """Write, read back and count, by partition of the layout."""
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_returnflag", "l_quantity")
    path = scratch_dir(spark, "round-trip")
    lines.write.partitionBy("l_returnflag").parquet(path)
    back = spark.read.schema(lines.schema).parquet(path)
    return back.groupBy("l_returnflag").agg(
        F.count("*").alias("n"), F.max("l_orderkey").alias("last_order"),
        F.lit(len(back.columns)).alias("n_columns"))


QUERIES["parquet_round_trip"] = parquet_round_trip
ORACLES["parquet_round_trip"] = """
select l_returnflag, count(*) as n, max(l_orderkey) as last_order, 4 as n_columns
from lineitem group by l_returnflag"""
