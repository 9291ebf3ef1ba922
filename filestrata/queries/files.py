"""Queries that go through files: messy inputs written from whole tables, read
back by the scans and jobs, and compared with the tables."""

from __future__ import annotations

import posixpath
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import NULL_TOKENS
from ..operators.control import read_manifest
from ..plans.bronze import BronzeBatch, bad_row_records
from ..plans.landing import run_landing
from ..schemas import EXECUTION_LOG, QUALITY_LOG
from ..sources import delimited, workbook
from ..sources.files import hash_files
from ..sources.groups import drop_empty_rows
from ..sources.tables import read_table
from ..sources.workbook_source import read_workbooks
from ..storage import delete_path, scratch_dir
from .inputs import table, write_csv, write_text_files, write_workbooks, written_files

QUERIES, ORACLES = {}, {}
_TOKENS = ", ".join(f"'{t}'" for t in NULL_TOKENS)


def csv_round_trip(spark, sf):
    """Whole documents, with line breaks and quotes in their text, as files of
    three delimiters and two encodings; the scan finds out which is which."""
    documents = table(spark, sf, "documents").select(
        F.col("doc_id").alias("Nº Documento"), F.col("text").alias("TEXTO"),
        F.col("lang").alias("Língua"), F.col("source").alias("Fonte (%)"),
        F.col("n_chars").alias("Nº Caracteres"))
    fits = F.col("TEXTO").rlike("^[\\x00-\\xff]*$") & (F.col("`Nº Documento`") % 2 == 0)
    english = F.col("Língua") == "en"
    root = scratch_dir(spark, "csv")
    write_csv(documents.where(fits), f"{root}/a", ",", "ISO-8859-1")
    write_csv(documents.where(~fits & english), f"{root}/b", ";")
    write_csv(documents.where(~fits & ~english), f"{root}/c", "\t")
    return delimited.read_delimited(spark, written_files(spark, root)).drop("_source_path")


QUERIES["csv_round_trip"] = csv_round_trip
ORACLES["csv_round_trip"] = f"""
select doc_id::varchar as no_documento,
  case when text not in ({_TOKENS}) then text end as texto,
  lang as lingua, source as fonte, n_chars::varchar as no_caracteres
from documents"""


def csv_line_ends(spark, sf):
    """Whole documents, line breaks in their text, as small files whose rows end
    with LF, CR, CRLF or each of them in turn."""
    documents = table(spark, sf, "documents").select("doc_id", "text")
    ends = F.array(F.lit("\n"), F.lit("\r"), F.lit("\r\n"))
    kind = F.floor(F.col("doc_id") / 25) % 4
    end = F.get(ends, F.when(kind == 3, F.col("doc_id") % 3).otherwise(kind).cast("int"))
    row = F.concat(F.col("doc_id").cast("string"), F.lit(';"'),
                   F.replace(F.coalesce("text", F.lit("")), F.lit('"'), F.lit('""')), F.lit('"'), end)
    files = documents.select(F.floor(F.col("doc_id") / 25).alias("file"), kind.alias("kind"), end.alias("end"),
                             "doc_id", row.alias("row")).groupBy("file").agg(
        F.sort_array(F.collect_list(F.struct("doc_id", "row", "end"))).alias("rows"))
    root = scratch_dir(spark, "line-ends")
    write_text_files(files.select(
        F.concat(F.col("file").cast("string"), F.lit(".csv")).alias("relative_path"),
        F.concat(F.lit("documento;texto"), F.col("rows")[0]["end"],
                 F.array_join(F.transform("rows", lambda r: r["row"]), "")).alias("text")), root)
    return delimited.read_delimited(spark, written_files(spark, root)).drop("_source_path")


QUERIES["csv_line_ends"] = csv_line_ends
ORACLES["csv_line_ends"] = f"""
select doc_id::varchar as documento, case when text not in ({_TOKENS}) then text end as texto
from documents"""


def csv_plain(spark, sf):
    """Well-formed files: the split-friendly path of the scan."""
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus",
        F.date_format("l_shipdate", "dd/MM/yyyy").alias("l_shipdate"))
    root = scratch_dir(spark, "csv")
    write_csv(lines, root)
    return delimited.read_delimited(spark, written_files(spark, root)).drop("_source_path")


QUERIES["csv_plain"] = csv_plain
ORACLES["csv_plain"] = """
select l_orderkey::varchar as l_orderkey, l_linenumber::varchar as l_linenumber,
  l_partkey::varchar as l_partkey, l_suppkey::varchar as l_suppkey, l_returnflag, l_linestatus,
  strftime(l_shipdate, '%d/%m/%Y') as l_shipdate
from lineitem"""


def _write_ragged(spark, sf, folder):
    """Customers as raw lines: some short, some over-long, some with a surplus
    empty field, which is not an error."""
    line = (
        F.when(F.col("c_mktsegment") == "BUILDING",
               F.concat_ws(";", "c_custkey", "c_name", "c_nationkey", F.lit("a"), F.lit("b")))
        .when(F.col("c_mktsegment") == "MACHINERY", F.concat_ws(";", "c_custkey", "c_name"))
        .when(F.col("c_mktsegment") == "FURNITURE",
              F.concat_ws(";", "c_custkey", "c_name", "c_nationkey", F.lit("")))
        .otherwise(F.concat_ws(";", "c_custkey", "c_name", "c_nationkey"))
    )
    customers = table(spark, sf, "customer").select(line.alias("custkey;name;nation"))
    # One column under a header of three: no quoting, no escaping.
    customers.write.option("header", True).option("sep", "\x01").csv(folder)


def _ragged_scan(spark, sf):
    root = scratch_dir(spark, "ragged")
    _write_ragged(spark, sf, root)
    files = written_files(spark, root)
    dialects = delimited.detect_dialects(spark, files)
    return [group.open() for group in delimited.header_groups(spark, dialects)]


def csv_bad_lines(spark, sf):
    tables = [group.table() for group in _ragged_scan(spark, sf)]
    return reduce(DataFrame.unionByName, tables).drop("_file_uri")


QUERIES["csv_bad_lines"] = csv_bad_lines
ORACLES["csv_bad_lines"] = """
select c_custkey::varchar as custkey, c_name as name,
  case when c_mktsegment <> 'MACHINERY' then c_nationkey::varchar end as nation
from customer where c_mktsegment <> 'BUILDING'"""


def quality_log(spark, sf):
    """Quality records of the over-long rows, counted by kind."""
    bad = [g.bad_rows for g in _ragged_scan(spark, sf) if g.bad_rows is not None]
    records = bad_row_records(
        reduce(DataFrame.unionByName, bad)
        .withColumn("source_file", F.lit("clientes.csv"))
        .withColumn("snapshot_date", F.lit("2024-02-01_0800")))
    return records.groupBy("source_file", "issue_type", "issue_description", "severity").agg(
        F.count("*").alias("n"), F.count("line_number").alias("n_located"),
        F.count_distinct("source_path", "line_number").alias("n_places"))


QUERIES["quality_log"] = quality_log
ORACLES["quality_log"] = """
select 'clientes.csv' as source_file, 'BAD_CSV_LINE_SKIPPED' as issue_type,
  'Row left out, it has more fields than the header: expected 3 fields, saw 5' as issue_description,
  'WARNING' as severity, count(*) as n, count(*) as n_located, count(*) as n_places
from customer where c_mktsegment = 'BUILDING' having count(*) > 0"""


def _document_files(spark, sf, root):
    write_text_files(
        table(spark, sf, "documents").select(
            F.concat_ws("/", "lang", "source",
                        F.concat(F.lit("doc +"), F.col("doc_id").cast("string"), F.lit(".TXT")))
            .alias("relative_path"), "text"),
        root)


def landing_run(spark, sf):
    """One raw file per document, found, hashed and copied by the landing job;
    the hash of each landed copy is taken again."""
    root = scratch_dir(spark, "landing")
    _document_files(spark, sf, f"{root}/raw")
    landed = run_landing(spark, f"{root}/raw", f"{root}/lake", f"{root}/metadata", "contracts")
    copies = landed.select(
        "landing_key", F.concat(F.lit(f"{root}/lake/"), "landing_key").alias("source_path"),
        "file_size_bytes")
    rehashed = hash_files(copies).select("landing_key", F.col("file_hash").alias("copy_hash"))
    return landed.join(rehashed, "landing_key").select(
        "snapshot_date", "source_file", "relative_path", "landing_bucket", "landing_key",
        "file_extension", "file_size_bytes", "file_hash", "copy_hash", "upload_status",
        "error_message")


QUERIES["landing_run"] = landing_run
ORACLES["landing_run"] = """
select lang as snapshot_date, 'doc +' || doc_id || '.TXT' as source_file,
  lang || '/' || source || '/doc +' || doc_id || '.TXT' as relative_path,
  'contracts' as landing_bucket,
  'landing/snapshot_date=' || lang || '/' || source || '/doc +' || doc_id || '.TXT' as landing_key,
  '.txt' as file_extension, octet_length(encode(text)) as file_size_bytes,
  sha256(text) as file_hash, sha256(text) as copy_hash, 'SUCCESS' as upload_status,
  null::varchar as error_message
from documents"""


def _landed_orders(spark, sf, root):
    """Raw CSV files of all orders, a snapshot folder per priority, landed. The
    writer's own marker and checksum files are left out of the batch."""
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("Nº Pedido"), F.col("o_custkey").alias("Cliente"),
        F.col("o_orderstatus").alias("Situação"),
        F.date_format("o_orderdate", "dd/MM/yyyy").alias("Data"),
        F.col("o_orderpriority").alias("snap"))
    write_csv(orders, f"{root}/raw", partition_by=["snap"])
    landed = run_landing(spark, f"{root}/raw", f"{root}/lake", f"{root}/metadata", "contracts")
    return landed.where(F.col("file_extension") == ".csv")


def _batches(spark, sf):
    root = scratch_dir(spark, "bronze")
    landed = _landed_orders(spark, sf, root)

    def batch(force=False):
        run = BronzeBatch(spark, f"{root}/lake", f"{root}/bronze", f"{root}/control")
        return run.run(landed, force)

    return root, landed, batch


def bronze_rows(spark, sf):
    """All orders through landing and Bronze: text columns with lineage."""
    root, _, batch = _batches(spark, sf)
    batch()
    bronze = spark.read.option("mergeSchema", False).parquet(f"{root}/bronze")
    return bronze.select(
        "no_pedido", "cliente", "situacao", "data", "_snapshot_date", "_source_type",
        "_pipeline_version", F.length("_file_hash").alias("hash_length"))


QUERIES["bronze_rows"] = bronze_rows
ORACLES["bronze_rows"] = """
select o_orderkey::varchar as no_pedido, o_custkey::varchar as cliente,
  o_orderstatus as situacao, strftime(o_orderdate, '%d/%m/%Y') as data,
  'snap=' || o_orderpriority as _snapshot_date, 'csv' as _source_type,
  'bronze_v1' as _pipeline_version, 64 as hash_length
from orders"""


def bronze_batch(spark, sf):
    """The batch three times over: ingest, skip, forced. Per snapshot: statuses,
    Bronze rows after all runs, one manifest row per file."""
    root, landed, batch = _batches(spark, sf)
    first, second, forced = batch(), batch(), batch(force=True)

    def statuses(records, name):
        return records.groupBy("snapshot_date").agg(
            F.array_join(F.array_sort(F.collect_set("status")), ",").alias(name))

    rows = spark.read.parquet(f"{root}/bronze").groupBy(
        F.col("_snapshot_date").alias("snapshot_date")).agg(F.count("*").alias("n_rows"))
    files = landed.groupBy("snapshot_date").agg(F.count("*").alias("files"))
    kept = read_manifest(spark, f"{root}/control/manifest").groupBy("snapshot_date").agg(
        F.count("*").alias("kept"))
    logged = read_table(spark, f"{root}/control/execution_log", EXECUTION_LOG).groupBy(
        "snapshot_date").agg(
            F.count("*").alias("logged"),
            F.count_distinct("execution_id").alias("n_runs"),
            F.bool_and(F.col("duration_seconds") >= 0).alias("durations_ok"))
    joined = reduce(
        lambda a, b: a.join(b, "snapshot_date"),
        [statuses(first, "first_run"), statuses(second, "second_run"),
         statuses(forced, "forced_run"), rows, files, kept, logged])
    return joined.select(
        "snapshot_date", "first_run", "second_run", "forced_run", "n_rows", "n_runs",
        "durations_ok", (F.col("kept") == F.col("files")).alias("manifest_ok"),
        (F.col("logged") == 3 * F.col("files")).alias("log_ok"))


QUERIES["bronze_batch"] = bronze_batch
ORACLES["bronze_batch"] = """
select 'snap=' || o_orderpriority as snapshot_date, 'SUCCESS' as first_run,
  'SKIPPED' as second_run, 'SUCCESS' as forced_run, count(*) as n_rows, 3::bigint as n_runs,
  true as durations_ok, true as manifest_ok, true as log_ok
from orders group by o_orderpriority"""


class _FirstWriteFails(BronzeBatch):
    """A batch whose first write of every group breaks."""

    def _write(self, group, mine, paths):
        written = super()._write(group, mine, paths)
        if not getattr(group, "broken_once", False):
            group.broken_once = True
            raise OSError("the store went away")
        return written


def bronze_retry(spark, sf):
    """Customers as ragged files through a batch whose first write of every group
    fails: all rows are there once, and every over-long row is logged once."""
    root = scratch_dir(spark, "retry")
    _write_ragged(spark, sf, f"{root}/raw/2024-01-01")
    landed = run_landing(spark, f"{root}/raw", f"{root}/lake", f"{root}/metadata", "contracts").where(
        F.col("file_extension") == ".csv")
    done = _FirstWriteFails(
        spark, f"{root}/lake", f"{root}/bronze", f"{root}/control", delay_seconds=0.0).run(landed)
    outcome = done.groupBy("snapshot_date").agg(
        F.array_join(F.array_sort(F.collect_set("status")), ",").alias("status"),
        F.min("retry_count").alias("retries"))
    rows = spark.read.parquet(f"{root}/bronze").groupBy(
        F.col("_snapshot_date").alias("snapshot_date")).agg(F.count("*").alias("n_rows"))
    logged = read_table(spark, f"{root}/control/quality_log", QUALITY_LOG).groupBy("snapshot_date").agg(
        F.count("*").alias("n_bad"), F.count_distinct("source_path", "line_number").alias("n_places"))
    return outcome.join(rows, "snapshot_date").join(logged, "snapshot_date", "left").fillna(
        0, ["n_bad", "n_places"])


QUERIES["bronze_retry"] = bronze_retry
ORACLES["bronze_retry"] = """
select '2024-01-01' as snapshot_date, 'SUCCESS' as status, 1 as retries,
  count(*) filter (where c_mktsegment <> 'BUILDING') as n_rows,
  count(*) filter (where c_mktsegment = 'BUILDING') as n_bad,
  count(*) filter (where c_mktsegment = 'BUILDING') as n_places
from customer"""


def workbook_scan(spark, sf):
    """All customers as XLSX and all suppliers as XLSB workbooks, read back."""
    root = scratch_dir(spark, "workbooks")
    customers = table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("Nº"), F.col("c_name").alias("Razão Social"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")).alias("Setor"))
    suppliers = table(spark, sf, "supplier").select(
        F.col("s_suppkey").cast("string").alias("Nº"), F.col("s_name").alias("Razão Social"),
        F.lit("NA").alias("Setor"))
    write_workbooks(customers, f"{root}/a", "xlsx")
    write_workbooks(suppliers, f"{root}/b", "xlsb")
    _, groups = workbook.header_groups(spark, written_files(spark, root))
    return reduce(DataFrame.unionByName, [g.open().table() for g in groups]).drop("_file_uri")


QUERIES["workbook_scan"] = workbook_scan
ORACLES["workbook_scan"] = """
select c_custkey::varchar as no, c_name as razao_social,
  case when c_mktsegment <> 'BUILDING' then c_mktsegment end as setor
from customer
union all select s_suppkey::varchar, s_name, null from supplier"""


def sample_scan(spark, sf):
    """The first sheet rows of every workbook, as layout detection sees them."""
    root = scratch_dir(spark, "workbooks")
    parts = table(spark, sf, "part").select(
        F.col("p_partkey").cast("string").alias("Número de contrato"), F.col("p_name").alias("Nome"))
    write_workbooks(parts, root, "xlsx")
    rows = workbook.scan_workbooks(written_files(spark, root), max_rows=5)
    return workbook.sample_rows(rows).groupBy("source_path").agg(
        F.max(F.col("row_idx")).alias("last_row"),
        F.bool_or((F.col("row_idx") == 0) & F.array_contains("cells", "Número de contrato"))
        .alias("marked"),
    ).select("last_row", "marked").distinct()


QUERIES["sample_scan"] = sample_scan
ORACLES["sample_scan"] = """
select 4 as last_row, true as marked from part having count(*) >= 4"""


def workbook_source(spark, sf):
    """All parts as workbooks, through the Spark data source: every row of them, and
    how many workbooks show their header in a second load of two rows each."""
    root = scratch_dir(spark, "workbooks")
    parts = table(spark, sf, "part").select(
        F.col("p_partkey").cast("string").alias("Nº"), F.col("p_name").alias("Nome"),
        F.when(F.col("p_size") > 25, F.col("p_brand")).alias("Marca"))
    write_workbooks(parts, f"{root}/a", "xlsx", rows_per_file=500)
    write_workbooks(parts, f"{root}/b", "xlsb", rows_per_file=700)
    files = written_files(spark, root)
    rows = read_workbooks(files).where("row_idx > 0").select(
        *[F.get("cells", F.lit(i)).alias(n) for i, n in enumerate(("no", "nome", "marca"))])
    tops = read_workbooks(files, rows=2).groupBy("source_path").agg(
        F.max("row_idx").alias("last"), F.bool_or(F.array_contains("cells", "Nome")).alias("marked"))
    unlike = tops.where("last <> 1 or not marked").select(
        F.col("source_path").alias("no"), F.lit("top").alias("nome"), F.lit(None).cast("string").alias("marca"))
    return rows.unionByName(unlike)


QUERIES["workbook_source"] = workbook_source
ORACLES["workbook_source"] = """
select p_partkey::varchar as no, p_name as nome, case when p_size > 25 then p_brand end as marca
from part, range(2)"""


def empty_rows_kept_out(spark, sf):
    """Rows blank in every data column leave, whatever their lineage says."""
    events = table(spark, sf, "events").select(
        F.when(F.col("value") >= 5, F.col("props")).alias("props"),
        F.when(F.col("event_type") == "click", F.col("user_id")).alias("user_id"),
        F.col("event_id").alias("_record_number"))
    return drop_empty_rows(events, ["props", "user_id"])


QUERIES["empty_rows_kept_out"] = empty_rows_kept_out
ORACLES["empty_rows_kept_out"] = """
select case when value >= 5 then props end as props,
  case when event_type = 'click' then user_id end as user_id, event_id as _record_number
from events where (value >= 5 and props is not null) or (event_type = 'click' and user_id is not null)"""


class _FilesVanish(BronzeBatch):
    """A batch whose first files, by name, are gone once their headers are known."""

    def _csv_groups(self, paths):
        errors, groups = super()._csv_groups(paths)
        for path in sorted(r.source_path for r in paths.select("source_path").collect()):
            if posixpath.basename(path) < "part-10":
                delete_path(self.spark, path)
        return errors, groups


def vanishing_files(spark, sf):
    """All order lines as 14 files, of which the first ten are broken before
    their rows are read: each fails alone, all others are published whole."""
    root = scratch_dir(spark, "vanishing")
    lines = table(spark, sf, "lineitem").select(
        (F.col("l_orderkey") % 14).alias("part"), F.col("l_orderkey").cast("string").alias("pedido"),
        F.col("l_linenumber").cast("string").alias("linha"))
    row = F.concat("pedido", F.lit(";"), "linha")
    texts = lines.groupBy("part").agg(F.array_join(F.collect_list(row), "\n").alias("rows"))
    write_text_files(texts.select(
        F.concat(F.lit("part-"), F.lpad(F.col("part").cast("string"), 2, "0"), F.lit(".csv"))
        .alias("relative_path"), F.concat(F.lit("pedido;linha\n"), "rows", F.lit("\n")).alias("text")),
        f"{root}/raw/2024-01-01")
    landed = run_landing(spark, f"{root}/raw", f"{root}/lake", f"{root}/metadata", "contracts").where(
        F.col("file_extension") == ".csv")
    done = _FilesVanish(
        spark, f"{root}/lake", f"{root}/bronze", f"{root}/control", attempts=1).run(landed)
    rows = spark.read.parquet(f"{root}/bronze").groupBy(F.col("_source_file").alias("source_file")).agg(
        F.count("*").alias("n_rows"))
    return done.select("source_file", "status").join(rows, "source_file", "left").fillna(0, ["n_rows"])


QUERIES["vanishing_files"] = vanishing_files
ORACLES["vanishing_files"] = """
select 'part-' || lpad((l_orderkey % 14)::varchar, 2, '0') || '.csv' as source_file,
  case when l_orderkey % 14 < 10 then 'FAILED' else 'SUCCESS' end as status,
  case when l_orderkey % 14 < 10 then 0 else count(*) end as n_rows
from lineitem group by l_orderkey % 14"""


class CutOff(BaseException):
    """Ends a batch as a lost driver would: nothing catches it."""


class _EndsAfterOnePart(BronzeBatch):
    def _note(self, outcome):
        super()._note(outcome)
        raise CutOff


class _Counting(BronzeBatch):
    parts = 0

    def _note(self, outcome):
        self.parts += 1
        super()._note(outcome)


def bronze_resume(spark, sf):
    """Orders in two header groups; a batch that ends after the first of them, and the
    next one, which writes only the other. A third finds all in the manifest."""
    root = scratch_dir(spark, "resume")
    orders = table(spark, sf, "orders").withColumn("snap", F.col("o_orderpriority"))
    urgent = F.col("o_orderpriority").startswith("1")
    write_csv(orders.where(urgent).select(
        F.col("o_orderkey").alias("pedido"), "snap"), f"{root}/raw/a", partition_by=["snap"])
    write_csv(orders.where(~urgent).select(
        F.col("o_orderkey").alias("pedido"), F.col("o_custkey").alias("cliente"), "snap"),
        f"{root}/raw/b", partition_by=["snap"])
    landed = run_landing(spark, f"{root}/raw", f"{root}/lake", f"{root}/metadata", "contracts")
    landed = landed.where(F.col("file_extension") == ".csv")

    def batch(kind):
        return kind(spark, f"{root}/lake", f"{root}/bronze", f"{root}/control")

    try:
        batch(_EndsAfterOnePart).run(landed)
    except CutOff:
        pass
    resumed = batch(_Counting)
    second = resumed.run(landed)
    third = batch(BronzeBatch).run(landed)

    def statuses(records, name):
        return records.groupBy("snapshot_date").agg(
            F.array_join(F.array_sort(F.collect_set("status")), ",").alias(name))

    rows = spark.read.parquet(f"{root}/bronze").groupBy(
        F.col("_snapshot_date").alias("snapshot_date")).agg(
            F.count("*").alias("n_rows"), F.count_distinct("pedido").alias("n_orders"))
    frames = [statuses(second, "second_run"), statuses(third, "third_run"), rows]
    return reduce(lambda a, b: a.join(b, "snapshot_date"), frames).select(
        "snapshot_date", "second_run", "third_run", "n_rows", "n_orders",
        F.lit(resumed.parts).cast("bigint").alias("parts_written"))


QUERIES["bronze_resume"] = bronze_resume
ORACLES["bronze_resume"] = """
select case when o_orderpriority like '1%' then 'a' else 'b' end as snapshot_date,
  'SUCCESS' as second_run, 'SKIPPED' as third_run, count(*) as n_rows,
  count(distinct o_orderkey) as n_orders, 1::bigint as parts_written
from orders group by 1"""
