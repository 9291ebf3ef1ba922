"""Value, header, path and row rules on whole tables."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import functions as F

from ..functions import paths as P
from ..functions import text as T
from ..functions.folding import fold_accents
from ..functions.headers import layout_name, reader_names, technical_names
from ..operators.lineage import add_lineage, attach_file_attributes
from ..sources.files import with_path_attributes
from ..sources.groups import drop_empty_rows
from ..storage import materialize
from .inputs import table

RUN_TIME = datetime(2024, 2, 1, tzinfo=timezone.utc)

QUERIES, ORACLES = {}, {}


def contract_number(spark, sf):
    raw = F.concat(F.when(F.col("c_acctbal") < 0, "sem número").otherwise(F.col("c_name")),
                   F.lit(" ٣/"), F.col("c_nationkey").cast("string"))
    return table(spark, sf, "customer").select(
        "c_custkey", T.contract_number(F.col("c_name")).alias("contract_number"),
        T.contract_number(raw).alias("mixed_number"),
        T.contract_number(F.col("c_mktsegment")).alias("no_number"))


QUERIES["contract_number"] = contract_number
ORACLES["contract_number"] = r"""
select c_custkey,
  nullif(regexp_replace(c_name, '[^\p{Nd}]', '', 'g'), '') as contract_number,
  nullif(regexp_replace((case when c_acctbal < 0 then 'sem número' else c_name end)
    || ' ٣/' || c_nationkey, '[^\p{Nd}]', '', 'g'), '') as mixed_number,
  nullif(regexp_replace(c_mktsegment, '[^\p{Nd}]', '', 'g'), '') as no_number
from customer"""


def content_hash(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("file_hash"))


QUERIES["content_hash"] = content_hash
ORACLES["content_hash"] = "select doc_id, sha256(text) as file_hash from documents"


def bronze_stringify(spark, sf):
    return T.stringify(table(spark, sf, "events").select(
        "event_id", "user_id", "event_type", "props",
        F.when(F.col("value") > 10, F.col("user_id")).alias("big_spender")))


QUERIES["bronze_stringify"] = bronze_stringify
ORACLES["bronze_stringify"] = """
select event_id::varchar as event_id, user_id::varchar as user_id, event_type, props,
  (case when value > 10 then user_id end)::varchar as big_spender
from events"""

_TOKEN_LIST = ", ".join(f"'{t}'" for t in T.NULL_TOKENS)


def na_tokens(spark, sf):
    texts = F.array(*[F.lit(t) for t in (*T.NULL_TOKENS, " NA", "Na", "x")])
    token = F.get(texts, (F.col("p_partkey") % 22).cast("int"))
    return table(spark, sf, "part").select(
        "p_partkey", "p_name", token.alias("token")).select(
        "p_partkey",
        T.null_tokens("token").alias("value"),
        T.null_tokens("p_name").alias("p_name"),
        T.null_tokens("token", ()).alias("kept"))


QUERIES["na_tokens"] = na_tokens
ORACLES["na_tokens"] = f"""
with given as (
  select *, [{_TOKEN_LIST}, ' NA', 'Na', 'x'][(p_partkey % 22)::int + 1] as token from part)
select p_partkey, case when token not in ({_TOKEN_LIST}) then token end as value,
  case when p_name not in ({_TOKEN_LIST}) then p_name end as p_name, token as kept
from given"""


def drop_empty(spark, sf):
    poor = F.col("c_acctbal") < 1000
    return drop_empty_rows(table(spark, sf, "customer").select(
        F.when(~poor, F.col("c_custkey")).alias("c_custkey"),
        F.when(~poor | (F.col("c_mktsegment") == "BUILDING"), F.col("c_name")).alias("c_name"),
        F.when(~poor, F.col("c_mktsegment")).alias("c_mktsegment")))


QUERIES["drop_empty_rows"] = drop_empty
ORACLES["drop_empty_rows"] = """
select * from (
  select case when c_acctbal >= 1000 then c_custkey end as c_custkey,
    case when c_acctbal >= 1000 or c_mktsegment = 'BUILDING' then c_name end as c_name,
    case when c_acctbal >= 1000 then c_mktsegment end as c_mktsegment
  from customer)
where not (c_custkey is null and c_name is null and c_mktsegment is null)"""


def _lineage(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey",
        F.concat(F.lit("/raw/"), "o_orderpriority", F.lit("/orders.csv")).alias("read_path"))
    files = orders.select("read_path").distinct().select(
        "read_path", F.col("read_path").alias("source_path"),
        P.file_name(F.col("read_path")).alias("source_file"),
        F.element_at(F.split("read_path", "/"), 3).alias("snapshot_date"),
        P.source_type(P.file_name(F.col("read_path"))).alias("source_type"),
        F.sha2("read_path", 256).alias("file_hash"))
    files = materialize(files, "files")
    return add_lineage(
        attach_file_attributes(orders, files, "read_path", files.count()), RUN_TIME)


def lineage(spark, sf):
    return _lineage(spark, sf).select(
        "o_orderkey", "o_custkey", "_snapshot_date", "_source_file", "_source_path",
        "_source_type", "_file_hash", "_bronze_ingestion_timestamp", "_pipeline_version")


QUERIES["lineage"] = lineage
ORACLES["lineage"] = """
select o_orderkey, o_custkey, o_orderpriority as _snapshot_date, 'orders.csv' as _source_file,
  '/raw/' || o_orderpriority || '/orders.csv' as _source_path, 'csv' as _source_type,
  sha256('/raw/' || o_orderpriority || '/orders.csv') as _file_hash,
  '2024-02-01T00:00:00+00:00' as _bronze_ingestion_timestamp,
  'bronze_v1' as _pipeline_version
from orders"""


def record_numbers(spark, sf):
    """Record numbers are unique: each occurs once over the whole table."""
    per_number = _lineage(spark, sf).groupBy("_record_number").agg(F.count("*").alias("n"))
    return per_number.groupBy(F.col("n").alias("times_used")).agg(F.count("*").alias("rows"))


QUERIES["record_numbers"] = record_numbers
ORACLES["record_numbers"] = "select 1::bigint as times_used, count(*) as rows from orders"


def header_clean(spark, sf):
    """Messy, repeated and blank header cells over whole-table rows."""
    messy = reader_names(["Nº do Cliente", "NOME / RAZÃO SOCIAL", "NOME / RAZÃO SOCIAL", "",
                          "***", "SALDO (%)"])
    customers = table(spark, sf, "customer").select(
        F.col("c_custkey"), F.col("c_name"), F.col("c_mktsegment"), F.col("c_nationkey"),
        F.lit("x"), F.col("c_acctbal"))
    return customers.toDF(*technical_names(messy))


QUERIES["header_clean"] = header_clean
ORACLES["header_clean"] = """
select c_custkey as no_do_cliente, c_name as nome_razao_social,
  c_mktsegment as nome_razao_social_1, c_nationkey as unnamed_3, 'x' as col_4,
  c_acctbal as saldo
from customer"""


def header_layout(spark, sf):
    messy = [" PROJETO/ÁREA ", "SALDO (%)", "P.O", "PRAZO - INÍCIO"]
    return table(spark, sf, "supplier").select(
        "s_suppkey", "s_name", "s_nationkey", "s_acctbal"
    ).toDF(*[layout_name(n) for n in messy])


QUERIES["header_layout"] = header_layout
ORACLES["header_layout"] = """
select s_suppkey as projeto_area, s_name as "saldo_(percentual)", s_nationkey as po,
  s_acctbal as "prazo_-_inicio"
from supplier"""


def route_files(spark, sf):
    key = F.col("o_orderkey").cast("string")
    kind = F.col("o_orderkey") % 8
    name = (
        F.when(kind == 0, F.concat(F.lit("QEC_"), key, F.lit(".csv")))
        .when(kind == 1, F.lit("AnaliticoProjeto.csv"))
        .when(kind == 2, F.lit("Exportação_bm_acompanhamento.xlsx"))
        .when(kind == 3, F.concat(F.lit("Relatório Mensal-"), key, F.lit(".XLSB")))
        .when(kind == 4, F.concat(F.lit("qec_"), key, F.lit(".v2.csv")))
        .when(kind == 5, F.concat(F.lit("notas-"), key, F.lit(".txt")))
        .when(kind == 6, F.concat(F.lit("sem extensão "), key))
        .otherwise(F.concat(F.lit("202211_"), key, F.lit(".xlsb")))
    )
    folder = F.when(kind == 7, F.lit("\\raw\\s1\\nact\\")).otherwise(F.lit("/raw/s1/outros/"))
    files = table(spark, sf, "orders").select(
        "o_orderkey", name.alias("source_file"), F.concat(folder, name).alias("source_path"))
    return files.select(
        "o_orderkey", P.source_type(F.col("source_file")).alias("source_type"),
        P.source_type_error(F.col("source_file")).alias("error_message"),
        P.dataset_name(F.col("source_file"), F.col("source_path")).alias("dataset_name"))


QUERIES["route_files"] = route_files
ORACLES["route_files"] = """
select o_orderkey,
  case o_orderkey % 8 when 0 then 'csv' when 1 then 'csv' when 2 then 'xlsx' when 3 then 'xlsb'
    when 4 then 'csv' when 7 then 'xlsb' end as source_type,
  case o_orderkey % 8 when 5 then 'Unsupported extension: txt'
    when 6 then 'Unsupported extension: ' end as error_message,
  case o_orderkey % 8 when 0 then 'qec' when 1 then 'analitico_projeto'
    when 2 then 'controle_medicoes_andamento' when 3 then 'relatório_mensal_' || o_orderkey
    when 4 then 'qec_' || o_orderkey || '.v2' when 5 then 'notas_' || o_orderkey
    when 6 then 'sem_extensão_' || o_orderkey else 'nact' end as dataset_name
from orders"""


def reader_routing(spark, sf):
    """Source types by name: readable, declared without a reader, or unknown."""
    kinds = F.array(*[F.lit(t) for t in (*P.SOURCE_TYPES, *P.DECLARED_TYPES, "zip")])
    kind = F.get(kinds, (F.col("event_id") % 11).cast("int"))
    return table(spark, sf, "events").select(
        "event_id", kind.alias("source_type"), P.reader_error(kind).alias("error_message"))


_KINDS = ", ".join(f"'{t}'" for t in (*P.SOURCE_TYPES, *P.DECLARED_TYPES, "zip"))
QUERIES["reader_routing"] = reader_routing
ORACLES["reader_routing"] = f"""
select event_id, [{_KINDS}][(event_id % 11)::int + 1] as source_type,
  case when event_id % 11 < 3 then null
    when event_id % 11 = 10 then 'Reader not found: zip'
    else 'Reader not implemented: ' || [{_KINDS}][(event_id % 11)::int + 1] end as error_message
from events"""


def landing_keys(spark, sf):
    """Path attributes of files whose paths come from page addresses."""
    files = table(spark, sf, "pages").select(
        "page_id", F.length("html").cast("bigint").alias("file_size_bytes"),
        F.concat(F.lit("/data/RAW/"), F.regexp_replace("url", "^https?://", "")).alias("source_path"))
    return with_path_attributes(files, "/data/RAW", "contracts").select(
        "page_id", "snapshot_date", "source_file", "relative_path", "landing_bucket",
        "landing_key", "file_extension")


QUERIES["landing_keys"] = landing_keys
ORACLES["landing_keys"] = r"""
with p as (select page_id, regexp_replace(url, '^https?://', '') as rel from pages),
n as (select *, regexp_extract(rel, '([^/]*)$', 1) as name,
        split_part(rel, '/', 1) as snap from p)
select page_id, snap as snapshot_date, name as source_file, rel as relative_path,
  'contracts' as landing_bucket,
  'landing/snapshot_date=' || snap || '/' || substr(rel, length(snap) + 2) as landing_key,
  lower(regexp_extract(name, '^.+(\.[^.]+)$', 1)) as file_extension
from n"""


def fold_values(spark, sf):
    """Whole documents without accents, and how many signs that took."""
    folded = fold_accents(F.col("text"))
    return table(spark, sf, "documents").select(
        "doc_id", F.sha2(folded, 256).alias("folded_sha256"),
        (F.char_length("text") - F.char_length(folded)).cast("bigint").alias("n_marks"))


QUERIES["fold_values"] = fold_values
ORACLES["fold_values"] = """
select doc_id, sha256(strip_accents(text)) as folded_sha256,
  (length(text) - length(strip_accents(text)))::bigint as n_marks
from documents"""
