"""The canonical entities joined as of each snapshot."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import canonical as C
from ..operators.asof import asof_join
from ..plans import canonical as CP
from ..plans.contracts import run_contracts
from ..schemas import NACT_CONTRACTS
from ..storage import scratch_dir
from .inputs import money, table
from .values import RUN_TIME

QUERIES, ORACLES = {}, {}


def _snapshot(day):
    """The year of a day, as a snapshot's name."""
    return F.concat(F.date_format(F.date_trunc("year", day), "yyyy-MM-dd"), F.lit("_0800"))


def _states(spark, sf):
    """Finished orders as contract states, several a contract and some a snapshot."""
    orders = table(spark, sf, "orders").where("o_orderstatus = 'F'")
    number = F.concat(F.lit("NR "), F.col("o_custkey").cast("string"))
    known = {
        "contract_number_raw": number,
        "contract_number": F.col("o_custkey").cast("string"),
        "supplier_name": F.col("o_orderpriority"),
        "compliance_score": money("o_totalprice"),
        "source_vendor": F.lit(C.VENDORS[C.EY]),
        "source_layout": F.lit(C.EY),
        "canonical_entity": F.lit("nact_contracts"),
        "snapshot_date": _snapshot(F.col("o_orderdate")),
        "processed_at": F.lit(RUN_TIME.isoformat()),
    }
    return orders.select(
        *[known.get(n, F.lit(None).cast("string")).alias(n) for n in NACT_CONTRACTS.names],
        F.concat(F.lit("/states/"), F.col("o_custkey") % 3).alias("source_path"))


def _portfolio(spark, sf):
    """Open orders as portfolio rows; contract 1 holds a third of them."""
    orders = table(spark, sf, "orders").where("o_orderstatus <> 'F'")
    owner = F.when(F.col("o_orderkey") % 3 == 0, F.lit(1)).otherwise(F.col("o_custkey"))
    raw = orders.select(
        owner.cast("string").alias("CONTRATO"), F.col("o_orderkey").cast("string").alias("PO"),
        money("o_totalprice").alias("VALOR TOTAL"), "o_orderdate")
    mapped = C.sgc_contracts(raw, _snapshot(F.col("o_orderdate")), RUN_TIME)
    return mapped.withColumn("source_path", F.concat(F.lit("/portfolio/"), F.crc32("contract_number") % 2))


def contracts_joined(spark, sf):
    """The portfolio with the last contract state at or before each snapshot, by the
    job: both canonical tables written, joined in two runs, read back."""
    root = scratch_dir(spark, "contracts")
    CP.write_canonical(_states(spark, sf), root)
    CP.write_canonical(_portfolio(spark, sf), root)
    snapshots = [r.s for r in spark.read.parquet(f"{root}/entity=sgc_contracts")
                 .select(F.col("snapshot_date").alias("s")).distinct().sort("s").collect()]
    half = len(snapshots) // 2
    run_contracts(spark, root, snapshots[:half])
    joined = run_contracts(spark, root, snapshots[half:])
    return joined.select(
        "contract_number", "po_value", "total_value", "snapshot_date", "nact_snapshot_date",
        "nact_supplier_name", "nact_compliance_score", "nact_contract_number_raw")


QUERIES["contracts_joined"] = contracts_joined
ORACLES["contracts_joined"] = """
with states as (
  select o_custkey, date_trunc('year', o_orderdate) as year,
    max({'name': o_orderpriority, 'score': o_totalprice::decimal(18,2)::varchar}) as state
  from orders where o_orderstatus = 'F' group by all),
portfolio as (
  select case when o_orderkey % 3 = 0 then 1 else o_custkey end as owner, o_orderkey,
    o_totalprice::decimal(18,2)::varchar as total_value, date_trunc('year', o_orderdate) as year
  from orders where o_orderstatus <> 'F')
select p.owner::varchar as contract_number, p.o_orderkey::varchar as po_value, p.total_value,
  strftime(p.year, '%Y-%m-%d') || '_0800' as snapshot_date,
  strftime(s.year, '%Y-%m-%d') || '_0800' as nact_snapshot_date,
  s.state.name as nact_supplier_name, s.state.score as nact_compliance_score,
  'NR ' || s.o_custkey as nact_contract_number_raw
from portfolio p asof left join states s
  on p.owner = s.o_custkey and p.year >= s.year"""


def latest_views(spark, sf):
    """Each purchase with the user's last page view at or before it."""
    events = table(spark, sf, "events")
    buys = events.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    views = events.where("event_type = 'view'").select(
        "user_id", "ts", F.col("event_id").alias("view_id"), "value")
    return asof_join(buys, views, "user_id", "ts", "ts", ["view_id", "value"], "last_").select(
        "event_id", "user_id", "last_view_id", "last_value")


QUERIES["latest_views"] = latest_views
ORACLES["latest_views"] = """
with views as (
  select user_id, ts, max({'view_id': event_id, 'value': value}) as state
  from events where event_type = 'view' group by user_id, ts)
select b.event_id, b.user_id, v.state.view_id as last_view_id, v.state.value as last_value
from events b asof left join views v on b.user_id = v.user_id and b.ts >= v.ts
where b.event_type = 'purchase'"""
