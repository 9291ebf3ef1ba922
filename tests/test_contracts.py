"""As-of join, and the job that joins the canonical entities."""

import random

import pytest
from pyspark.sql import functions as F

from filestrata.operators.asof import asof_join
from filestrata.plans import canonical as CP
from filestrata.plans.contracts import CONTRACTS, run_contracts
from filestrata.schemas import NACT_CONTRACTS, SGC_CONTRACTS


def plain(left, right):
    """The last state at or before each row's time; of equal times the greatest."""
    out = []
    for i, key, time in left:
        known = [(t, a, b) for k, t, a, b in right
                 if None not in (k, t, key, time) and k == key and t <= time]
        best = max(known, default=(None,) * 3, key=lambda s: (s[0], s[1] is not None, s[1] or "",
                                                               s[2] is not None, s[2] or ""))
        out.append((i, key, time, *best[1:], best[0]))
    return sorted(out, key=repr)


@pytest.mark.parametrize("parts", ["1", "8"])
def test_asof_join(spark, parts):
    rng = random.Random(int(parts))
    left = [(i, rng.choice(["hot", "hot", "a", "b", "c", None]), rng.choice([None, *range(400)]))
            for i in range(600)]
    right = [(rng.choice(["hot", "hot", "a", "d", None]), rng.choice([None, *range(300)]),
              rng.choice([None, "x", "y"]), rng.choice([None, "1", "2"])) for _ in range(500)]
    lefts = spark.createDataFrame(left, "id int, k string, t int")
    rights = spark.createDataFrame(right, "k string, at int, name string, t string")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    # So that a hot key is cut into slices that are not put together again.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        joined = asof_join(lefts, rights, "k", "t", "at", ["name", "t"], "r_")
        assert joined.columns == ["id", "k", "t", "r_name", "r_t", "r_at"]
        assert sorted(map(tuple, joined.collect()), key=repr) == plain(left, right)
        plan = joined._jdf.queryExecution().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan
        none = asof_join(lefts, rights.where("false"), "k", "t", "at", ["name"], "r_")
        assert none.where("r_name is not null").count() == 0 and none.count() == len(left)
        assert asof_join(lefts.where("false"), rights, "k", "t", "at", ["name"], "r_").count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def canonical(spark, schema, entity, rows):
    """Rows ``(contract, snapshot, {column: value})`` as a canonical table."""
    full = [[{"contract_number": c, "snapshot_date": s, "canonical_entity": entity, **more}.get(n)
             for n in schema.names] for c, s, more in rows]
    return spark.createDataFrame(full, schema).withColumn("source_path", F.concat("contract_number", "snapshot_date"))


def test_contracts_job(spark, tmp_path):
    root = str(tmp_path / "canonical")
    assert run_contracts(spark, root).collect() == []
    CP.write_canonical(canonical(spark, SGC_CONTRACTS, "sgc_contracts", [
        ("1", "2024-01-01_0800", {}), ("1", "2024-03-01_0800", {}), ("2", "2024-03-01_0800", {})]), root)
    # Without any state of a contract its rows stay.
    assert {r.nact_supplier_name for r in run_contracts(spark, root).collect()} == {None}
    CP.write_canonical(canonical(spark, NACT_CONTRACTS, "nact_contracts", [
        ("1", "2024-02-01_0800", {"supplier_name": "old", "nact_internal_id": "7"}),
        ("1", "2024-03-01_0800", {"supplier_name": "new"}),
        ("2", "2024-03-02_0800", {"supplier_name": "late"})]), root)
    joined = run_contracts(spark, root, ["2024-03-01_0800"])
    assert joined.schema.simpleString() == CONTRACTS.simpleString()
    assert sorted((r.contract_number, r.snapshot_date, r.nact_supplier_name, r.nact_snapshot_date)
                  for r in joined.collect()) == [
        ("1", "2024-01-01_0800", None, None), ("1", "2024-03-01_0800", "new", "2024-03-01_0800"),
        ("2", "2024-03-01_0800", None, None)]
    CP.write_canonical(canonical(spark, SGC_CONTRACTS, "sgc_contracts", [("1", "2024-02-15_0800", {})]), root)
    again = run_contracts(spark, root).where("snapshot_date = '2024-02-15_0800'").first()
    assert (again.nact_supplier_name, again.nact_internal_id) == ("old", "7")
