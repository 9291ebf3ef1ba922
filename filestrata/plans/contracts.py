"""The two canonical entities joined: the portfolio with the state of its contracts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.asof import asof_join
from ..schemas import NACT_CONTRACTS, SGC_CONTRACTS
from ..storage import clear_scratch, path_exists, scratch_mark
from .canonical import read_canonical

ENTITY = "contracts"
KEY, TIME, PREFIX = "contract_number", "snapshot_date", "nact_"
# What a contract's state says; key, entity and processing time are the row's own.
STATE_COLUMNS = [n for n in NACT_CONTRACTS.names
                 if n not in (KEY, TIME, "canonical_entity", "processed_at")]


def _state_name(column: str) -> str:
    return PREFIX + column.removeprefix(PREFIX)


CONTRACTS = T.StructType([
    *SGC_CONTRACTS.fields,
    *[T.StructField(_state_name(n), T.StringType()) for n in (*STATE_COLUMNS, TIME)],
])


def contracts_with_state(sgc: DataFrame, nact: DataFrame) -> DataFrame:
    """Every portfolio row with its contract's last state at or before the row's
    snapshot. Snapshots are compared as text, which their names sort by."""
    joined = asof_join(
        sgc.select(*SGC_CONTRACTS.names), nact, KEY, TIME, TIME, STATE_COLUMNS, f"_{PREFIX}")
    return joined.select(
        *SGC_CONTRACTS.names,
        *[F.col(f"_{PREFIX}{n}").alias(_state_name(n)) for n in (*STATE_COLUMNS, TIME)],
    )


def _entity(spark: SparkSession, root: str, name: str, schema: T.StructType) -> DataFrame:
    """A canonical table; without rows before the first run that wrote it."""
    if not path_exists(spark, f"{root.rstrip('/')}/entity={name}"):
        return spark.createDataFrame([], schema)
    return read_canonical(spark, root, name)


def run_contracts(spark: SparkSession, root: str, snapshots: list[str] | None = None) -> DataFrame:
    """Join the canonical tables below ``root`` and overwrite the joined one.

    ``snapshots`` limits the run to portfolio rows of those snapshots, for instance
    the new ones; others keep what an earlier run wrote for them. States of all
    earlier snapshots are looked at either way. Returns the joined table.
    """
    mark = scratch_mark()
    sgc = _entity(spark, root, "sgc_contracts", SGC_CONTRACTS)
    nact = _entity(spark, root, "nact_contracts", NACT_CONTRACTS)
    if snapshots is not None:
        sgc = sgc.where(F.col(TIME).isin(*snapshots))
        nact = nact.where(F.col(TIME) <= max(snapshots, default=""))
    (
        contracts_with_state(sgc, nact).withColumn("entity", F.lit(ENTITY))
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("entity", TIME).parquet(root)
    )
    clear_scratch(spark, mark)
    return read_contracts(spark, root)


def read_contracts(spark: SparkSession, root: str) -> DataFrame:
    """The joined table in its fixed column order; empty before its first rows."""
    folder = f"{root.rstrip('/')}/entity={ENTITY}"
    if not path_exists(spark, folder):
        return spark.createDataFrame([], CONTRACTS)
    return spark.read.schema(CONTRACTS).parquet(folder).select(*CONTRACTS.names)
