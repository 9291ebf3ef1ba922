"""Compare every registered query with its SQL: ``python tests/check_oracles.py [sf] [name …]``."""

import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
import __spark_entry__ as entry  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return connection


def normalised(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def compare(spark, connection, name, sf_dir):
    """Differences between a query's rows and its SQL's, as a list of texts."""
    df = entry.queries()[name](spark, sf_dir)
    got = normalised([tuple(r) for r in df.collect()], df.columns)
    result = connection.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    want = normalised(result.fetchall(), columns)
    problems = []
    if sorted(columns) != sorted(df.columns):
        problems.append(f"columns {sorted(df.columns)} != {sorted(columns)}")
    if len(got) != len(want):
        problems.append(f"{len(got)} rows, expected {len(want)}")
    if not want:
        problems.append("the SQL gives no rows")
    problems += [f"got {g!r}\n  want {w!r}"[:1500] for g, w in zip(got, want) if g != w][:2]
    return problems


if __name__ == "__main__":
    sf_dir = f"/root/testdata/sf{sys.argv[1] if len(sys.argv) > 1 else '0.01'}"
    session = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.shuffle.partitions", "8")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.driver.memory", "8g").getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    failed = []
    for query in sys.argv[2:] or entry.oracle_sql():
        start = time.time()
        try:
            issues = compare(session, connect(sf_dir), query, sf_dir)
        except Exception as error:
            issues = [f"{type(error).__name__}: {str(error)[:1500]}"]
        print(f"{'FAIL' if issues else 'ok':5}{query:22}{time.time() - start:7.2f}s", flush=True)
        for issue in issues:
            print("  " + issue)
        failed += [query] if issues else []
    print("failed:", failed)
