"""What a task holds and how work is shared out, on small inputs."""

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from filestrata.queries import canonical
from filestrata.queries.workbook_writer import write_xlsx
from filestrata.sources import delimited
from filestrata.sources import workbook as WB
from filestrata.sources import workbook_format as WF
from filestrata.storage import BYTES_PER_TASK, FILES_PER_TASK, spread_files


def test_few_pieces_in_a_staged_file(spark, tmp_path, monkeypatch):
    """A Parquet reader takes thousands of rows at once, here of megabytes each."""
    monkeypatch.setattr(WB, "PIECE_BYTES", 2_000)
    monkeypatch.setattr(WF, "BLOCK_BYTES", 1_000)
    staged = []
    materialize = WB.materialize

    def noted(df, label, **options):
        table = materialize(df, label, **options)
        staged.extend((label, f.removeprefix("file://")) for f in table.inputFiles())
        return table

    monkeypatch.setattr(WB, "materialize", noted)
    write_xlsx(tmp_path / "big.xlsx", {"s": [[f"t{i}", i] for i in range(5_000)]})
    files = spark.createDataFrame([(str(tmp_path / "big.xlsx"),)], "source_path string")
    assert WB.scan_workbooks(files).count() == 5_000
    held = [pq.ParquetFile(path).metadata.num_rows for label, path in staged if label == "pieces"]
    assert sum(held) > 3 * WB.PIECES_PER_TASK and max(held) <= WB.PIECES_PER_TASK


def test_damaged_workbooks_are_written_by_many_tasks(spark, tmp_path, monkeypatch):
    lines = ("/root/testdata/sf0.001", "lineitem")
    n = spark.read.parquet("/".join(lines) + ".parquet").where("l_returnflag = 'N'").count()
    monkeypatch.setattr(canonical, "DAMAGED_ROWS", 500)
    parts = []
    write = canonical.write_workbooks

    def noted(df, folder, *args, **options):
        parts.append((folder.rsplit("/", 2)[1:], df.rdd.getNumPartitions()))
        return write(df, folder, *args, **options)

    monkeypatch.setattr(canonical, "write_workbooks", noted)
    rows = {r.snapshot_date: r.asDict() for r in canonical.damaged_workbooks(spark, lines[0]).collect()}
    assert rows["whole"]["n_bronze"] == rows["whole"]["n_canonical"] == 2 * n
    assert rows["late"]["bronze"] == rows["early"]["canonical"] == "FAILED"
    assert dict((tuple(f), k) for f, k in parts)[("whole", "xlsx")] == -(-n // 500) > 1


def test_small_files_of_known_sizes_share_tasks(spark):
    """A task of 64 files of a few bytes is all overhead; large files stay few to a task."""
    files = spark.range(10_000).select(F.col("id").cast("string").alias("source_path"))
    least = spark.sparkContext.defaultParallelism
    tasks = lambda df, **options: spread_files(df, **options).rdd.getNumPartitions()
    assert tasks(files.withColumn("file_size_bytes", F.lit(100))) == max(least, 5)
    assert tasks(files.withColumn("file_size_bytes", F.lit(BYTES_PER_TASK))) == 10_000
    assert tasks(files) == -(-10_000 // FILES_PER_TASK)


def test_paths_are_listed_by_few_tasks(spark, put, monkeypatch):
    """Spark would list each of many paths in a task of its own."""
    regular = [put(f"r{i}.csv", f"a;b\n{i};x\n") for i in range(40)]
    irregular = [put(f"q{i}.csv", f'a;b\n{i};"x\ny"\n') for i in range(40)]
    setting, seen = "spark.sql.sources.parallelPartitionDiscovery.parallelism", []
    literal = delimited.literal_paths

    def noted(paths):
        seen.append(int(spark.conf.get(setting)))
        return literal(paths)

    monkeypatch.setattr(delimited, "literal_paths", noted)
    before = spark.conf.get(setting)
    files = spark.createDataFrame([(p,) for p in regular + irregular], "source_path string")
    rows = delimited.read_delimited(spark, files).collect()
    assert sorted((r.a, r.b) for r in rows) == sorted(
        [(str(i), b) for i in range(40) for b in ("x", "x\ny")])
    assert len(seen) >= 3 and max(seen) <= 4 * spark.sparkContext.defaultParallelism
    assert spark.conf.get(setting) == before
