"""Workbooks as a Spark data source: ``spark.read.format("workbook")``.

Which rows are wanted is an option of the load: a sheet is read no further than the last
of them. It is not a pushed filter, because Spark 4.1 keeps the filters that a Python
source was given once for each loaded table: of two queries on one frame, the first would
then be read with the filters of the second.
"""

from __future__ import annotations

import zipfile
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions.text import null_tokens_sql
from ..storage import FILES_PER_TASK, spread_files, stage, task_filesystem
from .workbook_format import Book, is_binary

FORMAT = "workbook"
SCHEMA = "source_path string, row_idx int, cells array<string>, error string"
_ARROW = pa.schema([("source_path", pa.string()), ("row_idx", pa.int32()),
                    ("cells", pa.list_(pa.string())), ("error", pa.string())])
# Rows to a batch.
BATCH_ROWS = 5_000
LAST_ROW = 1 << 20


@dataclass
class ListedFiles(InputPartition):
    """One part of the staged list of files: its rows are read in the task."""

    part: str


class WorkbookReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.parts = options["files"]
        self.rows = int(options.get("rows") or LAST_ROW)

    def partitions(self) -> Sequence[InputPartition]:
        """One for each part of the list, which deals files out by their bytes. The
        driver sees the parts' names only."""
        filesystem, inner = task_filesystem(self.parts)
        from pyarrow.fs import FileSelector
        names = sorted(f.path for f in filesystem.get_file_info(FileSelector(inner))
                       if f.path.endswith(".parquet"))
        return [ListedFiles(name) for name in names]

    def read(self, partition: ListedFiles) -> Iterator[pa.RecordBatch]:
        filesystem, _ = task_filesystem(self.parts)
        with filesystem.open_input_file(partition.part) as handle:
            listed = pq.read_table(handle, columns=["source_path", "sheet"])
        for path, sheet in zip(*(c.to_pylist() for c in listed.columns)):
            yield from self._file(path, sheet)

    def _file(self, path: str, sheet: str | None) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        try:
            filesystem, inner = task_filesystem(path)
            with filesystem.open_input_file(inner) as handle, zipfile.ZipFile(handle) as archive:
                for index, cells in Book(archive, is_binary(path), sheet).first_rows(self.rows):
                    if any(c is not None for c in cells):
                        rows.append((path, index, cells, None))
                    if len(rows) == BATCH_ROWS:
                        yield _batch(rows)
                        rows = []
        except Exception as failure:
            rows.append((path, -1, [], f"Unreadable workbook: {type(failure).__name__}: {failure}"))
        yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(
        {n: [row[i] for row in rows] for i, n in enumerate(_ARROW.names)}, schema=_ARROW)


class WorkbookSource(DataSource):
    """Options ``files``: a folder of Parquet parts that list ``source_path`` and ``sheet``;
    ``rows``: how many rows of each sheet, from its top, blank ones counted."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WorkbookReader:
        return WorkbookReader(dict(self.options))


def read_workbooks(files: DataFrame, rows: int | None = None, tasks: int | None = None) -> DataFrame:
    """Sheet rows of ``files`` (``source_path``, optionally ``sheet`` and
    ``file_size_bytes``) as ``(source_path, row_idx, cells, error)``, the first ``rows``
    of each sheet or all.

    A file that breaks off gives a last row with ``row_idx`` -1 and its ``error`` behind
    those that could be read. Large sheets are better read by ``scan_workbooks``, which
    deals one sheet to many tasks.
    """
    spark = files.sparkSession
    sheet = F.col("sheet") if "sheet" in files.columns else F.lit(None)
    size = [F.col("file_size_bytes")] if "file_size_bytes" in files.columns else []
    listed = spread_files(
        files.select("source_path", sheet.cast("string").alias("sheet"), *size), tasks, FILES_PER_TASK)
    spark.dataSource.register(WorkbookSource)
    reader = spark.read.format(FORMAT).option("files", stage(listed.select("source_path", "sheet"), "workbook-list"))
    found = (reader if rows is None else reader.option("rows", rows)).load()
    return found.withColumn("cells", F.expr(f"transform(cells, c -> {null_tokens_sql('c')})"))
