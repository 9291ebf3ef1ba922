"""Raw inputs that queries derive from the given tables: files of many kinds.

All of them are written by tasks into the shared scratch folder.
"""

from __future__ import annotations

import io
import posixpath
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import shuffles_dropped, task_filesystem
from .workbook_writer import write_xlsb, write_xlsx

# Below the format's limit of 1,048,576 rows per sheet.
ROWS_PER_WORKBOOK = 20_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def money(column: str):
    """Two-decimal text, the same in every engine."""
    return F.col(column).cast("decimal(18,2)").cast("string")


def write_csv(
    df: DataFrame, folder: str, sep: str = ";", encoding: str = "UTF-8", partition_by=(),
) -> None:
    """Delimited files with a header, quoted only where needed."""
    (
        df.write.partitionBy(*partition_by)
        .options(header=True, sep=sep, encoding=encoding, quote='"', escape='"',
                 nullValue="", emptyValue="", ignoreLeadingWhiteSpace=False,
                 ignoreTrailingWhiteSpace=False)
        .csv(folder)
    )


def written_files(spark: SparkSession, *folders: str) -> DataFrame:
    """``source_path`` of the data files below folders; contents are not read."""
    return (
        spark.read.format("binaryFile").option("recursiveFileLookup", True)
        .load(list(folders))
        .select(F.regexp_replace("path", r"^file:/+", "/").alias("source_path"))
    )


def _put(path: str, content: bytes) -> None:
    filesystem, inner = task_filesystem(path)
    filesystem.create_dir(posixpath.dirname(inner), recursive=True)
    with filesystem.open_output_stream(inner) as sink:
        sink.write(content)


def write_text_files(df: DataFrame, folder: str) -> None:
    """One file per row: ``relative_path`` with the bytes of ``text``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, text in zip(*(c.to_pylist() for c in batch.columns)):
                _put(f"{folder}/{path}", text.encode())
            yield pa.RecordBatch.from_pydict({"n": pa.array([batch.num_rows], pa.int64())})

    written = df.select("relative_path", "text").mapInArrow(run, "n bigint")
    written.agg(F.sum("n")).collect()


def _cut_off(book: io.BytesIO, share: float) -> bytes:
    """The workbook with its sheets ending too early, else whole."""
    import zipfile

    out = io.BytesIO()
    with zipfile.ZipFile(book) as source, zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as target:
        for name in source.namelist():
            data = source.read(name)
            if name.startswith("xl/worksheets/sheet"):
                data = data[:int(len(data) * share)]
            target.writestr(name, data)
    return out.getvalue()


def write_workbooks(
    df: DataFrame, folder: str, kind: str, sheet: str = "Plan1", title_rows: int = 0,
    rows_per_file: int = ROWS_PER_WORKBOOK, cut: float | None = None,
) -> None:
    """The frame's text columns as workbooks with a header row, in each task's
    own files; ``title_rows`` puts lines of prose above the header. ``cut`` damages
    every file: its sheet ends after that share of its bytes."""
    columns = df.columns
    write = {"xlsx": write_xlsx, "xlsb": write_xlsb}[kind]
    titles = [[f"Relatório {i}"] for i in range(title_rows)]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import uuid
        held: list[list] = []

        def flush() -> pa.RecordBatch:
            content = io.BytesIO()
            write(content, {sheet: [*titles, list(columns), *held]})
            data = content.getvalue() if cut is None else _cut_off(content, cut)
            _put(f"{folder}/{uuid.uuid4().hex}.{kind}", data)
            count = pa.array([len(held)], pa.int64())
            held.clear()
            return pa.RecordBatch.from_pydict({"n": count})

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                held.append(list(row))
                if len(held) == rows_per_file:
                    yield flush()
        if held:
            yield flush()

    with shuffles_dropped(df.sparkSession):
        df.mapInArrow(run, "n bigint").agg(F.sum("n")).collect()
