"""Shared pieces of the training-data operators: tables, word shapes, text blocks.

A *text block* is a few megabytes of documents in one row, compressed, with a
number that never changes because the blocks are written before they are used.
Work that compares documents with each other ships what a block has once,
instead of once for each of its documents.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import scratch_dir

# Documents of about so many bytes of text share a block. Only bounds a task's
# memory: a longer document has a block of its own.
BLOCK_BYTES = 8 << 20
# Rows of a batch that are made Python's values at a time.
ROWS_AT_ONCE = 100


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def unpack(blob: bytes | pa.Buffer) -> pa.Table:
    """A table from its packed bytes. That of a block's documents has ``doc_id`` and
    ``text``, null texts as empty."""
    with pa.ipc.open_stream(pa.BufferReader(blob)) as reader:
        return reader.read_all()


def pack(table: pa.Table) -> bytes:
    """A table as compressed bytes, to be moved as one value."""
    sink = pa.BufferOutputStream()
    options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=3))
    with pa.ipc.new_stream(sink, table.schema, options=options) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def text_blocks(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``block``, ``docs`` (see ``unpack``) and ``size`` (code points of the texts),
    written to the shared folder.

    Every document is in one block; a block's documents come from one input
    partition and keep their order. The table is bucketed by ``block``: what is
    grouped by block with it comes to the texts, they are not shuffled.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, ids, texts, held = TaskContext.get().partitionId(), 0, [], [], 0

        def flush() -> pa.RecordBatch:
            nonlocal number, ids, texts, held
            out = pa.RecordBatch.from_pydict({
                "block": pa.array([part << 32 | number], pa.int64()),
                "docs": pa.array([pack(pa.table({
                    "doc_id": pa.array(ids, pa.int64()),
                    "text": pa.array(texts, pa.large_string())}))], pa.binary()),
                "size": pa.array([held], pa.int64())})
            number, ids, texts, held = number + 1, [], [], 0
            return out

        for batch in batches:
            # Spark sends thousands of rows at once: few of them become Python's strings.
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                some = batch.slice(at, ROWS_AT_ONCE)
                for doc_id, text in zip(some.column(0).to_pylist(), some.column(1).to_pylist()):
                    text = text or ""
                    ids.append(doc_id)
                    texts.append(text)
                    held += len(text)
                    if held >= block_bytes:
                        yield flush()
        if ids:
            yield flush()

    spark = docs.sparkSession
    packed = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    path = scratch_dir(spark, "blocks")
    table = "blocks_" + path.rsplit("-", 1)[-1]
    (packed.mapInArrow(run, "block bigint, docs binary, size bigint").write.format("parquet")
     .bucketBy(partitions(spark), "block").option("path", path).saveAsTable(table))
    return spark.table(table)
