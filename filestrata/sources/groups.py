"""Files that share a header, read together: the unit of a job."""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Iterable, Iterator, Sequence
from concurrent.futures import Future, ThreadPoolExecutor
from dataclasses import dataclass
from typing import TypeVar

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.headers import technical_names

# Files per job: bounds the path list and the broadcast per-file attributes.
FILES_PER_GROUP = 50_000
# Groups whose jobs run side by side.
GROUPS_AT_ONCE = 8

Item = TypeVar("Item")
Result = TypeVar("Result")


@dataclass
class OpenGroup:
    """A group's frames, for one attempt to read them.

    ``rows`` has ``file_uri`` and the text columns ``c0`` … ``c<n-1>``; where rows
    can be too long also ``over_long``. ``bad_rows`` holds those and ``failed``
    files that turned out unreadable, both by ``source_path``; they are ``None``
    when there can be none.
    """

    names: list[str]
    rows: DataFrame
    bad_rows: DataFrame | None = None
    failed: DataFrame | None = None

    _skipped: Observation | None = None

    def table(self, names: Sequence[str] | None = None) -> DataFrame:
        """Data under technical names (or the given ones) plus ``_file_uri``; empty
        and over-long rows dropped, the latter counted in its first reading. No
        technical name begins with ``_``."""
        names = list(names or technical_names(self.names))
        cells = [f"c{i}" for i in range(len(names))]
        rows = self.rows
        if "over_long" in rows.columns:
            self._skipped = Observation()
            rows = rows.observe(self._skipped, F.count_if("over_long").alias("n")).where(
                ~F.col("over_long"))
        return drop_empty_rows(rows, cells).select(
            *[F.col(c).alias(n) for c, n in zip(cells, names)],
            F.col("file_uri").alias("_file_uri"),
        )

    def has_bad_rows(self) -> bool:
        """Whether rows were skipped; known once the last ``table`` has been read."""
        return self._skipped is not None and self._skipped.get["n"] > 0


@dataclass
class HeaderGroup:
    """Files of one dialect and header, read as one frame.

    Columns are named in ``names``; ``uris`` are the ``paths`` as the scan spells
    them. ``open`` reads some or all of the files, afresh for every attempt.
    """

    spark: SparkSession
    names: list[str]
    paths: list[str]
    uris: list[str]
    read: Callable[[Sequence[str]], OpenGroup]

    def open(self, paths: Sequence[str] | None = None) -> OpenGroup:
        return self.read(self.paths if paths is None else paths)

    def files(self) -> DataFrame:
        """``source_path`` and ``_file_uri`` of the group's files."""
        return self.spark.createDataFrame(
            list(zip(self.paths, self.uris)), "source_path string, _file_uri string")


def at_once(action: Callable[[Item], Result], items: Iterable[Item]) -> Iterator[Result]:
    """Run an action per group, a few groups at a time, results in order.

    Groups are jobs of their own; small ones would leave a cluster idle if run
    one by one. Only a few are held at any time.
    """
    with ThreadPoolExecutor(GROUPS_AT_ONCE) as pool:
        waiting: deque[Future] = deque()
        for item in items:
            waiting.append(pool.submit(action, item))
            if len(waiting) == GROUPS_AT_ONCE:
                yield waiting.popleft().result()
        while waiting:
            yield waiting.popleft().result()


def drop_empty_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Drop rows in which every data column is null."""
    return df.dropna(how="all", subset=list(columns) if columns else None)


def path_groups(files: DataFrame, *keys: str) -> Iterator:
    """Distinct keys with bounded, parallel lists of file ``paths`` and ``uris``.

    Paths of a larger group are dealt to several by hash, so neither a list nor
    the per-file table of one job grows with the data.
    """
    # Half full on average: no unevenness of the hash fills a bucket beyond the bound.
    buckets = -(-2 * files.count() // FILES_PER_GROUP) or 1
    bucket = F.pmod(F.xxhash64("source_path"), F.lit(buckets))
    uri = F.col("file_uri") if "file_uri" in files.columns else F.col("source_path")
    pairs = F.sort_array(F.collect_list(F.struct("source_path", uri.alias("file_uri"))))
    return (
        files.groupBy(*keys, bucket.alias("bucket")).agg(pairs.alias("pairs"))
        .select(*keys, F.col("pairs.source_path").alias("paths"),
                F.col("pairs.file_uri").alias("uris"))
        .toLocalIterator()
    )
