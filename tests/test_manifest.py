"""The manifest in buckets, and accents of values."""

import os
import unicodedata
from datetime import datetime, timezone

from pyspark.sql import functions as F

from filestrata import schemas as S
from filestrata.functions.folding import fold_accents
from filestrata.operators import control as K


def records(spark, names, path):
    when = datetime(2024, 1, 1, tzinfo=timezone.utc)
    return spark.createDataFrame(
        [(n, "20240201", "csv", "d", "h", path, "bronze_v1", when) for n in names], S.MANIFEST)


def buckets(root, version):
    folder = f"{root}-buckets/v{version:08d}"
    return {int(n.split("=")[1]) for n in os.listdir(folder) if n.startswith("bucket=")} if (
        os.path.isdir(folder)) else set()


def test_an_upsert_rewrites_the_buckets_it_touches(spark, tmp_path):
    root = str(tmp_path / "manifest")
    names = [f"file {i}" for i in range(400)]
    K.upsert_manifest(records(spark, names, "old"), root)
    everything = buckets(root, 1)
    assert len(everything) > 50
    few = records(spark, [*names[:3], "new"], "new")
    touched = K._buckets_of(few, S.MANIFEST_KEYS)
    K.upsert_manifest(few, root)
    assert buckets(root, 2) == touched and len(touched) <= 4
    state = {r.source_file: r.bronze_path for r in K.read_manifest(spark, root).collect()}
    assert state == {n: "old" for n in names} | dict.fromkeys([*names[:3], "new"], "new")
    # The version before stays whole; a later one lets go what only older ones name.
    assert buckets(root, 1) == everything
    K.upsert_manifest(records(spark, names[:1], "third"), root)
    assert buckets(root, 1) == everything - touched
    # A batch reads its own buckets, and they answer for it as the whole would.
    own = K.read_manifest(spark, root, files=few)
    assert own.select(K._bucket(S.MANIFEST_KEYS).alias("b")).distinct().count() == len(touched)
    batch = spark.createDataFrame([(names[0], "20240201", "h"), ("unknown", "20240201", "h"),
                                   (None, "20240201", "h")], "source_file string, snapshot_date string, file_hash string")
    marked = [K.mark_processed(batch, m).collect()
              for m in (K.read_manifest(spark, root), K.read_manifest(spark, root, files=batch))]
    assert sorted(map(str, marked[0])) == sorted(map(str, marked[1]))
    assert {r.source_file for r in marked[1] if r.processed} == {names[0]}


def test_a_write_that_never_finished_is_not_taken_up(spark, tmp_path):
    root = str(tmp_path / "manifest")
    K.upsert_manifest(records(spark, ["a"], "1"), root)
    os.makedirs(f"{root}-buckets/v00000002/bucket=3")
    K.upsert_manifest(records(spark, ["b"], "2"), root)
    assert {r.source_file for r in K.read_manifest(spark, root).collect()} == {"a", "b"}
    assert sorted(os.listdir(root)) == ["v00000001", "v00000003"]


def test_fold_accents(spark):
    texts = ["Vitória São João", "ÅÖ ß Ł", "é ñ", "日本 が", "", None, "\U0001d15e x", "Ǟ ṩ ﬁ 한"]
    got = [r.f for r in spark.createDataFrame([(t,) for t in texts], "t string")
           .select(fold_accents(F.col("t")).alias("f")).collect()]
    plain = ["".join(c for c in unicodedata.normalize("NFD", t) if unicodedata.category(c)[0] != "M")
             if t is not None else None for t in texts]
    assert got == [unicodedata.normalize("NFC", p) if p is not None else None for p in plain]
