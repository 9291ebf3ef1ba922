"""What a group does with broken files, and with a store that takes no writes."""

import pytest
from pyspark.sql import functions as F

from filestrata.plans.bronze import BronzeBatch
from filestrata.sources.groups import HeaderGroup


class Stubbed(BronzeBatch):
    """Writes nothing; a part with a broken file fails."""

    broken: frozenset = frozenset()

    def _write(self, group, mine, paths):
        self.tried = getattr(self, "tried", 0) + 1
        if self.broken & set(paths):
            raise OSError("broken")
        return object(), set(paths), {}


def outcomes(spark, root, broken, bronze=None):
    names = [f"f{i:02d}" for i in range(20)]
    group = HeaderGroup(spark, ["a"], names, names, lambda paths: None)
    files = spark.createDataFrame([(n,) for n in names], "read_path string").withColumn("x", F.lit(1))
    batch = Stubbed(spark, root, bronze or f"{root}/bronze", root, attempts=1)
    batch.broken = frozenset(broken)
    done = batch._write_group(group, files)
    return {path: ok for _, _, part in done for path, ok, *_ in part}, batch.tried


@pytest.mark.parametrize("broken", [
    [f"f{i:02d}" for i in range(10)] + ["f12"], [f"f{i:02d}" for i in range(10, 20)],
    [f"f{i:02d}" for i in range(20)], []])
def test_good_files_do_not_depend_on_broken_ones(spark, tmp_path, broken):
    got, _ = outcomes(spark, str(tmp_path), broken)
    assert {p for p, ok in got.items() if not ok} == set(broken) and len(got) == 20


def test_a_store_without_writes_fails_the_group_at_once(spark, tmp_path):
    (tmp_path / "bronze").write_text("a file where the folder should be")
    got, tried = outcomes(spark, str(tmp_path), ["f03"])
    assert not any(got.values()) and len(got) == 20 and tried == 1
