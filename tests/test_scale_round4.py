"""What a scan of workbooks leaves on disk, on small inputs."""

import io
import os
import random
import time
import zipfile

import pytest
from pyspark.sql import functions as F

from filestrata import storage
from filestrata.queries.inputs import _cut_off, write_workbooks
from filestrata.queries.workbook_writer import write_xlsb, write_xlsx
from filestrata.sources import workbook as WB
from filestrata.sources import workbook_format as WF

BOTH = pytest.mark.parametrize("write, name", [(write_xlsx, "a.xlsx"), (write_xlsb, "a.xlsb")])


def files(spark, *paths):
    return spark.createDataFrame([(str(p),) for p in paths], "source_path string")


def texts(n, seed=1):
    rng = random.Random(seed)
    return [["k", "v", "w"], *[[f"{rng.randrange(10**6)}-{i}", str(rng.randrange(10**5)), "O"] for i in range(n)]]


def shuffled_mb(spark):
    """Of shuffle files that are there now."""
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    found = [blocks.apply(i) for i in range(blocks.size())]
    return sum(f.length() for f in found if f.getName().startswith("shuffle_")) / 1e6


def staged(monkeypatch, noted):
    """Notes size and rows of what ``WB`` stages, by label."""
    stage, materialize = WB.stage, WB.materialize

    def note(label, table, folder):
        size = sum(os.path.getsize(f.removeprefix("file://")) for f in table.inputFiles())
        noted.append((label, size, table.count()))
        return folder

    monkeypatch.setattr(WB, "materialize", lambda df, label, **o: note(
        label, table := materialize(df, label, **o), table))
    monkeypatch.setattr(WB, "stage", lambda df, label, *a, **o: note(
        label, df.sparkSession.read.parquet(folder := stage(df, label, *a, **o)), folder))


@BOTH
def test_strings_are_not_rows(spark, tmp_path, monkeypatch, write, name):
    """Of a sheet with a large string table no more is staged than the workbook has, and
    no table with a row for each string; what is staged for the rows goes with its shuffles."""
    noted = []
    staged(monkeypatch, noted)
    write(tmp_path / name, {"s": texts(60_000)})
    monkeypatch.setattr(WB, "INLINE_STRINGS", 1 << 16)
    monkeypatch.setattr(WB, "PIECE_BYTES", 1 << 18)
    before, mark = shuffled_mb(spark), storage.scratch_mark()
    errors, groups = WB.header_groups(spark, files(spark, tmp_path / name))
    left = storage._scratch_folders[mark:]
    [group] = groups
    rows = group.open().table()
    assert rows.count() == 60_000 and errors.count() == 0
    assert rows.agg(F.sum(F.split("k", "-")[1])).first()[0] == sum(range(60_000))
    sizes = {label: size for label, size, _ in noted}
    assert max(n for label, _, n in noted if label not in ("workbooks",)) < 1_000
    assert sizes["pieces"] < 1.2 * os.path.getsize(tmp_path / name)
    assert not [f for f in left if "/pieces-" in f or "/strings-" in f]
    for _ in range(20):
        if shuffled_mb(spark) < before + 0.2:
            break
        time.sleep(0.5)
    assert shuffled_mb(spark) < before + 0.2


@BOTH
@pytest.mark.parametrize("held", [0, 1 << 20])
def test_damaged_workbooks_are_not_staged(spark, tmp_path, monkeypatch, write, name, held):
    """Neither rows nor, while they are few, pieces of a file that is known to break off."""
    noted = []
    monkeypatch.setattr(WB, "HELD_BYTES", held)
    monkeypatch.setattr(WB, "INLINE_STRINGS", 1 << 12)
    monkeypatch.setattr(WB, "PIECE_BYTES", 1 << 13)
    monkeypatch.setattr(WF, "BLOCK_BYTES", 1 << 12)
    good, bad = tmp_path / f"good-{name}", tmp_path / name
    write(good, {"s": texts(3_000)})
    bad.write_bytes(_cut_off(io.BytesIO(good.read_bytes()), 0.97))
    alone = WB.scan_workbooks(files(spark, bad), whole=True).collect()
    assert {(r.row_idx, tuple(r.cells), r.attempt) for r in alone} == {(-1, (), a) for a in range(3)}
    assert all("no end" in r.error for r in alone)
    staged(monkeypatch, noted)
    WB.scan_workbooks(files(spark, bad), whole=True)
    [(label, _, n)] = [x for x in noted if x[0] == "pieces"]
    assert n == 3 if held else n > 10
    rows, errors = WB.whole_rows(WB.materialize(
        WB.scan_workbooks(files(spark, bad, good), whole=True), "scan"))
    assert rows.count() == 3_001 and {r.source_path for r in rows.collect()} == {str(good)}
    assert [r.source_path for r in errors.collect()] == [str(bad)]


def test_cut_off_workbooks_are_compressed(spark, tmp_path):
    lines = spark.range(20_000).select(F.col("id").cast("string").alias("a"), F.lit("x").alias("b"))
    for cut in (None, 0.97):
        write_workbooks(lines.coalesce(1), str(tmp_path / str(cut)), "xlsx", cut=cut)
    whole, cut = ([p.stat().st_size for p in (tmp_path / k).iterdir()] for k in ("None", "0.97"))
    assert len(whole) == len(cut) == 1 and 0.8 * whole[0] < cut[0] <= whole[0]


CELLS = [
    '<c r="A1" t="s"><v>1</v></c>', "<c t='s' r='B1' s='3'><v>22</v></c>", '<x:c t = "s" ><x:v> 3 </x:v></x:c>',
    '<c t="n"><v>4</v></c>', '<c><v>5</v></c>', '<c t="str"><v>t="s"</v></c>', '<c t="s"><f>A1</f><v>6</v></c>',
    '<c t="s"><v>7</v><v>8</v></c>', '<c t="s"/>', '<c t="&#115;"><v>9</v></c>', '<c t="s"><v><!-- -->10</v></c>',
    '<c t="s"><v><![CDATA[11]]></v></c>', '<c t="s"><v>&#49;2</v></c>', '<c a=">" t="s"><v>13</v></c>']


def test_ids_of_strings_however_cells_are_written():
    def parsed(piece, facts):
        ids = set()
        for _ in WF.piece_rows(piece, -1, lambda i: ids.add(i) or "", facts):
            pass
        return ids

    facts = {"binary": False, "dates": {}, "base_1904": False}
    cells = [c.replace("<x:", "<").replace("</x:", "</") for c in CELLS]
    rows = [*cells, "".join(cells), "".join(cells[:5]), *["".join(random.Random(i).sample(cells[:9], 5)) for i in range(30)]]
    for row in rows:
        piece = f'<row r="1">{row}</row>'.encode()
        assert WF.piece_string_ids(piece, -1, facts) >= parsed(piece, facts), row
    assert WF.piece_string_ids(f"<row>{CELLS[2]}</row>".encode(), -1, facts) == {3}
    book = io.BytesIO()
    write_xlsb(book, {"s": [["a", 5.0, None, True], ["b", "a"]]})
    with zipfile.ZipFile(book) as archive:
        [(base, piece)] = WF.Book(archive, True, None).sheet_pieces()
    assert WF.piece_string_ids(piece, base, {"binary": True}) == parsed(piece, {"binary": True}) == {0, 1, 2}
