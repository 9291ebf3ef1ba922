"""What a task of the encoding holds."""

import tracemalloc

import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")

from filestrata.llm import bpe  # noqa: E402

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_a_block_is_split_in_little_memory():
    texts = [f"It's text {i}, ²  of  <|endoftext|>é words " * 60 for i in range(900)] + ["", "x" * 300_000, ""]
    special, classes = bpe.special_tokens(PATH), bpe.character_classes()
    size = sum(map(len, texts))
    assert size > bpe.BLOCK_CHARS
    tracemalloc.start()
    words, first = bpe.split_words(texts, special, classes)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 24 * size
    for k in (0, 1, 450, 899, 900, 901, 902):
        own, _ = bpe.split_words([texts[k]], special, classes)
        assert words[first[k]:first[k + 1]].to_pylist() == own.to_pylist()
    assert first[0] == 0 and first[-1] == len(words) and len(first) == len(texts) + 1
    assert [len(x) for x in bpe.split_words([], special, classes)] == [0, 1]


def test_the_vocabulary_starts_no_python_workers(spark):
    table = bpe.vocabulary(spark, PATH)
    assert "LocalTableScan" in table._jdf.queryExecution().executedPlan().toString()
    assert table.dtypes == [("id", "int"), ("piece", "binary")]
    rows = table.orderBy("id").collect()
    assert [r.id for r in rows] == list(range(len(rows)))
    assert {b"a", b" the"} <= {bytes(r.piece) for r in rows}
