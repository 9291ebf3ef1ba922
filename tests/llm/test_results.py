"""Every registered query against SQL or a plain version, on whole small tables."""

import os
import zlib

import brute
import pytest
from check_oracles import compare, connect

from filestrata.llm import queries as Q
from filestrata.llm.html_extraction import extract
from filestrata.llm.line_dedup import units

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def documents(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]


def rows(spark, name):
    return Q.QUERIES[name](spark, SF_DIR).collect()


@pytest.mark.parametrize("name", list(Q.ORACLES))
def test_equals_sql(spark, name):
    assert compare(spark, connect(SF_DIR), name, SF_DIR) == []


def test_every_operator_is_registered():
    numbers = {int(name[2:].split("_")[0]) for name in Q.QUERIES}
    assert numbers == set(range(1, 14))


def test_suffix_dedup(spark, documents):
    got = [tuple(r) for r in rows(spark, "op1_suffix_dedup")]
    assert sorted(got) == sorted(brute.repeats(documents, 50))


def test_near_dedup(spark, documents):
    got = {r.doc_id: r for r in rows(spark, "op2_near_dedup")}
    assert {i: r.class_id for i, r in got.items()} == brute.classes(documents)
    assert all(r.kept == (r.class_id == i) for i, r in got.items())


def test_html(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()}
    got = {r.page_id: r for r in rows(spark, "op4_html_extraction")}
    assert set(got) == set(pages)
    for page, row in got.items():
        assert row.n_chars == len(row.text)
        article = pages[page].split("<article>")[1].split("</article>")[0]
        footer = pages[page].split("<footer>")[1].split("</footer>")[0]
        assert footer not in row.text and len(row.text) > 0.3 * len(article)


def test_toxicity(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    right = total = 0
    for r in rows(spark, "op5_toxicity"):
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7)
        if r.held_out and r.doc_id in labels:
            total += 1
            right += r.predicted == labels[r.doc_id]
    assert right >= 0.85 * total


def test_bpe(spark, documents):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {}
    for i, text in documents:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        want[i] = (len(ids), brute.sha(",".join(map(str, ids))),
                   brute.sha(tokenizer.decode(ids, skip_special_tokens=False)))
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256)
            for r in rows(spark, "op6_bpe")} == want


def test_pii(spark, documents):
    kinds = ("email", "ip", "card", "phone")
    got = {r.doc_id: r for r in rows(spark, "op7_pii")}
    for i, text in documents:
        want = brute.personal(text)
        said = [f"{kinds[k]}:{s}:{e}" for s, k, e in want]
        assert got[i].base_sha256 == brute.sha(",".join(said))
        assert set(said) <= set(got[i].spans.split(",") if got[i].spans else [])
        assert [got[i][f"n_{k}"] for k in kinds] == [sum(x[1] == j for x in want) for j in range(4)]


def test_line_dedup(spark, documents):
    want = dict(brute.repeated_units(documents, units))
    assert {r.doc_id: r.kept_sha256 for r in rows(spark, "op9_line_dedup")} == want


def test_mix_comes_near_its_targets(spark):
    taken, target, most = {}, {}, {}
    docs = {r.doc_id: r.source for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    for r in rows(spark, "op10_mixing"):
        source = docs[r.doc_id]
        taken[source] = taken.get(source, 0) + r.taken
        target[source], most[source] = r.target, max(most.get(source, 0), r.size)
        assert r.taken <= 3 * r["size"]
    assert all(abs(taken[s] - target[s]) <= most[s] for s in taken)


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    sizes, current = [docs.count()], docs
    from filestrata.storage import materialize
    for name, stage in corpus_pipeline.STAGES[:4]:
        current = materialize(stage(spark, current, SF_DIR), "test-stage")
        assert current.columns == docs.columns
        sizes.append(current.count())
        if name in ("exact_dedup", "near_dedup"):
            ids = [r.doc_id for r in current.select("doc_id").collect()]
            assert len(ids) == len(set(ids))
        if name == "near_dedup":
            texts = [(r.doc_id, r.text) for r in current.collect()]
            found = brute.classes(texts)
            assert all(k == v for k, v in found.items())
    assert sizes[0] > sizes[1] > sizes[2] >= sizes[3]
    coded = corpus_pipeline.run(spark, SF_DIR).collect()
    assert len(coded) == sizes[4]
    text = {r.doc_id: r.text for r in docs.collect()}
    assert all(brute.sha(text[r.doc_id] or "") == r.decoded_sha256 and r.n_tokens == len(r.ids)
               for r in coded)
