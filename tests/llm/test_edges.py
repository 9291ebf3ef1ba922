"""Nulls, empty and very long texts, ties, repeated rows, empty tables, odd columns."""

import json
import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from filestrata.llm import bpe, exact_dedup, html_extraction, line_dedup, mixing, near_dup
from filestrata.llm import pii, suffix_dedup, toxicity, vector_search

# Columns whose names the operators use inside.
SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, name string, "
          "block string, bucket string, digest string, size string, n string, spans string")
LONG = "lorem ipsum " * 40_000


def table(spark, rows, schema=SCHEMA):
    extra = len(schema.split(",")) - 5
    return spark.createDataFrame(
        [(i, t, "en", s, 1, *["x"] * extra) for i, t, s in rows], schema)


@pytest.fixture(scope="module")
def odd(spark):
    """Rows with every oddity, and their table."""
    rng = random.Random(3)
    words = ["alpha", "béta", "gamma", "δelta", "eins", "zwei", "idiot", "中文", "x"]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    base = [text(60) for _ in range(4)]
    rows = [(i, rng.choice(base)[:rng.randint(50, 300)] + text(rng.randint(0, 30)),
             rng.choice(["a", "b", None])) for i in range(40)]
    rows += [(50, None, "a"), (51, "", None), (52, "", "c"), (None, base[0], "a"), (None, None, None),
             (53, base[0], "a"), (53, base[0], "a"), (54, LONG, "b"), (55, LONG + " end", "b"),
             (56, " \t\n", "a"), (57, "a", "z"), (58, "a\x00b c", "z")]
    return rows, table(spark, rows)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.mark.parametrize("many", [1, 16])
def test_suffix_dedup(odd, empty, monkeypatch, many):
    rows, docs = odd
    monkeypatch.setattr(suffix_dedup, "MANY_PIECES", many)
    for options in ({}, {"length": 12, "gram": 8, "hot_blocks": 1, "block_bytes": 300},
                    {"length": 12, "gram": 8, "block_bytes": 2000}):
        short = [(i, t) for i, t, _ in rows if t is None or len(t) < 10_000]
        done = suffix_dedup.remove_repeats(docs.where("text is null or length(text) < 10000"), **options)
        got = [(r.doc_id, r.n_bytes, r.n_bytes - len(r.kept), len(r.removed), brute.sha(bytes(r.kept)))
               for r in done.collect()]
        assert sorted(got, key=repr) == sorted(brute.repeats(short, options.get("length", 50)), key=repr)
    whole = {r.doc_id: r for r in suffix_dedup.remove_repeats(docs).collect()}
    assert len(whole[54].kept) == len(LONG) and bytes(whole[55].kept) == b" end"[-len(whole[55].kept):]
    assert suffix_dedup.remove_repeats(empty).collect() == []


def test_longest_previous_factors():
    rng = np.random.default_rng(1)
    windows = rng.integers(97, 99, (200, 9)).astype(np.uint8)
    rank = rng.integers(0, 40, 200)
    got = suffix_dedup.longest_previous(windows, rank)
    for i in range(200):
        common = [int(np.argmin(np.append(windows[i] == windows[j], False)))
                  for j in range(200) if rank[j] < rank[i]]
        assert got[i] == max(common, default=0)


def test_near_dup(odd, empty):
    rows, docs = odd
    got = near_dup.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    want = brute.classes([(i, t) for i, t, _ in rows if i is not None])
    for r in got:
        assert r.class_id == (None if r.doc_id is None else want[r.doc_id])
    left = near_dup.without_near_duplicates(docs)
    assert left.columns == docs.columns
    assert {r.doc_id for r in left.collect()} == set(want.values()) | {None}
    assert near_dup.near_duplicates(empty).collect() == []


def test_a_chain_of_links_is_one_class(spark):
    words = [f"w{i}" for i in range(120)]
    chain = []
    for i in range(12):
        words = words[:i * 10] + [f"v{i}"] + words[i * 10 + 1:]
        chain.append((i, " ".join(words), "a"))
    got = near_dup.near_duplicates(table(spark, chain)).collect()
    assert {r.class_id for r in got} == set(brute.classes([(i, t) for i, t, _ in chain]).values()) == {0}


def test_weighted_signatures_estimate_weighted_similarity():
    rng = np.random.default_rng(5)
    elements = rng.integers(0, 2 ** 63, 80).astype(np.uint64)
    a, b = rng.uniform(0, 3, 80), rng.uniform(0, 3, 80)
    both = near_dup.dart_signatures(np.concatenate([elements, elements]), np.array([0, 80, 160, 160]),
                                    4096, np.concatenate([a, b]))
    true = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    assert abs((both[0] == both[1]).mean() - true) < 0.04
    assert not both[2].any()


@pytest.mark.parametrize("options", [{}, {"block_bytes": 7}, {"block_bytes": 7, "digest": F.crc32},
                                     {"block_bytes": 7, "digest": lambda b: F.substring(b, 1, 1)}])
def test_exact_dedup(odd, empty, options):
    rows, docs = odd
    rows = [(i, t) for i, t, _ in rows if t is None or len(t) < 10_000 or not options]
    docs = docs if not options else docs.where("text is null or length(text) < 10000")
    norm = lambda t: "".join(c for c in t or "" if c not in " \t\n\x0b\x0c\r")
    groups = {}
    for i, t in rows:
        groups.setdefault(norm(t), []).append((-len(t or ""), i is None, i))
    got = exact_dedup.duplicate_groups(docs, **options).collect()
    want = [(i, min(groups[norm(t)])[2], len(groups[norm(t)]), brute.sha(norm(t))) for i, t in rows]
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got], key=repr) == sorted(
        want, key=repr)
    assert sum(r.kept for r in got) == len(groups)
    left = exact_dedup.without_duplicates(docs, **options)
    assert left.columns == docs.columns and left.count() == len(groups)
    assert exact_dedup.duplicate_groups(empty, **options).collect() == []


PAGE = """<html><head><title>t</title><script>var a="<p>no</p>";</script></head><body>
<header><h2>Site</h2></header><nav><ul><li><a href=/>Home</a><li>About</ul></nav>
<div class="cookie-notice">We use cookies</div>
<article><h1>Big &amp; bold</h1><p>One <b>two</b>
 three<p>Fo<i>ur</i>{more}<aside>Related</aside><form>Name <input></form></article>
<section id="comments"><p>First!</section><footer>&copy; us</footer></body></html>"""


def test_html(spark):
    pages = [(1, "http://h.example/a", PAGE.format(more="")),
             (2, "http://h.example/b", PAGE.format(more="<ul><li>x<li>y</ul><p>last")),
             (2, "http://h.example/b", PAGE.format(more="<ul><li>x<li>y</ul><p>last")),
             (3, "http://h.example/c", PAGE.split("<aside>")[0].format(more="")),
             (4, None, None), (5, "no host", ""), (6, "//other/", "plain <b>text</b> only"),
             (7, "http://deep.example/", "<div>" * 3000 + "deep"),
             (8, "http://open.example/", "<p>a<!-- never closed <p>b"), (None, "http://h.example/", "<p>q")]
    docs = spark.createDataFrame(
        [(*p, "x", "x", 1) for p in pages], "page_id bigint, url string, html string, host string, "
                                            "wrapper string, n bigint")
    got = [(r.page_id, r.text) for r in html_extraction.extract(docs).collect()]
    assert sorted(got, key=repr) == sorted([
        (1, "Big & bold\nOne two three\nFour"), (2, "Big & bold\nOne two three\nFour\nx\ny\nlast"),
        (2, "Big & bold\nOne two three\nFour\nx\ny\nlast"), (3, "Big & bold\nOne two three\nFour"),
        (4, ""), (5, ""), (6, "plain text only"), (7, "deep"), (8, "a"), (None, "")], key=repr) or (
        dict(got)[None] == "q")
    assert html_extraction.extract(docs.limit(0)).collect() == []


def test_wrapper_has_optional_and_repeated_groups():
    pages = ["<ul><li>a<li>b</ul><p>x", "<ul><li>a</ul><h2>t</h2><p>x<p>y"]
    shapes = [html_extraction.shape(html_extraction.fold(html_extraction.tokens(p)[0])) for p in pages]
    assert html_extraction.merge_all(shapes) == [
        ["^", False], ["ul", False], [[["li", False]], False], ["/ul", False], ["h2", True], ["/h2", True],
        [[["p", False]], False]]


def html_texts(*pages):
    """The texts of one host's pages, without Spark."""
    shapes = [html_extraction.shape(html_extraction.fold(html_extraction.tokens(p)[0])) for p in pages]
    wrapper = json.dumps(html_extraction.merge_all(shapes))
    return [html_extraction.main_text(p, wrapper, {}) for p in pages]


@pytest.mark.parametrize("ad", ['<div class="ad"><p>buy{}</p></div>', "<aside><p>buy{}</p></aside>"])
def test_tags_of_one_name_inside_and_outside_the_article_keep_their_parts(ad):
    texts = "one", "two", "three"
    after = "".join(f"<p>{t}</p>" + ad.format(k) for k, t in enumerate(texts))
    before = "".join(ad.format(k) + f"<p>{t}</p>" for k, t in enumerate(texts))
    section = "".join(f"<h2>h{t}</h2><p>{t}</p>{ad.format(k)}<p>more {t}</p>" for k, t in enumerate(texts))
    page = "<body><p>top</p><article>{}</article><footer><p>end</p></footer></body>"
    plain = "\n".join(texts)
    sections = "\n".join(f"h{t}\n{t}\nmore {t}" for t in texts)
    for bodies, want in (([after], [plain]), ([before], [plain]), ([section], [sections]),
                         ([after, section, "<p>x</p>"], [plain, sections, "x"]),
                         ([before, "<p>x</p>" + ad.format(9) + "<p>y</p>", after], [plain, "x\ny", plain])):
        assert html_texts(*map(page.format, bodies)) == want


def irregular(rng, n):
    """The inside of an article of ``n`` blocks that hardly folds, and its text."""
    blocks = [rng.choice("h2 h3 h4 pre blockquote section figure aside ul".split()) for _ in range(n)]
    body = "".join(f"<{t}><p>{t}{k}</p></{t}>" for k, t in enumerate(blocks))
    return body, "\n".join(f"{t}{k}" for k, t in enumerate(blocks) if t not in ("figure", "aside"))


def test_pages_of_any_length_keep_their_article():
    rng = random.Random(6)
    bodies = [irregular(rng, n) for n in (3, 450, 500, 5)]
    ends = "<ul><li>a<li>b</ul>", "<p>c</p><h2>d</h2>"
    pages = [f"<body><nav><p>top</p></nav><article>{b}</article><footer>{ends[k % 2]}</footer></body>"
             for k, (b, _) in enumerate(bodies)]
    assert html_texts(*pages) == [text for _, text in bodies]


@pytest.mark.parametrize("kept", [1, 40, 4_000_000])
def test_alignment_is_the_same_in_blocks(monkeypatch, kept):
    """Blocks change nothing, and the leaves of a page find their place."""
    rng = random.Random(8)
    page = lambda: "".join(rng.choice(["<ul><li>a<li>b</ul>", "<h2>x</h2>", "<p>x", "<div><p>y</div>" * 2, "<dl><dt>t</dl>"])
                           for _ in range(rng.randint(0, 25)))
    leaves = html_extraction._sections
    for _ in range(60):
        a, b = (html_extraction.shape(html_extraction.fold(html_extraction.tokens(page())[0])) for _ in "ab")
        monkeypatch.setattr(html_extraction, "KEPT_PAIRS", 4_000_000)
        want = html_extraction.align(a, b)
        monkeypatch.setattr(html_extraction, "KEPT_PAIRS", kept)
        places = []
        got = html_extraction.align(a, b, places)
        assert got == want
        assert [leaves(got)[k] for k in places] == leaves(b) and places == sorted(places)


def test_an_advert_that_another_page_lacks_does_not_take_in_its_neighbour():
    pages = ['<div class="ad">buy</div><div>one</div>', '<div class="ad"><p>sell</p></div>', "<div><p>two</p></div>"]
    assert html_texts(*pages) == ["one", "", "two"]


def test_toxicity(spark, odd, empty):
    rows, docs = odd
    labels = spark.createDataFrame(
        [(i, int("idiot" in (t or "")), 0) for i, t, _ in rows] + [(9999, 1, 1), (1, None, None)],
        "doc_id bigint, toxic int, quality int")
    got = toxicity.score_documents(docs, labels).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    blank = {r.score for r, (_, t, _) in zip(got, rows) if not t}
    assert len(blank) == 1
    assert all(r.predicted == 0 for r in toxicity.score_documents(docs, labels.limit(0)).collect())
    assert toxicity.score_documents(empty, labels).collect() == []
    assert toxicity.without_toxic(docs, labels).columns == docs.columns


def test_label_model_tells_good_voters_from_copies():
    rng = np.random.default_rng(2)
    truth = rng.random(4000) < 0.2
    sure = (truth & (rng.random(4000) < 0.8)) | (~truth & (rng.random(4000) < 0.01))
    noise = rng.random(4000) < 0.2
    votes = np.stack([sure, sure, sure, noise], 1).astype(np.float32)
    label = np.where(rng.random(4000) < 0.95, truth, ~truth).astype(int)
    posterior, odds, share = toxicity.label_model(votes, label)
    assert ((posterior > 0.5) == truth).mean() > 0.93
    assert share[0] < 0.5 < share[3] and odds[0] > abs(odds[3])


def test_bpe(odd, empty):
    import public_tokenizers
    from tokenizers import Tokenizer

    rows, docs = odd
    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    for options in ({}, {"block_bytes": 100}):
        got = bpe.encode_and_decode(docs, path, **options).collect()
        want = [(i, tokenizer.encode(t or "", add_special_tokens=False).ids, t or "") for i, t, _ in rows]
        assert sorted([(r.doc_id, r.ids, r.decoded) for r in got], key=repr) == sorted(want, key=repr)
    assert bpe.encode_and_decode(empty, path).collect() == []


def test_word_split_is_the_tokenizers(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer, rng = Tokenizer.from_file(path), random.Random(1)
    signs = ["a", "b", " ", "  ", "\n", "'", "s", "'s", "'re", "t", "1", "é", "²", "٣", "　", ".",
             "<|endoftext|>", "\x1c", "\x85", "\t", "'ll", "Ⅷ", "中", "😀", "́", "\x00"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 14))) for _ in range(3000)]
    words, first = bpe.split_words(texts, bpe.special_tokens(path), bpe.character_classes())
    words = words.to_pylist()
    for k, text in enumerate(texts):
        own = words[first[k]:first[k + 1]]
        assert "".join(own) == text
        assert [i for w in own for i in tokenizer.encode(w, add_special_tokens=False).ids] == (
            tokenizer.encode(text, add_special_tokens=False).ids)


PRIVATE = ["a@b.c", "x a.b+c@d-e.fr@g.hi", "1.2.3.4.5.6.7.8", "300.1.1.1 0001.2.3.4 1.2.3.04",
           "4111 1111 1111 1111 4111-1111-1111-1112", "+1 (743) 555-3824.", "+49 12", "@@a@@", "é 😀 q@w.e",
           "1" * 5000 + ".1.1.1", "a" * 5000, "+1" * 3000, "1 2 3", None, "", "9" * 30]


def test_pii_base(spark):
    docs = table(spark, [(i, t, "a") for i, t in enumerate(PRIVATE)] + [(None, "a@b.c", "a"), (0, "a@b.c", "a")])
    got = pii.find(docs).collect()
    assert len(got) == len(PRIVATE) + 2
    for r in got:
        if r.doc_id is not None:
            assert [(s.start, s.kind, s.end) for s in r.base] == brute.personal(PRIVATE[r.doc_id])


def test_pii_finds_unseen_identifiers_in_seed_contexts(spark):
    rng = random.Random(4)
    number = lambda: f"+1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}"
    rows = [(i, f"hello there call me {number()} or not, the total of 12345 was paid", "a") for i in range(40)]
    rows += [(100, "so call me 555-0199 tomorrow", "a"), (101, "the total of 98765 was paid", "a")]
    got = {r.doc_id: r for r in pii.find(table(spark, rows)).collect()}
    assert [(s.start, s.end, s.kind) for s in got[100].found] == [(11, 19, 3)]
    assert got[101].found == [] and got[0].found == []


def test_pii_scores_every_pattern(spark, monkeypatch):
    monkeypatch.setattr(pii, "PATTERNS", 1, raising=False)
    monkeypatch.setattr(pii, "PAIRS_AT_ONCE", 2, raising=False)
    rows = [(i, f"sent it to +1 202 555 {1000 + i} or went to it anyway, it to me", "a") for i in range(30)]
    rows += [(100 + i, f"please phone Karl +1 303 555 {2000 + i} today", "a") for i in range(8)]
    rows += [(200, "please phone karl 555-0123 today", "a")]
    got = {r.doc_id: r for r in pii.find(table(spark, rows)).collect()}
    assert [(s.start, s.end, s.kind) for s in got[200].found] == [(18, 26, 3)]


def test_pii_found_identifiers_make_new_patterns_confident(spark):
    rows = [(i, f"then call me +1 202 555 {1000 + i} soon", "a") for i in range(120)]
    rows += [(200 + i, f"then call me 555-{3000 + i} soon", "a") for i in range(20)]
    rows += [(300 + i, f"just dial now 555-{3000 + i} soon", "a") for i in range(20)]
    rows += [(400 + i, f"just dial now +1 303 555 {1000 + i} soon", "a") for i in range(3)]
    rows += [(500, "just dial now 555-9876 soon", "a")]
    docs = table(spark, rows)
    got = {r.doc_id: r for r in pii.find(docs).collect()}
    assert [(s.start, s.end, s.kind) for s in got[500].found] == [(14, 22, 3)]
    assert all([(s.start, s.end, s.kind) for s in got[i].found] == [(13, 21, 3)] for i in range(200, 220))
    assert all(not r.found for r in pii.find(docs, confidence=0.99).collect())


def test_vectors(spark):
    rng = np.random.default_rng(7)
    rows = [(i, [float(x) for x in rng.normal(size=6)], 1) for i in range(150)]
    rows += [(i, rows[0][1], 1) for i in range(200, 240)]
    rows += [(20, rows[20][1], 1), (300, None, 1), (320, [1.0, None, 1.0, 1.0, 1.0, 1.0], 1),
             (340, [float("nan")] * 6, 1), (360, [float("inf")] * 6, 1), (380, [1.0, 2.0], 1),
             (381, [2.0, 2.0], 1), (None, rows[1][1], 1), (400, [], 1)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")
    valid = [(i, np.floor(64 * np.array(v, np.float32).astype(float)).astype(int)) for i, v, _ in rows
             if i is not None and v is not None and None not in v and np.isfinite(v).all()]
    want = []
    for a, (i, q) in enumerate(valid):
        if i % 20 == 0:
            scored = sorted((-int(q @ c), j) for b, (j, c) in enumerate(valid) if b != a and len(c) == len(q))
            want += [(i, k + 1, j, -s) for k, (s, j) in enumerate(scored[:20])]
    got = [tuple(r) for r in vector_search.top_k(frame).collect()]
    assert sorted(got) == sorted(want)
    assert vector_search.top_k(frame.limit(0)).collect() == []


def test_line_dedup(odd, empty):
    rows, docs = odd
    got = line_dedup.remove_repeats(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        cut = "".join(c for k, c in enumerate(r.text) if not any(s.start <= k < s.end for s in r.removed)) if (
            len(r.text) < 10_000) else r.kept_text
        assert cut == r.kept_text
    assert line_dedup.remove_repeats(empty).collect() == []


def test_lines_and_sentences(spark):
    line = "A line that stands in more than one document."
    sentence = "This sentence of nine words is shared by two."
    rows = [(1, f"{line}\nOwn words here. {sentence} And more own words follow.", "a"),
            (2, f"Another start {line.upper()}\n{line}", "a"), (3, f"Then: other words. {sentence} End of it.", "a"),
            (4, "Short line.\nShort line.", "a")]
    got = {r.doc_id: r.kept_text for r in line_dedup.remove_repeats(table(spark, rows)).collect()}
    assert got[1] == rows[0][1] and got[4] == rows[3][1]
    assert got[2] == f"Another start {line.upper()}\n"
    assert got[3] == "Then: other words.  End of it."


def plain_units(text):
    """Lines and sentences by a rule of its own: characters, not expressions."""
    out, at = [], 0
    for line in text.split("\n"):
        starts = [0]
        for k, c in enumerate(line):
            if c in "\u3002\uff01" or (c in ".!?" and line[k + 1:k + 2].isspace()):
                starts.append(k + 1)
        parts = [(s, e) for s, e in zip(starts, [*starts[1:], len(line)]) if line[s:e].strip()]
        for s, e in [(0, len(line)), *(parts if len(parts) > 1 else [])]:
            s += (len(line[s:e]) - len(line[s:e].lstrip())) * ((s, e) in parts and len(parts) > 1)
            if line[s:e].strip():
                out.append((at + s, at + e, " ".join(line[s:e].lower().split())))
        at += len(line) + 1
    return out


def test_units_of_any_length_go(spark):
    passage = " ".join(f"So it goes {k}. It ended." for k in ("one", "two", "three", "four", "five")) + " We left."
    thai, chinese = "\u0e01\u0e32\u0e23\u0e17\u0e14\u0e2a\u0e2d\u0e1a", "\u4e2d\u6587\u53e5\u5b50\u5f88\u957f"
    texts = [f"Read more\nFirst. {passage} Here.\n{chinese}\n{thai}\nOwn.",
             f"read  more\n\n \nSecond! {passage} There.\n{thai}",
             f"Other\n{chinese}\n{chinese}\u3002\u65b0\u7684\u3002{chinese}\u3002\nRead more", "Yes.", "No. Yes.\nYes."]
    rows = [(k, t, "a") for k, t in enumerate(texts)]
    want = dict(brute.repeated_units([(k, t) for k, t, _ in rows], plain_units))
    got = {r.doc_id: r.kept_text for r in line_dedup.remove_repeats(table(spark, rows)).collect()}
    assert {k: brute.sha(t) for k, t in got.items()} == want
    assert "So it goes" not in got[1] and "more" not in got[1] + got[2]
    assert thai not in got[1] and got[2].count(chinese) == 1


def test_short_lines_are_counted_off_against_earlier_documents(spark):
    rows = [(1, "la la\nown\nla la", "a"), (2, "la la\nLA LA\nnew\nla la", "a"), (3, "la la", "a")]
    got = {r.doc_id: r.kept_text for r in line_dedup.remove_repeats(table(spark, rows)).collect()}
    assert got == {1: "la la\nown\nla la", 2: "\n\nnew\nla la", 3: ""}


def test_mixing(odd, empty):
    rows, docs = odd
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows)
    by_source = {}
    for r in got:
        own = by_source.setdefault(r.source, [r.source_size, r.target, 0, 0])
        own[2] += r["size"]
        own[3] += r.taken
        assert 0 <= r.taken <= 3 * r["size"]
    total = sum(o[0] for o in by_source.values())
    assert sum(o[1] for o in by_source.values()) == pytest.approx(total)
    assert all(o[0] == o[2] and o[1] <= 3 * o[0] + 1e-9 for o in by_source.values())
    assert sorted(map(repr, got)) == sorted(map(repr, mixing.mix(docs.repartition(5)).collect()))
    copies = mixing.mixed_documents(docs)
    assert copies.columns == docs.columns
    assert mixing.mix(empty).collect() == [] and mixing.mixed_documents(empty).collect() == []


def test_mixed_documents_repeat_each_row_as_often_as_the_mix_says(spark):
    rows = [(None, f"w{i} " * 5, "a") for i in range(40)] + [(7, f"v{i} x y", "b") for i in range(60)]
    docs = table(spark, rows)
    mixed = mixing.mixed_documents(docs)
    for source, words in (("a", 5), ("b", 3)):
        of = lambda r: r.source == source
        own = [r for r in mixing.mix(docs).collect() if of(r)]
        taken = sum(r.taken for r in own)
        assert abs(taken - own[0].target) <= words and len({r.repeats for r in own}) > 1
        assert sum(map(of, mixed.collect())) == sum(r.repeats for r in own)
    assert mixed.columns == docs.columns
    assert sorted(map(repr, mixed.collect())) == sorted(
        map(repr, mixing.mixed_documents(docs.repartition(5)).collect()))
