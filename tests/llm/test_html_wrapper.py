"""What the pages of a host say about each other, and names that mislead."""

import json

import pytest

from filestrata.llm import html_extraction as H


def texts(*pages):
    wrapper = json.dumps(H.merge_all(H.shape(H.fold(H.tokens(p)[0])) for p in pages))
    return [H.main_text(p, wrapper, {}) for p in pages]


@pytest.mark.parametrize("page, want", [
    ('<body><div class="content has-sidebar"><p>one</p></div></body>', "one"),
    ('<main><div class="search-and-rescue"><p>two</p></div></main>', "two"),
    ('<div id="app" class="search"><article><p>three</p><aside>no</aside></article></div>', "three"),
    ('<article><p>four</p></article><section id="comments"><article>no</article></section>', "four"),
    ('<section id="comments"><article>no</article></section><div class="content">five</div>', "five"),
    ('<div class="search"><article>no</article></div><article>six</article>', "six"),
    ('<div class="content"><p>seven</p><div class="ad-box"><p>no</p></div></div>', "seven"),
])
def test_names_of_surroundings(page, want):
    assert texts(page) == [want]


@pytest.mark.parametrize("times", [2, 3, 7])
@pytest.mark.parametrize("length", [1, 2, 12, 13, 40])
def test_runs_of_any_length_fold(times, length):
    run = "".join(f"<x{k}>" for k in range(length))
    nodes = H.fold(H.tokens("<table>" + run * times + "<hr>")[0])
    assert len(nodes) == 4 and len(nodes[2][0]) == length
    assert [len(leaf[1]) for leaf in H._leaves(nodes[2][0])] == [times] * length


def test_groups_fold_within_groups():
    nodes = H.fold(H.tokens("<ul><x><x></ul><p>" * 3)[0])
    assert H.shape(nodes) == [["^", False], [[["ul", False], [[["x", False]], False], ["/ul", False],
                                             ["p", False]], False]]


def page(k, more="<p>Subscribe to our letter today</p>"):
    return f"<article><h1>title {k}</h1>{more}<p>story {k}</p></article>"


def extracted(spark, pages, **other):
    rows = [(k, f"http://{host}/{k}", html) for k, (host, html) in enumerate(pages)]
    docs = spark.createDataFrame(rows, "page_id int, url string, html string")
    return {r.page_id: r.text for r in H.extract(docs).collect()}


def test_text_that_all_pages_of_a_host_hold_is_template(spark):
    # One host with the template, one whose last page lacks it, one of copies, a small one.
    pages = [("a", page(k)) for k in range(8)]
    pages += [("b", page(k)) for k in range(7)] + [("b", page(7, ""))]
    pages += [("c", page(1))] * 8 + [("d", page(k)) for k in range(4)]
    pages += [("a", ""), ("a", None)]
    got = extracted(spark, pages)
    whole = "title {0}\nSubscribe to our letter today\nstory {0}"
    assert [got[k] for k in range(8)] == [f"title {k}\nstory {k}" for k in range(8)]
    assert [got[8 + k] for k in range(8)] == [whole.format(k) for k in range(7)] + ["title 7\nstory 7"]
    assert [got[16 + k] for k in range(8)] == [whole.format(1)] * 8
    assert [got[24 + k] for k in range(4)] == [whole.format(k) for k in range(4)]
    assert got[28] == got[29] == ""
