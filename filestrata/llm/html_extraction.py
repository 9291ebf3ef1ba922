"""Main text of web pages by wrappers that are inferred per host.

A page is a stream of block tags with a text slot after each. Equal runs that
follow each other fold into repeated groups. The folded streams of a host are
aligned one after the other into one wrapper, a regular expression without
unions: where two streams differ, the tags that one of them lacks become
optional, and a group that occurs once in one and often in the other becomes a
repeated one. A tag carries the part of its own page it stands in, and tags of
different parts are never aligned, so no slot takes its part from a tag that
another page leaves open. The slots of the wrapper are then sorted into article
and other parts, and every page is read through its host's wrapper. Last, the texts that
fill the slots of a host's pages are compared: one that all of them hold, however much
they differ else, belongs to the template and not to the article.
"""

from __future__ import annotations

import html as _html
import json
import re
from collections import defaultdict, deque
from collections.abc import Iterable, Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import materialize
from .common import read

# Wrappers of all hosts up to so many bytes go to the executors by broadcast;
# beyond it pages are joined with them by host.
BROADCAST_BYTES = 16 << 20
# A host's shapes are first aligned in so many parts, then the parts with each other.
PARTS = 16
# So many different texts of a host must hold a block before it counts as template.
LEAST_PAGES = 5
# Steps of an alignment are kept for so many pairs of nodes at a time; those of
# longer streams are worked out again, block by block, from costs kept between.
KEPT_PAIRS = 4_000_000

# Fixed values of HTML: elements whose content is no markup, markup within a
# line, elements without an end tag, and end tags that may be left out.
RAW = ("script", "style", "noscript", "template", "textarea", "svg", "iframe", "object", "select",
       "button", "title")
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp "
    "small span strike strong sub sup time tt u var wbr br img picture source".split())
VOID = frozenset("area base col embed hr input link meta param track source".split())
ENDS_LEFT_OUT = frozenset("p li dt dd option tr td th thead tbody tfoot colgroup caption".split())

OUTSIDE = frozenset("nav header footer aside form head menu dialog figure".split())
INSIDE = frozenset("article main".split())
_OUTSIDE_NAME = re.compile(
    r"(?:^|[^a-z])(?:ads?|advert\w*|banner|sponsor\w*|promo\w*|side-?bar|menu|nav\w*|breadcrumbs?|"
    r"cookies?|consent|notice|alert|popup|modal|overlay|comments?|disqus|repl(?:y|ies)|share|sharing|"
    r"social|related|recommend\w*|newsletter|subscri\w*|login|signup|search|footer|header|masthead|"
    r"toolbar|widget|pagination|pager|skip)(?:$|[^a-z])")
# Parts whose items may be articles themselves: an article element within one is none.
_ITEMS_NAME = re.compile(
    r"(?:^|[^a-z])(?:ads?|advert\w*|sponsor\w*|promo\w*|comments?|disqus|repl(?:y|ies)|related|"
    r"recommend\w*)(?:$|[^a-z])")
# Names that say what the page has (``has-sidebar``) or are phrases, not parts.
_NO_PART = re.compile(r"(?:has|is|with|without|no|not)[^a-z]|.*[^a-z](?:and|of|for|the)[^a-z]")
_INSIDE_NAME = re.compile(r"(?:^|[^a-z])(?:article|main|content|post|entry|story)(?:$|[^a-z])")

_TOKEN = re.compile(
    r"<!--(?:.*?-->|.*)|<[!?][^>]*>?|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>",
    re.S)
_NAMES = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)


def _tag_name(tag: str, attributes: str) -> str:
    """The tag with what its class, id or role says about its part of the page."""
    if attributes and tag not in INSIDE and tag not in OUTSIDE:
        said = " ".join("".join(m) for m in _NAMES.findall(attributes)).lower()
        said = " ".join(name for name in said.split() if not _NO_PART.match(name))
        if said and _OUTSIDE_NAME.search(said):
            return tag + ("--" if _ITEMS_NAME.search(said) else "-")
        if said and _INSIDE_NAME.search(said):
            return tag + "+"
    return tag


def tokens(page: str) -> tuple[list[str], list[str]]:
    """Block tags (``/x`` for an end tag) and the raw text after each; the first
    tag is the start of the page."""
    tags, texts, at, end = ["^"], [[]], 0, len(page)
    while at < end:
        m = _TOKEN.search(page, at)
        if m is None:
            texts[-1].append(page[at:])
            break
        if m.start() > at:
            texts[-1].append(page[at:m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if tag in RAW and not m[1] and not m[3].rstrip().endswith("/"):
            close = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            at = close.end() if close else end
            if tag == "button" or tag == "select":
                texts[-1].append(" ")
            continue
        if tag in INLINE:
            if tag == "br":
                texts[-1].append(" ")
            continue
        if m[1]:
            if tag in ENDS_LEFT_OUT or tag in VOID:
                texts.append([])
                tags.append("/")
                continue
            tags.append("/" + tag)
        else:
            tags.append(_tag_name(tag, m[3]))
        texts.append([])
    return _parted(tags), ["".join(t) for t in texts]


def _parted(tags: list[str]) -> list[str]:
    """The tags with the part of the page that the slot after each is in: ``*`` for
    one within an article, ``!`` for one within something that is none. ``?`` is for
    an article element whose surroundings only their names speak against."""
    out, stack, at_names = [], [(None, False, 0, False)], defaultdict(list)
    for tag in tags:
        if tag == "/":
            out.append(tag)
            continue
        own = False
        name = tag.rstrip("+-")
        if tag.startswith("/"):
            if at_names[tag[1:]]:
                open_at = at_names[tag[1:]][-1]
                while len(stack) > open_at:
                    at_names[stack.pop()[0]].pop()
        elif name not in VOID and name not in ENDS_LEFT_OUT and tag != "^":
            at_names[name].append(len(stack))
            _, inside, outside, doubtful = stack[-1]
            if tag in INSIDE and outside == 1 and not inside:
                outside, doubtful = 0, True
            if tag in OUTSIDE or tag.endswith("--"):
                outside = 2
            elif tag.endswith("-"):
                outside = max(outside, 1)
            stack.append((name, inside or tag in INSIDE or tag.endswith("+"), outside, doubtful))
        else:
            own = tag.endswith("-")
        _, inside, outside, doubtful = stack[-1]
        out.append(tag + "*" * inside + "?" * doubtful + "!" * (outside > 0 or own))
    return out


# A node is [tag, places] or [[node, ...], None] for a group that repeats.
def _join_places(a: list, b: list) -> None:
    if isinstance(a[0], str):
        a[1] += b[1]
    else:
        for x, y in zip(a[0], b[0]):
            _join_places(x, y)


def fold(tags: list[str]) -> list:
    """Nodes of a tag stream, runs that repeat as groups; a leaf knows its places.

    End tags that HTML lets out say nothing and belong to the tag before them.
    """
    nodes: list = []
    for at, tag in enumerate(tags):
        if tag == "/" and nodes:
            nodes[-1][1].append(at)
        elif tag != "/":
            nodes.append([tag, [at]])
    known: dict = {}

    def number(node: list) -> int:
        key = node[0] if isinstance(node[0], str) else tuple(map(number, node[0]))
        return known.setdefault(key, len(known))

    numbers, changed = np.array([number(n) for n in nodes]), True
    while changed:
        changed, length = False, 1
        while 2 * length <= len(nodes):
            differ = np.flatnonzero(numbers[length:] != numbers[:-length])
            stops = np.append(differ, len(nodes) - length)
            # A run that repeats is as long as the way between two differences.
            if np.diff(stops, prepend=-1).max() > length:
                out = _folded(nodes, stops, length)
                if len(out) < len(nodes):
                    nodes, changed = out, True
                    numbers = np.array([number(n) for n in nodes])
            length += 1
    return nodes


def _folded(nodes: list, stops: np.ndarray, length: int) -> list:
    """The nodes with each run of ``length`` that follows itself as one group;
    ``stops`` are the places whose node differs from the one ``length`` further on."""
    ahead = stops[np.searchsorted(stops, np.arange(stops[-1] + 1))] - np.arange(stops[-1] + 1)
    out, at = [], 0
    while at < len(nodes):
        again = int(ahead[at]) // length if at < len(ahead) else 0
        if not again or (length == 1 and not isinstance(nodes[at][0], str)):
            out.append(nodes[at])
            at += 1
            continue
        group = nodes[at:at + length]
        for k in range(1, again + 1):
            for x, y in zip(group, nodes[at + k * length:at + (k + 1) * length]):
                _join_places(x, y)
        out.append([group, None])
        at += (again + 1) * length
    return out


def shape(nodes: list) -> list:
    """A page's nodes as a wrapper: ``[tag or [nodes], optional]``."""
    return [[n[0] if isinstance(n[0], str) else shape(n[0]), False] for n in nodes]


def _optional(node: list) -> list:
    return [node[0], True]


def _single(node: list):
    """The only tag of a group of one, or the tag itself."""
    if isinstance(node[0], str):
        return node[0]
    return _single(node[0][0]) if len(node[0]) == 1 else None


def _weight(node: list) -> int:
    return 1 if isinstance(node[0], str) else sum(map(_weight, node[0]))


def _head(nodes: list) -> str:
    return nodes[0][0] if isinstance(nodes[0][0], str) else _head(nodes[0][0])


def align(a: list, b: list, places: list | None = None) -> list:
    """The wrapper of what both take. ``places`` gets, for each leaf of ``b`` in
    order, the place of its leaf in the result."""
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    between: list = []
    middle = _align(a[head:len(a) - tail], b[head:len(b) - tail], between)
    if places is not None:
        before = sum(map(_weight, a[:head]))
        after = before + sum(map(_weight, middle))
        places += range(before)
        places += [before + k for k in between]
        places += range(after, after + sum(map(_weight, a[len(a) - tail:])))
    return a[:head] + middle + a[len(a) - tail:]


# Steps of an alignment: what is paired, in the order of preference, or left over.
_TAG, _GROUPS, _SINGLE, _LEFT, _RIGHT, _ONLY_A, _ONLY_B = range(7)
_FAR = 1 << 40


def _align(a: list, b: list, places: list) -> list:
    """The alignment that leaves least over, for streams of any length.

    Costs are worked out from the end, a row of ``b`` for each node of ``a``. Steps
    are kept for a block of rows; memory grows with the longer stream and the root
    of the other, time with their product.
    """
    if not a or not b:
        places += range(sum(map(_weight, b)))
        return list(map(_optional, a + b))
    ids: dict[str, int] = {}

    def number(content) -> int:
        return -1 if content is None else ids.setdefault(
            content if isinstance(content, str) else json.dumps(content), len(ids))

    def is_group(node: list) -> bool:
        return not isinstance(node[0], str)

    n, m = len(a), len(b)
    a_ids = [number(x[0]) for x in a]
    b_ids = np.array([number(y[0]) for y in b])
    b_heads = np.array([number(_head(y[0]) if is_group(y) else None) for y in b])
    b_singles = np.array([number(_single(y)) for y in b])
    # Groups of b that may stand for a run of a, by the run's first node.
    runs: dict[int, dict[tuple[int, ...], list[int]]] = defaultdict(lambda: defaultdict(list))
    reach = 1
    for j, y in enumerate(b):
        if is_group(y) and len(y[0]) > 1:
            run = tuple(number(p[0]) for p in y[0])
            runs[run[0]][run].append(j)
            reach = max(reach, len(run))
    rest = np.zeros(m + 1, np.int64)
    rest[:m] = np.cumsum([_weight(y) for y in b][::-1])[::-1]

    def row(i: int, below: deque) -> tuple[np.ndarray, np.ndarray]:
        """Costs and steps of a[i] at each place of b; ``below`` has the next rows."""
        x, cost, steps = a[i], np.full(m + 1, _FAR), np.zeros(m + 1, np.uint8)

        def offer(at: np.ndarray, costs: np.ndarray, step: int) -> None:
            better = costs < cost[at]
            cost[at[better]] = costs[better]
            steps[at[better]] = step

        if is_group(x):
            same, step = np.flatnonzero(b_heads == number(_head(x[0]))), _GROUPS
        else:
            same, step = np.flatnonzero(b_ids == a_ids[i]), _TAG
        offer(same, below[0][same + 1], step)
        one = number(_single(x))
        if one >= 0:
            single = np.flatnonzero((b_singles == one) & (b_ids != a_ids[i]))
            offer(single, below[0][single + 1], _SINGLE)
        if is_group(x) and 1 < len(x[0]) <= m:
            last = m - len(x[0]) + 1
            fits = np.ones(last, bool)
            for k, p in enumerate(x[0]):
                fits &= b_ids[k:k + last] == number(p[0])
            at = np.flatnonzero(fits)
            offer(at, below[0][at + len(x[0])], _LEFT)
        for run, js in runs.get(a_ids[i], {}).items():
            if tuple(a_ids[i:i + len(run)]) == run:
                at = np.array(js)
                offer(at, below[len(run) - 1][at + 1], _RIGHT)
        over = below[0] + _weight(x)
        steps[over < cost] = _ONLY_A
        cost = np.minimum(cost, over)
        least = np.minimum.accumulate((cost - rest)[::-1])[::-1] + rest
        steps[least < cost] = _ONLY_B
        return least, steps

    block = max(reach, isqrt(n * reach), KEPT_PAIRS // (m + 1))
    kept, below = {}, deque([rest], maxlen=reach)
    for start in range((n - 1) // block * block, -1, -block):
        kept[start] = deque(below, maxlen=reach)
        if start:
            for i in range(min(start + block, n) - 1, start - 1, -1):
                below.appendleft(row(i, below)[0])
    # What is paired has its leaves in the same order on both sides.
    out, i, j, leaf = [], 0, 0, 0
    for start in range(0, n, block):
        below, end = kept.pop(start), min(start + block, n)
        steps: deque = deque()
        for k in range(end - 1, start - 1, -1):
            costs, of_row = row(k, below)
            below.appendleft(costs)
            steps.appendleft(of_row)
        while i < end:
            step, di, dj = steps[i - start][j], 1, 1
            if step == _ONLY_A:
                dj = 0
                out.append(_optional(a[i]))
            elif step == _ONLY_B:
                di = 0
                out.append(_optional(b[j]))
                places += range(leaf, leaf + _weight(b[j]))
            else:
                if step == _LEFT:
                    dj = len(a[i][0])
                elif step == _RIGHT:
                    di = len(b[j][0])
                optional = any(x[1] for x in a[i:i + di]) or any(y[1] for y in b[j:j + dj])
                if step == _GROUPS:
                    inner: list = []
                    out.append([align(a[i][0], b[j][0], inner), optional])
                    places += [leaf + k for k in inner]
                else:
                    right = step == _RIGHT or (step == _SINGLE and not is_group(a[i]))
                    out.append([(b[j] if right else a[i])[0], optional])
                    places += range(leaf, leaf + _weight(out[-1]))
            leaf += _weight(out[-1])
            i, j = i + di, j + dj
    places += range(leaf, leaf + int(rest[j]))
    return out + list(map(_optional, b[j:]))


def _sections(wrapper: list) -> list[str]:
    """The wrapper's tags in order, groups opened out once."""
    return [t for n in wrapper for t in ([n[0]] if isinstance(n[0], str) else _sections(n[0]))]


def _has_article(tags: list[str]) -> bool:
    names = [t.rstrip("*?!") for t in tags]
    return any(t in INSIDE or t.endswith("+") for t in names)


def _labels(wrapper_json: str, shape_json: str) -> tuple[bool, ...]:
    """For each leaf of a page's shape whether its slot is article text, as the
    page's place in the host's wrapper says."""
    wrapper, page = json.loads(wrapper_json), json.loads(shape_json)
    places: list = []
    tags = _sections(align(wrapper, page, places))
    known = _has_article(tags)
    mine = [tags[at] for at in places]
    sure = any("*" in t and "?" not in t and "!" not in t for t in mine)
    return tuple(not t.endswith("!") and ("*" in t or not known) and not (sure and "?" in t)
                 for t in mine)


def _leaves(nodes: list) -> Iterator[list]:
    for n in nodes:
        if isinstance(n[0], str):
            yield n
        else:
            yield from _leaves(n[0])


def main_text(page: str, wrapper_json: str, known: dict) -> str:
    """The article of a page; ``known`` keeps the labels of shapes already seen."""
    tags, texts = tokens(page)
    nodes = fold(tags)
    key = wrapper_json, json.dumps(shape(nodes))
    labels = known.get(key) or known.setdefault(key, _labels(*key))
    wanted = [False] * len(tags)
    for leaf, label in zip(_leaves(nodes), labels):
        for at in leaf[1]:
            wanted[at] = label
    blocks = (" ".join(_html.unescape(t).split()) for t, w in zip(texts, wanted) if w)
    return "\n".join(b for b in blocks if b)


def merge_all(shapes: Iterable[list]) -> list | None:
    out = None
    for one in shapes:
        out = one if out is None else out if out == one else align(out, one)
    return out


def infer_wrappers(pages: DataFrame) -> DataFrame:
    """``host`` and ``wrapper`` (JSON) over all pages.

    Equal shapes of a host are counted before anything is moved, so a host with
    a third of all pages sends each of its shapes once per task.
    """
    def shapes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: dict[tuple[str, str], int] = {}
            for host, page in zip(*(c.to_pylist() for c in batch.columns)):
                key = host, json.dumps(shape(fold(tokens(page)[0])))
                seen[key] = seen.get(key, 0) + 1
            yield pa.RecordBatch.from_pydict({
                "host": pa.array([h for h, _ in seen], pa.string()),
                "shape": pa.array([s for _, s in seen], pa.string()),
                "n": pa.array(list(seen.values()), pa.int64())})

    def merge(table: pa.Table) -> pa.Table:
        rows = sorted(zip(table["n"].to_pylist(), table["shape"].to_pylist()),
                      key=lambda r: (-r[0], r[1]))
        wrapper = merge_all(json.loads(s) for _, s in rows)
        return pa.table({"host": table["host"].slice(0, 1),
                         "shape": pa.array([json.dumps(wrapper)], pa.string()),
                         "n": pa.array([sum(n for n, _ in rows)], pa.int64())})

    schema = "host string, shape string, n bigint"
    counted = pages.mapInArrow(shapes, schema).groupBy("host", "shape").agg(F.sum("n").alias("n"))
    parts = counted.groupBy("host", F.pmod(F.crc32("shape"), F.lit(PARTS))).applyInArrow(merge, schema)
    return parts.groupBy("host").applyInArrow(merge, schema).select(
        "host", F.col("shape").alias("wrapper"))


def _block_digests(text: str):
    """64-bit digests of a text's blocks, in order."""
    return F.transform(F.split(text, "\n", -1), lambda b: F.xxhash64(b))


def template_blocks(texts: DataFrame, least_pages: int = LEAST_PAGES) -> DataFrame:
    """``host`` and ``template``, digests of the blocks that all of a host's ``text``s hold.

    Equal texts count once, so copies of a page do not make its article a template;
    a host with fewer than ``least_pages`` different texts has none. Empty texts say
    nothing. Only digests are shuffled, and they are counted before anything is
    gathered, so a host with a third of all pages is many groups; what is gathered
    stands in one page.
    """
    different = texts.where(F.col("text") != "").groupBy(
        "host", F.unhex(F.sha2("text", 256)).alias("same")).agg(
            F.first(F.array_distinct(_block_digests("text"))).alias("blocks"))
    least = F.col("n") >= least_pages
    hosts = different.groupBy("host").agg(F.count("*").alias("n")).where(least)
    held = different.select("host", F.explode("blocks").alias("block")).groupBy(
        "host", "block").agg(F.count("*").alias("n")).where(least)
    return held.join(hosts, ["host", "n"]).groupBy("host").agg(
        F.collect_list("block").alias("template"))


def without_template(texts: DataFrame) -> DataFrame:
    """``texts`` (with ``host`` and ``text``) without their hosts' template blocks; a
    text of nothing else stays as it is."""
    texts = materialize(texts, "texts")
    templates = materialize(template_blocks(texts), "templates")
    size = templates.agg(F.sum(8 * F.size("template") + F.length("host"))).first()[0]
    if size is None:
        return texts
    if size <= BROADCAST_BYTES:
        templates = F.broadcast(templates)
    own = F.filter(F.split("text", "\n", -1),
                   lambda b: ~F.array_contains("template", F.xxhash64(b)))
    return texts.join(templates, "host", "left").withColumn(
        "text", F.when(F.col("template").isNull() | (F.size(own) == 0), F.col("text"))
        .otherwise(F.array_join(own, "\n"))).select(*texts.columns)


def extract(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``text`` of every row of ``pages``.

    Text of the article: blocks joined by one line end, character references
    decoded, white space within a block one space. A block that all of at least
    ``LEAST_PAGES`` different texts of a host hold is template and goes, unless a text
    has no other. Null and empty pages give an
    empty text; pages without a readable host share a wrapper; repeated rows
    give repeated rows; an empty table none; other columns are ignored.
    """
    url = F.col("url").cast("string")
    host = F.lower(F.coalesce(F.regexp_extract(url, r"^(?:[^:/?#]+:)?//([^/?#]*)", 1), F.lit("")))
    rows = pages.select("page_id", url.alias("url"), host.alias("host"),
                        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    wrappers = materialize(infer_wrappers(rows.select("host", "html")), "wrappers")
    total = wrappers.agg(F.coalesce(F.sum(F.length("wrapper") + F.length("host")), F.lit(0))).first()[0]
    if total <= BROADCAST_BYTES:
        wrappers = F.broadcast(wrappers)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict = {}
        for batch in batches:
            texts = [main_text(page, wrapper, known) for page, wrapper in
                     zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(4), pa.array(texts, pa.string())],
                names=["page_id", "url", "host", "text"])

    kind = rows.schema["page_id"].dataType.simpleString()
    texts = rows.join(wrappers, "host").select("page_id", "url", "html", "wrapper", "host").mapInArrow(
        run, f"page_id {kind}, url string, host string, text string")
    return without_template(texts).drop("host")


def op4_html_extraction(spark, sf_dir: str) -> DataFrame:
    """The main text of all pages."""
    return extract(read(spark, sf_dir, "pages")).select(
        "page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))
