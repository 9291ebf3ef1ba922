"""Exact duplicates by deterministic block naming. DataFrame operations only.

A text is cut into blocks of a fixed number of bytes. Distinct blocks get
integer names; adjacent names are paired and distinct pairs get names of their
own, until every document has one name. Two documents have the same name at the
same level exactly if their texts are the same: names stand for contents, and a
digest is used only to look a block's name up, after it was seen to be unique
among the distinct blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..storage import materialize
from .common import read

BLOCK_BYTES = 4096
# No name: the second half of a pair whose document ends with the first.
NOTHING = -1


def normalised(text: Column) -> Column:
    """Text without white space characters; null is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", "")


def _blocks(block_bytes: int) -> Column:
    """The blocks of ``bytes`` as an array; an empty text has one empty block."""
    count = F.greatest(F.lit(1), F.ceil(F.length("bytes") / block_bytes))
    return F.transform(F.sequence(F.lit(0), (count - 1).cast("int")),
                       lambda i: F.substring(F.col("bytes"), i * block_bytes + 1, F.lit(block_bytes)))


def _numbered(distinct: DataFrame, label: str, first: int = 0) -> DataFrame:
    """Distinct rows with an integer ``name``, written so that names stay."""
    name = F.monotonically_increasing_id() + first
    return materialize(distinct.withColumn("name", name), label)


def _block_names(contents: DataFrame, digest) -> tuple[DataFrame, DataFrame | None]:
    """``digest``, ``name`` of the distinct blocks; those that share a digest
    with another block come second, with their contents."""
    distinct = contents.distinct()
    names = _numbered(distinct.select(digest(F.col("block")).alias("digest")), "block-names")
    shared = names.groupBy("digest").count().where("count > 1").select("digest")
    if shared.isEmpty():
        return names, None
    shared = materialize(shared, "block-clashes")
    clashing = (distinct.withColumn("digest", digest(F.col("block")))
                .join(shared, "digest", "left_semi"))
    names_end = names.agg(F.max("name")).first()[0] + 1
    return (names.join(shared, "digest", "left_anti"),
            _numbered(clashing, "clash-names", names_end))


def name_documents(docs: DataFrame, block_bytes: int = BLOCK_BYTES, digest=F.md5) -> DataFrame:
    """One row per row of ``docs``: ``row``, ``doc_id``, ``sha256`` (of the
    normalised text), ``n_chars`` (code points of the text as given) and its
    identity ``(level, name)``.

    ``digest`` only speeds the lookup of names up; any function of the block
    gives the same groups.
    """
    texts = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    cut = texts.select("doc_id", F.length(F.coalesce("text", F.lit(""))).alias("n_chars"),
                       F.encode(normalised(F.col("text")), "UTF-8").alias("bytes"))
    parts = cut.select(F.monotonically_increasing_id().alias("row"), "doc_id", "n_chars",
                       F.sha2("bytes", 256).alias("sha256"), _blocks(block_bytes).alias("blocks"))
    placed = materialize(
        parts.select("row", "doc_id", "n_chars", "sha256",
                     F.size("blocks").alias("n"), F.posexplode("blocks").alias("at", "block"))
        .select("row", "doc_id", "n_chars", "sha256", "n", "at", digest(F.col("block")).alias("digest"),
                F.length("block").alias("block_length")),
        "block-places")
    contents = cut.select(F.explode(_blocks(block_bytes)).alias("block"))
    names, clashing = _block_names(contents, digest)
    rows = ["row", "doc_id", "n_chars", "sha256", "n", "at"]
    named = placed.join(names, "digest").select(*rows, "name")
    if clashing is not None:
        again = (parts.select("row", F.posexplode("blocks").alias("at", "block"))
                 .join(clashing, "block").select("row", "at", "name"))
        named = named.unionByName(placed.join(again, ["row", "at"]).select(*rows, "name"))
    level = 0
    current, finished = materialize(named, "names"), []
    while True:
        done = current.where("n = 1").select(
            "row", "doc_id", "n_chars", "sha256", F.lit(level).alias("level"), "name")
        finished.append(done)
        current = current.where("n > 1")
        if current.isEmpty():
            break
        left = F.max(F.when(F.col("at") % 2 == 0, F.col("name"))).alias("left")
        right = F.coalesce(F.max(F.when(F.col("at") % 2 == 1, F.col("name"))),
                           F.lit(NOTHING)).alias("right")
        pairs = (current.groupBy("row", "doc_id", "n_chars", "sha256",
                                 F.ceil(F.col("n") / 2).cast("int").alias("n"),
                                 F.floor(F.col("at") / 2).cast("int").alias("at"))
                 .agg(left, right))
        names = _numbered(pairs.select("left", "right").distinct(), "pair-names")
        current = materialize(pairs.join(names, ["left", "right"]).select(*rows, "name"), "names")
        level += 1
    identities = finished[0]
    for part in finished[1:]:
        identities = identities.unionByName(part)
    return identities


def duplicate_groups(docs: DataFrame, **options) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``keep_id``, ``group_size``, ``kept``,
    ``text_sha256``, ``n_chars``.

    Texts are equal if they are the same without white space characters. Of
    equal ones the row with the most code points as given stays, then the one
    with the smallest ``doc_id`` (null last); of rows that agree in both, one.
    Null and empty texts are equal to each other; an empty table gives no rows;
    other columns are ignored, whatever their names.
    """
    identities = name_documents(docs, **options)
    first = F.min(F.struct((-F.col("n_chars")).alias("a"), F.col("doc_id").isNull().alias("b"),
                           "doc_id", "row"))
    # Written, so that the join reads both sides as they are and can split a large group.
    groups = materialize(identities.groupBy("level", "name").agg(
        F.count(F.lit(1)).alias("group_size"), first.alias("best")), "groups")
    return identities.join(groups, ["level", "name"]).select(
        "doc_id", F.col("best.doc_id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("best.row")).alias("kept"), F.col("sha256").alias("text_sha256"),
        "n_chars")


def without_duplicates(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one row of each group of equal texts, its columns unchanged."""
    kept = duplicate_groups(docs, **options).where("kept").select(
        F.col("doc_id").alias("k_doc"), F.col("text_sha256").alias("k_sha"),
        F.col("n_chars").alias("k_chars"))
    text = docs["text"].cast("string")
    marked = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("doc"),
        docs["doc_id"].cast("bigint").alias("k_doc"),
        F.sha2(F.encode(normalised(text), "UTF-8"), 256).alias("k_sha"),
        F.length(F.coalesce(text, F.lit(""))).alias("k_chars"))
    same = (marked["k_doc"].eqNullSafe(kept["k_doc"]) & (marked["k_sha"] == kept["k_sha"])
            & (marked["k_chars"] == kept["k_chars"]))
    left = marked.join(kept, same, "left_semi")
    return left.dropDuplicates(["k_doc", "k_sha", "k_chars"]).select("doc.*")


def op3_exact_dedup(spark, sf_dir: str) -> DataFrame:
    """Groups of equal texts over all documents."""
    return duplicate_groups(read(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


OP3_SQL = r"""
with texts as (
    select doc_id, length(coalesce(text, '')) as n_chars,
           regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') as norm
    from documents),
ranked as (
    select *, row_number() over (partition by norm order by n_chars desc, doc_id) as turn,
           count(*) over (partition by norm) as group_size,
           first_value(doc_id) over (partition by norm order by n_chars desc, doc_id) as keep_id
    from texts)
select doc_id, keep_id, group_size, turn = 1 as kept, sha256(norm) as text_sha256
from ranked
"""
