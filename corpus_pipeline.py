"""Training data from the documents table, stage by stage.

Each stage takes what the one before it kept, is written as Parquet to the shared
folder, and read back by the next.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filestrata.llm.bpe import encode_and_decode
from filestrata.llm.common import read
from filestrata.llm.exact_dedup import without_duplicates
from filestrata.llm.mixing import mixed_documents
from filestrata.llm.near_dup import without_near_duplicates
from filestrata.llm.toxicity import without_toxic
from filestrata.storage import materialize, use_local_checkpoint_dir

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject; it learns from ``labels``."""
    use_local_checkpoint_dir(spark)
    return without_toxic(docs, read(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    use_local_checkpoint_dir(spark)
    return without_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    use_local_checkpoint_dir(spark)
    return without_near_duplicates(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix of their sources takes them."""
    use_local_checkpoint_dir(spark)
    return mixed_documents(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and the digest of the text they decode to."""
    import public_tokenizers

    use_local_checkpoint_dir(spark)
    coded = encode_and_decode(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return coded.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), "ids",
                        F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mixing),
    ("encoding", encoding),
]

# A trained classifier, signatures and a tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table."""
    use_local_checkpoint_dir(spark)
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
