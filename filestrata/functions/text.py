"""Value expressions: every one stays in the JVM, no Python UDF."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The texts read as null in delimited files and workbooks.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)


def contract_number(value: Column) -> Column:
    """Keep the decimal digits of any script; null when none is left.

    ``\\D`` in Java regex is ASCII-only, so the Unicode digit class is named.
    """
    digits = F.regexp_replace(value.cast("string"), r"[^\p{Nd}]", "")
    return F.nullif(digits, F.lit(""))


def null_tokens_sql(value: str, tokens: Iterable[str] = NULL_TOKENS) -> str:
    """SQL that nulls out the missing-value texts; they are compared untrimmed.

    One parsed expression: a list of literal columns for each of many table
    columns would make planning slow.
    """
    listed = ", ".join("'" + t.replace("\\", "\\\\").replace("'", "\\'") + "'" for t in tokens)
    return f"if({value} IN ({listed}), NULL, {value})" if listed else value


def null_tokens(value: str, tokens: Iterable[str] = NULL_TOKENS) -> Column:
    """``null_tokens_sql`` as a column."""
    return F.expr(null_tokens_sql(value, tokens))


def stringify(df: DataFrame) -> DataFrame:
    """Every column as nullable text, nulls kept."""
    return df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])


def contains_text(value: Column, needle: str) -> Column:
    """Substring test in which a null value counts as no match."""
    return F.coalesce(value.contains(needle), F.lit(False))


def elapsed_seconds(start: Column, end: Column) -> Column:
    """Fractional seconds between two timestamps."""
    return (F.unix_micros(end) - F.unix_micros(start)) / F.lit(1e6)
