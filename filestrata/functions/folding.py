"""Accent folding of values: stays in the JVM, whatever the script."""

from __future__ import annotations

import sys
import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F


@cache
def _letters() -> tuple[str, str]:
    """Letters that are written as one sign with their marks, and what is left without.

    Made from the Unicode tables: a sign whose canonical decomposition is one sign and
    marks alone.
    """
    composed, bare = [], []
    for point in range(0xC0, sys.maxunicode + 1):
        parts = unicodedata.normalize("NFD", chr(point))
        if len(parts) > 1 and all(unicodedata.category(c)[0] == "M" for c in parts[1:]):
            composed.append(chr(point))
            bare.append(parts[0])
    return "".join(composed), "".join(bare)


def fold_accents(value: Column) -> Column:
    """Text without accents and other marks; letters, case and everything else stay.

    Marks go whether they are part of a letter or signs of their own. A null stays
    null, an empty text empty.
    """
    return F.regexp_replace(F.translate(value.cast("string"), *_letters()), r"\p{M}+", "")
