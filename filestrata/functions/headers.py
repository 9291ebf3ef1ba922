"""Header-name rules.

Names are schema metadata: a handful per layout, so they are worked out on the
driver and applied as column aliases. No data row passes through here.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterable, Sequence


def fold_ascii(text: str) -> str:
    """Strip accents and drop what has no ASCII form."""
    return unicodedata.normalize("NFKD", text).encode("ascii", "ignore").decode("ascii")


def reader_names(cells: Sequence[str | None], width: int | None = None) -> list[str]:
    """Names as a tabular reader hands them over.

    A blank cell becomes ``Unnamed: <position>`` and a repeated name gets
    ``.1``, ``.2`` and so on. ``width`` pads a header shorter than its data.
    """
    padded = list(cells) + [None] * max(0, (width or 0) - len(cells))
    wanted = [c if c else f"Unnamed: {i}" for i, c in enumerate(padded)]
    return _make_unique(wanted, ".")


def technical_name(name: str) -> str:
    """Lower-case ASCII with every run of other characters as one ``_``."""
    return re.sub(r"[^a-z0-9]+", "_", fold_ascii(name).lower()).strip("_")


def technical_names(names: Iterable[str], reserved: Iterable[str] = ()) -> list[str]:
    """Technical names made unique with ``_1``, ``_2``; empty ones ``col_<i>``.

    ``reserved`` names (storage partition columns) count as already taken.
    """
    wanted = [technical_name(n) or f"col_{i}" for i, n in enumerate(names)]
    return _make_unique(wanted, "_", reserved)


def layout_name(name: str) -> str:
    """The contract-portfolio layout's own rule; punctuation other than
    ``/ % .`` and runs of ``_`` stay."""
    text = fold_ascii(name.strip().lower())
    # The layout's replacements, in its order.
    for old, new in (("/", "_"), ("%", "percentual"), (" ", "_"), (".", "")):
        text = text.replace(old, new)
    return text


def _make_unique(
    names: Sequence[str], separator: str, reserved: Iterable[str] = ()
) -> list[str]:
    """Suffix repeats until unique, never taking a name another column owns."""
    taken = set(reserved)
    owned = Counter(names)
    seen: Counter[str] = Counter()
    result = []
    for name in names:
        unique = name
        while unique in taken or (unique != name and unique in owned):
            seen[name] += 1
            unique = f"{name}{separator}{seen[name]}"
        taken.add(unique)
        result.append(unique)
    return result
