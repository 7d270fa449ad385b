"""Column-name normalisation. Runs on the driver over `df.columns` only
(metadata, no job) and is applied with one `toDF`."""

from __future__ import annotations

import re

# Separators collapsed to '_' and the characters removed.
_SEPARATORS = re.compile(r"[\s\-/]+")
_NON_WORD = re.compile(r"[^\w]")


def normalize_name(name: str) -> str:
    """Strip, drop a leading byte-order mark, strip '"', lower-case,
    runs of whitespace/'-'/'/' -> '_', drop non-word characters (Unicode-aware:
    accented letters stay)."""
    n = name.strip().lstrip("﻿").strip('"').lower()
    n = _SEPARATORS.sub("_", n)
    return _NON_WORD.sub("", n)


def ascii_name(name: str) -> str:
    """Drop non-ASCII characters, then '_' at both ends."""
    return name.encode("ascii", "ignore").decode().strip("_")


def check_unique(names: list[str], context: str = "") -> list[str]:
    """Spark resolves names case-insensitively: two names equal up to case
    would be ambiguous, so refuse them."""
    seen = {}
    for n in names:
        k = n.lower()
        if k in seen:
            raise ValueError(f"column name collision{(' in ' + context) if context else ''}: "
                             f"{seen[k]!r} and {n!r}")
        seen[k] = n
    return names


__all__ = ["normalize_name", "ascii_name", "check_unique"]
