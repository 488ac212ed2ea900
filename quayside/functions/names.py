"""Column-name standardisation (P1), in plain Python for schema metadata and
as a Column expression for names stored as data."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# A hyphen between a letter and a digit is dropped, every other
# run of non-alphanumerics becomes "_", and this one correction is applied.
NAME_CORRECTIONS = [("lifts_100_tons", "lifts_100_plus_tons")]

_LETTER_HYPHEN_DIGIT = re.compile(r"([a-z])-([0-9])")
_NON_ALNUM = re.compile(r"[^a-z0-9]+")


def standardize_column_name(name: str) -> str:
    out = name.strip().lower()
    out = _LETTER_HYPHEN_DIGIT.sub(r"\1\2", out)
    out = _NON_ALNUM.sub("_", out).strip("_")
    for old, new in NAME_CORRECTIONS:
        out = out.replace(old, new)
    return out


def standardize_name(c) -> Column:
    """Same rule as :func:`standardize_column_name`, evaluated on executors."""
    col = F.col(c) if isinstance(c, str) else c
    out = F.lower(F.trim(col))
    out = F.regexp_replace(out, r"([a-z])-([0-9])", "$1$2")
    out = F.regexp_replace(out, r"[^a-z0-9]+", "_")
    out = F.regexp_replace(out, r"^_+|_+$", "")
    for old, new in NAME_CORRECTIONS:
        out = F.replace(out, F.lit(old), F.lit(new))
    return out
