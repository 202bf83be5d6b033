"""Column helpers that pin down R semantics on Spark.

All helpers return ``Column`` expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def rint0(c: str | Column) -> Column:
    """R ``round(x, 0)``: half-to-even, and ``-0.0`` normalised to ``0.0``."""
    return F.rint(col(c)) + F.lit(0.0)


def round_half_even(c: str | Column, digits: int) -> Column:
    """R ``round(x, d)`` (half-to-even) for ``d > 0``; used to make floating sums
    engine-independent before comparison."""
    return F.bround(col(c), digits) + F.lit(0.0)


def clamp0(c: str | Column) -> Column:
    """``x[x<0] := 0`` keeping nulls (``greatest`` would turn null into 0)."""
    x = col(c)
    return F.when(x < 0, F.lit(0)).otherwise(x)


def safe_log(c: str | Column) -> Column:
    """``log(ifelse(x==0, 1, x))``."""
    x = col(c)
    return F.log(F.when(x == 0, F.lit(1.0)).otherwise(x.cast("double")))


def ladder(pairs: Sequence[tuple[Column, object]], default: object | None = None,
           use_default: bool = False) -> Column:
    """Nested ``ifelse`` as a ``when`` chain.

    R's ``ifelse(NA, ...)`` yields NA immediately, whereas SQL ``CASE`` falls
    through on NULL.  The chain therefore has no ``otherwise`` unless the caller
    asks for one (e.g. ``grepl`` is never NA, so its default is reachable).
    """
    expr = None
    for cond, value in pairs:
        v = value if isinstance(value, Column) else F.lit(value)
        expr = F.when(cond, v) if expr is None else expr.when(cond, v)
    if use_default:
        expr = expr.otherwise(default if isinstance(default, Column) else F.lit(default))
    return expr


def r_bool(c: str | Column) -> Column:
    """D-12: ``"0"/"False"`` -> false, ``"1"/"True"`` -> true, anything else -> null."""
    x = col(c).cast("string")
    return (F.when(x.isin("0", "False"), F.lit(False))
             .when(x.isin("1", "True"), F.lit(True)))


def letters_only(c: str | Column) -> Column:
    """``gsub("[^A-Za-z]", "", x)``."""
    return F.regexp_replace(col(c), "[^A-Za-z]", "")


def trimws(c: str | Column) -> Column:
    """R ``trimws`` strips space, tab, CR and LF (Spark ``trim`` strips spaces only)."""
    return F.regexp_replace(col(c), r"^[ \t\r\n]+|[ \t\r\n]+$", "")


def r_strsplit(c: str | Column, delimiters: Sequence[str]) -> Column:
    """R ``strsplit(x, rx)``: ``""`` -> empty array, NA -> NA, and a single
    trailing empty piece is dropped (Spark's ``split`` keeps it).  Every delimiter is
    matched literally (D17: all regex metacharacters are escaped) and the
    delimiters are OR-ed."""
    rx = "|".join(re.escape(d) for d in delimiters)
    x = col(c).cast("string")
    parts = F.split(x, rx, -1)
    trimmed = F.when(F.get(parts, F.size(parts) - 1) == F.lit(""),
                     F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)
    return F.when(x.isNull(), F.lit(None)).when(x == F.lit(""), F.array().cast("array<string>")) \
            .otherwise(trimmed)


def is_in(c: str | Column, values: Sequence[object]) -> Column:
    """R ``%in%`` never yields NA."""
    return F.coalesce(col(c).isin(*values), F.lit(False))
