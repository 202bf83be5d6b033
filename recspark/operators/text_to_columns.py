"""Split a delimited text column into N columns.

Semantics kept from the reference helper:
* delimiters are OR-ed and matched literally (D17: every regex metacharacter is
  escaped, not only ``. ^ $ | ? + : * ( )``);
* R ``strsplit``: ``""`` -> no parts, NA -> NA, one trailing empty part dropped;
* optional ``trimws`` of every part (space, tab, CR, LF);
* N = the largest number of parts over the whole column (A22 — one scalar
  aggregate, the only value brought to the driver); shorter rows are right-padded
  with nulls (D18: a missing early delimiter shifts parts left, as in a spreadsheet);
* new columns ``{new_name_conv}1..N``; placement: next to the original, at the far
  right, or replacing the original in place (D16 fixed for the last column).
The column is cast to string first (D34).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.core import r_strsplit, trimws


def text_to_columns(df: DataFrame, column: str | int, delimiters: str | Sequence[str],
                    trim: bool = True, put_at_end: bool = False, keep_orig: bool = True,
                    new_name_conv: str = "new", n_parts: int | None = None) -> DataFrame:
    """Return ``df`` with ``column`` split into ``new1..newN``.

    ``column`` may be a name or a 1-based position.  ``n_parts`` skips the
    max-size scan when the caller knows N."""
    cols = df.columns
    if isinstance(column, int):
        if not 1 <= column <= len(cols):
            raise ValueError("column position out of range")
        name = cols[column - 1]
    else:
        if column not in cols:
            raise ValueError(f"unknown column {column!r}")
        name = column
    delims = [delimiters] if isinstance(delimiters, str) else list(delimiters)
    if not delims:
        raise ValueError("at least one delimiter is required")

    parts = r_strsplit(name, delims)
    if trim:
        parts = F.transform(parts, lambda p: trimws(p))
    x = df.withColumn("__parts", parts)
    if n_parts is None:
        n_parts = x.agg(F.max(F.size("__parts"))).collect()[0][0] or 0
        n_parts = max(int(n_parts), 1)  # an all-empty column still yields new1 (all null)
    new_cols = [F.get(F.col("__parts"), j).alias(f"{new_name_conv}{j + 1}") for j in range(n_parts)]

    idx = cols.index(name)
    if len(cols) == 1:
        put_at_end = True
    if keep_orig:
        if put_at_end or idx == len(cols) - 1:
            out = [*cols, *new_cols]
        else:
            out = [*cols[: idx + 1], *new_cols, *cols[idx + 1:]]
    else:
        rest = [c for c in cols if c != name]
        out = [*rest, *new_cols] if put_at_end else [*cols[:idx], *new_cols, *cols[idx + 1:]]
    return x.select(*[F.col(c) if isinstance(c, str) else c for c in out])
