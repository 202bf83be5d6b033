"""Operator 5: drop boilerplate lines by their frequency within a site.

Native plan.  Rows (pages) are grouped by host; the pages of a host that contain a line are
divided by the host's page total, and lines at or above ``ratio`` (and on at least
``min_pages`` pages) go, wherever they stand.

Counting: a page's distinct non-blank line hashes are taken inside its row (no shuffle),
then counted per (host, line) with map-side combining, so a line on a third of all pages
costs one row per task.  The lines that go are gathered per host into one set; since a
page adds each of its lines once, a host can have at most (mean distinct lines per page /
ratio) such lines, so this set has a bound that does not grow with the host.  It is joined
back on (host, salt): pages of a hot host are spread over ``SALTS`` tasks by their id and the small
side is repeated once per salt.

A line is identified by a 64-bit and a 32-bit hash of its text without surrounding blanks.

Defined results: a null text stays null and counts no lines (its page still counts for
the host); a null host is a host of its own; blank lines are never boilerplate and stay;
repeated rows are pages of their own; an empty table gives no rows; all input columns are
kept and may have any names without a leading ``_line_``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RATIO = 0.1
MIN_PAGES = 5
SALTS = 32


def _line_key(line: Column) -> Column:
    bare = F.trim(line)
    return F.struct(F.xxhash64(bare).alias("h"), F.hash(bare).alias("g"))


def boilerplate(pages: DataFrame, host: Column, text: Column, ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """``(host, pages, lines)``: per host its page total and the keys of its boilerplate
    lines; hosts without any do not appear."""
    page = pages.select(host.alias("host"), text.alias("text"))
    totals = page.groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    bare = F.filter(F.split("text", "\n"), lambda x: F.trim(x) != "")
    keys = page.where(F.col("text").isNotNull()).select("host", F.explode(F.array_distinct(F.transform(bare, _line_key))).alias("key"))
    counts = keys.groupBy("host", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_pages)
    counts = counts.join(totals.withColumnRenamed("host", "h2"), F.col("host").eqNullSafe(F.col("h2")))
    return counts.where(F.col("n") >= F.col("pages") * ratio).groupBy("host").agg(
        F.first("pages").alias("pages"), F.collect_list("key").alias("lines"))


def drop_boilerplate(pages: DataFrame, host: Column, text_col: str = "text", ratio: float = RATIO,
                     min_pages: int = MIN_PAGES, id_col: str = "doc_id") -> DataFrame:
    """All rows and columns of ``pages`` with boilerplate lines taken out of ``text_col``,
    plus ``_line_total`` and ``_line_dropped``."""
    bad = boilerplate(pages, host, F.col(text_col), ratio, min_pages)
    bad = bad.select(F.col("host").alias("_line_host2"), F.col("lines").alias("_line_bad"),
                     F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_line_salt2"))
    salted = pages.withColumn("_line_host", host).withColumn(
        "_line_salt", F.pmod(F.xxhash64(id_col), F.lit(SALTS)).cast("int"))
    j = salted.join(bad, F.col("_line_host").eqNullSafe(F.col("_line_host2")) & (F.col("_line_salt") == F.col("_line_salt2")), "left")
    lines = F.split(F.col(text_col), "\n")
    kept = F.filter(lines, lambda x: (F.trim(x) == "") | ~F.array_contains("_line_bad", _line_key(x)))
    j = j.withColumn("_line_kept", F.when(F.col("_line_bad").isNotNull(), kept))
    total = F.coalesce(F.size(lines), F.lit(0)).cast("long")
    j = j.withColumn("_line_total", F.when(F.col(text_col).isNull(), 0).otherwise(total).cast("long"))
    j = j.withColumn("_line_dropped", F.when(F.col("_line_kept").isNull(), 0).otherwise(F.col("_line_total") - F.size("_line_kept")).cast("long"))
    j = j.withColumn(text_col, F.when(F.col("_line_dropped") > 0, F.array_join("_line_kept", "\n")).otherwise(F.col(text_col)))
    return j.select(*pages.columns, "_line_total", "_line_dropped")


OP5_SQL = """
WITH l AS (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line,
                  generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents),
n AS (SELECT source, count(*) AS pages FROM documents GROUP BY source),
c AS (SELECT source, trim(line, ' ') AS line, count(DISTINCT doc_id) AS k FROM l WHERE trim(line, ' ') <> '' GROUP BY 1, 2),
b AS (SELECT c.source, c.line FROM c JOIN n ON c.source IS NOT DISTINCT FROM n.source WHERE k >= 5 AND k >= pages * CAST(0.1 AS DOUBLE)),
k AS (SELECT l.doc_id, count(*) AS n_lines, count(*) FILTER (WHERE b.line IS NOT NULL) AS n_dropped,
             coalesce(string_agg(l.line, chr(10) ORDER BY l.pos) FILTER (WHERE b.line IS NULL), '') AS kept
      FROM l LEFT JOIN b ON l.source IS NOT DISTINCT FROM b.source AND trim(l.line, ' ') = b.line GROUP BY l.doc_id)
SELECT d.doc_id, d.source, CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(n_dropped, 0) AS BIGINT) AS n_dropped,
       CASE WHEN d.text IS NOT NULL THEN md5(kept) END AS kept_md5
FROM documents d LEFT JOIN k ON d.doc_id = k.doc_id
"""
