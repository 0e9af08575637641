"""Line dedup [native]: overlapping three-line windows, hashed, counted globally, later occurrences removed.

A text is cut at line feeds. A window is three consecutive lines of one document; a document of fewer lines
has none, and windows of three blank lines don't count. Windows are ordered by (doc_id, start), nulls first;
each window whose lines also start earlier is a later occurrence, and every line that it covers is removed.
Windows are judged on the input. Lines are compared by 128 bits of hash.

Plan: windows are hashed in one projection, first occurrences come from a partially aggregated groupBy, and
a join by hash returns them. A window that a third of the documents hold is combined before the shuffle, and
on the join's side its rows are an ordinary skewed key that adaptive execution splits.

Edge cases: a null text has no lines (n_lines 0) and stays null; an empty one has a single empty line. Rows
that repeat a doc_id and a text count as one occurrence and all get its result. Where a doc_id repeats with other
texts, equal windows at equal starts are the same place and neither counts as earlier. Other columns pass through
untouched; the names that start with __ld_ are reserved.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.llm import shared

WINDOW = 3

_WINDOWS = """
transform(sequence(0, size(__ld_l) - {n}), i -> struct(i AS p,
  xxhash64(slice(__ld_l, i + 1, {n})) AS a,
  xxhash64('b', slice(__ld_l, i + 1, {n}), length(__ld_l[i])) AS b,
  length(trim(BOTH ' \\t\\r' FROM concat_ws('', slice(__ld_l, i + 1, {n})))) AS c))
"""


def repeated_windows(docs: DataFrame, width: int = WINDOW) -> DataFrame:
    """(doc_id, __ld_t, starts): the starts of each document's later windows."""
    lines = docs.select("doc_id", F.xxhash64("text").alias("__ld_t"), F.split("text", "\n", -1).alias("__ld_l"))
    windows = (
        lines.filter(F.size("__ld_l") >= width)
        .select("doc_id", "__ld_t", F.explode(F.expr(_WINDOWS.format(n=width))).alias("w"))
        .filter("w.c > 0")
        .select("doc_id", "__ld_t", F.col("w.p").alias("p"), F.col("w.a").alias("a"), F.col("w.b").alias("b"))
    )
    windows = shared.materialize(windows, "line-windows")
    first = (
        windows.groupBy("a", "b")
        .agg(F.min(F.struct("doc_id", "p")).alias("f"), F.max(F.struct("doc_id", "p")).alias("l"))
        .filter("NOT (f <=> l)")
        .select("a", "b", "f")
    )
    later = windows.join(first, ["a", "b"]).filter(~F.struct("doc_id", "p").eqNullSafe(F.col("f")))
    return later.groupBy("doc_id", "__ld_t").agg(F.sort_array(F.collect_set("p")).alias("starts"))


def line_dedup(docs: DataFrame, width: int = WINDOW) -> DataFrame:
    """docs with text cut, and n_lines, n_removed added (names in docs that clash are replaced)."""
    names = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    marked = repeated_windows(docs, width).withColumnsRenamed({"doc_id": "__ld_d", "__ld_t": "__ld_u"})
    keyed = docs.select(*(F.col(f"`{c}`") for c in names), F.xxhash64("text").alias("__ld_t"))
    both = keyed.join(marked, F.col("doc_id").eqNullSafe(F.col("__ld_d")) & (F.col("__ld_t") == F.col("__ld_u")), "left")
    # A line goes if a later window starts on it or on one of the width - 1 lines before it; set difference keeps order.
    gone = f"flatten(transform(starts, s -> sequence(s, s + {width - 1})))"
    kept = f"transform(array_except(sequence(0, size(__ld_l) - 1), {gone}), i -> __ld_l[i])"
    cut = both.withColumn("__ld_l", F.split("text", "\n", -1)).withColumn("__ld_k", F.when(F.col("starts").isNull(), F.col("__ld_l")).otherwise(F.expr(kept)))
    return cut.select(
        *(F.array_join("__ld_k", "\n").alias("text") if c == "text" else F.col(f"`{c}`") for c in names),
        F.when(F.col("text").isNull(), 0).otherwise(F.size("__ld_l")).cast("long").alias("n_lines"),
        F.when(F.col("text").isNull(), 0).otherwise(F.size("__ld_l") - F.size("__ld_k")).cast("long").alias("n_removed"),
    )


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup(shared.table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


ORACLE = """
WITH lines AS (
  SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) AS i, unnest(string_split(text, chr(10))) AS line
  FROM documents
), windows AS (
  SELECT doc_id, i, line, lead(line, 1) OVER w AS l2, lead(line, 2) OVER w AS l3, lead(i, 2) OVER w AS i3
  FROM lines WINDOW w AS (PARTITION BY doc_id ORDER BY i)
), later AS (
  SELECT doc_id, i FROM (
    SELECT doc_id, i, row_number() OVER (PARTITION BY line, l2, l3 ORDER BY doc_id, i) AS r FROM windows
    WHERE i3 IS NOT NULL AND length(trim(line || l2 || l3, chr(32) || chr(9) || chr(13))) > 0
  ) WHERE r > 1
), gone AS (
  SELECT DISTINCT doc_id, i + k AS i FROM later, (VALUES (0), (1), (2)) t(k)
)
SELECT l.doc_id, count(*)::BIGINT AS n_lines, count(g.i)::BIGINT AS n_removed,
  sha256(coalesce(string_agg(l.line, chr(10) ORDER BY l.i) FILTER (WHERE g.i IS NULL), '')) AS kept_sha256
FROM lines l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.i = g.i
GROUP BY l.doc_id
"""
