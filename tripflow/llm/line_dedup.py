"""Line dedup by overlapping three-line windows.

A window is three consecutive lines that hold a word (blank lines between them
are passed over). The first occurrence of a window, in order of document id and
position, stays; the lines of every later one go. Overlapping windows merge, so
a repeated passage of any length of three lines or more goes as a whole.

Defined results: NULL text stays NULL; a document of fewer than three such
lines has no window and stays as it is, like blank lines; a NULL id counts as
the smallest; rows that repeat an id and text are one document, each given its
result; an empty table gives an empty table; other columns pass through, and
``n_lines`` and ``n_removed`` replace columns of those names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.llm.words import WORD_PATTERN


def windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each window: document key, the line numbers it covers and
    a 128-bit hash of its lines."""
    lines = F.filter(
        F.transform(F.split(F.col(text_col), "\n"), lambda x, i: F.struct(i.alias("i"), x.alias("x"))),
        lambda l: l["x"].rlike(WORD_PATTERN),  # noqa: E741
    )
    at = lambda i, k: F.col("_lines")[i + k]
    window = F.transform(
        F.slice("_lines", 1, F.greatest(F.size("_lines") - 2, F.lit(0))),
        lambda _, i: F.struct(
            F.xxhash64(*(at(i, k)["x"] for k in (0, 1, 2))).alias("h1"),
            F.xxhash64(*(at(i, k)["x"] for k in (2, 0, 1))).alias("h2"),
            F.array(*(at(i, k)["i"] for k in (0, 1, 2))).alias("at"),
        ),
    )
    return (
        docs.where(F.col(text_col).isNotNull())
        .select(F.col(id_col).alias("_id"), F.xxhash64(text_col).alias("_th"), lines.alias("_lines"))
        .withColumn("_w", F.explode(window))
        .select("_id", "_th", "_w.*")
    )


def later_windows(found: DataFrame) -> DataFrame:
    """Windows that also occur earlier: the count and the first occurrence are
    combined on the map side, and the join back splits a hot window."""
    here = F.struct("_id", "_th", "at")
    first = found.groupBy("h1", "h2").agg(F.min(here).alias("_first"), F.count("*").alias("_n")).where("_n > 1")
    return found.join(first, ["h1", "h2"]).where(here > F.col("_first"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the lines of repeated windows removed from ``text_col``,
    ``n_lines`` and ``n_removed`` added. One row in, one row out."""
    covered = (
        later_windows(windows(docs, id_col, text_col))
        .groupBy(F.col("_id").alias("_id2"), F.col("_th").alias("_th2"))
        .agg(F.array_distinct(F.flatten(F.collect_set("at"))).alias("_covered"))
    )
    rows = docs.select(F.struct("*").alias("_row")).select(
        "_row", F.col(f"_row.{id_col}").alias("_id"), F.xxhash64(F.col(f"_row.{text_col}")).alias("_th")
    )
    joined = rows.join(covered, rows["_id"].eqNullSafe(covered["_id2"]) & (rows["_th"] == covered["_th2"]), "left")
    lines = F.coalesce(F.split(f"_row.{text_col}", "\n"), F.array().cast("array<string>"))
    joined = joined.withColumn("_lines", lines).withColumn("_n", F.size("_lines"))
    stay = F.array_except(F.sequence(F.lit(0), F.col("_n") - 1), F.col("_covered"))
    text = F.when(F.col("_covered").isNull(), F.col(f"_row.{text_col}")).otherwise(
        F.array_join(F.transform(stay, lambda i: F.col("_lines")[i]), "\n")
    )
    out = {c: F.col(f"_row.{c}") for c in docs.columns} | {
        text_col: text,
        "n_lines": F.col("_n").cast("long"),
        "n_removed": F.coalesce(F.size("_covered"), F.lit(0)).cast("long"),
    }
    return joined.select(*(c.alias(k) for k, c in out.items()))


SQL = """
WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos
  FROM documents WHERE text IS NOT NULL
), w AS (
  SELECT doc_id, pos AS p1, line AS a, lead(pos) OVER o AS p2, lead(line) OVER o AS b,
         lead(pos, 2) OVER o AS p3, lead(line, 2) OVER o AS c
  FROM lines WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')
  WINDOW o AS (PARTITION BY doc_id ORDER BY pos)
), ranked AS (
  SELECT doc_id, p1, p2, p3, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, p1) AS rn
  FROM w WHERE p3 IS NOT NULL
), covered AS (
  SELECT DISTINCT doc_id, unnest([p1, p2, p3]) AS pos FROM ranked WHERE rn > 1
), kept AS (
  SELECT l.doc_id, count(*) AS n_lines, count(c.pos) AS n_removed,
         coalesce(string_agg(l.line, chr(10) ORDER BY l.pos) FILTER (WHERE c.pos IS NULL), '') AS text
  FROM lines l LEFT JOIN covered c ON c.doc_id = l.doc_id AND c.pos = l.pos
  GROUP BY l.doc_id
)
SELECT d.doc_id, coalesce(k.n_lines, 0) AS n_lines, coalesce(k.n_removed, 0) AS n_removed, k.text
FROM documents d LEFT JOIN kept k ON k.doc_id = d.doc_id
"""
