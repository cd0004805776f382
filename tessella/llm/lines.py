"""Line dedup by overlapping three-line windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import durable
from .registry import extra, partitions, query, table

SPAN = 3
#: Passages of more words than this are compared on one and two lines as well, where that is asked for.
PASSAGE = 50
#: Windows with more than this share of all places are hot; there are at most as many as its inverse.
HOT = 1000
_BLANK = "[ \\t\\n\\x0b\\f\\r]+"


def _filled(lines: Column) -> Column:
    """(position, line) of the lines that hold a word."""
    numbered = F.transform(lines, lambda line, i: F.struct(i.alias("at"), line.alias("line")))
    return F.filter(numbered, lambda x: F.length(F.translate(x["line"], " \t\n\x0b\x0c\r", "")) > 0)


def _windows(span: int) -> Column:
    """Windows of ``span`` lines of ``l``: hashes, and the first, second and last position; a short one repeats its last."""
    key = lambda i: [F.get("l", i + k)["line"] for k in range(span)]
    return F.transform(
        F.sequence(F.lit(0), F.size("l") - span),
        lambda i: F.struct(
            F.xxhash64(*key(i)).alias("h1"),
            F.xxhash64(F.lit("second"), *key(i)).alias("h2"),
            *[F.get("l", i + min(k, span - 1))["at"].alias(f"p{k}") for k in range(SPAN)],
            sum((F.get("l", i + k)["n"] for k in range(1, span)), F.get("l", i)["n"]).alias("n"),
        ),
    )


def _short_windows(docs: DataFrame, passage: int) -> DataFrame:
    """Windows of one and two lines: those of more than ``passage`` words, and whole texts of as few filled lines."""
    counted = F.transform(
        _filled(F.split("text", "\n")),
        lambda x: F.struct(
            x["at"].alias("at"),
            x["line"].alias("line"),
            F.size(F.filter(F.split(x["line"], _BLANK), lambda w: w != "")).alias("n"),
        ),
    )
    placed = docs.select("doc_id", "text_key", counted.alias("l"))
    found = [
        placed.where(F.size("l") >= span)
        .select("doc_id", "text_key", (F.size("l") == span).alias("whole"), F.inline(_windows(span)))
        .where(F.col("whole") | (F.col("n") > passage))
        .drop("whole", "n")
        for span in range(1, SPAN)
    ]
    return found[0].unionByName(found[1])


def repeated_windows(docs: DataFrame, passage: int | None = None) -> DataFrame:
    """(doc_id, text_key, positions): the lines of each row of ``docs(doc_id, text_key, text)`` to remove.

    Windows are stored and counted by partial sums. Those that hold over a thousandth of all
    places, so at most a thousand, get their first place by partial sums too, which goes to every
    task. All others are dealt once by their two 64-bit hashes; the count and the first place of
    each and the join back both use that dealing. Places of a window that came
    before are all but the first, in order of id, text and position. With ``passage``, the
    windows of ``_short_windows`` take part.
    """
    lines = _filled(F.split("text", "\n"))
    placed = docs.select("doc_id", "text_key", lines.alias("l")).where(F.size("l") >= SPAN)
    window = F.transform(
        F.sequence(F.lit(0), F.size("l") - SPAN),
        lambda i: F.struct(
            i.alias("at"),
            F.xxhash64(*[F.get("l", i + k)["line"] for k in range(SPAN)]).alias("h1"),
            F.xxhash64(F.lit("second"), *[F.get("l", i + k)["line"] for k in range(SPAN)]).alias("h2"),
            F.get("l", i)["at"].alias("p0"),
            F.get("l", i + 1)["at"].alias("p1"),
            F.get("l", i + 2)["at"].alias("p2"),
        ),
    )
    found = placed.select("doc_id", "text_key", F.inline(window)).drop("at")
    if passage is not None:
        found = found.unionByName(_short_windows(docs, passage))
    found = durable(found)
    place = F.struct("doc_id", "text_key", "p0", "p1", "p2")
    ends = [F.min(place).alias("first"), F.max(place).alias("last")]
    total = found.count()
    key = ["h1", "h2"]
    hot = F.broadcast(durable(found.groupBy(*key).agg(F.count("*").alias("n")).where(F.col("n") * HOT > total).drop("n")))
    hot_twice = durable(found.join(hot, key).groupBy(*key).agg(*ends).where("first < last").drop("last"))
    hot_later = found.join(F.broadcast(hot_twice), key)
    # All columns take part, so that both uses read one and the same exchange.
    dealt = found.join(hot, key, "left_anti").repartition(partitions(docs), *key)
    twice = dealt.groupBy(*key).agg(*ends).where("first < last").drop("last")
    later = dealt.join(twice, key).unionByName(hot_later).where(place > F.col("first"))
    return later.groupBy("doc_id", "text_key").agg(
        F.array_distinct(F.flatten(F.collect_list(F.array("p0", "p1", "p2")))).alias("positions")
    )


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", passage: int | None = None) -> DataFrame:
    """``docs`` without the lines of three-line windows that came before.

    A window is three consecutive lines that hold a word; blank lines don't count. Of the
    places of a window all but the first are covered, and the covered lines of a text
    are removed; lines, blank ones too, that no repeated window covers stay as they are.
    With ``passage``, one line or two consecutive ones of more than so many words are windows
    as well, and so are all lines of a text that holds only one or two. A passage that is
    part of a line stays.

    Returns doc_id, text (cleaned), n_lines and n_removed. Places are ordered by id, then by
    the text's hash, then by position; a null id comes first. Rows that are equal in id and text are one
    place and are cleaned alike. Null texts stay null; without ``passage`` texts of fewer than three
    lines that hold a word stay as they are; an empty table gives no rows. Other columns are ignored.
    """
    rows = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"), F.xxhash64(F.col(f"`{text_col}`")).alias("text_key")
    )
    # Merged at every size: a small list would be broadcast, and then the plan would change with the table.
    covered = durable(repeated_windows(rows, passage)).hint("merge")
    joined = rows.alias("r").join(
        covered.alias("c"),
        F.col("r.doc_id").eqNullSafe(F.col("c.doc_id")) & (F.col("r.text_key") == F.col("c.text_key")),
        "left",
    )
    split = joined.select(
        F.col("r.doc_id").alias("doc_id"),
        F.col("r.text").alias("text"),
        F.split("r.text", "\n").alias("lines"),
        "positions",
    )
    kept = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "positions")
    return split.select(
        "doc_id",
        F.when(F.col("positions").isNull(), F.col("text"))
        .otherwise(F.array_join(F.transform(kept, lambda i: F.get("lines", i)), "\n"))
        .alias("text"),
        F.greatest(F.size("lines"), F.lit(0)).cast("long").alias("n_lines"),
        F.greatest(F.size("positions"), F.lit(0)).cast("long").alias("n_removed"),
    )


@query(r"""
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS p FROM documents),
f AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY p) AS i FROM l WHERE length(translate(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '')) > 0),
w AS (SELECT a.doc_id, a.p AS p0, b.p AS p1, c.p AS p2, a.line || chr(10) || b.line || chr(10) || c.line AS k
      FROM f a JOIN f b ON a.doc_id = b.doc_id AND b.i = a.i + 1 JOIN f c ON a.doc_id = c.doc_id AND c.i = a.i + 2),
r AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id, p0) AS n FROM w),
x AS (SELECT DISTINCT doc_id, unnest([p0, p1, p2]) AS p FROM r WHERE n > 1),
kept AS (SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.p) FILTER (WHERE x.p IS NULL) AS text, count(*) AS n_lines, count(x.p) AS n_removed
         FROM l LEFT JOIN x ON l.doc_id = x.doc_id AND l.p = x.p GROUP BY l.doc_id)
SELECT doc_id, coalesce(text, '') AS text, n_lines, n_removed FROM kept
""")
def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without lines of repeated three-line windows."""
    return dedup_lines(table(spark, sf_dir, "documents"))


@extra
def passage_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without repeated windows, passages on one or two lines and short whole texts included."""
    return dedup_lines(table(spark, sf_dir, "documents"), passage=PASSAGE)
