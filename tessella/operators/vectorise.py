"""Tokens, vocabularies and TF-IDF weights.

Counting and weighting happen inside the task that holds the text (`terms`), so the only
shuffle over a corpus is the partially aggregated term table. A filter placed on a computed
array would be pushed below it and evaluate it again; arrays are therefore opened with
the outer form of explode and filtered afterwards.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import StructField, StructType

from ..functions import text as text_functions
from ..rules import STOP_WORDS
from ..session import durable, scratch_path
from .terms import Pairs, Places, batch_stats, most_used, weigh, weigh_grouped

# Vocabularies of up to this many terms are held on the driver and sent to every task.
MAX_TERMS = 1 << 20
MIN_SALTS = 64
_MARK = "\x01"  # between a group and a term


def tokenize(
    df: DataFrame, col: str, stop_words: Sequence[str] = STOP_WORDS, out: str = "tokens"
) -> DataFrame:
    """Add the words of a text; a missing text has none."""
    return df.withColumn(
        out, text_functions.tokens(F.coalesce(F.col(col), F.lit("")), stop_words)
    )


def ngrams_1_2(df: DataFrame, col: str = "tokens", out: str = "terms") -> DataFrame:
    """Add single words and adjacent pairs as one list."""
    return df.withColumn(out, text_functions.with_bigrams(F.col(col)))


def term_counts(df: DataFrame, ids: Sequence[str], col: str = "terms") -> DataFrame:
    """``(ids.., term, tf)``: runs of the sorted terms, without a shuffle."""
    ordered = df.select(*ids, F.sort_array(col).alias("_s"))
    starts = ordered.withColumn(
        "_starts",
        F.filter(
            F.transform("_s", lambda t, i: F.when((i == 0) | (t != F.get("_s", i - 1)), i)),
            lambda i: i.isNotNull(),
        ),
    )
    runs = F.transform(
        "_starts",
        lambda i, j: F.struct(
            F.get("_s", i).alias("term"),
            (F.coalesce(F.get("_starts", j + 1), F.size("_s")) - i).alias("tf"),
        ),
    )
    return starts.select(*ids, F.inline_outer(runs)).where("term is not null")


def vocabulary(
    counts: DataFrame,
    n_docs: int | Column,
    min_df: int = 5,
    max_df: float = 0.6,
    size: int | None = 6000,
) -> DataFrame:
    """``(term, df, tf)``: terms within the document-frequency limits, most used first.

    Ties go to the term that sorts first.
    """
    stats = counts.groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("tf"))
    return _limited(stats, n_docs, min_df, max_df, size)


def _limited(
    stats: DataFrame, n_docs: int | Column, min_df: int, max_df: float, size: int | None
) -> DataFrame:
    n = F.lit(n_docs) if isinstance(n_docs, int) else n_docs
    kept = stats.where((F.col("df") >= min_df) & (F.col("df") <= n * max_df))
    return kept if size is None else kept.orderBy(F.desc("tf"), "term").limit(size)


def term_stats(
    df: DataFrame, col: str = "terms", group: str | None = None, pairs: bool = False
) -> DataFrame:
    """``(term, df, tf)`` of the terms of all rows, or ``(group, term, df, tf)``.

    Tasks sum whole batches, and Spark the sums of the batches. With ``pairs`` the column holds
    words of `tokenize`, and the terms are those of `ngrams_1_2`.
    """
    key = F.col(group) if group else F.lit(0)
    rows = df.select(key.alias("group"), F.col(col).alias("terms"))
    kind = rows.schema["group"].dataType.simpleString()
    parts = rows.mapInArrow(functools.partial(batch_stats, pairs=pairs), f"group {kind}, term string, df bigint, tf bigint")
    by = [F.col("group").alias(group), "term"] if group else ["term"]
    return parts.groupBy(*by).agg(F.sum("df").alias("df"), F.sum("tf").alias("tf"))


def pair_stats(
    df: DataFrame, col: str, group: str | None = None, size: int | None = None, min_df: int = 1, max_df: float | None = None
) -> DataFrame:
    """`term_stats` of words and their pairs, without those that can't be among the ``size`` most used.

    Only terms in at least ``min_df`` and at most ``max_df`` rows compete. The words come first: a pair
    comes no more often, and in no more rows, than either of its words. So no pair of a word rarer than the
    ``size``-th of the words that compete is counted, and pairs are summed and shuffled as numbers.
    The words that are left go to every task; beyond `MAX_TERMS` of them all terms are counted.
    """
    rows = df.select((F.col(group) if group else F.lit(0)).alias("group"), F.col(col).alias("terms"))
    words = durable(term_stats(rows, "terms", "group"))
    left = words.where(F.col("df") >= min_df)
    if size is not None:
        fit = left if max_df is None else left.where(F.col("df") <= max_df)
        first = _most_used(fit, "group", size).groupBy(F.col("group").alias("of"))
        least = first.agg(F.count("*").alias("n"), F.min("tf").alias("least")).where(F.col("n") >= size)
        bound = F.coalesce("least", F.lit(0).cast("long"))
        left = left.join(F.broadcast(least), F.col("group").eqNullSafe(F.col("of")), "left")
        left = left.where(F.col("tf") >= bound).select(*words.columns, bound.alias("least"))
    else:
        left = left.withColumn("least", F.lit(0).cast("long"))
    left = durable(left)
    by = [F.col("group").alias(group)] if group else []
    held = left.select("group", "term", "least").limit(MAX_TERMS + 1).toArrow()
    if held.num_rows > MAX_TERMS:
        return term_stats(rows, "terms", "group", pairs=True).select(*by, "term", "df", "tf")
    pairs, kind = Pairs(held), rows.schema["group"].dataType.simpleString()
    counts = rows.mapInArrow(lambda batches: pairs.counted(batches), "pair bigint, df bigint, tf bigint")
    sums = counts.groupBy("pair").agg(F.sum("df").alias("df"), F.sum("tf").alias("tf"))
    named = sums.where(F.col("df") >= min_df).mapInArrow(
        lambda batches: pairs.named(batches), f"group {kind}, term string, df bigint, tf bigint"
    )
    return left.drop("least").unionByName(named).select(*by, "term", "df", "tf")


def doc_frequency_audit(
    df: DataFrame, id_col: str, col: str = "tokens", min_df: int = 5
) -> DataFrame:
    """``(term, df)`` of the terms a ``min_df`` cut would drop."""
    terms = df.select(id_col, F.explode_outer(F.array_distinct(col)).alias("term"))
    counts = terms.where("term is not null").groupBy("term").agg(F.count("*").alias("df"))
    return counts.where(F.col("df") < min_df)


def smooth_idf(n_docs: Column, df: Column) -> Column:
    """ln((1 + n) / (1 + df)) + 1."""
    return F.log((1 + n_docs) / (1 + df)) + 1


@dataclass(frozen=True)
class TfidfModel:
    """A fitted vocabulary with its idf weights, terms in alphabetical order."""

    terms: list[str]
    idf: list[float]
    sublinear: bool = True

    def transform(
        self, df: DataFrame, col: str = "terms", out: str = "tfidf", pairs: bool = False
    ) -> DataFrame:
        """Add the L2-normalised weights as ``struct<type,size,indices,values>``.

        Everything happens within the row: no join, no shuffle. `as_vectors` turns
        the structs into ML vectors.
        """
        terms, idf, sublinear = Places(pa.array(self.terms, pa.string()), pairs), np.array(self.idf, float), self.sublinear

        def weighted(lists: pa.Array) -> pa.Array:
            return weigh(lists, terms, idf, sublinear)

        kind = "struct<type:tinyint,size:int,indices:array<int>,values:array<double>>"
        return df.withColumn(out, F.arrow_udf(weighted, kind).asNondeterministic()(col))


@dataclass(frozen=True)
class TermTable:
    """A fitted vocabulary of any size as a stored table ``(term, code, idf)``.

    Nothing of it is held on the driver: weights are joined on the term, by a shuffle whatever
    the size of the compressed files, and collected per row. Codes count the terms in alphabetical order.
    """

    vocab: DataFrame
    size: int
    sublinear: bool = True

    def transform(
        self, df: DataFrame, col: str = "terms", out: str = "tfidf", key: str = "id", pairs: bool = False
    ) -> DataFrame:
        """Add the L2-normalised weights, as `TfidfModel` does, to rows with a unique ``key``."""
        raw = (1 + F.log("tf") if self.sublinear else F.col("tf")) * F.col("idf")
        pairs = (
            term_counts(ngrams_1_2(df, col, "_grams"), [key], "_grams" if pairs else col)
            .join(self.vocab.hint("merge"), "term")
            .select(key, F.struct("code", raw.cast("double").alias("w")).alias("pair"))
            .groupBy(key)
            .agg(F.sort_array(F.collect_list("pair")).alias("_pairs"))
        )
        squares = F.aggregate("_pairs", F.lit(0.0), lambda acc, p: acc + p["w"] * p["w"])
        norms = F.array_repeat(F.sqrt(squares), F.size("_pairs"))
        none = F.array().cast("array<struct<code:int,w:double>>")
        joined = df.join(pairs, key, "left").withColumn("_pairs", F.coalesce("_pairs", none))
        return joined.withColumn(
            out,
            F.struct(
                F.lit(0).cast("tinyint").alias("type"),
                F.lit(self.size).alias("size"),
                F.transform("_pairs", lambda p: p["code"]).alias("indices"),
                F.zip_with("_pairs", norms, lambda p, n: p["w"] / n).alias("values"),
            ),
        ).drop("_pairs")


def numbered(df: DataFrame, col: str, out: str = "code") -> DataFrame:
    """Add 0, 1, .. in the order of ``col``, whose values differ.

    Ranges are numbered on their own and start where the one before ends, so no task
    sorts the whole.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = durable(df.repartitionByRange(parts, col).withColumn("_part", F.spark_partition_id()))
    counts = dict(dealt.groupBy("_part").agg(F.count("*")).collect())
    starts = [sum(counts.get(p, 0) for p in range(i)) for i in range(max(counts, default=0) + 1)]
    start = F.get(F.array(*[F.lit(s) for s in starts]), F.col("_part"))
    inside = Window.partitionBy("_part").orderBy(col)
    return dealt.withColumn(out, (F.row_number().over(inside) - 1 + start).cast("int")).drop("_part")


def fit_tfidf(
    df: DataFrame,
    col: str = "terms",
    min_df: int = 5,
    max_df: float = 0.6,
    size: int | None = 6000,
    sublinear: bool = True,
    pairs: bool = False,
) -> TfidfModel | TermTable:
    """Fit vocabulary and idf.

    A vocabulary of a given ``size`` of up to `MAX_TERMS` is held on the driver and applied
    inside the row; without a size, or with a larger one, it stays a table. With ``pairs``
    the column holds words, and the terms are these and their pairs.
    """
    n_docs = df.count()
    stats = pair_stats(df, col, None, size, min_df, n_docs * max_df) if pairs else term_stats(df, col)
    vocab = _limited(stats, n_docs, min_df, max_df, size)
    fitted = vocab.select("term", smooth_idf(F.lit(n_docs), F.col("df")).alias("idf"))
    if size is None or size > MAX_TERMS:
        stored = durable(numbered(fitted, "term"))
        return TermTable(stored, max(1, stored.count()), sublinear)
    rows = sorted(fitted.collect(), key=lambda r: r.term.encode())
    return TfidfModel([r.term for r in rows], [r.idf for r in rows], sublinear)


def tfidf_transform(
    df: DataFrame, id_col: str, model: TfidfModel, col: str = "terms"
) -> DataFrame:
    """``(id, term, weight)`` of rows under a fitted model; unseen terms are ignored."""
    names = F.split(F.lit("\n".join(model.terms)), "\n")
    weighted = model.transform(df.select(id_col, col), col)
    pairs = F.zip_with(
        F.col("tfidf.indices"),
        F.col("tfidf.values"),
        lambda i, w: F.struct(F.get(names, i).alias("term"), w.alias("weight")),
    )
    return weighted.select(id_col, F.inline_outer(pairs)).where("term is not null")


def tfidf(df: DataFrame, id_col: str, col: str = "terms", **settings) -> DataFrame:
    """Fit on the rows and return their weights as ``(id, term, weight)``."""
    return tfidf_transform(df, id_col, fit_tfidf(df, col, **settings), col)


def top_per_group(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int, spread_by: str
) -> DataFrame:
    """First ``n`` rows per group, exactly, without any group passing through one task whole.

    Small ``n``: Spark limits each group before the shuffle, up to the session's own
    threshold. Larger ``n``: each group is first cut to ``n`` rows within every salt, and
    only the survivors meet.
    """
    conf = df.sparkSession.conf
    if n > int(conf.get("spark.sql.optimizer.windowGroupLimitThreshold")):
        salts = max(MIN_SALTS, int(conf.get("spark.sql.shuffle.partitions")))
        salted = df.withColumn("_salt", F.pmod(F.xxhash64(spread_by), F.lit(salts)))
        part = Window.partitionBy(*group, "_salt").orderBy(*order)
        df = (
            salted.withColumn("_rank", F.row_number().over(part))
            .where(F.col("_rank") <= n)
            .drop("_rank", "_salt")
        )
    whole = Window.partitionBy(*group).orderBy(*order)
    ranked = df.withColumn("_rank", F.row_number().over(whole))
    return ranked.where(F.col("_rank") <= n).drop("_rank")


def per_group_vocabulary(
    counts: DataFrame, sizes: DataFrame, group: str, size: int = 5000
) -> DataFrame:
    """``(group, term, idf)``: the ``size`` most used terms of every group, one job for all.

    ``sizes`` holds ``(group, n_docs)``.
    """
    stats = counts.groupBy(group, "term").agg(F.count("*").alias("df"), F.sum("tf").alias("tf"))
    return top_vocabulary(stats, sizes, group, size)


def top_vocabulary(stats: DataFrame, sizes: DataFrame, group: str, size: int) -> DataFrame:
    """The same of ``stats`` ``(group, term, df, tf)``: each task keeps its own first terms, and only these meet."""
    return _most_used(stats, group, size).join(sizes, group).select(
        group, "term", smooth_idf(F.col("n_docs"), F.col("df")).alias("idf")
    )


def _most_used(stats: DataFrame, group: str, size: int) -> DataFrame:
    rows = stats.select(F.col(group).alias("group"), "term", "df", "tf")
    kind = rows.schema["group"].dataType.simpleString()
    own = rows.mapInArrow(
        lambda batches: most_used(batches, size), f"group {kind}, term string, df bigint, tf bigint"
    ).withColumnRenamed("group", group)
    return top_per_group(own, [group], [F.desc("tf"), F.col("term")], size, "term")


def weigh_per_group(
    df: DataFrame, vocab: DataFrame, group: str, col: str = "terms", out: str = "weights", pairs: bool = False
) -> DataFrame:
    """Add ``array<struct<term,weight>>``: plain tf times the group's idf, L2-normalised.

    The groups' vocabularies, of a bounded size each, are held as one whose terms begin
    with the group; everything happens within the row. Beyond `MAX_TERMS` in all they are
    joined on the term and collected per row.
    """
    key = F.concat(F.coalesce(F.col(group).cast("string"), F.lit("")), F.lit(_MARK), "term")
    rows = vocab.select(key.alias("key"), "idf").limit(MAX_TERMS + 1).collect()
    if len(rows) > MAX_TERMS:
        if pairs:
            grams = ngrams_1_2(df, col, "_grams")
            return _weigh_by_join(grams, vocab, group, "_grams", out).drop("_grams")
        return _weigh_by_join(df, vocab, group, col, out)
    parts = [r.key.split(_MARK, 1) for r in rows]
    groups, terms = ({x: i for i, x in enumerate(sorted({p[j] for p in parts}, key=str.encode))} for j in (0, 1))
    keys = np.array([groups[g] * len(terms) + t for g, t in ((g, terms[t]) for g, t in parts)], np.int64)
    order = np.argsort(keys)
    terms = pa.array(list(terms), pa.string())
    held = (
        pa.array(list(groups), pa.string()), terms, Places(terms, pairs),
        keys[order], np.array([r.idf for r in rows], float)[order],
    )

    def weighted(named: pa.Array, lists: pa.Array) -> pa.Array:
        return weigh_grouped(named, lists, *held)

    udf = F.arrow_udf(weighted, "array<struct<term:string,weight:double>>").asNondeterministic()
    return df.withColumn(out, udf(F.coalesce(F.col(group).cast("string"), F.lit("")), F.col(col)))


def _weigh_by_join(
    df: DataFrame, vocab: DataFrame, group: str, col: str, out: str
) -> DataFrame:
    """The same for vocabularies too large to hold: the rows are numbered and stored first."""
    stored = durable(df.withColumn("_row", F.monotonically_increasing_id()))
    raw = term_counts(stored, ["_row", group], col).join(vocab, [group, "term"])
    pair = F.struct("term", (F.col("tf") * F.col("idf")).alias("w"))
    pairs = raw.groupBy("_row").agg(F.collect_list(pair).alias("_pairs"))
    squares = F.aggregate("_pairs", F.lit(0.0), lambda acc, p: acc + p["w"] * p["w"])
    norms = F.array_repeat(F.sqrt(squares), F.size("_pairs"))
    weighted = F.zip_with(
        "_pairs", norms, lambda p, n: F.struct(p["term"].alias("term"), (p["w"] / n).alias("weight"))
    )
    none = F.array().cast("array<struct<term:string,weight:double>>")
    joined = stored.join(pairs, "_row", "left")
    return joined.withColumn(out, F.coalesce(weighted, none)).drop("_row", "_pairs")


def per_group_tfidf(
    df: DataFrame, vocab: DataFrame, group: str, id_col: str, col: str = "terms", pairs: bool = False
) -> DataFrame:
    """``(group, id, term, weight)``: plain tf times the group's idf, L2-normalised per row."""
    weighted = weigh_per_group(df, vocab, group, col, pairs=pairs)
    return weighted.select(group, id_col, F.inline_outer("weights")).where("term is not null")


@dataclass(frozen=True)
class StandardiseModel:
    """Means and population deviations of numeric columns."""

    means: dict[str, float]
    deviations: dict[str, float]

    def transform(self, df: DataFrame) -> DataFrame:
        scaled = {
            c: (F.col(c) - mean) / (self.deviations[c] or 1.0) for c, mean in self.means.items()
        }
        return df.withColumns(scaled)


def standardise(train: DataFrame, cols: Sequence[str]) -> StandardiseModel:
    """Fit (x - mean) / population deviation; a constant column is only centred."""
    row = train.agg(
        *[F.avg(c).alias(f"m_{c}") for c in cols], *[F.stddev_pop(c).alias(f"s_{c}") for c in cols]
    ).first()
    return StandardiseModel({c: row[f"m_{c}"] for c in cols}, {c: row[f"s_{c}"] for c in cols})


def as_vectors(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Write ``df`` to the scratch folder and read the weight structs back as ML vectors.

    A vector column is stored as exactly that struct, so no conversion code runs, and
    the learners iterate over a compact table instead of the texts.
    """
    path = scratch_path(df.sparkSession)
    df.write.parquet(path)
    schema = StructType(
        [StructField(f.name, VectorUDT() if f.name in cols else f.dataType) for f in df.schema]
    )
    return df.sparkSession.read.schema(schema).parquet(path)


def assemble(df: DataFrame, cols: Sequence[str], out: str = "features") -> DataFrame:
    """Append columns and vectors into one vector."""
    return VectorAssembler(inputCols=list(cols), outputCol=out).transform(df)


def append_values(df: DataFrame, cols: Sequence[str], col: str = "tfidf", out: str = "features") -> DataFrame:
    """Append numeric columns to a weight struct, as a struct once more; nulls and repeated places raise an error.

    `assemble` describes every place of a vector in the column's metadata, which the driver
    holds; here only the width is known, so a vocabulary may have any size.
    """
    def value(c: str) -> Column:
        return F.coalesce(F.col(c).cast("double"), F.raise_error(F.lit(f"{c} is null")).cast("double"))

    given = F.array(*[F.struct(F.lit(i).alias("at"), value(c).alias("w")) for i, c in enumerate(cols)])
    filled = F.filter(given, lambda x: x["w"] != 0)
    size, places = F.col(f"{col}.size"), F.col(f"{col}.indices")
    twice = F.raise_error(F.lit("a place comes twice in a row: its key is not unique")).cast("array<int>")
    places = F.when(F.size(F.array_distinct(places)) < F.size(places), twice).otherwise(places)
    return df.withColumn(
        out,
        F.struct(
            F.lit(0).cast("tinyint").alias("type"),
            (size + len(cols)).cast("int").alias("size"),
            F.concat(places, F.transform(filled, lambda x: (x["at"] + size).cast("int"))).alias("indices"),
            F.concat(F.col(f"{col}.values"), F.transform(filled, lambda x: x["w"])).alias("values"),
        ),
    )
