"""Quality rules: robust multivariate outliers by minimum covariance determinants."""

from __future__ import annotations

from math import sqrt
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import durable
from .registry import query, table
from .words import spans, texts_of, windows, word_hashes

_SYMBOL = np.array([chr(b) in "#*$%&|<>" for b in range(256)])
_UPPER = np.array([chr(b).isupper() and b < 128 for b in range(256)])
_MARK = np.array([b < 128 and not chr(b).isalnum() and b > 32 for b in range(256)])
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_marks", "n_lines", "n_distinct"]


def text_counts(text: bytes | None) -> tuple[int, ...]:
    """The ``COUNTS`` of one whole text."""
    text = text or b""
    data = np.frombuffer(text, np.uint8)
    starts, ends = spans(data)
    n = len(starts)
    letters = np.count_nonzero((data & 0xC0) != 0x80)
    blanks = len(data) - int((ends - starts).sum())
    lines, seen, again = 0, set(), 0
    for line in text.split(b"\n"):
        if line.strip():
            lines += 1
            again += line in seen
            seen.add(line)
    hashes = word_hashes(text)
    found = windows(hashes, 5)
    repeated = 0
    if len(found):
        ordered = np.sort(found)
        twice = ordered[1:][ordered[1:] == ordered[:-1]]
        if len(twice):
            hit = np.isin(found, twice)
            covered = np.zeros(n, bool)
            for i in range(5):
                covered[i : i + len(hit)] |= hit
            repeated = int(covered.sum())
    return (
        n,
        letters - blanks,
        int(_SYMBOL[data].sum()),
        again,
        repeated,
        int(_UPPER[data].sum()),
        int(_MARK[data].sum()),
        lines,
        len(np.unique(hashes)),
    )


_COUNTS_TYPE = "struct<" + ",".join(f"{c}:bigint" for c in COUNTS) + ">"


def _counts(texts: pa.Array) -> pa.Array:
    rows = [text_counts(t) for t in texts_of(texts)]
    columns = list(zip(*rows, strict=True)) or [()] * len(COUNTS)
    return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], COUNTS)


def statistics(n: Column, chars: Column, upper: Column, marks: Column, lines: Column, distinct: Column) -> list[Column]:
    """Transformed statistics: logarithms of lengths and shares, damped for short texts."""
    log = lambda c: F.log(c.cast("double"))
    return [
        log(n + 1),
        log((chars + 20) / (n + 4)),
        log((marks + 3) / (chars + 60)),
        log((upper + 3) / (chars + 60)),
        log((n + 20) / (lines + 1)),
        log((distinct + 10) / (n + 10)),
    ]


def chi2_quantile(share: float, p: int) -> float:
    """The Wilson-Hilferty approximation."""
    z = NormalDist().inv_cdf(share)
    return p * (1 - 2 / (9 * p) + z * sqrt(2 / (9 * p))) ** 3


def _distance(xs: list[str], fit: str = "") -> Column:
    """Squared distance of a row's ``xs`` from its cell's centre under the cell's inverse covariance."""
    p = len(xs)
    away = [F.col(x) - F.get(f"{fit}centre", F.lit(i)) for i, x in enumerate(xs)]
    total = F.lit(0.0)
    for i in range(p):
        row = F.lit(0.0)
        for j in range(p):
            row = row + F.get(f"{fit}inverse", F.lit(i * p + j)) * away[j]
        total = total + away[i] * row
    return total


def _moments(xs: list[str]) -> list[Column]:
    p = len(xs)
    return [F.count(F.lit(1)).alias("n"), F.array(*[F.avg(x) for x in xs]).alias("means")] + [
        F.array(*[F.avg(F.col(xs[i]) * F.col(xs[j])) for i in range(p) for j in range(p)]).alias("squares")
    ]


def _inverted(cells: DataFrame, keys: str, p: int, floor: float) -> DataFrame:
    """Centre, inverse covariance and log determinant of each row of moments."""

    def invert(batches):
        for batch in batches:
            frame = batch.to_pandas()
            centres, inverses, sizes = [], [], []
            for means, squares in zip(frame["means"], frame["squares"], strict=True):
                mean = np.asarray(means, float)
                cov = np.asarray(squares, float).reshape(p, p) - np.outer(mean, mean) + floor * np.eye(p)
                centres.append(mean)
                inverses.append(np.linalg.inv(cov).ravel())
                sizes.append(float(np.linalg.slogdet(cov)[1]))
            out = frame[["cell", "start"]].assign(centre=centres, inverse=inverses, logdet=sizes)
            yield pa.RecordBatch.from_pandas(out, schema=schema, preserve_index=False)

    schema = pa.schema(
        [("cell", pa.string()), ("start", pa.int32()), ("centre", pa.list_(pa.float64())), ("inverse", pa.list_(pa.float64())), ("logdet", pa.float64())]
    )
    return cells.mapInArrow(invert, keys + ", centre array<double>, inverse array<double>, logdet double")


def robust_distances(
    rows: DataFrame, xs: list[str], core: float = 0.75, steps: int = 100, floor: float = 1e-4
) -> DataFrame:
    """Per cell of ``rows(cell, xs..)``: centre, inverse covariance and scale of the MCD.

    Two starts (medians with absolute deviations, and plain moments) are refined by
    concentration steps: keep the ``core`` share of the cell's rows that lie nearest, take
    their moments, repeat until the determinants fall no more (over ``steps`` steps raise an
    error); the start with the smaller determinant stays. A step is two aggregations over all rows, combined before they are
    shuffled, so a cell of any size costs no more than its rows; only one row per cell is
    shuffled. ``floor`` is added to the variances, so constant columns don't break it.
    The scale makes the cell's median squared distance that of a normal sample. The core's
    edge is Spark's approximate percentile (rank error at most 1 in 10,000).
    """
    p, keys = len(xs), "cell string, start int"
    medians = rows.groupBy("cell").agg(*[F.percentile_approx(x, 0.5).alias(f"m_{x}") for x in xs])
    away = rows.join(durable(medians), "cell")
    spread = away.groupBy("cell").agg(
        *[F.first(f"m_{x}").alias(f"m_{x}") for x in xs],
        *[F.percentile_approx(F.abs(F.col(x) - F.col(f"m_{x}")), 0.5).alias(f"s_{x}") for x in xs],
    )
    deviation = [1.4826 * F.col(f"s_{x}") for x in xs]
    first = spread.select(
        "cell",
        F.lit(0).alias("start"),
        F.array(*[F.col(f"m_{x}") for x in xs]).alias("means"),
        F.array(
            *[
                F.col(f"m_{xs[i]}") * F.col(f"m_{xs[j]}") + (deviation[i] * deviation[i] if i == j else F.lit(0.0))
                for i in range(p)
                for j in range(p)
            ]
        ).alias("squares"),
    )
    second = rows.groupBy("cell").agg(*_moments(xs)).select("cell", F.lit(1).alias("start"), "means", "squares")
    fits = durable(_inverted(first.unionByName(second), keys, p, floor))
    both = rows.withColumn("start", F.explode(F.array(F.lit(0), F.lit(1))))
    last = None
    for _ in range(steps):
        near = both.join(fits, ["cell", "start"]).select("cell", "start", *xs, _distance(xs).alias("d2"))
        edges = durable(near.groupBy("cell", "start").agg(F.percentile_approx("d2", core, 10_000).alias("edge")))
        inner = near.join(edges, ["cell", "start"]).where(F.col("d2") <= F.col("edge"))
        moments = inner.groupBy("cell", "start").agg(*_moments(xs))
        fits = durable(_inverted(moments.select("cell", "start", "means", "squares"), keys, p, floor))
        now = fits.agg(F.sum("logdet")).first()[0]
        if now is None or last is not None and last - now <= 1e-6 * max(1.0, abs(now)):
            break
        last = now
    else:
        raise RuntimeError(f"determinants still fall after {steps} steps")
    best = durable(
        fits.groupBy("cell").agg(F.min(F.struct("logdet", "start", "centre", "inverse")).alias("f")).select("cell", "f.centre", "f.inverse")
    )
    near = rows.join(best, "cell").select("cell", _distance(xs).alias("d2"))
    scale = near.groupBy("cell").agg((F.percentile_approx("d2", 0.5, 10_000) / chi2_quantile(0.5, p)).alias("scale"))
    return durable(best.join(scale, "cell"))


def reject_outliers(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    min_words: int = 10,
    least: int = 120,
    tail: float = 1e-9,
    slack: float = 3.0,
    cores: tuple[float, ...] = (0.75, 0.5),
) -> DataFrame:
    """Counts of every whole text, whether the plain rules fail it, and whether it is kept.

    Each (language, source) with ``least`` different vectors of statistics or more is a
    cell with estimates of its own; the rows of smaller ones share their language's cell,
    or else that of the table. Equal vectors count once in the estimates, so copies of a
    text can't set them, however many; all rows are judged.
    Cells are fitted with each of ``cores``, and the greater distance counts: half of the rows
    stand against up to nearly half of alike outliers, three quarters against a tight group of fewer.
    Base-failed rows take no part in the estimates. A row is rejected if its squared robust
    distance is over ``slack`` times the chi-squared quantile of ``1 - tail``: the
    statistics are only roughly normal, and clean documents are to stay.

    Returns doc_id, ``COUNTS``, base_failed, distance (null where base-failed or where no
    cell has ``least`` vectors) and kept. Null and empty texts have no words and fail the base; a null
    language or source is a value of its own; repeated rows are judged alike, and so are rows
    of equal distance: the one at the cut is kept, those at a core's edge are all in it. Texts of
    any length are counted whole; an empty table gives no rows. Other columns are ignored.
    """
    counted = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        F.col(f"`{lang_col}`").cast("string").alias("lang"),
        F.col(f"`{source_col}`").cast("string").alias("source"),
        F.arrow_udf(_counts, _COUNTS_TYPE).asNondeterministic()(F.col(f"`{text_col}`")).alias("c"),
    )
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    xs = [f"x{i}" for i in range(6)]
    stats = statistics(*[F.col(c) for c in ("n_words", "word_chars", "n_upper", "n_marks", "n_lines", "n_distinct")])
    rows = durable(
        counted.select("doc_id", "lang", "source", "c.*")
        .withColumn("base_failed", failed)
        .select("*", *[s.alias(x) for s, x in zip(stats, xs, strict=True)])
    )
    judged = rows.where(~F.col("base_failed"))
    vectors = durable(judged.select("lang", "source", *xs).distinct())
    in_lang = durable(vectors.select("lang", *xs).distinct())
    sizes = vectors.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"))
    by_lang = in_lang.groupBy("lang").agg(F.count(F.lit(1)).alias("n_lang"))
    name = lambda *cols: F.to_json(F.struct(*cols))
    cells = (
        sizes.alias("s")
        .join(by_lang.alias("l"), F.col("s.lang").eqNullSafe(F.col("l.lang")))
        .select(
            F.col("s.lang").alias("of_lang"),
            F.col("s.source").alias("of_source"),
            F.when(F.col("n") >= least, name(F.lit(2).alias("level"), F.col("s.lang"), F.col("s.source")))
            .when(F.col("n_lang") >= least, name(F.lit(1).alias("level"), F.col("s.lang")))
            .otherwise(name(F.lit(0).alias("level")))
            .alias("cell"),
        )
    )
    cells = durable(cells)
    of_cell = F.col("lang").eqNullSafe(F.col("of_lang")) & F.col("source").eqNullSafe(F.col("of_source"))
    celled = durable(judged.join(cells, of_cell).select("doc_id", "cell", *COUNTS, *xs))
    # A shared cell is fitted on all vectors of its language, not only on those of small sources.
    wide = durable(cells.select("cell").distinct().where(~F.col("cell").startswith('{"level":2')))
    whole = in_lang.select(name(F.lit(1).alias("level"), F.col("lang")).alias("cell"), *xs).unionByName(
        in_lang.select(*xs).distinct().select(name(F.lit(0).alias("level")).alias("cell"), *xs)
    )
    own = vectors.join(cells.where(F.col("cell").startswith('{"level":2')), of_cell).select("cell", *xs)
    fitted = own.unionByName(whole.join(wide, "cell", "left_semi"))
    big = fitted.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least).select("cell")
    fitted = durable(fitted.join(durable(big), "cell", "left_semi"))
    fits, distances = None, []
    for i, core in enumerate(cores):
        fit = robust_distances(fitted, xs, core).select("cell", F.struct("centre", "inverse", "scale").alias(f"f{i}"))
        fits = fit if fits is None else fits.join(fit, "cell")
        distances.append(_distance(xs, f"f{i}.") / F.greatest(F.col(f"f{i}.scale"), F.lit(1e-12)))
    distance = F.greatest(*distances) if len(distances) > 1 else distances[0]
    cut = slack * chi2_quantile(1 - tail, len(xs))
    kept = celled.join(fits, "cell", "left").select("doc_id", *COUNTS, distance.alias("distance"))
    out = kept.select("doc_id", *COUNTS, F.lit(False).alias("base_failed"), "distance")
    out = out.unionByName(
        rows.where("base_failed").select("doc_id", *COUNTS, "base_failed", F.lit(None).cast("double").alias("distance"))
    )
    return out.withColumn("kept", ~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= cut))


@query()
def op5_robust_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts, base verdict and the robust verdict of every document."""
    judged = reject_outliers(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", *COUNTS[:5], "base_failed", "kept", "distance")
