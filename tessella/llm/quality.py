"""Quality classifier: nearest-neighbour voting in a latent semantic space."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .registry import query, table
from .words import texts_of, windows, word_hashes

#: Term families of a text's vector: (first column, end, weight).
LETTERS, SHAPES, REPEATS, LENGTHS = (0, 1024, 0.6), (1024, 2048, 1.0), (2048, 2050, 1.0), (2050, 2066, 0.7)
BINS = LENGTHS[1]

# Letters, capitals and digits are one class each; every mark and blank is its own.
_CLASS = np.array([97 if b >= 128 or chr(b).islower() else 65 if chr(b).isupper() else 48 if chr(b).isdigit() else b for b in range(256)])


def _hashed(codes: np.ndarray) -> np.ndarray:
    """Hashed counts of the trigrams of a sequence."""
    if len(codes) < 3:
        return np.zeros(1024, np.float32)
    codes = codes.astype(np.uint32)
    mixed = codes[:-2] * np.uint32(0x9E3779B1) + codes[1:-1] * np.uint32(0x85EBCA77) + codes[2:] * np.uint32(0xC2B2AE3D)
    return np.bincount(mixed >> np.uint32(22), minlength=1024).astype(np.float32)


def term_counts(text: bytes | None) -> np.ndarray:
    """Term counts of a whole text: byte trigrams, trigrams of its shape, repetition and length.

    The shape keeps marks and blanks and one sign for each run of letters, capitals or
    digits, so it is alike in all languages. Repetition is the share of words in five-word windows
    found before; length is the logarithm of the number of words, spread over two columns.
    """
    data = np.frombuffer(text or b"", np.uint8)
    out = np.zeros(BINS, np.float32)
    words = word_hashes(text or b"")
    if not len(words):
        return out
    out[LETTERS[0] : LETTERS[1]] = _hashed(data)
    kinds = _CLASS[data]
    keep = np.r_[True, (kinds[1:] != kinds[:-1]) | (kinds[1:] < 48)]
    out[SHAPES[0] : SHAPES[1]] = _hashed(kinds[keep])
    found = windows(words, min(5, len(words)))
    again = 1 - len(np.unique(found)) / len(found)
    out[REPEATS[0] : REPEATS[1]] = again, 1 - again
    at = min(np.log2(len(words)), 14.999)
    out[LENGTHS[0] + int(at)], out[LENGTHS[0] + int(at) + 1] = 1 - at % 1, at % 1
    return out


def _weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Terms weighted as usual, each family scaled to its weight."""
    parts = []
    for first, end, weight in (LETTERS, SHAPES, REPEATS, LENGTHS):
        part = counts[:, first:end]
        if end <= len(idf):
            part = np.log1p(part) * idf[first:end]
        size = np.linalg.norm(part, axis=1, keepdims=True)
        parts.append(weight * np.divide(part, size, out=np.zeros_like(part), where=size > 0))
    return np.concatenate(parts, 1)


@dataclass
class Neighbours:
    """Labelled documents as unit vectors in a latent semantic space."""

    idf: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    prior: float
    k: int
    power: int = 16

    def embed(self, counts: np.ndarray) -> np.ndarray:
        latent = _weighted(counts, self.idf) @ self.axes
        size = np.linalg.norm(latent, axis=1, keepdims=True)
        return np.divide(latent, size, out=np.zeros_like(latent), where=size > 0)

    def score(self, counts: np.ndarray) -> np.ndarray:
        """Mean label of the nearest vectors, weighted by a power of the cosine; the prior where none is similar."""
        if not len(self.labels):
            return np.full(len(counts), self.prior)
        cosines = self.embed(counts) @ self.vectors.T
        k = min(self.k, len(self.labels))
        nearest = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
        weight = np.clip(np.take_along_axis(cosines, nearest, 1), 0, None).astype(np.float64) ** self.power
        total = weight.sum(1)
        voted = (weight * self.labels[nearest]).sum(1)
        return np.where(total > 0, voted / np.where(total > 0, total, 1), self.prior).clip(0, 1)


def latent_axes(matrix: np.ndarray, rank: int, rounds: int = 4) -> np.ndarray:
    """Leading right singular vectors by randomised subspace iteration."""
    rank = min(rank, *matrix.shape)
    basis = np.random.default_rng(7).standard_normal((matrix.shape[1], min(rank + 10, min(matrix.shape)))).astype(np.float32)
    for _ in range(rounds):
        basis, _ = np.linalg.qr(matrix.T @ (matrix @ basis))
    _, _, right = np.linalg.svd(matrix @ basis, full_matrices=False)
    return (basis @ right.T)[:, :rank].astype(np.float32)


def _features(texts: pa.Array) -> pa.Array:
    return pa.array([term_counts(t).tobytes() for t in texts_of(texts)], pa.binary())


def held_out(id_col: Column) -> Column:
    """Whether a row is kept from training: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit_neighbours(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    per_class: int = 2048,
    rank: int = 64,
    k: int = 15,
) -> Neighbours:
    """Fit on up to ``per_class`` labelled rows of each side, drawn by a hash of the id.

    The bound is a parameter of the model; it keeps what comes to the driver and what is
    broadcast at most ``2 * per_class`` rows whatever the table's size. Held-out rows are
    never used. Rows with a null id or label are left out; an id labelled several times
    has its mean label; without labelled rows every score is the prior, 0.5.
    """
    labelled = (
        labels.where(F.col(f"`{label_col}`").isNotNull() & F.col(f"`{id_col}`").isNotNull() & ~held_out(F.col(f"`{id_col}`")))
        .groupBy(F.col(f"`{id_col}`").alias("labelled_id"))
        .agg(F.avg(f"`{label_col}`").alias("label"))
    )
    good = F.col("label") >= 0.5
    n, high = labelled.agg(F.count(F.lit(1)), F.count(F.when(good, 1))).first()
    prior = high / n if n else 0.5
    drawn = [
        labelled.where(side).orderBy(F.xxhash64("labelled_id"), "labelled_id").limit(per_class) for side in (good, ~good)
    ]
    some = F.broadcast(drawn[0].unionByName(drawn[1]))  # at most 2 * per_class rows
    found = (
        docs.select(F.col(f"`{id_col}`").alias("labelled_id"), F.col(f"`{text_col}`").alias("text"))
        .join(some, "labelled_id")
        .groupBy("labelled_id", "label")
        .agg(F.max("text").alias("text"))
        .select("labelled_id", "label", F.arrow_udf(_features, "binary")("text").alias("counts"))
        .orderBy("labelled_id")
        .toArrow()
    )
    if not found.num_rows:
        return Neighbours(np.ones(SHAPES[1], np.float32), np.eye(BINS, 1, dtype=np.float32), np.zeros((0, 1), np.float32), np.zeros(0), prior, k)
    counts = np.frombuffer(b"".join(found["counts"].to_pylist()), np.float32).reshape(-1, BINS)
    idf = (np.log((1 + len(counts)) / (1 + (counts[:, : SHAPES[1]] > 0).sum(0))) + 1).astype(np.float32)
    axes = latent_axes(_weighted(counts, idf), rank)
    model = Neighbours(idf, axes, np.zeros((0, 1), np.float32), np.asarray(found["label"], float), prior, k)
    model.vectors = model.embed(counts)
    return model


def score_texts(spark: SparkSession, model: Neighbours, text: Column, block: int = 256) -> Column:
    """The score of each text: products with all labelled vectors, ``block`` texts at a time."""
    shared = spark.sparkContext.broadcast(vars(model))

    def score(texts: pa.Array) -> pa.Array:
        out, voters = [], Neighbours(**shared.value)
        for at in range(0, len(texts), block):
            part = texts_of(texts.slice(at, block))
            out.append(voters.score(np.stack([term_counts(t) for t in part])))
        return pa.array(np.concatenate(out) if out else np.zeros(0), pa.float64())

    return F.arrow_udf(score, "double").asNondeterministic()(text)  # so that a filter on the score doesn't compute it twice


def classify_quality(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = 0.3,
    score_col: str = "score",
    **options: int,
) -> DataFrame:
    """``docs`` with ``score_col``: the likelihood of quality label 1, from the text alone.

    Every whole text is compared with every labelled vector. Null, empty and very short texts
    have no vector and score the share of good labels. All columns of ``docs`` stay (one that is
    named like the score is replaced); repeated rows score alike; an empty table stays
    empty. The language, the source and the id are no inputs.
    """
    model = fit_neighbours(docs, labels, id_col, text_col, **options)
    return docs.withColumn(score_col, score_texts(docs.sparkSession, model, F.col(f"`{text_col}`")))


@query()
def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score and verdict of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = classify_quality(docs, table(spark, sf_dir, "labels"))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )
