"""Queries: tokens, vocabularies, TF-IDF weights, scaling, splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import operators as op
from .base import counts_sql, grams_sql, query, table, texts, tokens_sql


def _tokens(spark, sf_dir):
    return op.tokenize(texts(spark, sf_dir).select("doc_id", "lang", "text"), "text")


def _terms(spark, sf_dir):
    return op.ngrams_1_2(_tokens(spark, sf_dir))


def _digest(col: str):
    return [F.size(col).cast("bigint").alias("n"), F.md5(F.array_join(col, " ")).alias("digest")]


@query(f"""
SELECT doc_id, len(t) AS n, md5(array_to_string(t, ' ')) AS digest
FROM (SELECT doc_id, {tokens_sql('text')} AS t FROM documents)""")
def tokenize(spark, sf_dir):
    return _tokens(spark, sf_dir).select("doc_id", *_digest("tokens"))


@query(f"""
SELECT doc_id, len(g) AS n, md5(array_to_string(g, ' ')) AS digest
FROM (SELECT doc_id, {grams_sql('t')} AS g FROM (SELECT doc_id, {tokens_sql('text')} AS t FROM documents))""")
def ngrams_1_2(spark, sf_dir):
    return _terms(spark, sf_dir).select("doc_id", *_digest("terms"))


_COUNTS = counts_sql("counts", "documents", "doc_id")
_VOCAB = f"""
{_COUNTS},
stats AS (SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS tf FROM counts GROUP BY term),
vocab AS (
  SELECT * FROM stats WHERE df >= 5 AND df <= 0.6 * (SELECT count(*) FROM documents)
  ORDER BY tf DESC, term LIMIT 6000),
idf AS (SELECT term, ln((1 + (SELECT count(*) FROM documents)) / (1 + df)) + 1 AS idf FROM vocab)
"""


@query(f"WITH {_VOCAB} SELECT term, df, tf FROM vocab")
def vocabulary(spark, sf_dir):
    n_docs = table(spark, sf_dir, "documents").agg(F.count("*")).scalar()
    return op.vocabulary(op.term_counts(_terms(spark, sf_dir), []), n_docs)


@query(f"""
WITH tok AS (SELECT doc_id, unnest(list_distinct({tokens_sql('text')})) AS term FROM documents)
SELECT term, count(*) AS df FROM tok GROUP BY term HAVING count(*) < 5""")
def doc_frequency_audit(spark, sf_dir):
    return op.doc_frequency_audit(_tokens(spark, sf_dir), "doc_id")


_WEIGHTS = """
raw AS (SELECT {id}, term, (1 + ln(tf)) * idf AS w FROM {counts} JOIN idf USING (term)),
norms AS (SELECT {id}, sqrt(sum(w * w)) AS norm FROM raw GROUP BY {id})
SELECT {id}, term, round(w / norm, 6) AS weight FROM raw JOIN norms USING ({id})
"""


@query(f"WITH {_VOCAB}, {_WEIGHTS.format(id='doc_id', counts='counts')}")
def tfidf(spark, sf_dir):
    weights = op.tfidf(_terms(spark, sf_dir), "doc_id")
    return weights.withColumn("weight", F.round("weight", 6))


@query(f"""
WITH {_VOCAB}, {counts_sql('asked', 'benchmark', 'item_id')},
{_WEIGHTS.format(id='item_id', counts='asked')}""")
def tfidf_transform(spark, sf_dir):
    model = op.fit_tfidf(_terms(spark, sf_dir))
    items = op.ngrams_1_2(op.tokenize(table(spark, sf_dir, "benchmark"), "text"))
    weights = op.tfidf_transform(items, "item_id", model)
    return weights.withColumn("weight", F.round("weight", 6))


def group_vocab_sql(name: str) -> str:
    """``{name}_weights(lang, doc_id, term, weight)`` and the CTEs below it."""
    return f"""
{counts_sql(f'{name}_counts', 'documents', 'lang, doc_id')},
{name}_stats AS (SELECT lang, term, count(*) AS df, sum(tf) AS tf FROM {name}_counts GROUP BY lang, term),
{name}_ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY tf DESC, term) AS r FROM {name}_stats),
{name}_sizes AS (SELECT lang, count(*) AS n_docs FROM documents GROUP BY lang),
{name}_idf AS (
  SELECT lang, term, ln((1 + n_docs) / (1 + df)) + 1 AS idf FROM {name}_ranked JOIN {name}_sizes USING (lang) WHERE r <= 5000),
{name}_raw AS (SELECT lang, doc_id, term, tf * idf AS w FROM {name}_counts JOIN {name}_idf USING (lang, term)),
{name}_norms AS (SELECT doc_id, sqrt(sum(w * w)) AS norm FROM {name}_raw GROUP BY doc_id),
{name}_weights AS (SELECT lang, doc_id, term, w / norm AS weight FROM {name}_raw JOIN {name}_norms USING (doc_id))
"""


@query(f"WITH {group_vocab_sql('g')} SELECT lang, doc_id, term, round(weight, 6) AS weight FROM g_weights")
def per_group_tfidf(spark, sf_dir):
    index = op.build_index(texts(spark, sf_dir), "doc_id", "lang", "text")
    return index.weights.select(
        F.col("group").alias("lang"),
        F.col("doc").alias("doc_id"),
        "term",
        F.round("weight", 6).alias("weight"),
    )


def _numbers(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id")
    return docs.select("doc_id", F.col("n_chars").cast("double").alias("n_chars"), "quality", "toxic",
                       F.lit(7.0).alias("constant"))


@query("""
WITH numbers AS (SELECT d.doc_id, n_chars, quality, toxic FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
fit AS (SELECT avg(n_chars) AS mn, stddev_pop(n_chars) AS sn, avg(quality) AS mq,
  stddev_pop(quality) AS sq, avg(toxic) AS mt, stddev_pop(toxic) AS st FROM numbers)
SELECT doc_id, round((n_chars - mn) / sn, 6) AS n_chars, round((quality - mq) / sq, 6) AS quality,
  round((toxic - mt) / st, 6) AS toxic, 0.0::DOUBLE AS constant
FROM numbers, fit""")
def standardise(spark, sf_dir):
    numbers = _numbers(spark, sf_dir)
    cols = ["n_chars", "quality", "toxic", "constant"]
    scaled = op.standardise(numbers, cols).transform(numbers)
    return scaled.withColumns({c: F.round(c, 6) for c in cols})


@query("""
SELECT lang, CAST(row_number() OVER (ORDER BY lang) - 1 AS DOUBLE) AS label, count(*) AS n
FROM documents GROUP BY lang""")
def index_labels(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    indexed, _ = op.index_labels(docs, "lang")
    return indexed.groupBy("lang", "label").agg(F.count("*").alias("n"))


@query("""
WITH sizes AS (SELECT lang, count(*) AS n FROM documents GROUP BY lang),
exact AS (
  SELECT lang, n, ceil(0.2 * (SELECT count(*) FROM documents)) * n / (SELECT count(*) FROM documents) AS x
  FROM sizes),
quota AS (
  SELECT lang, n, floor(x) + CASE WHEN row_number() OVER (ORDER BY x - floor(x) DESC, lang)
    <= ceil(0.2 * (SELECT count(*) FROM documents)) - sum(floor(x)) OVER () THEN 1 ELSE 0 END AS q
  FROM exact)
SELECT doc_id, d.lang, row_number() OVER (
  PARTITION BY d.lang ORDER BY substr(md5('42:' || doc_id), 1, 15), doc_id) <= q AS is_test
FROM documents d JOIN quota USING (lang)""")
def stratified_split(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return op.stratified_split(docs, "lang", "doc_id")


@query("""
WITH placed AS (
  SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY substr(md5('42:' || doc_id), 1, 15), doc_id) - 1 AS i,
    count(*) OVER (PARTITION BY lang) AS n FROM documents)
SELECT doc_id, lang, CAST(CASE WHEN i < (n % 5) * (n // 5 + 1) THEN i // (n // 5 + 1)
  ELSE n % 5 + (i - (n % 5) * (n // 5 + 1)) // greatest(n // 5, 1) END AS INTEGER) AS fold FROM placed""")
def stratified_folds(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return op.stratified_folds(docs, "lang", "doc_id")


@query("""
SELECT doc_id, lang, round((SELECT count(*) FROM documents)::DOUBLE
  / ((SELECT count(DISTINCT lang) FROM documents) * count(*) OVER (PARTITION BY lang)), 6) AS weight
FROM documents""")
def balanced_weights(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return op.balanced_weights(docs, "lang").withColumn("weight", F.round("weight", 6))
