"""Queries: top-k retrieval of documents for the benchmark passages, and its reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import operators as op
from ..plans import answer_questions
from .base import (
    DEFAULT_ROUTE,
    FLAGS,
    ROUTES,
    SPACE,
    TAXONOMY,
    TITLE,
    counts_sql,
    flags_sql,
    posts,
    query,
    route_sql,
    table,
)
from .vectors import group_vocab_sql

K = 20

def retrieved_sql(k: int, name: str) -> str:
    """``{name}_retrieved`` of the ``asked(query_id, text, lang)``, and the CTEs below it."""
    return f"""
{group_vocab_sql(name)},
{counts_sql(f'{name}_qcounts', 'asked', 'lang, query_id')},
{name}_qraw AS (SELECT lang, query_id, term, tf * idf AS w FROM {name}_qcounts JOIN {name}_idf USING (lang, term)),
{name}_qnorms AS (SELECT query_id, sqrt(sum(w * w)) AS norm FROM {name}_qraw GROUP BY query_id),
{name}_qweights AS (SELECT lang, query_id, term, w / norm AS q FROM {name}_qraw JOIN {name}_qnorms USING (query_id)),
{name}_hits AS (
  SELECT query_id, doc_id, round(sum(weight * q), 9) AS similarity
  FROM {name}_qweights JOIN {name}_weights USING (lang, term) GROUP BY query_id, doc_id),
{name}_ranked_docs AS (
  SELECT a.query_id, a.lang AS "group", d.doc_id AS doc, coalesce(h.similarity, 0) AS similarity,
    CAST(row_number() OVER (PARTITION BY a.query_id ORDER BY coalesce(h.similarity, 0) DESC, d.doc_id) AS INTEGER) AS rank
  FROM asked a JOIN documents d ON d.lang = a.lang
  LEFT JOIN {name}_hits h ON h.query_id = a.query_id AND h.doc_id = d.doc_id),
{name}_retrieved AS (SELECT * FROM {name}_ranked_docs WHERE rank <= {k})
"""


def skills_sql(name: str) -> str:
    """``{name}_freq``: skill frequencies of ``{name}_retrieved``."""
    return f"""
{name}_found AS (SELECT r.query_id, r."group", {flags_sql('lower(d.text)')}
  FROM {name}_retrieved r JOIN documents d ON d.doc_id = r.doc),
{name}_long AS ({' UNION ALL '.join(
    f'SELECT query_id, "group", count(*) AS n_rows, {chr(39)}{f}{chr(39)} AS flag, sum({f}) AS n FROM {name}_found GROUP BY ALL'
    for f in FLAGS)}),
{name}_freq AS (
  SELECT query_id, "group", CAST(row_number() OVER (PARTITION BY query_id ORDER BY n DESC, flag) AS INTEGER) AS rank,
    flag, CAST(round_even(n * 1.0::DOUBLE / n_rows * 100, 0) AS INTEGER) AS pct, CAST(n AS BIGINT) AS n, n_rows
  FROM {name}_long WHERE n > 0)
"""


_RETRIEVED = f"""
asked AS (SELECT item_id AS query_id, text, {route_sql('text')} AS lang FROM benchmark),
{retrieved_sql(K, 'r')},
retrieved AS (SELECT * FROM r_retrieved), sizes AS (SELECT * FROM r_sizes)
"""


def _questions(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), "text")


def _retrieved(spark, sf_dir):
    docs = posts(spark, sf_dir)
    index = op.build_index(docs, "doc_id", "role_category", "description")
    asked = op.route_query(_questions(spark, sf_dir), "text", ROUTES, DEFAULT_ROUTE, out="group")
    return index, docs, op.retrieve_topk(index, asked, K)


@query(f"""
WITH {_RETRIEVED}
SELECT query_id, "group", rank, doc, round(similarity, 6) AS similarity FROM retrieved""")
def retrieve_topk(spark, sf_dir):
    _, _, found = _retrieved(spark, sf_dir)
    return found.withColumn("similarity", F.round("similarity", 6))


def _answers(spark, sf_dir):
    docs = posts(spark, sf_dir)
    index = op.build_index(docs, "doc_id", "role_category", "description")
    return answer_questions(
        index, docs, "doc_id", _questions(spark, sf_dir), K, TAXONOMY, ROUTES, DEFAULT_ROUTE
    )


_SKILLS = f"""
{_RETRIEVED},
{skills_sql('r')},
freq AS (SELECT * FROM r_freq)
"""
_TOP_SKILLS = """
SELECT query_id, f."group", rank, flag, pct, n, n_rows, n_docs
FROM freq f JOIN sizes s ON s.lang = f."group" WHERE rank <= 12"""


@query(f"WITH {_SKILLS} {_TOP_SKILLS}")
def answer_top_skills(spark, sf_dir):
    return _answers(spark, sf_dir)["skills"]


_QUOTES = f"""
quoted AS (
  SELECT r.query_id, {TITLE} AS job_title, d.source AS company,
    regexp_replace(d.text, '^[{SPACE}]+|[{SPACE}]+$', '', 'g') AS t, r.rank
  FROM retrieved r JOIN documents d ON d.doc_id = r.doc),
picked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY rank) AS INTEGER) AS quote
  FROM quoted WHERE length(t) >= 60)
"""
_QUOTE_ROWS = """
SELECT query_id, quote, job_title, company,
  replace(substring(t, 1, 220), chr(10), ' ') || '...' AS snippet FROM picked WHERE quote <= 3"""


@query(f"WITH {_RETRIEVED}, {_QUOTES} {_QUOTE_ROWS}")
def grounding_quotes(spark, sf_dir):
    return _answers(spark, sf_dir)["quotes"]


_SOURCE_ROWS = f"""
SELECT r.query_id, r.rank, {TITLE} AS job_title, d.source AS company,
  round(similarity, 3) AS similarity, d.lang AS source
FROM retrieved r JOIN documents d ON d.doc_id = r.doc WHERE r.rank <= 5"""


@query(f"WITH {_RETRIEVED} {_SOURCE_ROWS}")
def top_sources(spark, sf_dir):
    return _answers(spark, sf_dir)["sources"]


@query(f"""
WITH {_SKILLS},
own AS (SELECT item_id AS query_id, {flags_sql('lower(text)')} FROM benchmark),
own_long AS ({' UNION ALL '.join(f"SELECT query_id, '{f}' AS flag, {f} AS has FROM own" for f in FLAGS)}),
gaps AS (
  SELECT query_id, CASE WHEN has = 1 THEN 'present' ELSE 'missing' END AS status, rank AS place, flag, pct
  FROM freq JOIN own_long USING (query_id, flag) WHERE pct >= 15),
placed AS (
  SELECT query_id, status, CAST(row_number() OVER (PARTITION BY query_id, status ORDER BY place) AS INTEGER) AS rank,
    flag, pct FROM gaps)
SELECT * FROM placed WHERE rank <= 10""")
def skill_gap(spark, sf_dir):
    _, docs, found = _retrieved(spark, sf_dir)
    attached = op.with_documents(found, docs, "doc_id", ["description"])
    freq = op.skill_frequencies(
        op.tag_flags(attached, ["description"], TAXONOMY), ["query_id"], FLAGS
    )
    own = op.own_flags(_questions(spark, sf_dir), "text", TAXONOMY).select("query_id", *FLAGS)
    return op.skill_gap(freq, own, "query_id", FLAGS)


@query(f"""
WITH {_SKILLS}, {_QUOTES},
top_skills AS ({_TOP_SKILLS}), quote_rows AS ({_QUOTE_ROWS}), source_rows AS ({_SOURCE_ROWS})
SELECT query_id, 'skill' AS section, rank, flag AS item, CAST(pct AS DOUBLE) AS value FROM top_skills
UNION ALL SELECT query_id, 'quote', quote, job_title || ' @ ' || company || ': ' || snippet, NULL FROM quote_rows
UNION ALL SELECT query_id, 'source', rank, job_title || ' @ ' || company || ' (' || source || ')', similarity
FROM source_rows""")
def answer_questions_(spark, sf_dir):
    tables = _answers(spark, sf_dir)
    none = F.lit(None).cast("double")
    quoted = F.concat("job_title", F.lit(" @ "), "company", F.lit(": "), "snippet")
    sourced = F.concat("job_title", F.lit(" @ "), "company", F.lit(" ("), "source", F.lit(")"))

    def section(df, name, rank, item, value):
        return df.select("query_id", F.lit(name).alias("section"), F.col(rank).alias("rank"),
                         item.alias("item"), value.alias("value"))

    skills = section(tables["skills"], "skill", "rank", F.col("flag"), F.col("pct").cast("double"))
    quotes = section(tables["quotes"], "quote", "quote", quoted, none)
    sources = section(tables["sources"], "source", "rank", sourced, F.col("similarity"))
    return skills.unionByName(quotes).unionByName(sources)
