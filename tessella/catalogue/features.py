"""Queries: flags, engineered columns, rates and gap tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import operators as op
from ..functions import clean_text, extract_first_int, text_length, word_count
from .base import (
    AREA_CODE,
    ECHOES,
    EDGE,
    FLAGGED,
    FLAGS,
    SPACE,
    TAXONOMY,
    TITLE,
    clean_sql,
    flags_sql,
    query,
    table,
    texts,
    title,
    unpivot_sql,
)

_GROUPS = {
    g: ["skill_" + e.name for e in TAXONOMY if e.group == g]
    for g in dict.fromkeys(e.group for e in TAXONOMY)
}
_TOTAL = " + ".join(FLAGS)
_FLAG_LIST = ", ".join(FLAGS)
_GROUP_LIST = ", ".join(
    f"CAST({' + '.join(names)} AS DOUBLE) AS group_{g}_count" for g, names in _GROUPS.items()
)


def _flagged(spark, sf_dir):
    return op.tag_flags(texts(spark, sf_dir), ["text"], TAXONOMY)


@query(f"""
SELECT doc_id, {flags_sql(f"lower({TITLE} || ' ' || source || ' ' || text)")} FROM documents""")
def tag_flags(spark, sf_dir):
    docs = texts(spark, sf_dir).withColumn("job_title", title())
    return op.tag_flags(docs, ["job_title", "source", "text"], TAXONOMY).select("doc_id", *FLAGS)


@query(f"""
WITH {FLAGGED}
SELECT doc_id, {_FLAG_LIST}, {_TOTAL} AS n_skills_total, {_GROUP_LIST} FROM flagged""")
def taxonomy_features(spark, sf_dir):
    features = op.taxonomy_features(texts(spark, sf_dir), "text", TAXONOMY)
    return features.select(
        "doc_id", *FLAGS, "n_skills_total", *[f"group_{g}_count" for g in _GROUPS]
    )


@query(f"WITH {FLAGGED} SELECT doc_id, {_TOTAL} AS n_skills_total FROM flagged")
def n_hits_total(spark, sf_dir):
    return op.n_hits_total(_flagged(spark, sf_dir), FLAGS).select("doc_id", "n_skills_total")


@query(f"WITH {FLAGGED} SELECT doc_id, {_GROUP_LIST} FROM flagged")
def group_counts(spark, sf_dir):
    counted = op.group_counts(_flagged(spark, sf_dir), TAXONOMY)
    return counted.select("doc_id", *[f"group_{g}_count" for g in _GROUPS])


@query(rf"""
SELECT doc_id,
  CAST(regexp_matches(l, 'bachelor|b\.?s{EDGE}|undergraduate degree') AS INTEGER) AS mentions_bachelor,
  CAST(regexp_matches(l, 'master|m\.?s{EDGE}|msc{EDGE}') AS INTEGER) AS mentions_master,
  CAST(regexp_matches(l, 'ph\.?d|doctorate') AS INTEGER) AS mentions_phd
FROM (SELECT doc_id, lower(text) AS l FROM documents)""")
def degree_flags(spark, sf_dir):
    return op.degree_flags(texts(spark, sf_dir), "text").select(
        "doc_id", "mentions_bachelor", "mentions_master", "mentions_phd"
    )


@query(rf"""
SELECT doc_id, coalesce(TRY_CAST(regexp_extract(text, '{AREA_CODE}', 1) AS INTEGER), 0) AS area_code
FROM documents""")
def extract_first_int_(spark, sf_dir):
    code = extract_first_int(F.col("text"), AREA_CODE)
    return texts(spark, sf_dir).select("doc_id", code.alias("area_code"))


@query("SELECT doc_id, CAST(length(text) AS INTEGER) AS description_length FROM documents")
def text_length_(spark, sf_dir):
    return texts(spark, sf_dir).select(
        "doc_id", text_length(F.col("text")).alias("description_length")
    )


@query(f"""
SELECT doc_id, CAST(len(regexp_extract_all(text, '[^{SPACE}]+')) AS INTEGER) AS word_count
FROM documents""")
def word_count_(spark, sf_dir):
    return texts(spark, sf_dir).select("doc_id", word_count(F.col("text")).alias("word_count"))


@query("""
SELECT doc_id, CAST(lang = 'de' AS INTEGER) AS is_de, CAST(lang = 'en' AS INTEGER) AS is_en,
  CAST(lang = 'es' AS INTEGER) AS is_es, CAST(lang = 'fr' AS INTEGER) AS is_fr
FROM documents""")
def one_hot(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return op.one_hot(docs, "lang", ["de", "en", "es", "fr"], "is_").drop("lang")


@query(f"SELECT conv_id, turn, {flags_sql('lower(text)')} FROM conversations")
def own_flags(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations")
    return op.own_flags(turns, "text", TAXONOMY).select("conv_id", "turn", *FLAGS)


def stripped_sql() -> str:
    branches = []
    for label, patterns in ECHOES.items():
        out = "text"
        for p in patterns:
            out = f"regexp_replace({out}, '(?i){p}', ' ', 'g')"
        branches.append(f"WHEN '{label}' THEN {out}")
    return f"CASE lang {' '.join(branches)} ELSE text END"


def _stripped(spark, sf_dir):
    return op.strip_label_echo(texts(spark, sf_dir), "text", "lang", ECHOES, "stripped")


@query(f"""
SELECT doc_id, length(s) AS n, md5(s) AS stripped_md5
FROM (SELECT doc_id, {stripped_sql()} AS s FROM documents)""")
def strip_label_echo(spark, sf_dir):
    return _stripped(spark, sf_dir).select(
        "doc_id", F.length("stripped").alias("n"), F.md5("stripped").alias("stripped_md5")
    )


@query(f"""
SELECT count(*) FILTER (text IS DISTINCT FROM s) AS n_changed, count(*) AS n_rows
FROM (SELECT text, {stripped_sql()} AS s FROM documents)""")
def echo_change_count(spark, sf_dir):
    return op.echo_change_count(_stripped(spark, sf_dir), "text", "stripped")


_TERMS = ["llm", "the", "and", "les", "tion", "data", "ing"]


@query(" UNION ALL ".join(
    f"SELECT '{t}' AS term, count(*) FILTER (contains(lower(text), '{t}')) AS unbounded, "
    f"count(*) FILTER (regexp_matches(lower(text), '(^|[^\\p{{L}}\\p{{N}}_]){t}{EDGE}')) AS bounded "
    "FROM documents"
    for t in _TERMS
))
def pattern_inflation(spark, sf_dir):
    return op.pattern_inflation(texts(spark, sf_dir), "text", _TERMS)


@query("SELECT source AS value, count(*) AS n FROM documents WHERE source IS NOT NULL GROUP BY source")
def value_counts(spark, sf_dir):
    return op.value_counts(table(spark, sf_dir, "documents"), "source")


@query("""
SELECT lang AS value, round_even(count(*) * 100.0 / (SELECT count(lang) FROM documents), 1)::DOUBLE AS pct
FROM documents WHERE lang IS NOT NULL GROUP BY lang""")
def value_shares(spark, sf_dir):
    return op.value_shares(table(spark, sf_dir, "documents"), "lang")


@query(f"""
WITH {FLAGGED}
SELECT flag, round(pct, 6) AS pct FROM ({unpivot_sql('avg({f}) * 100 AS pct', 'flagged')})
ORDER BY pct DESC, flag LIMIT 10""")
def flag_frequency(spark, sf_dir):
    top = op.flag_frequency(_flagged(spark, sf_dir), FLAGS)
    return top.withColumn("pct", F.round("pct", 6))


# The whole road from raw text to rates: clean, drop short texts, keep first copies, tag.
_KEPT = f"""
WITH kept AS (
  SELECT lang, clean FROM (
    SELECT lang, clean, row_number() OVER (PARTITION BY clean ORDER BY doc_id) AS copy
    FROM (SELECT doc_id, lang, %s AS clean FROM documents) WHERE length(clean) >= 150)
  WHERE copy = 1),
flagged AS (SELECT lang, {flags_sql('lower(clean)')} FROM kept)
"""


def _rates(spark, sf_dir):
    cleaned = (
        texts(spark, sf_dir)
        .select("doc_id", "lang", clean_text(F.col("text")).alias("clean"))
        .withColumn("n", F.length("clean"))
    )
    # Copies share their length; filtered afterwards, every text is cleaned once.
    kept = op.dedupe_keep_first(cleaned, ["clean"], "doc_id").where("n >= 150")
    return op.rate_by_group(op.tag_flags(kept, ["clean"], TAXONOMY), "lang", FLAGS)


def _kept_sql() -> str:
    return _KEPT % clean_sql("text")


def _rates_sql(where: str = "") -> str:
    parts = unpivot_sql("avg({f}) * 100 AS pct", "flagged", 'lang AS "group", count(*) AS n')
    return " UNION ALL ".join(f"{p} {where} GROUP BY lang" for p in parts.split(" UNION ALL "))


@query(f"""
{_kept_sql()}
SELECT "group", n, flag, round(pct, 6) AS pct FROM ({_rates_sql()})""")
def rate_by_group(spark, sf_dir):
    return _rates(spark, sf_dir).withColumn("pct", F.round("pct", 6))


_GAP_SQL = """
SELECT flag, max(pct) FILTER ("group" = 'en') - max(pct) FILTER ("group" = 'fr') AS gap
FROM ({rates}) GROUP BY flag"""


@query(f"""
{_kept_sql()}
SELECT flag, round(gap, 6) AS gap FROM ({_GAP_SQL.format(rates=_rates_sql())})""")
def rate_gap(spark, sf_dir):
    gap = op.rate_gap(_rates(spark, sf_dir), "en", "fr")
    return gap.withColumn("gap", F.round("gap", 6))


_LABELLED = f"""
labelled AS (SELECT f.* FROM flagged f SEMI JOIN labels l ON f.doc_id = l.doc_id)"""


@query(f"""
WITH {FLAGGED}, {_LABELLED},
old AS ({_GAP_SQL.format(rates=_rates_sql().replace('FROM flagged', 'FROM labelled'))}),
new AS ({_GAP_SQL.format(rates=_rates_sql())})
SELECT flag, round(old.gap, 6) AS old_gap, round(new.gap, 6) AS new_gap,
  CASE WHEN sign(old.gap) = sign(new.gap) THEN 'holds' ELSE 'reversed' END AS verdict
FROM old JOIN new USING (flag)""")
def gap_shift(spark, sf_dir):
    flagged = _flagged(spark, sf_dir)
    labelled = flagged.join(table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_semi")
    gaps = [op.rate_gap(op.rate_by_group(d, "lang", FLAGS), "en", "fr") for d in (labelled, flagged)]
    shift = op.gap_shift(*gaps)
    return shift.withColumns({c: F.round(c, 6) for c in ("old_gap", "new_gap")})


@query(f"""
WITH {FLAGGED}
SELECT flag, CAST(pos AS BIGINT) AS pos, CAST(neg AS BIGINT) AS neg
FROM ({unpivot_sql('sum({f}) AS pos, sum(1 - {f}) AS neg', 'flagged')})
WHERE pos >= 15 AND neg >= 15""")
def class_balance_eligibility(spark, sf_dir):
    return op.class_balance_eligibility(_flagged(spark, sf_dir), FLAGS)


@query(f"""
WITH {FLAGGED},
long AS ({' UNION ALL '.join(
    f"SELECT source, count(*) AS n_rows, '{f}' AS flag, sum({f}) AS n FROM flagged GROUP BY source"
    for f in FLAGS)})
SELECT source, CAST(row_number() OVER (PARTITION BY source ORDER BY n DESC, flag) AS INTEGER) AS rank,
  flag, CAST(round_even(n * 1.0::DOUBLE / n_rows * 100, 0) AS INTEGER) AS pct,
  CAST(n AS BIGINT) AS n, n_rows
FROM long WHERE n > 0""")
def skill_frequencies(spark, sf_dir):
    return op.skill_frequencies(_flagged(spark, sf_dir), ["source"], FLAGS)


def _title_predictions(spark, sf_dir):
    """Flag of the whole text as truth, flag of the first line as its prediction."""
    docs = texts(spark, sf_dir).withColumn("job_title", title())
    both = op.tag_flags(docs, ["text"], TAXONOMY, "y_")
    both = op.tag_flags(both, ["job_title"], TAXONOMY, "p_")
    pairs = [
        F.struct(F.lit(e.name).alias("flag"), F.col(f"y_{e.name}").alias("y"), F.col(f"p_{e.name}").alias("p"))
        for e in TAXONOMY
    ]
    return both.select("doc_id", F.inline(F.array(*pairs)))


_PREDICTED = f"""
truth AS (SELECT doc_id, {flags_sql('lower(text)')} FROM documents),
guess AS (SELECT doc_id, {flags_sql(f'lower({TITLE})')} FROM documents),
pairs AS ({' UNION ALL '.join(
    f"SELECT '{e.name}' AS flag, t.skill_{e.name} AS y, g.skill_{e.name} AS p "
    "FROM truth t JOIN guess g USING (doc_id)" for e in TAXONOMY)}),
cells AS (
  SELECT flag, count(*) FILTER (y = 1 AND p = 1) AS tp, count(*) FILTER (y = 1) AS pos,
    count(*) FILTER (p = 1) AS said, count(*) FILTER (y = p) AS same, count(*) AS n
  FROM pairs GROUP BY flag),
scored AS (
  SELECT flag, pos AS n_positive, n - pos AS n_negative,
    coalesce(2.0::DOUBLE * tp / nullif(pos + said, 0), 0) AS f1,
    coalesce(tp::DOUBLE / nullif(said, 0), 0) AS precision,
    coalesce(tp::DOUBLE / nullif(pos, 0), 0) AS recall, same::DOUBLE / n AS accuracy
  FROM cells)
"""


@query(f"""
WITH {_PREDICTED}
SELECT flag, n_positive, n_negative, round(f1, 6) AS f1, round(precision, 6) AS precision,
  round(recall, 6) AS recall, round(accuracy, 6) AS accuracy FROM scored""")
def binary_metrics(spark, sf_dir):
    scores = op.binary_metrics(_title_predictions(spark, sf_dir), ["flag"])
    return scores.withColumns(
        {c: F.round(c, 6) for c in ("f1", "precision", "recall", "accuracy")}
    )


@query(f"""
WITH {_PREDICTED}
SELECT flag, round(greatest(avg(y), 1 - avg(y)), 6) AS baseline FROM pairs GROUP BY flag""")
def majority_baseline(spark, sf_dir):
    baseline = op.majority_baseline(_title_predictions(spark, sf_dir), ["flag"])
    return baseline.withColumn("baseline", F.round("baseline", 6))


@query(f"""
WITH {_PREDICTED},
banded AS (SELECT flag, f1, CASE WHEN f1 >= 0.6 THEN 'strong' WHEN f1 >= 0.3 THEN 'mid' ELSE 'weak' END AS band
  FROM scored)
SELECT flag, round(f1, 6) AS f1, band,
  CAST(row_number() OVER (PARTITION BY band ORDER BY f1 DESC, flag) AS INTEGER) AS rank
FROM banded""")
def band_by_f1(spark, sf_dir):
    scores = op.binary_metrics(_title_predictions(spark, sf_dir), ["flag"])
    return op.band_by_f1(scores).withColumn("f1", F.round("f1", 6))
