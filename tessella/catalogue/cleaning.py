"""Queries: sources and sinks, cleaning, filters, dedupe, labelling."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .. import operators as op
from ..functions import (
    KeywordRule,
    PatternRule,
    clean_text,
    label_by_keywords,
    label_by_regex,
    parse_timestamp_utc,
    seniority_band,
)
from ..plans import labelled_postings, stage_report, tagged_postings
from ..rules import RAW_HEADERS
from ..session import scratch_path
from ..sources import (
    normalise_columns,
    read_postings_csv,
    read_postings_json,
    write_metrics,
    write_table,
)
from .base import (
    DEFAULT_ROUTE,
    FLAGS,
    LANG_NAMES,
    PART_BANDS,
    PART_PATTERNS,
    PART_RULES,
    ROUTES,
    TAXONOMY,
    TITLE,
    clean_sql,
    flags_sql,
    query,
    route_sql,
    table,
    texts,
    title,
)


@query("SELECT doc_id, lang, source, md5(text) AS text_md5 FROM documents")
def read_postings_csv_(spark, sf_dir):
    path = scratch_path(spark)
    docs = texts(spark, sf_dir).select("doc_id", "lang", "source", "text")
    writer = docs.write.option("header", True).option("quote", '"').option("escape", '"')
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    schema = StructType(
        [StructField("doc_id", LongType())]
        + [StructField(c, StringType()) for c in ("lang", "source", "text")]
    )
    back = read_postings_csv(spark, path, schema)
    return back.select("doc_id", "lang", "source", F.md5("text").alias("text_md5"))


@query("SELECT conv_id, turn, role, text FROM conversations")
def read_postings_json_(spark, sf_dir):
    path = scratch_path(spark)
    turns = table(spark, sf_dir, "conversations")
    # Each file is one array over many lines: the first object opens it, the last line closes it.
    rows = turns.select(F.to_json(F.struct("conv_id", "turn", "role", "text")).alias("value"), F.spark_partition_id().alias("part"))
    rows = rows.withColumn("at", F.monotonically_increasing_id())
    edges = rows.groupBy("part").agg(F.min("at").alias("first"), F.max("at").alias("last"))
    placed = rows.join(edges, "part")
    opened = F.when(F.col("at") == F.col("first"), "[").otherwise("")
    closed = F.when(F.col("at") == F.col("last"), "]").otherwise(",")
    lines = placed.select("part", "at", F.concat(opened, "value", closed).alias("value"))
    lines.repartition("part").sortWithinPartitions("part", "at").select("value", "part").write.partitionBy("part").text(path)
    return read_postings_json(spark, path, turns.schema)


@query(f"""
SELECT doc_id, {TITLE} AS job_title, source AS company, md5(text) AS description_md5, lang
FROM documents""")
def normalise_columns_(spark, sf_dir):
    raw = texts(spark, sf_dir).select(
        "doc_id",
        title().alias("Job Title"),
        F.col("source").alias("Company Name"),
        F.col("text").alias("Job Description"),
        "lang",
    )
    named = normalise_columns(raw, RAW_HEADERS)
    return named.select(
        "doc_id", "job_title", "company", F.md5("description_raw").alias("description_md5"), "lang"
    )


@query("SELECT doc_id, lang, n_chars FROM documents")
def write_table_(spark, sf_dir):
    path = scratch_path(spark)
    write_table(table(spark, sf_dir, "documents"), path, ["doc_id", "lang", "n_chars"])
    return spark.read.parquet(path)


@query("""
SELECT 'by_lang' AS metric, lang AS value, count(*) AS n FROM documents GROUP BY lang
UNION ALL
SELECT 'by_source', source, count(*) FROM documents GROUP BY source""")
def write_metrics_(spark, sf_dir):
    path = scratch_path(spark)
    docs = table(spark, sf_dir, "documents")
    metrics = {"by_lang": op.value_counts(docs, "lang"), "by_source": op.value_counts(docs, "source")}
    write_metrics(metrics, path)

    def read(name):
        back = spark.read.schema("value string, n bigint").json(f"{path}/{name}")
        return back.select(F.lit(name).alias("metric"), "value", "n")

    return read("by_lang").unionByName(read("by_source"))


def _with_labels(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return docs.join(table(spark, sf_dir, "labels"), "doc_id", "left")


@query("""
SELECT d.doc_id, lang, quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
WHERE quality IS NOT NULL AND lang IS NOT NULL""")
def drop_missing(spark, sf_dir):
    return op.drop_missing(_with_labels(spark, sf_dir), ["lang", "quality"]).select(
        "doc_id", "lang", "quality"
    )


@query("""
SELECT d.doc_id, coalesce(CAST(quality AS VARCHAR), '') AS quality_text
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def fill_missing_text(spark, sf_dir):
    joined = _with_labels(spark, sf_dir).select(
        "doc_id", F.col("quality").cast("string").alias("quality_text")
    )
    return op.fill_missing_text(joined, ["quality_text"])


def _cleaned(spark, sf_dir):
    return texts(spark, sf_dir).withColumn("clean", clean_text(F.col("text")))


@query(f"""
SELECT 'page' AS kind, page_id AS id, length({clean_sql('html')}) AS n, md5({clean_sql('html')}) AS digest
FROM pages
UNION ALL
SELECT 'page_url', page_id, length({clean_sql("url || ' ' || url")}), md5({clean_sql("url || ' ' || url")})
FROM pages
UNION ALL
SELECT 'document', doc_id, length({clean_sql('text')}), md5({clean_sql('text')}) FROM documents""")
def clean_text_(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    twice = F.concat("url", F.lit(" "), "url")
    parts = [
        pages.select(F.lit("page").alias("kind"), F.col("page_id").alias("id"), F.col("html").alias("t")),
        pages.select(F.lit("page_url").alias("kind"), F.col("page_id").alias("id"), twice.alias("t")),
        texts(spark, sf_dir).select(
            F.lit("document").alias("kind"), F.col("doc_id").alias("id"), F.col("text").alias("t")
        ),
    ]
    every = parts[0].unionByName(parts[1]).unionByName(parts[2])
    cleaned = every.withColumn("t", clean_text(F.col("t")))
    return cleaned.select("kind", "id", F.length("t").alias("n"), F.md5("t").alias("digest"))


@query(f"""
SELECT doc_id, length({clean_sql('text')}) AS n FROM documents
WHERE length({clean_sql('text')}) >= 150""")
def min_length_filter(spark, sf_dir):
    kept = op.min_length_filter(_cleaned(spark, sf_dir), "clean", 150)
    return kept.select("doc_id", F.length("clean").alias("n"))


@query(f"""
SELECT doc_id, lang, source FROM (
  SELECT *, row_number() OVER (PARTITION BY {clean_sql('text')} ORDER BY doc_id) AS copy FROM documents
) WHERE copy = 1""")
def dedupe_keep_first(spark, sf_dir):
    return op.dedupe_keep_first(_cleaned(spark, sf_dir), ["clean"], "doc_id").select(
        "doc_id", "lang", "source"
    )


@query(f"""
SELECT doc_id, job_title, source, lang FROM (
  SELECT *, row_number() OVER (PARTITION BY job_title, source, lang ORDER BY doc_id) AS copy
  FROM (SELECT doc_id, {TITLE} AS job_title, source, lang FROM documents)
) WHERE copy = 1""")
def dedupe_keep_first_composite(spark, sf_dir):
    docs = texts(spark, sf_dir).select("doc_id", title().alias("job_title"), "source", "lang")
    return op.dedupe_keep_first(docs, ["job_title", "source", "lang"], "doc_id")


@query(f"""
SELECT count(*) AS rows_before, count(DISTINCT {clean_sql('text')}) AS rows_after,
       count(*) - count(DISTINCT {clean_sql('text')}) AS dropped
FROM documents""")
def dedupe_report(spark, sf_dir):
    return op.dedupe_report(_cleaned(spark, sf_dir), ["clean"])


@query("""
SELECT event_id, epoch_us(CASE event_type
    WHEN 'error' THEN NULL
    WHEN 'view' THEN date_trunc('day', ts)
    WHEN 'signup' THEN date_trunc('second', ts)
    WHEN 'purchase' THEN ts - INTERVAL 2 HOUR
    ELSE ts END) AS posted_us
FROM events""")
def parse_timestamp_utc_(spark, sf_dir):
    ts = F.col("ts").cast("timestamp_ntz")

    def shown(pattern):
        return F.date_format(ts, pattern)

    kind = F.col("event_type")
    written = (
        F.when(kind == "error", F.lit("posted lately"))
        .when(kind == "view", shown("yyyy-MM-dd"))
        .when(kind == "signup", shown("yyyy-MM-dd HH:mm:ss"))
        .when(kind == "purchase", F.concat(shown("yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+02:00")))
        .otherwise(F.concat(shown("yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z")))
    )
    events = table(spark, sf_dir, "events").select("event_id", written.alias("posted"))
    return events.select("event_id", F.unix_micros(parse_timestamp_utc(F.col("posted"))).alias("posted_us"))


@query("""
SELECT p_partkey, CASE
  WHEN (contains(n, 'hot') OR contains(n, 'red'))
       AND (contains(n, 'ring') OR contains(n, 'bolt') OR contains(n, 'gear')) THEN 'hot_metal'
  WHEN contains(n, 'cold') OR contains(n, 'blue') THEN 'cold'
  WHEN contains(n, 'small') OR contains(n, 'large') THEN 'sized'
  ELSE 'Other' END AS label
FROM (SELECT p_partkey, lower(p_name) AS n FROM part)""")
def label_by_keywords_(spark, sf_dir):
    label = label_by_keywords(F.col("p_name"), PART_RULES, "Other")
    return table(spark, sf_dir, "part").select("p_partkey", label.alias("label"))


_PATTERN_SQL = r"""
SELECT p_partkey, CASE
  WHEN (contains(n, 'red') OR contains(n, 'blue'))
       AND NOT (contains(n, 'ring') OR regexp_matches(n, '\bbolt\b')) THEN 'coloured'
  WHEN regexp_matches(n, '\bold\b') OR regexp_matches(n, '\bnew\b') THEN 'aged'
  WHEN contains(n, 'ring') OR contains(n, 'bolt') THEN 'ring_like' END AS label
FROM (SELECT p_partkey, lower(p_name) AS n FROM part)"""


def _pattern_labels(spark, sf_dir):
    label = label_by_regex(F.col("p_name"), PART_PATTERNS)
    return table(spark, sf_dir, "part").select("p_partkey", label.alias("label"))


@query(_PATTERN_SQL)
def label_by_regex_(spark, sf_dir):
    return _pattern_labels(spark, sf_dir)


@query(f"SELECT p_partkey, label FROM ({_PATTERN_SQL}) WHERE label IS NOT NULL")
def drop_unlabelled(spark, sf_dir):
    return op.drop_unlabelled(_pattern_labels(spark, sf_dir), "label")


@query("""
SELECT p_partkey, CASE
  WHEN contains(n, 'old') OR contains(n, 'large') THEN 'senior'
  WHEN contains(n, 'new') OR contains(n, 'small') THEN 'junior'
  ELSE 'mid' END AS band
FROM (SELECT p_partkey, lower(p_name) AS n FROM part)""")
def seniority_band_(spark, sf_dir):
    band = seniority_band(F.col("p_name"), PART_BANDS)
    return table(spark, sf_dir, "part").select("p_partkey", band.alias("band"))


@query("""
SELECT doc_id, CASE lang WHEN 'en' THEN 'english' WHEN 'fr' THEN 'french'
  WHEN 'de' THEN 'german' WHEN 'es' THEN 'spanish' END AS category
FROM documents""")
def map_category(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return op.map_category(docs, "lang", LANG_NAMES, "category").select("doc_id", "category")


@query(f"SELECT conv_id, turn, {route_sql('text')} AS category FROM conversations")
def route_query(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    return op.route_query(turns, "text", ROUTES, DEFAULT_ROUTE).select("conv_id", "turn", "category")


def _raw_posts(spark, sf_dir):
    return texts(spark, sf_dir).select(
        "doc_id",
        F.concat("lang", F.lit(" "), "source").alias("Job Title"),
        F.col("text").alias("Job Description"),
        F.col("source").alias("Company Name"),
        F.lit(None).cast("string").alias("Location"),
        F.lit(None).cast("string").alias("City"),
        F.col("lang").alias("State"),
        F.lit(None).cast("double").alias("SalaryMin"),
        F.lit(None).cast("double").alias("SalaryMax"),
        F.col("n_chars").cast("double").alias("Rating"),
    )


_LANG_RULES = [
    PatternRule("german", r"\bde\b", exclude=r"src1\b"),
    PatternRule("french", r"\bfr\b"),
    PatternRule("english", r"\ben\b", exclude=r"src3"),
]


_LABELLED_SQL = f"""
WITH cleaned AS (
  SELECT doc_id, lang, source, lang || ' ' || source AS job_title, n_chars, {clean_sql('text')} AS description
  FROM documents),
kept AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY description ORDER BY doc_id) AS copy FROM cleaned
    WHERE length(description) >= 150) WHERE copy = 1),
labelled AS (
  SELECT *, CASE WHEN lang = 'de' AND NOT regexp_matches(source, 'src1$') THEN 'german'
    WHEN lang = 'fr' THEN 'french'
    WHEN lang = 'en' AND NOT contains(source, 'src3') THEN 'english' END AS role_category
  FROM kept)
"""


@query(_LABELLED_SQL + """
SELECT job_title, role_category,
  CASE WHEN contains(source, 'src1') THEN 'senior' WHEN contains(source, '2') THEN 'junior' ELSE 'mid' END AS seniority,
  source AS company, lang AS state, CAST(n_chars AS DOUBLE) AS company_rating,
  CAST(length(description) AS INTEGER) AS description_length, md5(description) AS description_md5
FROM labelled WHERE role_category IS NOT NULL""")
def labelled_postings_(spark, sf_dir):
    bands = [PatternRule("senior", "src1"), PatternRule("junior", "2")]
    posts = labelled_postings(_raw_posts(spark, sf_dir), "doc_id", roles=_LANG_RULES, seniority=bands)
    return posts.select(
        "job_title",
        "role_category",
        "seniority",
        "company",
        "state",
        "company_rating",
        "description_length",
        F.md5("description").alias("description_md5"),
    )


@query(_LABELLED_SQL + """
SELECT 'raw' AS stage, count(*) AS rows FROM documents
UNION ALL SELECT 'cleaned', count(*) FROM cleaned WHERE length(description) >= 150
UNION ALL SELECT 'deduplicated', count(*) FROM kept
UNION ALL SELECT 'labelled', count(role_category) FROM labelled""")
def stage_report_(spark, sf_dir):
    return stage_report(_raw_posts(spark, sf_dir), "doc_id", roles=_LANG_RULES)


@query(f"""
WITH kept AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY job_title, source, lang ORDER BY doc_id) AS copy
    FROM (SELECT doc_id, {TITLE} AS job_title, source, lang, n_chars, text FROM documents)) WHERE copy = 1)
SELECT job_title, source AS company, n_chars AS views,
  CASE WHEN contains(lower(job_title), 'the') AND contains(lower(job_title), 'and') THEN 'both'
       WHEN contains(lower(job_title), 'les') THEN 'les' ELSE 'Other' END AS role_category,
  {flags_sql("lower(job_title || ' ' || source || ' ' || text)")}
FROM kept""")
def tagged_postings_(spark, sf_dir):
    none = F.lit(None).cast("string")
    raw = texts(spark, sf_dir).select(
        "doc_id",
        title().alias("job_title"),
        F.col("source").alias("company"),
        F.col("lang").alias("city"),
        none.alias("state"),
        none.alias("location"),
        none.alias("post_date"),
        F.col("n_chars").alias("views"),
        F.col("source").alias("summary"),
        F.col("text").alias("body"),
    )
    rules = [KeywordRule("both", [["the"], ["and"]]), KeywordRule("les", [["les"]])]
    tagged = tagged_postings(raw, "doc_id", TAXONOMY, rules)
    return tagged.select("job_title", "company", "views", "role_category", *FLAGS)


@query("""
SELECT lang || ' ' || source AS job_title, lang AS role_category, source AS company,
  NULL AS location, CAST(length(text) AS INTEGER) AS description_length, md5(text) AS description_md5,
  CAST(n_chars AS DOUBLE) AS company_rating, 'base' AS source
FROM documents
UNION ALL
SELECT role, CASE role WHEN 'user' THEN 'asked' WHEN 'assistant' THEN 'answered' ELSE 'told' END, 'c' || conv_id, 't' || turn,
  CAST(length(text) AS INTEGER), md5(text), NULL, 'fresh'
FROM conversations""")
def build_corpus(spark, sf_dir):
    base = texts(spark, sf_dir).select(
        F.concat("lang", F.lit(" "), "source").alias("job_title"),
        F.col("lang").alias("role_category"),
        F.col("source").alias("company"),
        F.lit(None).cast("string").alias("location"),
        F.col("n_chars").cast("double").alias("company_rating"),
        F.length("text").alias("description_length"),
        F.col("text").alias("description"),
    )
    fresh = table(spark, sf_dir, "conversations").select(
        F.col("role").alias("job_title"),
        F.col("role").alias("category"),
        F.concat(F.lit("c"), "conv_id").alias("company"),
        F.concat(F.lit("t"), "turn").alias("location"),
        F.col("text").alias("description_text"),
    )
    roles = {"user": "asked", "assistant": "answered", "system": "told"}
    corpus = op.build_corpus(base, fresh, roles, "base", "fresh")
    return corpus.withColumn("description_md5", F.md5("description")).drop("description")
