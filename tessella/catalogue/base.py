"""Registry of queries, table loading, and rules that fit the sample tables.

The sample texts hold no job vocabulary, so the rules here name words they do hold.
Language stands in for the role category, source for the company, the first line of a
text for its title.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.labels import KeywordRule, PatternRule
from ..rules import STOP_WORDS, Entry
from ..session import spread

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
#: Jobs kept apart from the queries: none, those of published size are queries too.
PUBLISHED: dict[str, Query] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, with the SQL that must agree with it.

    A trailing underscore keeps the function apart from the operator it calls.
    """

    def register(fn: Query) -> Query:
        name = fn.__name__.rstrip("_")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents spread over the cores where their files are few, for work on the texts themselves."""
    return spread(table(spark, sf_dir, "documents"))


def title() -> Column:
    return F.substring_index("text", "\n", 1)


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents under the column names of postings."""
    return texts(spark, sf_dir).select(
        "doc_id",
        title().alias("job_title"),
        F.col("lang").alias("role_category"),
        F.col("source").alias("company"),
        F.col("lang").alias("source"),
        F.col("text").alias("description"),
    )


TAXONOMY = [
    Entry("words", "llm", "llm|large language model"),
    Entry("words", "licen", "licen"),
    Entry("words", "worth", "worth"),
    Entry("words", "data", "data"),
    Entry("words", "token", "token"),
    Entry("words", "stat", "stat"),
    Entry("ends", "tion", r"tion\b"),
    Entry("ends", "ing", r"ing\b"),
    Entry("ends", "the", r"\bthe\b"),
    Entry("ends", "les", r"\bles\b"),
    Entry("marks", "at_sign", "@"),
    Entry("marks", "pipe_or_plus", r"\||\+"),
    Entry("marks", "digits", r"[0-9]{3}"),
]
FLAGS = ["skill_" + e.name for e in TAXONOMY]

ROUTES = [
    KeywordRule("de", [[" der ", " die "], [" und ", " zu ", " den "]]),
    KeywordRule("fr", [[" les ", " des ", " et "]]),
    KeywordRule("es", [[" el ", " los ", " que "]]),
]
DEFAULT_ROUTE = "en"

PART_RULES = [
    KeywordRule("hot_metal", [["hot", "red"], ["ring", "bolt", "gear"]]),
    KeywordRule("cold", [["cold", "blue"]]),
    KeywordRule("sized", [["small", "large"]]),
]
PART_PATTERNS = [
    PatternRule("coloured", r"red|blue", exclude=r"ring|\bbolt\b"),
    PatternRule("aged", r"\bold\b|\bnew\b"),
    PatternRule("ring_like", r"ring|bolt"),
]
PART_BANDS = [PatternRule("senior", "old|large"), PatternRule("junior", "new|small")]

LANG_NAMES = {"en": "english", "fr": "french", "de": "german", "es": "spanish"}
ECHOES = {
    "en": [r"thes?", r"and"],
    "fr": [r"les?"],
    "de": [r"und", r"der"],
    "es": [r"de las?", r"el"],
}
AREA_CODE = r"\((\d{3})\)"

# SQL fragments. DuckDB's \b is ASCII only, so boundaries are spelled out there.
WORD = r"[\p{L}\p{N}_]"
EDGE = r"($|[^\p{L}\p{N}_])"
START = r"(^|[^\p{L}\p{N}_])"
SPACE = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"


def clean_sql(col: str) -> str:
    return (
        f"trim(regexp_replace(regexp_replace(coalesce({col}, ''), 'http[^{SPACE}]+', ' ', 'g'), "
        f"'[{SPACE}]+', ' ', 'g'), ' ')"
    )


_FLAG_SQL = {
    "llm": "contains(l, 'llm') OR contains(l, 'large language model')",
    "licen": "contains(l, 'licen')",
    "worth": "contains(l, 'worth')",
    "data": "contains(l, 'data')",
    "token": "contains(l, 'token')",
    "stat": "contains(l, 'stat')",
    "tion": f"regexp_matches(l, 'tion{EDGE}')",
    "ing": f"regexp_matches(l, 'ing{EDGE}')",
    "the": f"regexp_matches(l, '{START}the{EDGE}')",
    "les": f"regexp_matches(l, '{START}les{EDGE}')",
    "at_sign": "contains(l, '@')",
    "pipe_or_plus": "contains(l, '|') OR contains(l, '+')",
    "digits": "regexp_matches(l, '[0-9][0-9][0-9]')",
}


def flags_sql(lowered: str) -> str:
    """Flag expressions over a lower-cased text, as a select list."""
    return ", ".join(
        f"CAST(({cond.replace('(l,', '(' + lowered + ',')}) AS INTEGER) AS skill_{name}"
        for name, cond in _FLAG_SQL.items()
    )


TITLE = "split_part(text, chr(10), 1)"
FLAGGED = f"flagged AS (SELECT doc_id, lang, source, text, {flags_sql('lower(text)')} FROM documents)"


def unpivot_sql(values: str, source: str, ids: str = "", flags: list[str] = FLAGS) -> str:
    """One row per flag: ``values`` is an SQL template over ``{f}``."""
    lead = f"{ids}, " if ids else ""
    return " UNION ALL ".join(
        f"SELECT {lead}'{f}' AS flag, {values.format(f=f)} FROM {source}" for f in flags
    )


def tokens_sql(col: str) -> str:
    stops = ", ".join(f"'{w}'" for w in STOP_WORDS)
    return (
        f"list_filter(regexp_extract_all(lower({col}), '{WORD}{{2,}}'), "
        f"lambda w: NOT list_contains([{stops}], w))"
    )


def grams_sql(tokens: str) -> str:
    return (
        f"list_concat({tokens}, list_transform(range(1, len({tokens})), "
        f"lambda i: {tokens}[i] || ' ' || {tokens}[i + 1]))"
    )


def counts_sql(name: str, source: str, ids: str, text: str = "text") -> str:
    """CTEs ending in ``name(ids.., term, tf)`` over words and word pairs."""
    return (
        f"{name}_tok AS (SELECT {ids}, {tokens_sql(text)} AS tok FROM {source}), "
        f"{name}_all AS (SELECT {ids}, unnest({grams_sql('tok')}) AS term FROM {name}_tok), "
        f"{name} AS (SELECT {ids}, term, count(*) AS tf FROM {name}_all GROUP BY ALL)"
    )


def route_sql(col: str) -> str:
    l = f"lower({col})"

    def any_of(words):
        return "(" + " OR ".join(f"contains({l}, '{w}')" for w in words) + ")"

    branches = " ".join(
        f"WHEN {' AND '.join(any_of(words) for words in r.all_of)} THEN '{r.label}'" for r in ROUTES
    )
    return f"CASE {branches} ELSE '{DEFAULT_ROUTE}' END"
