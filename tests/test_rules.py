"""Rule tables: one case per branch, and the over-matches that are part of the rules."""

import random
import re

import pytest
from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import functions as F

from tessella import operators as op
from tessella.functions import (
    clean_text,
    extract_first_int,
    label_by_keywords,
    label_by_regex,
    parse_timestamp_utc,
    seniority_band,
    text_length,
    tokens,
    with_bigrams,
    word_count,
)
from tessella.rules import (
    CATEGORY_ROLES,
    DEGREE_PATTERNS,
    KEYWORD_DEFAULT,
    KEYWORD_ROLES,
    PATTERN_ROLES,
    POSTING_SKILLS,
    ROLE_TAXONOMY,
    SENIORITY_RULES,
    STOP_WORDS,
    TITLE_ECHOES,
    YEARS_PATTERN,
)


def apply(spark, values, column):
    """``column`` of each value, in order."""
    rows = spark.createDataFrame(list(enumerate(values)), "i int, t string")
    return [r.out for r in rows.select("i", column(F.col("t")).alias("out")).orderBy("i").collect()]


def test_keyword_roles(spark):
    titles = [
        "Database Engineer", "Data Scientist / Engineer", "Senior Scientist", "Head of Data Science",
        "Business Analyst", "Web Analytics Lead", "Software Engineer", "Plumber", None,
    ]
    got = apply(spark, titles, lambda c: label_by_keywords(c, KEYWORD_ROLES, KEYWORD_DEFAULT))
    assert got == [
        "Data Engineer", "Data Engineer", "Data Scientist", "Data Scientist",
        "Data Analyst", "Data Analyst", "Other", "Other", "Other",
    ]


def test_pattern_roles(spark):
    cases = {
        "Data Scientist, Machine Learning": "ai_ml_engineer",
        "AI Engineer II": "ai_ml_engineer",
        "Retail Engineer": None,
        "Big Data Engineer": "data_engineer",
        "Analytics Engineer": "data_engineer",
        "DATA SCIENTIST": "data_scientist",
        "Data Science Manager": None,
        "Data Science Manager / Data Analyst": "data_analyst",
        "Data Science VP": None,
        "Business Analyst": None,
        "BI Analyst": "data_analyst",
        None: None,
    }
    assert apply(spark, cases, lambda c: label_by_regex(c, PATTERN_ROLES)) == list(cases.values())


def test_seniority(spark):
    cases = {
        "Internal Auditor": "junior", "Leading Analyst": "senior", "Sr Analyst": "mid",
        "Sr. Analyst": "senior", "Head of Data": "senior", "Jr. Analyst": "junior",
        "Junior Lead": "senior", "Analyst": "mid",
    }
    assert apply(spark, cases, lambda c: seniority_band(c, SENIORITY_RULES)) == list(cases.values())


def test_question_routes(spark):
    asked = ["a business analyst?", "anything", "Data Engineer", "a GenAI engineer", "data scientist"]
    rows = spark.createDataFrame([(i, q) for i, q in enumerate(asked)], "i int, q string")
    got = [r.category for r in op.route_query(rows, "q").orderBy("i").collect()]
    assert got == ["data_analyst", "data_scientist", "data_engineer", "ai_ml_engineer", "data_scientist"]


def test_map_category_refuses_unknown_keys(spark):
    known = spark.createDataFrame([(k,) for k in CATEGORY_ROLES], "c string")
    got = {r.c: r.role for r in op.map_category(known, "c", CATEGORY_ROLES, "role").collect()}
    assert got == CATEGORY_ROLES
    for bad in ["Chef", None]:
        rows = spark.createDataFrame([(bad,)], "c string")
        with pytest.raises(Exception, match="without a mapping"):
            op.map_category(rows, "c", CATEGORY_ROLES, "role").collect()


def python_clean(text):
    t = re.sub(r"http\S+", " ", (text or "").replace("\xa0", " "))
    return re.sub(r"\s+", " ", t).strip()


SPACES = "".join(map(chr, [9, 10, 13, 28, 31, 32, 0x85, 0xA0, 0x1680, 0x2003, 0x2028, 0x3000]))


def random_texts(seed, n=150):
    rng = random.Random(seed)
    words = [
        "http", "https://a.b/c?d=1", "http://x", "SQL", "nosql", "R&D", "r", "Data", "scalable",
        "excellent", "digit", "git", "jobs", "systems", "M.S.", "b.s", "Ph.D", "PhD.", "MSc",
        "fulfillment", "llm", "c++", "a/b", "testing", "3-5", "years", "of", "experience", "10+",
        "power", "bi", "PowerBI", "visualisation", "java", "javascript", "éjava", "javaé", "_git",
        "git_", "machine", "learning", "api", "rapi", "dbt", "Straße", "İ", "ſql", "api.", "the",
    ]
    glue = [" ", "  ", "\n", "-", ". ", ""] + list(SPACES)
    texts = ["", " ", "http", "100 years of experience", "5 years experience", "3 to 5 years experience"]
    for _ in range(n):
        texts.append("".join(rng.choice(words) + rng.choice(glue) for _ in range(rng.randint(1, 12))))
    return texts


def test_clean_text_agrees_with_python(spark):
    texts = random_texts(1) + [None]
    assert apply(spark, texts, clean_text) == [python_clean(t) for t in texts]


def test_word_count_and_length_agree_with_python(spark):
    texts = random_texts(2) + ["😀 a"]
    assert apply(spark, texts, word_count) == [len(t.split()) for t in texts]
    assert apply(spark, texts, text_length) == [len(t) for t in texts]


def test_years_agree_with_python(spark):
    texts = random_texts(3) + ["3-5 years of experience", "none"]

    def python(t):
        found = re.search(YEARS_PATTERN, t, re.I)
        return int(found.group(1)) if found else 0

    got = apply(spark, texts, lambda c: extract_first_int(c, YEARS_PATTERN))
    assert got == [python(t) for t in texts]
    assert python("100 years of experience") == 0


@pytest.mark.parametrize("taxonomy", [ROLE_TAXONOMY, POSTING_SKILLS], ids=["grouped", "flat"])
def test_flags_agree_with_python(spark, taxonomy):
    texts = random_texts(4, 300)
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = {r.i: r for r in op.tag_flags(rows, ["t"], taxonomy).collect()}
    for i, text in enumerate(texts):
        for e in taxonomy:
            expected = int(bool(re.search(e.pattern, text.lower(), re.I)))
            assert got[i]["skill_" + e.name] == expected, (text, e)


def test_over_matches(spark):
    text = "fulfillment scalable excellent digit R&D jobs systems"
    rows = spark.createDataFrame([(text,)], "t string")
    row = op.engineered_features(rows, "t").first()
    for name in ["llm", "scala", "excel", "git", "r_lang"]:
        assert row["skill_" + name] == 1
    assert (row.mentions_bachelor, row.mentions_master, row.mentions_phd) == (1, 1, 0)
    assert row.n_skills_total == 5
    assert (row.group_lang_core_count, row.group_ml_ds_count) == (2, 1)
    bounded = op.tag_flags(rows, ["t"], ROLE_TAXONOMY, bounded=True).first()
    assert bounded.skill_llm == bounded.skill_excel == 0 and bounded.skill_r_lang == 1


def test_degrees_agree_with_python(spark):
    texts = random_texts(5)
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    for r in op.degree_flags(rows, "t").collect():
        for name, pattern in DEGREE_PATTERNS.items():
            assert r[name] == int(bool(re.search(pattern, r.t.lower(), re.I))), r.t


def test_engineered_names(spark):
    names = op.engineered_names()
    assert len(names) == 68 and len(ROLE_TAXONOMY) == 56 and len(POSTING_SKILLS) == 30
    rows = spark.createDataFrame([("x",)], "t string")
    assert op.engineered_features(rows, "t").columns == ["t", *names]


def test_strip_label_echo_agrees_with_python(spark):
    text = "Data Scientists and DATA SCIENCE; data engineering, ML engineer; data analyst"
    rows = spark.createDataFrame([(text, label) for label in [*TITLE_ECHOES, "chef"]], "t string, y string")
    for r in op.strip_label_echo(rows, "t", "y", TITLE_ECHOES, "s").collect():
        expected = text
        for p in TITLE_ECHOES.get(r.y, []):
            expected = re.sub(p, " ", expected, flags=re.I)
        assert r.s == expected
    counted = op.echo_change_count(op.strip_label_echo(rows, "t", "y", TITLE_ECHOES, "s"), "t", "s")
    assert counted.first().asDict() == {"n_changed": 4, "n_rows": 5}


def test_tokens_agree_with_python(spark):
    texts = random_texts(6)
    stops = set(STOP_WORDS)
    expected = [[w for w in re.findall(r"\b\w\w+\b", t.lower()) if w not in stops] for t in texts]
    skip = [i for i, t in enumerate(texts) if "İ" in t]  # lower-cases to a combining mark
    got = apply(spark, texts, lambda c: tokens(c, STOP_WORDS))
    pairs = apply(spark, texts, lambda c: with_bigrams(tokens(c, STOP_WORDS)))
    for i, words in enumerate(expected):
        if i not in skip:
            assert got[i] == words
            assert pairs[i] == words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def test_stop_words_are_sparks_default(spark):
    default = StopWordsRemover.loadDefaultStopWords("english")
    assert set(STOP_WORDS) == {w for w in default if re.fullmatch(r"\w\w+", w)}


def test_parse_timestamp_ignores_the_session_zone(spark):
    cases = {
        "2016-04-27": 1461715200, "2016-04-27 10:00:00": 1461751200, "2016-04-27T10:00:00Z": 1461751200,
        "2016-04-27T10:00:00+02:00": 1461744000, "2016-04-27 10:00:00 UTC": 1461751200,
        "soon": None, "": None, None: None,
    }
    for zone in ["UTC", "America/New_York"]:
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            got = apply(spark, cases, lambda c: F.unix_seconds(parse_timestamp_utc(c)))
            days = apply(spark, ["27/04/2016 10:00", "x"], lambda c: F.unix_seconds(parse_timestamp_utc(c, "dd/MM/yyyy HH:mm")))
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
        assert got == list(cases.values())
        assert days == [1461751200, None]
