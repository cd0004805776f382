"""Taxonomies, label rules, phrases and thresholds for job postings.

Results only agree with the published tables when these agree, so they are stated
here as data. Every operator takes them as parameters.
"""

from __future__ import annotations

from typing import NamedTuple

from .functions.labels import KeywordRule, PatternRule


class Entry(NamedTuple):
    """One taxonomy entry: a flag ``name`` set where ``pattern`` is found."""

    group: str
    name: str
    pattern: str


# Flat skill dictionary, searched in title + summary + body.
POSTING_SKILLS = [
    Entry("skills", name, pattern)
    for name, pattern in [
        ("python", r"\bpython\b"),
        ("r_lang", r"\bR\b"),
        ("sql", r"\bsql\b"),
        ("java", r"\bjava\b"),
        ("scala", r"\bscala\b"),
        ("excel", r"\bexcel\b"),
        ("tableau", r"\btableau\b"),
        ("power_bi", r"power\s?bi"),
        ("sas", r"\bsas\b"),
        ("spss", r"\bspss\b"),
        ("hadoop", r"\bhadoop\b"),
        ("spark", r"\bspark\b"),
        ("aws", r"\baws\b"),
        ("azure", r"\bazure\b"),
        ("machine_learning", r"machine learning"),
        ("deep_learning", r"deep learning"),
        ("statistics", r"statistic"),
        ("data_mining", r"data mining"),
        ("predictive_modeling", r"predictive model"),
        ("data_visualization", r"data visuali[sz]ation"),
        ("big_data", r"big data"),
        ("nlp", r"natural language processing|\bnlp\b"),
        ("communication", r"communication"),
        ("presentation", r"presentation"),
        ("business_intelligence", r"business intelligence|\bbi\b"),
        ("ab_testing", r"a/b test"),
        ("regression", r"regression"),
        ("nosql", r"nosql"),
        ("git", r"\bgit\b"),
        ("agile", r"\bagile\b"),
    ]
]

# Grouped taxonomy over the description, 6 + 15 + 19 + 11 + 5 entries.
ROLE_TAXONOMY = [
    Entry(group, name, pattern)
    for group, entries in [
        ("lang_core", [
            ("python", "python"), ("sql", "sql"), ("r_lang", r"\br\b"),
            ("scala", "scala"), ("java", r"java\b"), ("cpp", r"c\+\+"),
        ]),
        ("ml_ds", [
            ("machine_learning", "machine learning"), ("deep_learning", "deep learning"),
            ("tensorflow", "tensorflow"), ("pytorch", "pytorch"),
            ("scikit_learn", "scikit-learn"), ("keras", "keras"), ("nlp", "nlp"),
            ("computer_vision", "computer vision"), ("neural_network", "neural network"),
            ("xgboost", "xgboost"), ("statistics", "statistics"),
            ("ab_testing", "a/b testing"), ("regression", "regression"),
            ("classification_model", "classification model"),
            ("llm", "llm|large language model"),
        ]),
        ("data_eng", [
            ("spark", "spark"), ("hadoop", "hadoop"), ("kafka", "kafka"),
            ("airflow", "airflow"), ("etl", "etl"), ("data_warehouse", "data warehouse"),
            ("snowflake", "snowflake"), ("dbt", r"dbt\b"), ("kubernetes", "kubernetes"),
            ("docker", "docker"), ("aws", "aws"), ("azure", "azure"),
            ("gcp", "gcp|google cloud"), ("redshift", "redshift"),
            ("databricks", "databricks"), ("nosql", "nosql"), ("mongodb", "mongodb"),
            ("data_pipeline", "data pipeline"), ("data_lake", "data lake"),
        ]),
        ("bi_analyst", [
            ("tableau", "tableau"), ("power_bi", "power bi"), ("excel", "excel"),
            ("looker", "looker"), ("sql_server", "sql server"),
            ("data_visualization", "data visualization"), ("dashboard", "dashboard"),
            ("google_analytics", "google analytics"), ("kpi", "kpi"),
            ("stakeholder", "stakeholder"), ("reporting", "reporting"),
        ]),
        ("eng_general", [
            ("git", r"git\b"), ("linux", "linux"), ("agile", "agile"),
            ("api", r"api\b"), ("ci_cd", "ci/cd"),
        ]),
    ]
    for name, pattern in entries
]

# Degree mentions and years of experience.
DEGREE_PATTERNS = {
    "mentions_bachelor": r"bachelor|b\.?s\.?\b|undergraduate degree",
    "mentions_master": r"master|m\.?s\.?\b|msc\b",
    "mentions_phd": r"ph\.?d|doctorate",
}
YEARS_PATTERN = r"(\d{1,2})\+?\s*(?:-\s*\d{1,2}\s*)?years?\s+(?:of\s+)?experience"

# Role from the title by substrings; the default label is "Other".
KEYWORD_ROLES = [
    KeywordRule("Data Engineer", [["engineer"], ["data"]]),
    KeywordRule("Data Scientist", [["scientist", "data science"]]),
    KeywordRule("Data Analyst", [["analyst", "analytics"]]),
]
KEYWORD_DEFAULT = "Other"

# Role from the title by pattern, first match wins.
PATTERN_ROLES = [
    PatternRule(
        "ai_ml_engineer",
        r"machine learning|ml engineer|\bai engineer\b|artificial intelligence engineer|"
        r"deep learning|nlp engineer|computer vision engineer",
    ),
    PatternRule(
        "data_engineer",
        r"data engineer|big data engineer|etl developer|etl engineer|analytics engineer",
    ),
    PatternRule(
        "data_scientist",
        r"data scientist|data science",
        exclude=r"manager|director|vp\b|vice president",
    ),
    PatternRule(
        "data_analyst",
        r"data analyst|business intelligence analyst|\bbi analyst\b|analytics analyst",
    ),
]

# Seniority from the title; the default band is "mid".
SENIORITY_RULES = [
    PatternRule("senior", r"senior|sr\.|lead|principal|staff|head of"),
    PatternRule("junior", r"junior|jr\.|intern|entry"),
]

# Source category of a fresh posting to role.
CATEGORY_ROLES = {
    "AI Engineer": "ai_ml_engineer",
    "Machine Learning Engineer": "ai_ml_engineer",
    "Data Engineer": "data_engineer",
    "Data Analyst": "data_analyst",
    "Data Scientist": "data_scientist",
}

# Where a corpus row comes from.
BASE_SOURCE = "part3_corpus"
FRESH_SOURCE = "live_careers_page_2026"

# Role a question is about; the default role is "data_scientist".
QUESTION_ROUTES = [
    KeywordRule("ai_ml_engineer", [[
        "ai engineer", "ai/ml engineer", "ml engineer", "machine learning engineer",
        "genai engineer",
    ]]),
    KeywordRule("data_engineer", [["data engineer"]]),
    KeywordRule("data_analyst", [["data analyst", "business analyst", "bi analyst"]]),
    KeywordRule("data_scientist", [["data scientist"]]),
]
QUESTION_DEFAULT = "data_scientist"

# Phrases by which a description repeats its own title.
TITLE_ECHOES = {
    "data_scientist": [r"data scientists?", r"data sciences?"],
    "data_analyst": [r"data analysts?"],
    "data_engineer": [r"data engineers?", r"data engineerings?"],
    "ai_ml_engineer": [r"machine learning engineers?", r"ml engineers?", r"ai engineers?"],
}

# Raw posting headers to column names.
RAW_HEADERS = {
    "Job Title": "job_title",
    "Job Description": "description_raw",
    "Company Name": "company",
    "Location": "location",
    "City": "city",
    "State": "state",
    "SalaryMin": "salary_min",
    "SalaryMax": "salary_max",
    "Rating": "company_rating",
}

# Cells read as missing.
MISSING_CELLS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Spark's default English stop words, as far as the token pattern can
# produce them (two or more word characters, no apostrophe).
STOP_WORDS = (
    "me my myself we our ours ourselves you your yours yourself yourselves he him his "
    "himself she her hers herself it its itself they them their theirs themselves what "
    "which who whom this that these those am is are was were be been being have has had "
    "having do does did doing an the and but if or because as until while of at by for "
    "with about against between into through during before after above below to from up "
    "down in out on off over under again further then once here there when where why how "
    "all any both each few more most other some such no nor not only own same so than too "
    "very can will just don should now could cannot would ought"
).split()

# Shortest text kept, and the published output columns.
MIN_DESCRIPTION_CHARS = 150
TAGGED_COLUMNS = [
    "job_title", "role_category", "company", "city", "state", "location",
    "post_date_parsed", "views", "summary", "body",
]
LABELLED_COLUMNS = [
    "job_title", "role_category", "seniority", "company", "location", "city", "state",
    "company_rating", "salary_min", "salary_max", "description_length", "description",
]
