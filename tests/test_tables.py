"""Sources, cleaning steps, count tables and the two dataset plans."""

import csv
import json
import random

import pytest
from pyspark.sql import Row, functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from tessella import operators as op
from tessella.plans import labelled_postings, stage_report, tagged_postings
from tessella.sources import (
    pieces,
    normalise_columns,
    read_postings_csv,
    read_postings_json,
    write_metrics,
    write_table,
)


def test_csv_cells_with_newlines_quotes_and_missing_values(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text('id,Job Title,Rating\n1,"a ""b""\nc, d",3.5\n2,NA,\n3,,n/a\n', encoding="utf8")
    schema = StructType([
        StructField("id", LongType()), StructField("Job Title", StringType()),
        StructField("Rating", DoubleType()),
    ])
    df = normalise_columns(read_postings_csv(spark, str(path), schema, ordinal="row"), {"Job Title": "job_title"})
    got = [(r.id, r.job_title, r.Rating) for r in df.orderBy("row").collect()]
    assert got == [(1, 'a "b"\nc, d', 3.5), (2, None, None), (3, None, None)]


def test_json_array_file_and_array_lines(spark, tmp_path):
    rows = [{"job_title": f"t{i}", "category": "x"} for i in range(3)]
    schema = "job_title string, category string"
    schema = spark.createDataFrame([], schema).schema
    whole = tmp_path / "whole.json"
    whole.write_text(json.dumps(rows, indent=1))
    assert read_postings_json(spark, str(whole), schema).count() == 3
    lines = tmp_path / "lines.json"
    lines.write_text(json.dumps(rows) + "\n" + json.dumps(rows[:1]))
    assert read_postings_json(spark, str(lines), schema, lines=True).count() == 4


@pytest.fixture
def small_splits(spark):
    """Splits of a few bytes, so that every kind of edge falls on one."""
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]
    old = {n: spark.conf.get(n) for n in names}

    def use(size):
        for n in names:
            spark.conf.set(n, str(size))

    yield use
    for n, value in old.items():
        spark.conf.set(n, value)


@pytest.mark.parametrize("size", [15, 40, 1_000])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_csv_in_many_splits_reads_as_in_one_task(spark, tmp_path, small_splits, size, end):
    rng = random.Random(size)
    words = ["a", '"', ",", "\n", "é", "bc d", "\n\n", '""', "5' pipe", "NA", "", '",\n"']
    rows = [(str(i), *["".join(rng.choice(words) for _ in range(rng.randrange(5))) for _ in range(2)]) for i in range(14)]
    rows.append(("14", "x" * 60 + "\n" * 20 + '"', "end"))
    (tmp_path / "in").mkdir()
    for name, part in (("b.csv", rows[9:]), ("a.csv", rows[:9])):
        with open(tmp_path / "in" / name, "w", newline="", encoding="utf8") as out:
            writer = csv.writer(out, lineterminator=end)
            writer.writerow(["id", "left,\n", 'ri"ght'])
            writer.writerows(part[:5])
            out.write(end)
            writer.writerows(part[5:])
    schema = StructType([StructField("id", LongType()), StructField("x", StringType()), StructField("y", StringType())])
    small_splits(size)
    got = read_postings_csv(spark, str(tmp_path / "in"), schema, missing=["NA"], ordinal="row").orderBy("row").collect()
    empty = lambda t: None if t in ("", "NA") else t
    assert [tuple(r) for r in got] == [(int(i), empty(x), empty(y), n) for n, (i, x, y) in enumerate(rows)]
    if end == "\n":  # the plain reader takes the line feed in the header's cell for the line end
        plain = spark.read.schema(schema).options(header=True, multiLine=True, quote='"', escape='"').csv(str(tmp_path / "in"))
        assert [tuple(r)[:3] for r in got] == sorted((r.id, empty(r.x), empty(r.y)) for r in plain.collect())


def test_csv_quotes_inside_bare_cells(spark, tmp_path, small_splits):
    path = tmp_path / "raw.csv"
    path.write_text('id,x\n1,5" pipe\n2,"a\nb"\n3,c"d"\n4,"e ""f"" \n,\n g"\n', encoding="utf8")
    schema = StructType([StructField("id", LongType()), StructField("x", StringType())])
    plain = spark.read.schema(schema).options(header=True, multiLine=True, quote='"', escape='"').csv(str(path)).collect()
    assert len(plain) == 4
    for size in (9, 1_000):
        small_splits(size)
        got = read_postings_csv(spark, str(path), schema, missing=[])
        assert sorted(got.collect()) == sorted(plain)


@pytest.mark.parametrize("indent", [None, 1])
@pytest.mark.parametrize("size", [12, 50, 5_000])
def test_json_array_in_many_splits_reads_as_in_one_task(spark, tmp_path, small_splits, size, indent):
    rng = random.Random(size)
    words = ["a", "}", "{", '"', "\\", "]", "[", ",", "\n", "é", '"}', "\\}", '{"t": 1}']
    rows = [
        {"t": "".join(rng.choice(words) for _ in range(rng.randrange(7))), "deep": {"n": i, "l": [{"m": "}"}] * rng.randrange(3)}}
        for i in range(12)
    ]
    (tmp_path / "in").mkdir()
    for name, part in (("a.json", rows[:8]), ("b.json", rows[8:]), ("c.json", []), ("d.json", {"t": "one", "deep": {"n": 99, "l": []}})):
        (tmp_path / "in" / name).write_text(json.dumps(part, indent=indent, ensure_ascii=False), encoding="utf8")
    schema = spark.createDataFrame([], "t string, deep struct<n:int,l:array<struct<m:string>>>").schema
    small_splits(size)
    got = read_postings_json(spark, str(tmp_path / "in"), schema).collect()
    want = [*rows, {"t": "one", "deep": {"n": 99, "l": []}}]
    assert sorted((r.t, r.deep.n, len(r.deep.l)) for r in got) == sorted((r["t"], r["deep"]["n"], len(r["deep"]["l"])) for r in want)


def test_one_file_is_read_in_many_tasks(spark, tmp_path, small_splits):
    path = tmp_path / "raw.csv"
    path.write_text("id,x\n" + "".join(f'{i},"line\nand ""more"""\n' for i in range(5_000)), encoding="utf8")
    small_splits(10_000)
    found = pieces.records(spark, str(path), pieces.CsvLines)
    assert found.count() == 5_001
    assert pieces._pieces(spark, str(path), pieces.CsvLines).rdd.getNumPartitions() > 8


def test_sinks_overwrite(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "x int, y string")
    for _ in range(2):
        write_table(df, str(tmp_path / "t"), ["y"])
        write_metrics({"m": df}, str(tmp_path / "metrics"))
    assert spark.read.parquet(str(tmp_path / "t")).collect() == [Row(y="a")]
    assert spark.read.json(str(tmp_path / "metrics" / "m")).count() == 1


def test_dedupe_keeps_the_first_and_treats_missing_as_equal(spark):
    rows = [(5, "a", None), (2, "a", None), (3, "a", "x"), (4, "A", None), (1, "b", None), (9, "b", None)]
    df = spark.createDataFrame(rows, "i int, t string, c string")
    kept = op.dedupe_keep_first(df, ["t", "c"], "i")
    assert sorted(r.i for r in kept.collect()) == [1, 2, 3, 4]
    again = op.dedupe_keep_first(kept.repartition(3), ["t", "c"], "i")
    assert sorted(again.collect()) == sorted(kept.collect())
    assert op.dedupe_report(df, ["t", "c"]).first() == Row(rows_before=6, rows_after=4, dropped=2)


def test_dedupe_limits_copies_before_the_shuffle(spark):
    df = spark.createDataFrame([(1, "a")], "i int, t string")
    plan = op.dedupe_keep_first(df, ["t"], "i")._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_missing_and_short_texts(spark):
    df = spark.createDataFrame([("a" * 150, 1), ("a" * 149, 2), (None, 3)], "t string, i int")
    assert [r.i for r in op.min_length_filter(df, "t", 150).collect()] == [1]
    assert op.drop_missing(df, ["t"]).count() == 2
    assert op.fill_missing_text(df, ["t"]).where("t = ''").count() == 1


def test_first_copy_decides_the_label(spark):
    text = "word " * 40
    raw = spark.createDataFrame(
        [(1, "Plumber", text), (2, "Data Analyst", text + " \n"), (3, "Sr. Data Engineer", text + "x"),
         (4, "Data Engineer", "short"), (5, None, text + "y"), (6, "Data Scientist", "http://a " + text + "z")],
        "i int, `Job Title` string, `Job Description` string",
    )
    for name in ["Company Name", "Location", "City", "State"]:
        raw = raw.withColumn(name, F.lit("c"))
    for name in ["SalaryMin", "SalaryMax", "Rating"]:
        raw = raw.withColumn(name, F.lit(None).cast("double"))
    out = {r.job_title: r for r in labelled_postings(raw, "i").collect()}
    assert set(out) == {"Sr. Data Engineer", "Data Scientist"}
    assert out["Sr. Data Engineer"].seniority == "senior"
    assert out["Data Scientist"].description_length == len(text + "z")
    assert out["Data Scientist"].description.startswith("word")
    stages = {r.stage: r.rows for r in stage_report(raw, "i").collect()}
    assert stages == {"raw": 6, "cleaned": 4, "deduplicated": 3, "labelled": 2}


def test_tagged_postings(spark):
    raw = spark.createDataFrame(
        [(1, "Data Analyst", "c", "x", "SQL", None, "2016-04-08"), (2, "Data Analyst", "c", "x", "R", "y", "bad"),
         (3, "Chef", "c", None, None, "machine learning", None)],
        "i int, job_title string, company string, city string, summary string, body string, post_date string",
    ).withColumns({"state": F.lit("s"), "location": F.lit("l"), "views": F.lit(1)})
    out = {r.job_title: r for r in tagged_postings(raw, "i").collect()}
    assert (out["Data Analyst"].skill_sql, out["Data Analyst"].skill_r_lang) == (1, 0)
    assert out["Data Analyst"].post_date_parsed is not None
    assert (out["Chef"].role_category, out["Chef"].skill_machine_learning) == ("Other", 1)


def test_build_corpus_keeps_base_columns_and_fresh_texts(spark):
    base = spark.createDataFrame(
        [("t", "data_analyst", "mid", 4.5, 3, "abc")],
        "job_title string, role_category string, seniority string, company_rating double, "
        "description_length int, description string",
    ).withColumns({"company": F.lit("c"), "location": F.lit("l")})
    fresh = spark.createDataFrame(
        [("f", "co", "lo", "AI Engineer", "u", "d", " a\nb ")],
        "job_title string, company string, location string, category string, source_url string, "
        "date_posted string, description_text string",
    )
    rows = {r.source: r for r in op.build_corpus(base, fresh).collect()}
    new = rows["live_careers_page_2026"]
    assert (new.role_category, new.description, new.description_length) == ("ai_ml_engineer", " a\nb ", 5)
    assert new.seniority is None and new.company_rating is None
    assert rows["part3_corpus"].seniority == "mid"


def test_percent_rounds_half_to_even(spark):
    df = spark.createDataFrame(
        [("a", int(i < 1), int(i < 3)) for i in range(8)] + [("b", 0, 0)], "k string, f int, g int"
    )
    got = {(r.k, r.flag): (r.pct, r.n, r.n_rows) for r in op.skill_frequencies(df, ["k"], ["f", "g"]).collect()}
    assert got == {("a", "f"): (12, 1, 8), ("a", "g"): (38, 3, 8)}


def test_value_counts_leave_out_missing(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "c string")
    assert [tuple(r) for r in op.value_counts(df, "c").collect()] == [("a", 2), ("b", 1)]
    assert [tuple(r) for r in op.value_shares(df, "c").collect()] == [("a", 66.7), ("b", 33.3)]


def test_gaps_and_eligibility(spark):
    rates = spark.createDataFrame(
        [("ds", "sql", 40.0), ("da", "sql", 60.0), ("ds", "r", 5.0), ("da", "r", 1.0), ("x", "r", 99.0)],
        "group string, flag string, pct double",
    )
    gap = op.rate_gap(rates, "ds", "da")
    assert {r.flag: r.gap for r in gap.collect()} == {"sql": -20.0, "r": 4.0}
    old = spark.createDataFrame([("sql", 6.0), ("r", 58.0)], "flag string, gap double")
    assert {r.flag: r.verdict for r in op.gap_shift(old, gap).collect()} == {"sql": "reversed", "r": "holds"}
    flags = spark.createDataFrame([(int(i < 15), int(i < 14)) for i in range(30)], "f int, g int")
    assert [tuple(r) for r in op.class_balance_eligibility(flags, ["f", "g"]).collect()] == [("f", 15, 15)]


def test_pattern_inflation(spark):
    df = spark.createDataFrame([("fulfillment",), ("an LLM here",), (None,)], "t string")
    assert [tuple(r) for r in op.pattern_inflation(df, "t", ["llm"]).collect()] == [("llm", 2, 1)]
