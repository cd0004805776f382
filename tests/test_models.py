"""Metrics against published numbers, and vectors, splits, learners and retrieval against brute force."""

import collections
import functools
import math
import random

import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tessella import operators as op
from tessella.operators.evaluation import per_class_scores
from tessella.operators.splits import split_quotas
from tessella.operators.retrieval import load_index
from tessella.operators.vectorise import TermTable, top_per_group
from tessella.plans import (
    Settings,
    analyse_postings,
    build_features,
    load_role_model,
    published_candidates,
    skill_cv,
    skill_loo,
    skill_prediction,
    train_and_evaluate,
    train_role_model,
)
from tessella.rules import Entry

ROLES = ["ai_ml_engineer", "data_analyst", "data_engineer", "data_scientist"]
PUBLISHED_CM = [[69, 4, 11, 23], [0, 414, 13, 22], [10, 16, 325, 17], [25, 23, 25, 508]]
PUBLISHED_FOLDS = {
    "MultinomialNB": [0.6122057369535356, 0.612474344927562, 0.6140558593458697, 0.620555589316814, 0.6255637869376245],
    "LinearSVM": [0.8181829161465843, 0.8217049412454135, 0.8138932851888051, 0.8164905273202896, 0.8088959532826567],
}
PUBLISHED_F1 = [
    0.7115, 0.5882, 0.4419, 0.5070, 0.4118, 0.3871, 0.4835, 0.4211, 0.6667, 0.7692, 0.6133, 0.3478,
    0.4889, 0.4737, 0.3492, 0.2222,
]


@pytest.fixture(scope="module")
def published_cm(spark):
    cells = [(y, p, PUBLISHED_CM[i][j]) for i, y in enumerate(ROLES) for j, p in enumerate(ROLES)]
    return spark.createDataFrame(cells, "y string, p string, n bigint")


def test_published_accuracy_and_f1(published_cm):
    row = op.accuracy_macro_weighted(published_cm).first()
    assert row.accuracy == pytest.approx(0.8744186046511628, abs=1e-12)
    assert row.macro_f1 == pytest.approx(0.8316642972045039, abs=1e-12)
    assert row.weighted_f1 == pytest.approx(0.8741211228869903, abs=1e-12)


def test_published_report(published_cm):
    got = {r.label: [round(r.precision, 3), round(r.recall, 3), round(r.f1, 3), r.support]
           for r in op.classification_report(published_cm).collect()}
    assert got == {
        "ai_ml_engineer": [0.663, 0.645, 0.654, 107],
        "data_analyst": [0.906, 0.922, 0.914, 449],
        "data_engineer": [0.869, 0.883, 0.876, 368],
        "data_scientist": [0.891, 0.874, 0.883, 581],
        "macro avg": [0.832, 0.831, 0.832, 1505],
        "weighted avg": [0.874, 0.874, 0.874, 1505],
    }


def test_published_binary_metrics(spark):
    cells = [(1, 1)] * 37 + [(0, 1)] * 28 + [(1, 0)] * 2 + [(0, 0)] * 28
    pred = spark.createDataFrame(cells, "y int, p int")
    row = op.binary_metrics(pred).first()
    assert (row.n_positive, row.n_negative) == (39, 56)
    assert [row.f1, row.precision, row.recall, row.accuracy] == pytest.approx(
        [0.7115384615384616, 0.5692307692307692, 0.9487179487179487, 0.6842105263157895]
    )
    assert op.majority_baseline(pred).first().baseline == pytest.approx(0.5894736842105264)


def test_metrics_without_positives_are_zero(spark):
    row = op.binary_metrics(spark.createDataFrame([(0, 0)], "y int, p int")).first()
    assert (row.f1, row.precision, row.recall, row.accuracy) == (0, 0, 0, 1)


def test_published_cv_summary_and_choice(spark):
    cv = spark.createDataFrame(
        [(name, i, f, s) for i, (name, folds) in enumerate(PUBLISHED_FOLDS.items()) for f, s in enumerate(folds)],
        "candidate string, position int, fold int, macro_f1 double",
    )
    summary = {r.candidate: r for r in op.cv_summary(cv).collect()}
    assert summary["MultinomialNB"].mean == pytest.approx(0.6169710634962812)
    assert summary["MultinomialNB"]["std"] == pytest.approx(0.005255681719459659)
    assert summary["LinearSVM"]["std"] == pytest.approx(0.004296958258900041)
    assert list(summary["LinearSVM"].folds) == PUBLISHED_FOLDS["LinearSVM"]
    assert op.select_best(cv).first().candidate == "LinearSVM"
    tied = cv.withColumn("macro_f1", F.lit(0.5))
    assert op.select_best(tied).first().candidate == "MultinomialNB"


def test_published_bands(spark):
    scores = spark.createDataFrame([(f"s{i}", f) for i, f in enumerate(PUBLISHED_F1)], "flag string, f1 double")
    rows = op.band_by_f1(scores).collect()
    assert collections.Counter(r.band for r in rows) == {"strong": 4, "mid": 11, "weak": 1}
    assert next(r.flag for r in rows if r.band == "strong" and r["rank"] == 1) == "s9"
    edges = spark.createDataFrame([("a", 0.6), ("b", 0.3)], "flag string, f1 double")
    assert {r.flag: r.band for r in op.band_by_f1(edges).collect()} == {"a": "strong", "b": "mid"}


def test_confusion_lists_every_cell(spark):
    pred = spark.createDataFrame([("a", "a"), ("a", "b")], "y string, p string")
    cells = {(r.y, r.p): r.n for r in op.confusion_matrix(pred, ["a", "b", "c"]).collect()}
    assert len(cells) == 9 and cells["a", "b"] == 1 and cells["c", "c"] == 0
    pct = op.confusion_pct(op.confusion_matrix(pred, ["a", "b"]))
    assert {(r.y, r.p): r.pct for r in pct.collect()}["a", "a"] == 50.0


def test_macro_f1_counts_only_classes_seen(spark):
    counts = spark.createDataFrame([("x", "a", "a", 2), ("x", "a", "b", 1)], "k string, y string, p string, n bigint")
    scores = {r.label: r.f1 for r in per_class_scores(counts, ["k"]).collect()}
    assert scores == {"a": pytest.approx(0.8), "b": 0.0}


def test_auc_equals_pair_counting(spark):
    rng = random.Random(7)
    rows = [(c, rng.choice([rng.random(), 0.25, 0.5]), int(rng.random() < 0.3)) for c in "ab" for _ in range(400)]
    got = {r.label: r for r in op.roc_auc_ovr(
        spark.createDataFrame(rows, "label string, score double, positive int")).collect()}
    expected = {}
    for c in "ab":
        pos = [s for l, s, p in rows if l == c and p]
        neg = [s for l, s, p in rows if l == c and not p]
        wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
        expected[c] = wins / len(pos) / len(neg)
        assert got[c].auc == pytest.approx(expected[c]) and got[c].support == len(pos)
    assert got["macro"].auc == pytest.approx(sum(expected.values()) / 2)
    lone = op.roc_auc_ovr(spark.createDataFrame([("a", 0.5, 1), ("b", 0.5, 1), ("b", 0.1, 0)],
                                                "label string, score double, positive int"))
    assert {r.label: r.auc for r in lone.collect()} == {"a": None, "b": 1.0, "macro": None, "weighted": None}


def test_published_quotas():
    counts = dict(zip(ROLES, [534, 2246, 1841, 2902]))
    assert list(split_quotas(counts, 0.2).values()) == [107, 449, 368, 581]


@pytest.fixture(scope="module")
def classes(spark):
    rows = [(i, "big" if i % 3 else ("mid" if i % 2 else "few")) for i in range(997)] + [(5000, "one")]
    return spark.createDataFrame(rows, "id bigint, y string")


def test_split_is_exact_and_stable(classes):
    split = op.stratified_split(classes, "y", "id")
    counts = {r.y: r.n for r in split.where("is_test").groupBy("y").agg(F.count("*").alias("n")).collect()}
    expected = split_quotas(op.class_counts(classes, "y"), 0.2)
    assert counts == {c: q for c, q in expected.items() if q}
    again = op.stratified_split(classes.repartition(7), "y", "id")
    assert sorted(split.collect()) == sorted(again.collect())
    other = op.stratified_split(classes, "y", "id", seed=1)
    assert sorted(split.collect()) != sorted(other.collect())


def test_folds_cover_and_balance(classes):
    folds = op.stratified_folds(classes, "y", "id", k=5).collect()
    assert sorted(r.id for r in folds) == sorted(r.id for r in classes.collect())
    sizes = collections.Counter((r.y, r.fold) for r in folds)
    for y in ["big", "mid", "few"]:
        per_fold = [sizes[y, f] for f in range(5)]
        assert max(per_fold) - min(per_fold) <= 1
    assert sum(sizes["one", f] for f in range(5)) == 1


def test_weights_and_labels(classes):
    weights = {r.y: r.weight for r in op.balanced_weights(classes, "y").collect()}
    n_few = classes.where("y = 'few'").count()
    assert weights["few"] == pytest.approx(998 / (4 * n_few))
    _, labels = op.index_labels(classes, "y")
    assert labels == ["big", "few", "mid", "one"]


WORDS = ["spark", "joins", "rows", "data", "skew", "merge", "cores", "plans"]


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(11)
    rows = [
        (i, "ab"[i % 2], " ".join(rng.choices(WORDS[: 6 + 2 * (i % 2)], k=rng.randint(0, 9))))
        for i in range(40)
    ]
    rows += [(100, "a", rows[0][2]), (101, "a", "unrelated words")]
    return rows, spark.createDataFrame(rows, "id bigint, g string, text string")


def grams(text):
    words = text.split()
    return collections.Counter(words + [f"{a} {b}" for a, b in zip(words, words[1:])])


def brute_tfidf(docs, vocab, sublinear):
    n = len(docs)
    df = collections.Counter(t for d in docs.values() for t in d)
    out = {}
    for i, d in docs.items():
        w = {t: (1 + math.log(c) if sublinear else c) * (math.log((1 + n) / (1 + df[t])) + 1)
             for t, c in d.items() if t in vocab}
        norm = math.sqrt(sum(x * x for x in w.values()))
        out[i] = {t: x / norm for t, x in w.items()}
    return out, df


def test_term_counts(corpus):
    rows, df = corpus
    terms = op.ngrams_1_2(op.tokenize(df, "text", []))
    got = {(r.id, r.term): r.tf for r in op.term_counts(terms, ["id"]).collect()}
    assert got == {(i, t): c for i, _, text in rows for t, c in grams(text).items()}


def test_tfidf_equals_brute_force(corpus):
    rows, df = corpus
    docs = {i: grams(text) for i, _, text in rows}
    counts = collections.Counter()
    dfs = collections.Counter(t for d in docs.values() for t in d)
    for d in docs.values():
        counts.update(d)
    fit = [t for t in counts if 3 <= dfs[t] <= 0.6 * len(docs)]
    vocab = set(sorted(fit, key=lambda t: (-counts[t], t))[:12])
    expected, _ = brute_tfidf(docs, vocab, sublinear=True)
    terms = op.ngrams_1_2(op.tokenize(df, "text", []))
    weights = op.tfidf(terms, "id", min_df=3, max_df=0.6, size=12).collect()
    got = {(r.id, r.term): r.weight for r in weights}
    assert got == pytest.approx({(i, t): w for i, d in expected.items() for t, w in d.items()})
    model = op.fit_tfidf(terms, min_df=3, max_df=0.6, size=12)
    vectors = op.as_vectors(model.transform(terms).select("id", "tfidf"), ["tfidf"]).collect()
    for r in vectors:
        assert r.tfidf.size == 12
        assert Vectors.norm(r.tfidf, 2) == pytest.approx(1 if expected[r.id] else 0)


def test_vocabulary_of_any_size_equals_brute_force(corpus):
    rows, df = corpus
    docs = {i: grams(text) for i, _, text in rows}
    vocab = {t for d in docs.values() for t in d}
    expected, _ = brute_tfidf({i: d for i, d in docs.items() if d}, vocab, sublinear=False)
    n, seen = len(docs), collections.Counter(t for d in docs.values() for t in d)
    terms = op.ngrams_1_2(op.tokenize(df, "text", []))
    model = op.fit_tfidf(terms, min_df=1, max_df=1.0, size=None, sublinear=False)
    assert isinstance(model, TermTable) and model.size == len(vocab)
    names = {r.code: r.term for r in model.vocab.collect()}
    assert [names[i] for i in range(len(vocab))] == sorted(vocab)
    for r in op.as_vectors(model.transform(terms).select("id", "tfidf"), ["tfidf"]).collect():
        raw = {t: c * (math.log((1 + n) / (1 + seen[t])) + 1) for t, c in docs[r.id].items()}
        norm = math.sqrt(sum(x * x for x in raw.values())) or 1
        got = {names[i]: w for i, w in zip(r.tfidf.indices.tolist(), r.tfidf.values.tolist(), strict=True)}
        assert r.tfidf.size == len(vocab) and got == pytest.approx({t: x / norm for t, x in raw.items()})


def test_top_per_group_beyond_the_group_limit(spark):
    df = spark.range(6000).select((F.col("id") % 2).alias("g"), F.col("id").alias("x"))
    n = int(spark.conf.get("spark.sql.optimizer.windowGroupLimitThreshold")) + 500
    got = top_per_group(df, ["g"], [F.desc("x")], n, "x").groupBy("g").agg(
        F.count("*").alias("n"), F.min("x").alias("low"))
    assert sorted(tuple(r) for r in got.collect()) == [(0, n, 6000 - 2 * n), (1, n, 6001 - 2 * n)]


def test_standardise_uses_population_deviation(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "x double, c double")
    scaled = op.standardise(df, ["x", "c"]).transform(df).orderBy("x").collect()
    assert [tuple(r) for r in scaled] == [(-1.0, 0.0), (1.0, 0.0)]


def test_retrieval_equals_brute_force(spark, corpus):
    rows, df = corpus
    index = op.build_index(df, "id", "g", "text", size=9, stop_words=[])
    asked = [(1, "a", rows[0][2]), (2, "b", "plans cores data"), (3, "a", "nothing known"), (4, "a", "unrelated")]
    queries = spark.createDataFrame(asked, "query_id bigint, group string, text string")
    got = collections.defaultdict(list)
    for r in op.retrieve_topk(index, queries, k=7).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.doc, r.similarity))
    for qid, g, text in asked:
        docs = {i: grams(t) for i, grp, t in rows if grp == g}
        total = collections.Counter()
        for d in docs.values():
            total.update(d)
        vocab = set(sorted(total, key=lambda t: (-total[t], t))[:9])
        weights, dfs = brute_tfidf(docs, vocab, sublinear=False)
        q = {t: c * (math.log((1 + len(docs)) / (1 + dfs[t])) + 1) for t, c in grams(text).items() if t in vocab}
        norm = math.sqrt(sum(x * x for x in q.values())) or 1
        sims = {i: round(sum(w.get(t, 0) * x / norm for t, x in q.items()), 9) for i, w in weights.items()}
        expected = sorted(sims.items(), key=lambda kv: (-kv[1], kv[0]))[:7]
        assert [d for d, _ in got[qid]] == [d for d, _ in expected]
        assert [s for _, s in got[qid]] == pytest.approx([s for _, s in expected])


def exchanges(df):
    """The keys of all exchanges of the plan that Spark chose."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    return [x.split("Exchange ", 1)[1] for x in plan.split("\n") if "Exchange hash" in x]


def test_retrieval_shuffles_no_terms(spark, corpus, tmp_path):
    rows, df = corpus
    path = str(tmp_path / "docs")
    df.repartition(16, "g").write.parquet(path)
    docs = spark.read.option("maxPartitionBytes", "1k").parquet(path)
    index = op.build_index(docs, "id", "g", "text", size=9, stop_words=[])
    queries = spark.createDataFrame([(1, "a", rows[0][2]), (2, "b", "plans cores")], "query_id bigint, group string, text string")
    keys = exchanges(op.retrieve_topk(index, queries, k=3))
    assert keys and not any("term" in k for k in keys)
    scored = [k for k in keys if "doc" in k and "query_id" in k]
    assert len(scored) <= 1  # only the k best per task meet, to drop the fill's copies


def test_index_is_read_back(spark, corpus, tmp_path):
    rows, df = corpus
    index = op.build_index(df, "id", "g", "text", size=9, stop_words=[])
    index.save(str(tmp_path / "index"))
    again = load_index(spark, str(tmp_path / "index"))
    queries = spark.createDataFrame([(1, "a", rows[0][2])], "query_id bigint, group string, text string")
    assert sorted(op.retrieve_topk(again, queries).collect()) == sorted(op.retrieve_topk(index, queries).collect())


def test_large_group_vocabularies_are_joined(corpus, monkeypatch):
    df = corpus[1].withColumnRenamed("g", "group")
    terms = op.ngrams_1_2(op.tokenize(df, "text", []))
    vocab = op.build_index(df, "id", "group", "text", size=9, stop_words=[]).vocab
    in_row = {(r.id, r.term): r.weight for r in op.per_group_tfidf(terms, vocab, "group", "id").collect()}
    monkeypatch.setattr("tessella.operators.vectorise.MAX_TERMS", 3)
    joined = {(r.id, r.term): r.weight for r in op.per_group_tfidf(terms, vocab, "group", "id").collect()}
    assert in_row == pytest.approx(joined) and in_row


def test_null_classes_are_refused(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "id long, y string")
    with pytest.raises(ValueError, match="null classes"):
        op.stratified_split(df, "y", "id")


def test_quotes_sources_and_gap(spark):
    ret = spark.createDataFrame(
        [(1, 1, "t1", None, "x" * 59, 0.91234, "s"), (1, 2, "t2", "c", " " + "y" * 60 + "\nz", 0.5, "s"),
         (1, 3, "t3", None, "w" * 300, 0.4, "s")],
        "query_id int, rank int, job_title string, company string, description string, similarity double, source string")
    quotes = op.grounding_quotes(ret, n=2).orderBy("quote").collect()
    assert [(r.job_title, r.company) for r in quotes] == [("t2", "c"), ("t3", "unlisted company")]
    assert quotes[0].snippet == "y" * 60 + " z..." and quotes[1].snippet == "w" * 220 + "..."
    top = op.top_sources(ret, n=1).first()
    assert (top.company, top.similarity) == ("unlisted", 0.912)
    freq = spark.createDataFrame(
        [(1, 1, "skill_a", 90), (1, 2, "skill_b", 15), (1, 3, "skill_c", 14)],
        "query_id int, rank int, flag string, pct int")
    own = spark.createDataFrame([(1, 1, 0, 0)], "query_id int, skill_a int, skill_b int, skill_c int")
    gap = op.skill_gap(freq, own, "query_id", ["skill_a", "skill_b", "skill_c"])
    assert sorted((r.status, r.flag) for r in gap.collect()) == [("missing", "skill_b"), ("present", "skill_a")]


TAXONOMY = [Entry("words", "spark", "spark"), Entry("words", "skew", "skew")]
SETTINGS = Settings(taxonomy=TAXONOMY, stop_words=[], size=30, min_df=1, max_df=1.0, folds=2)


@pytest.fixture(scope="module")
def postings(spark):
    rng = random.Random(3)
    kinds = {"x": WORDS[:4], "y": WORDS[2:6], "z": WORDS[4:]}
    rows = [(i, k, " ".join(rng.choices(kinds[k], k=8))) for i, k in enumerate("xyz" * 20)]
    return spark.createDataFrame(rows, "id bigint, role string, text string")


def test_train_and_evaluate(postings):
    features = build_features(postings, "id", "text", "role", SETTINGS)
    assert features.labels == ["x", "y", "z"]
    assert features.table.where("is_test").count() == 12
    row = features.table.first()
    assert row.features.size == len(features.names)
    tables = train_and_evaluate(features, published_candidates(trees=3, depth=3, max_iter=10))
    assert tables["cv"].count() == 8
    assert tables["best"].first().candidate in {c.name for c in published_candidates()}
    assert tables["summary"].first().accuracy > 0.5
    assert {r.label for r in tables["auc"].collect()} == {"x", "y", "z", "macro", "weighted"}
    assert tables["top_terms"].count() == 45
    assert tables["comparison"].count() == 4 and tables["comparison"].where("accuracy is not null").count() in (1, 2)
    assert sum(r.n for r in tables["classes"].collect()) == 60
    assert {r.is_test: r.n_rows for r in tables["shapes"].collect()} == {True: 12, False: 48}


def scans_of_texts(spark, path, job):
    """Scans below ``path`` that read the text column while ``job`` runs."""
    store = spark._jsparkSession.sharedState().statusStore()

    def executions():  # the store drops old ones, so they are told apart by id and not by place
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        plans = store.executionsList()
        return {plans.apply(i).executionId(): plans.apply(i) for i in range(plans.size())}

    last = max(executions(), default=-1)
    job()
    found = 0
    for plan in [p for i, p in executions().items() if i > last]:
        for scan in plan.physicalPlanDescription().split("Scan parquet")[1:]:
            found += path in scan.split("\n\n")[0] and "text:string" in scan.split("\n\n")[0]
    return found


def test_features_read_the_texts_once(spark, postings, tmp_path):
    path = str(tmp_path / "posts")
    postings.write.parquet(path)
    docs = spark.read.parquet(path)
    assert scans_of_texts(spark, path, lambda: docs.selectExpr("max(text)").collect()) == 1
    assert scans_of_texts(spark, path, lambda: build_features(docs, "id", "text", "role", SETTINGS)) == 1


def test_model_is_read_back(spark, postings, tmp_path):
    for i, fit in enumerate([functools.partial(op.fit_linear_svm, max_iter=10), functools.partial(op.fit_naive_bayes, features="tfidf")]):
        model = train_role_model(postings, "id", "text", "role", SETTINGS, fit)
        model.save(str(tmp_path / str(i)))
        again = load_role_model(spark, str(tmp_path / str(i)))
        assert sorted(again.classify(postings, "id", "text").collect()) == sorted(model.classify(postings, "id", "text").collect())


def test_svm_ranks_all_classes(postings):
    features = build_features(postings, "id", "text", "role", SETTINGS)
    svm = op.fit_linear_svm(features.train, max_iter=20)
    ranked = op.classify_ranked(svm, features.test, "id", features.labels).collect()
    pred = {r.id: features.labels[int(r.prediction)] for r in svm.transform(features.test).collect()}
    by_id = collections.defaultdict(list)
    for r in ranked:
        by_id[r.id].append((r["rank"], r.score, r.label))
    for i, rows in by_id.items():
        rows.sort()
        assert [s for _, s, _ in rows] == sorted((s for _, s, _ in rows), reverse=True)
        assert rows[0][2] == pred[i] and len(rows) == 3


def test_analyse_postings(spark, postings):
    index = op.build_index(postings, "id", "role", "text", stop_words=[])
    model = train_role_model(postings, "id", "text", "role", SETTINGS, functools.partial(op.fit_linear_svm, max_iter=10))
    docs = postings.withColumnRenamed("text", "description")
    pasted = spark.createDataFrame([(1, "spark joins rows data " * 2), (2, "skew merge cores plans " * 2)], "query_id int, text string")
    tables = analyse_postings(index, model, docs, "id", pasted, k=5, taxonomy=TAXONOMY)
    best = {r.query_id: r.label for r in tables["classified"].where("rank = 1").collect()}
    assert best == {1: "x", 2: "z"}
    assert tables["retrieved"].count() == 10
    assert {(r.query_id, r.flag): r.status for r in tables["gap"].collect()}[1, "skill_spark"] == "present"


def test_leave_one_out_equals_refitting(spark):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choices(WORDS, k=rng.randint(0, 4)) + [f"only{i}"] * (i % 3 == 0)), i % 2, int(rng.random() < 0.4))
            for i in range(30)]
    df = spark.createDataFrame(rows, "id bigint, title string, f int, g int")
    got = {(r.flag, r.id): r.p for r in skill_loo(df, "id", "title", ["f", "g"], stop_words=[]).collect()}
    roles = df.withColumn("role", F.concat(F.lit("role"), F.col("id") % 3))
    with_role = {(r.flag, r.id): r.p for r in skill_loo(roles, "id", "title", ["f", "g"], "role", []).collect()}
    as_word = df.withColumn("title", F.concat_ws(" ", "title", F.concat(F.lit("role"), F.col("id") % 3)))
    assert with_role == {(r.flag, r.id): r.p for r in skill_loo(as_word, "id", "title", ["f", "g"], stop_words=[]).collect()}
    for col, flag in [(2, "f"), (3, "g")]:
        for row in rows:
            others = [r for r in rows if r[0] != row[0]]
            vocab = {w for r in others for w in r[1].split()}
            scores = []
            for c in (0, 1):
                words = [w for r in others if r[col] == c for w in r[1].split()]
                counts = collections.Counter(words)
                prior = sum(r[col] == c for r in others) / len(others)
                scores.append(math.log(prior) + sum(
                    math.log((counts[w] + 1) / (len(words) + len(vocab))) for w in row[1].split() if w in vocab))
            if abs(scores[0] - scores[1]) > 1e-9:
                assert got[flag, row[0]] == int(scores[1] > scores[0])


def test_skill_cv_predicts_every_row_once(spark, postings):
    df = op.tag_flags(postings, ["text"], TAXONOMY)
    got = skill_cv(df, "id", "text", "role", ["skill_spark"], k=2, stop_words=[], max_iter=10).collect()
    assert sorted(r.id for r in got) == list(range(60))
    assert sum(r.y == r.p for r in got) > 45


def test_skill_prediction_is_one_job(spark, postings):
    df = op.tag_flags(postings, ["text"], [*TAXONOMY, Entry("words", "never", "nowhere")])
    tables = skill_prediction(df, "id", "text", "role", ["skill_spark", "skill_skew", "skill_never"], min_count=5)
    assert {r.flag for r in tables["eligible"].collect()} == {"skill_spark", "skill_skew"}
    assert tables["predictions"].count() == 120
    metrics = {r.flag: r for r in tables["metrics"].collect()}
    assert metrics["skill_spark"].f1 > 0.8 and 0.5 <= metrics["skill_spark"].baseline < 1
    assert {r.flag for r in tables["bands"].collect()} == set(metrics)
    always = lambda d, i, t, c, flags: d.select(F.lit(flags[0]).alias("flag"), i, F.col(flags[0]).alias("y"), F.lit(1).alias("p"))
    assert skill_prediction(df, "id", "text", "role", ["skill_spark"], 5, always)["metrics"].first().recall == 1
    with pytest.raises(ValueError, match="both sides"):
        skill_prediction(df, "id", "text", "role", ["skill_never"])


def test_forest_keeps_the_nodes_of_rows_and_grows_the_same_trees(spark):
    rng = random.Random(5)
    rows = [(i, float(i % 3), Vectors.dense([rng.gauss(i % 3, 1.5) for _ in range(6)])) for i in range(300)]
    df = spark.createDataFrame(rows, ["id", "label", "features"])
    model = op.fit_random_forest(df, trees=5, depth=12)
    assert model.getCacheNodeIds()
    weighted = op.balanced_weights(df, "label")
    plain = RandomForestClassifier(numTrees=5, maxDepth=12, seed=42, weightCol="weight").fit(weighted)
    assert [t.toDebugString.split("\n", 1)[1] for t in model.trees] == [t.toDebugString.split("\n", 1)[1] for t in plain.trees]
