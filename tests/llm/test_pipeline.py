"""The corpus pipeline, stage by stage, against plain Python."""

import random
from collections import Counter

import pytest

pytest.importorskip("tessella.llm")
pipeline = pytest.importorskip("corpus_pipeline")

from pyspark.sql import functions as F  # noqa: E402

from tessella.llm.mixing import mix_to_targets  # noqa: E402

from .test_copies import grouped  # noqa: E402
from .test_native import sharded, targets  # noqa: E402

ITEM = " ".join(f"question{i}" for i in range(30))


@pytest.fixture(scope="module")
def corpus(spark, documents, tmp_path_factory):
    """A folder of tables with clean, junk, copied and leaking documents, and odd rows."""
    rng = random.Random(13)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 9)))
    texts, kinds = [], []
    for i in range(320):
        kind = ["clean", "clean", "clean", "junk", "copy", "near", "leak", "clean"][i % 8]
        clean = [t for t, k in zip(texts, kinds, strict=True) if k == "clean"]
        if kind == "clean":
            texts.append(" ".join(word() for _ in range(rng.randrange(30, 160))) + ".")
        elif kind == "junk":
            texts.append(" ".join(word().upper() + "!!" for _ in range(rng.randrange(30, 160))))
        elif kind == "copy":
            texts.append(rng.choice(clean))
        elif kind == "near":
            texts.append(rng.choice(clean) + " " + word())
        else:
            parts = ITEM.split()
            texts.append(" ".join([word() for _ in range(40)] + parts[15:] + [word()] + parts[:15]))
        kinds.append(kind)
    texts += [None, "", "  "]
    kinds += ["blank"] * 3
    sources = [None if i % 13 == 0 else f"s{min(i % 9, 3)}" for i in range(len(texts))]
    docs = documents(texts, sources=sources)
    docs = docs.unionByName(docs.where("doc_id = 0")).withColumn("text_key", F.lit("clash")).withColumn("kept_id", F.lit(1))
    path = tmp_path_factory.mktemp("corpus")
    docs.write.parquet(f"{path}/documents.parquet")
    labels = [(i, int(k != "junk"), 0) for i, k in enumerate(kinds) if k != "blank" and i % 2]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path), kinds


def rows_of(df):
    return [(r.doc_id, r.text, r.source) for r in df.collect()]


def test_stages(spark, corpus):
    path, kinds = corpus
    docs = spark.read.parquet(f"{path}/documents.parquet")
    stages = dict(pipeline.STAGES)
    assert [name for name, _ in pipeline.STAGES] == ["quality", "near duplicates", "decontamination", "mixing", "sharding"]
    store = lambda df, name: df.write.parquet(f"{path}/{name}") or spark.read.parquet(f"{path}/{name}")

    good = store(stages["quality"](spark, docs, path), "stage1")
    assert good.columns == docs.columns
    kept = {r[0] for r in rows_of(good)}
    junk = {i for i, k in enumerate(kinds) if k == "junk"}
    assert len(kept & junk) <= 0.05 * len(junk) and len(kept - junk) >= 0.98 * (len(kinds) - len(junk))

    single = store(stages["near duplicates"](spark, good, path), "stage2")
    assert single.columns == docs.columns
    rows = rows_of(good)
    lead = {doc: c for (doc, _, _), (n, c) in zip(rows, grouped([r[:2] for r in rows]), strict=True) if n}
    expected = {c for c in lead.values()} | {doc for doc, t, _ in rows if not (t or "").split()}
    assert sorted(r[0] for r in rows_of(single)) == sorted(expected)

    clean = store(stages["decontamination"](spark, single, path), "stage3")
    assert sorted(rows_of(clean), key=str) == sorted([r for r in rows_of(single) if "question3 " not in (r[1] or "")], key=str)

    mixed = store(stages["mixing"](spark, clean, path), "stage4")
    assert mixed.columns == docs.columns
    times = {r.doc_id: r.copies for r in mix_to_targets(clean).collect()}
    assert Counter(r[0] for r in rows_of(mixed)) == Counter({d: n for d, n in times.items() if n})
    sizes, taken = Counter(), Counter()
    for _, text, source in rows_of(clean):
        sizes[source] += len((text or "").split())
    for _, text, source in rows_of(mixed):
        taken[source] += len((text or "").split())
    for source, goal in targets(dict(sizes)).items():
        assert abs(taken[source] - goal) <= 90

    final = stages["sharding"](spark, mixed, path).collect()
    assert sorted(((r.doc_id, r.size, r.text_crc32, r.shard, r.slot) for r in final), key=str) == sorted(
        sharded([r[:2] for r in rows_of(mixed)], pipeline.SHARDS), key=str
    )
    whole = pipeline.run(spark, path).collect()
    assert sorted(map(str, whole)) == sorted(map(str, final))


def test_empty_tables(spark, corpus, tmp_path):
    path, _ = corpus
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{path}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert pipeline.run(spark, str(tmp_path)).count() == 0
