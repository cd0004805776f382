import pytest

LONG = "long " * 30_000


@pytest.fixture(scope="session")
def documents(spark):
    """A builder of small document tables with null, empty, long and repeated texts and clashing columns."""

    def make(texts, langs=None, sources=None, ids=None):
        ids = list(range(len(texts))) if ids is None else ids
        rows = [
            (ids[i], t, (langs or ["en"] * len(texts))[i], (sources or ["src0"] * len(texts))[i], len(t or ""), "x", 1.5, 7)
            for i, t in enumerate(texts)
        ]
        return spark.createDataFrame(
            rows,
            "doc_id long, text string, lang string, source string, n_chars long, shard string, score double, size int",
        )

    return make


@pytest.fixture(scope="session")
def long_text():
    return LONG
