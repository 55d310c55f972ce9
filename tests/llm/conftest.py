import pytest


@pytest.fixture(scope="session", autouse=True)
def workers(spark):
    from tidemark.llm.common import workers_find_package
    workers_find_package(spark)
    return spark


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table from (doc_id, text) pairs, with extra columns whose names clash with those used inside."""
    def make(rows, **extra):
        names = ["t", "k", "digest", "h", "bucket", "n", "uid", "range", "length", "salt"]
        return spark.createDataFrame([(i, t, "en", "s", 1, *names) for i, t in rows],
                                     "doc_id long, text string, lang string, source string, n_chars long, "
                                     + ", ".join(f"{c} string" for c in names))
    return make


def words(rng, n, lo=0, hi=5000):
    return [f"w{rng.randrange(lo, hi)}x" for _ in range(n)]
