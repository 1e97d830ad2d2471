import pytest


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text[, source]) tuples, with extra columns of clashing names."""

    def make(*rows, parts=3):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or ""), 1, "x", 2) for r in rows]
        return spark.createDataFrame(
            full, "doc_id long, text string, lang string, source string, n_chars long, node int, size string, `key` int"
        ).repartition(parts)

    return make


@pytest.fixture(scope="session")
def words():
    """Made-up words from a seeded generator."""
    import random

    def make(n, seed):
        r = random.Random(seed)
        return " ".join("".join(r.choices("abcdeé", k=r.randint(2, 7))) for _ in range(n))

    return make
