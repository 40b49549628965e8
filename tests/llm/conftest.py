import random

import pytest

pytest.importorskip("cohortlab.llm")

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(rows, parts=3):
        """rows: (doc_id, text) or (doc_id, text, lang, source)."""
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, SCHEMA).repartition(parts)
    return make


@pytest.fixture
def words():
    """Random words from a small alphabet of syllables."""
    rnd = random.Random(7)

    def make(n, pool=4000):
        return [f"w{rnd.randrange(pool)}" for _ in range(n)]
    return make
