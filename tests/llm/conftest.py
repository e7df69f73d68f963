import random

import pytest

WORDS = ["the", "of", "river", "stone", "Ünder", "éa", "idiot", "token", "fox", "lamp,", "night.", "rain;", "sun", "x1", "door", "glass.", "wind", "key"]


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (id, text, source) or texts, with extra columns whose names clash with the operators' own."""

    def build(rows):
        full = [(i, r, "web") if not isinstance(r, tuple) else (*r, "web")[:3] for i, r in enumerate(rows)]
        clash = [(i, t, s, "?", "?", "?", "?", 7) for i, t, s in full]
        schema = "doc_id long, text string, source string, k string, t string, node string, version string, n_tokens int"
        return spark.createDataFrame(clash, schema)

    return build


@pytest.fixture(scope="session")
def prose():
    """A text of random words, the same for the same seed."""

    def make(seed, n=60, per_line=12):
        rng = random.Random(seed)
        words = [rng.choice(WORDS) + (str(rng.randrange(400)) if rng.random() < 0.7 else "") for _ in range(n)]
        return "\n".join(" ".join(words[i : i + per_line]) for i in range(0, n, per_line))

    return make


EDGES = [(1, None), (2, ""), (3, " \n\t "), (None, "no id here at all"), (4, "same text\nagain and again"), (4, "same text\nagain and again"), (5, "same text\nagain and again"), (6, "x" * 120_000), (7, "word " * 40_000)]


@pytest.fixture(scope="session")
def edges(docs_of):
    """Nulls, empty and very long texts, ties and repeated rows."""
    return docs_of(EDGES)
