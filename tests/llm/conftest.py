import random

import pytest

#: Columns whose names clash with what operators make.
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, kept string, row string, s string, v string, node bigint, target string, grp string, label string, n_words string, by_source string, component_id string"


@pytest.fixture(scope="session")
def make_docs(spark):
    """A table of documents from (doc_id, text) or (doc_id, text, lang, source)."""

    def make(rows):
        full = [(*r, *("en", "src0")[len(r) - 2 :], None, 0.5, "no", "row", "s", "v", 1, "t", "g", "l", "w", "b", "c")[:17] for r in rows]
        return spark.createDataFrame(full, SCHEMA)

    return make


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    syllables = "ra ne to li mo ka su vi der pon tal mer sin gor".split()
    return " ".join("".join(r.choices(syllables, k=r.randint(1, 3))) for _ in range(n))
