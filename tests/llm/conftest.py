import random

import pytest

#: Names that the operators use inside, and a result of most of them.
EXTRA = "row string, key_a string, node string, bucket string, score string, spans string, ids string, path string, leaks string"


@pytest.fixture
def table(spark):
    """A documents table from (doc_id, text) rows, with columns whose names clash."""
    def make(rows):
        names = [c.split()[0] for c in EXTRA.split(", ")]
        return spark.createDataFrame(
            [(i, t, "en", "s", 1, *names) for i, t in rows],
            f"doc_id long, text string, lang string, source string, n_chars long, {EXTRA}",
        )

    return make


def sentence(rng: random.Random, count: int, words=800) -> str:
    return " ".join(f"w{rng.randrange(words)}" for _ in range(count))


@pytest.fixture
def odd_rows():
    """Nulls, empty, blank and very long texts, repeated rows and repeated ids."""
    rng = random.Random(5)
    long = "\n".join(sentence(rng, 12) for _ in range(600))
    return [
        (None, sentence(rng, 30)), (1, None), (2, ""), (3, " \n "), (4, "one"), (5, long), (6, long), (7, sentence(rng, 60)),
        (7, sentence(rng, 60)), (8, "a\nb\nc\nd"), (8, "a\nb\nc\nd"), (9, "x\na\nb\nc"), (10, "a " * 3000), (None, None),
    ]
