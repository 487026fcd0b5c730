"""Small tables with the awkward rows every operator must handle."""

import random

import pytest

from tidemark.llm.common import workers_import

WORDS = [a + b + c for a in ("ba", "do", "ri", "te") for b in ("na", "mo", "si", "") for c in ("lu", "ke", "")]
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, id long, key string, size long, "
          "tokens string, hash long, h long, node long, x string, rest string, private string, range int, "
          "component_id long, start long, target double, _tie int")


def sentence(rnd, n):
    return " ".join(rnd.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="session")
def workers(spark):
    workers_import(spark)
    return spark


@pytest.fixture(scope="session")
def messy_rows():
    rnd = random.Random(4)
    texts = [(k, sentence(rnd, rnd.randrange(3, 120)) + rnd.choice([".", "\n", " é ß", "!"])) for k in range(40)]
    base = sentence(rnd, 160)
    texts += [(100, base), (101, base), (102, base + " extra"), (103, base.replace("ba", "Ba", 3))]    # copies, near copies
    texts += [(200, None), (201, ""), (202, " \t\n"), (203, "one"), (204, "one two three"), (205, "one two three")]
    texts += [(300, sentence(rnd, 30_000))]                                                            # very long
    texts += [(400, "same row here again"), (400, "same row here again"), (400, "same id, another text")]
    texts += [(None, "a text without an id"), (None, None)]
    return texts


def frame(spark, rows):
    full = [(i, t, "en", None if k % 7 == 0 else f"src{k % 5}", None if t is None else len(t), 5, "k", 1, "t", 2, 3, 4, "x", "r",
             "p", 1, 9, 8, 0.5, 1) for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(full, SCHEMA)


@pytest.fixture(scope="session")
def messy(workers, messy_rows):
    return frame(workers, messy_rows)


@pytest.fixture(scope="session")
def no_rows(workers):
    return workers.createDataFrame([], SCHEMA)
