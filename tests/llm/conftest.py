import random

import pytest

from aerolake.llm.store import run_folder

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "id string, key int, component int, secrets int, seq int")


def rows(texts, first=0):
    return [(first + i, t, "en", "s", len(t or ""), "x", 1, 2, 3, 4) for i, t in enumerate(texts)]


@pytest.fixture()
def folder(spark):
    return run_folder(spark, "test")


@pytest.fixture(scope="session")
def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def texts():
    rnd = random.Random(7)
    words = ["ab", "cde", "ünï", "梦😀", "word", "x", "ein", "oder", "token", "zebra"]
    out = [" ".join(rnd.choice(words) for _ in range(rnd.randrange(1, 60))) for _ in range(40)]
    out += [out[0], out[0] + " tail", None, "", " \n\t ", "a", "q" * 30_000, "ab cd " * 9_000]
    return out


@pytest.fixture(scope="session")
def odd_docs(spark, texts):
    """NULL texts and ids, empty and long texts, repeated rows, clashing columns."""
    data = rows(texts)
    data += [data[0], data[3], (None, texts[1], None, None, None, None, None, None, None, None),
             (None, None, None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(data, SCHEMA).repartition(5)
