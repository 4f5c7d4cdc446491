import random

import pytest

from wattlane.llm.common import use_package

LONG = "unbroken" * 20_000


@pytest.fixture(autouse=True, scope="session")
def package(spark):
    use_package(spark)


@pytest.fixture(scope="session")
def texts():
    """Invented prose with copies, near copies, odd and empty texts."""
    rng = random.Random(4)
    vocabulary = ["".join(rng.choices("abdeilmnorst", k=rng.randint(2, 7))) for _ in range(400)]

    def prose(n):
        return " ".join(rng.choices(vocabulary, k=n)).capitalize() + "."

    rows = [prose(rng.randint(5, 120)) for _ in range(60)]
    for i in range(10):
        words = rows[i].split()
        words[len(words) // 2] = "changed"
        rows.append(" ".join(words))
    rows += rows[:5] + [rows[0].upper() + "!"]
    return [*rows, None, "", "  \n ", "!!! ???", "one", "two words", LONG, "nbsp and\ttab \n end ", "Ünïcödé Été d'été"]


@pytest.fixture(scope="session")
def docs(spark, texts):
    """The texts with a null key, a repeated row and columns whose names operators use themselves."""
    rows = [(i, t, "x", 1.0, "k", 7) for i, t in enumerate(texts)]
    rows += [(None, "a row without a key and enough words", None, None, None, None), rows[3]]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, score double, node string, n int")


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, score double")
