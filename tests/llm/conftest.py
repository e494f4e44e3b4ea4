import os

import pytest

# workers import the package from the repository
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), os.environ.get("PYTHONPATH")]))


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, repeated rows and ids, columns whose names clash with those of results."""
    long = " ".join(f"word{i} and more of the same long kind of sentence." for i in range(4000))
    near = [f"the quick brown fox number {i} jumps over the lazy dog and runs away from all of the other dogs in town today" for i in range(3)]
    texts = [
        (1, "Same Text here, twice. And again the same."), (2, "same text here, TWICE. and again the same."), (2, "same text here, TWICE. and again the same."),
        (3, None), (4, ""), (5, " \n\t "), (6, "one"), (7, "ONE"), (8, long), (9, long + " tail"), (10, near[0]), (11, near[1]), (12, near[2]),
        (None, "no id at all"), (None, None), (13, "é É ñ ß 日本語 😀"), (14, "a\nb\na\nb\n\na"), (15, "x" * 5000),
    ]
    schema = "doc_id long, text string, kept string, n int, v int, tokens string, content string, row string, t string"
    return spark.createDataFrame([(i, t, "k", 1, 2, "x", "y", "z", "w") for i, t in texts], schema)


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)
