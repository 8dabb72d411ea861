import pytest

from ontime.llm.common import prepare

LONG = " ".join(f"w{i % 977}x{i}" for i in range(30_000))
TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog and runs far away home"),
    (2, "The quick brown fox jumps over the lazy dog and runs far away home"),
    (2, "The quick brown fox jumps over the lazy dog and runs far away home"),  # repeated row
    (3, None),
    (4, ""),
    (5, " \n\t "),
    (None, "no id here but some words all the same"),
    (7, LONG),
    (8, "one two"),
    (9, "aa " * 200),
    (10, "Ümläute und ÉCOLE 日本語 😀 words"),
]
SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, score string, fp string, "
          "_k1 int, _spans int, kept_text int, _s int, _row int")


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    prepare(spark)


@pytest.fixture(scope="session")
def odd_docs(spark):
    """NULLs, empty, long and repeated texts, and columns named like those the operators make."""
    rows = [(i, t, "en" if i != 9 else None, None, None if t is None else len(t), "mine", "fp", 1, 2, 3, 4, 5) for i, t in TEXTS]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def odd_labels(spark):
    rows = [(1, 1, 0), (2, 1, None), (2, 0, 0), (3, None, None), (7, 1, 0), (9, 0, 0), (None, 1, 0), (99, 1, 1)]
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")
