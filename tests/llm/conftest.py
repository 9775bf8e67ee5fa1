import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, k string, id int"
LONG = " ".join(f"w{i % 700}x{i // 700}" for i in range(30_000))
BASE = " ".join(f"word{i}" for i in range(120))


@pytest.fixture(scope="session")
def docs(spark):
    """Nulls, empty and very long texts, repeats, ties, near copies and clashing extra columns."""
    texts = [BASE, BASE, BASE.replace("word7 ", "other "), BASE.upper(), None, "", "one", "one", "two words", "two words", LONG, LONG + " tail", " \t\n", BASE + " " + " ".join(f"z{i}" for i in range(40)), "été Été déjà 漢字 <|endoftext|> x", "a b c d " * 30]
    rows = [(i, t, ["en", "de", None][i % 3], ["s1", "s2", None, "s3"][i % 4], len(t or ""), "x", 1) for i, t in enumerate(texts)]
    rows += [(3, "repeated id", "en", "s1", 1, "x", 1), (None, "no id here at all", None, None, 1, "x", 1)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
