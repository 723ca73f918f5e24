import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, score string, key string"
WORDS = [f"w{i}" for i in range(400)]


def prose(lo: int, n: int) -> str:
    return " ".join(WORDS[(lo * 7 + i * 3 + i * i) % 400] + str((lo + i) % 9) for i in range(n))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in any column, empty and blank texts, a very long text, repeats, near copies, clashing columns."""
    long = prose(1, 30_000)
    rows = [
        (1, None, "en"), (2, "", "en"), (3, " \n\t ", None), (4, "one", "en"), (5, "one two three", "de"),
        (6, long, "en"), (7, prose(2, 200), "en"), (8, prose(2, 200), "en"), (8, prose(2, 200), "en"),
        (9, prose(2, 200).replace("w100", "x", 1), None), (10, "line a b c\nline a b c\nline a b c\n" * 9, "fr"), (11, "Ünïcode — 漢字 <|endoftext|> \x1c é́", "de"),
        (12, prose(5, 90) + " " + prose(2, 120), "en"), (13, "!!! ### $$$ 123", "en"),
    ]
    full = [(i, t, lang, "s", None if t is None else len(t), "a", "b", "c") for i, t, lang in rows]
    return spark.createDataFrame([*full, (None, "no id here", "en", None, None, None, None, None)], SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
