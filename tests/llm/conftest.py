import pytest

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    # names that operators use for columns of their own
    "id int, key string, `row` double, uid string, Fingerprint int, slot string, line_doc int, dedup_row int, `a.b` string"
)


def frame(spark, rows):
    """Documents of (doc_id, text, lang, source) with columns whose names clash with internal ones."""
    full = [(d, t, lang, s, None if t is None else len(t), 1, "k", 0.5, None, 3, "x", 9, 8, "ab") for d, t, lang, s in rows]
    return spark.createDataFrame(full, SCHEMA)


LONG = " ".join(f"word{i % 997}x{i % 13}" for i in range(30_000))
ODD = [
    (1, "The quick brown fox jumps over the lazy dog near the river bank.\nShared line of text here.", "en", "s0"),
    (2, "shared line of text HERE.  \nOther words that stay in this document, all of them.", "en", "s0"),
    (3, None, "en", None),
    (4, "", None, "s1"),
    (5, " \n\t\n ", "en", "s1"),
    (6, LONG, "en", "s2"),
    (7, LONG + " tail", "en", "s0"),
    (8, "The quick brown fox jumps over the lazy dog near the river bank.\nShared line of text here.", "en", "s3"),
    (8, "The quick brown fox jumps over the lazy dog near the river bank.\nShared line of text here.", "en", "s3"),
    (None, "Shared line of text here.\nA row without an id.", "de", "s4"),
    (None, None, None, None),
    (9, "1234 5678 %% ??", "de", "s0"),
    (10, "<|endoftext|> naïve Straße ÀÉ İstanbul ΑΣ ﬁ don't  it's 3½ á ​ x\x1cy", "fr", "s0"),
    (2**40, "one", "fr", "s0"),
]


@pytest.fixture(scope="session")
def odd(spark):
    return frame(spark, ODD)


@pytest.fixture(scope="session")
def none(spark):
    return frame(spark, [])


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"
