import pytest

TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog, and then it runs away. It is a fine day for it!", "en", "a"),
    (2, "the quick  brown fox jumps over the lazy dog, and then it runs away. It is a FINE day for it!", "en", "a"),
    (3, None, None, None),
    (4, "", "en", "a"),
    (5, "   \n\t ", "fr", "b"),
    (6, "12345 67890 !!! ### 4111", "en", "b"),
    (7, "Le renard brun saute par-dessus le chien paresseux, puis il s'en va. C'est un beau jour ÉTÉ.", "fr", None),
    (7, "Le renard brun saute par-dessus le chien paresseux, puis il s'en va. C'est un beau jour ÉTÉ.", "fr", None),
    (None, "A text without a name, quite short  .   ", None, "c"),
    (8, "long " * 30_000 + "end\n \n  x  ", "en", "a"),
    (9, 'config token = "9b0b3c6a43eb78aa99cbd7049c572391524f37a8" and api_key: your-token-here', "en", "a"),
    (10, "aaaaaaaaaaaaaaaa===== <|endoftext|>  \x85 ▁x ▁▁ ﬁ İ. 字字 \U0001f600\x1c\r\n  tail  ", "en", "a"),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Null, empty, blank, long, repeated and strange rows, and columns with names the operators use themselves."""
    rows = [(*r, 5, "mine", 1.5) for r in TEXTS]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_words long, lang_pred string, score double").repartition(3)


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def some(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
