import pytest

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, id long, node string, a int, b int, kept string, "
    "label string, key string, component_id string, score string, pick string, y int")


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls in every column, empty, blank, long and repeated texts, repeated rows, and clashing column names."""
    long_text = "\n".join(f"Line number {i} of a rather long text, with words {i % 7} and more." for i in range(6000))
    story = "once upon a time there was a small red fox who lived near the old mill by the river"
    rows = [
        (1, story, "en", "s1", 10), (2, story, "en", "s1", 10), (2, story, "en", "s1", 10), (3, None, None, None, None), (4, "", "en", "s1", 0),
        (5, " \t \n ", "de", None, 5), (6, long_text, "en", "s2", len(long_text)), (7, long_text + " tail", "en", "s2", 1), (None, story, "en", "s1", 1),
        (None, None, None, None, None), (8, "Été über straße  ñandú\n\n" + story, "fr", "s3", 3), (9, "one two", "es", "s3", 7), (10, "one two", "es", "s3", 7),
        (11, "\\u0070assword=abcdef123 token: x", "en", "s1", 2), (12, "日本語 テキスト 12 😀 aaaa" + "b" * 5000, "ja", "s4", 2),
    ]
    return spark.createDataFrame([(*r, 1, "n", 2, 3, "k", "l", "key", "c", "s", "p", 4) for r in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.limit(0)
