"""Tables with everything that may go wrong in them."""

LONG = "wort " * 40_000 + "x" * 200_000
DOCS = "doc_id long, text string, lang string, source string, n_chars long, size string, kept string, _index string"
PLAIN = "the quick brown fox jumps over the lazy dog while seven grey geese fly south again"


def docs(spark):
    """NULLs in any column, empty and very long texts, repeated rows and ids, clashing columns."""
    rows = [
        (1, "", "en", "a", 0, "s", "k", "i"),
        (2, None, None, None, None, None, None, None),
        (None, PLAIN, "en", "a", 5, "s", "k", "i"),
        (3, LONG, "de", "b", 9, "s", "k", "i"),
        (4, PLAIN, "en", "a", 5, "s", "k", "i"),
        (4, PLAIN, "en", "a", 5, "s", "k", "i"),
        (4, PLAIN.upper(), "en", "a", 5, "s", "k", "i"),
        (5, " \t\r\n\x0b\x0c ", "en", "b", 7, "s", "k", "i"),
        (6, "é ü <|im_start|> \U0001f600 one\nline\nline\n\nline", "fr", "c", 7, "s", "k", "i"),
        (7, "one two three", "fr", "c", 7, "s", "k", "i"),
    ]
    return spark.createDataFrame(rows, DOCS)


def no_docs(spark):
    return spark.createDataFrame([], DOCS)


def labels(spark):
    rows = [(4, 1, 0), (4, 0, 0), (3, None, 0), (None, 1, 0), (6, 1, None), (7, 0, 1), (99, 1, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")
