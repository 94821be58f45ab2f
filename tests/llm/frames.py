"""Small tables with the cases every operator must handle."""

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
PASSAGE = " ".join(f"word{i * 7919 % 1000}" for i in range(60))


def odd_documents(spark, extra: bool = True):
    """Nulls in every column, empty and long texts, repeated rows, equal texts, odd characters, and
    extra columns with names that operators use."""
    rows = [
        (1, "The quick brown fox jumps over the lazy dog. " + PASSAGE, "en", "a", 10),
        (2, "Der schnelle braune Fuchs springt über den faulen Hund.", "de", "a", 11),
        (3, "Le renard brun rapide saute par-dessus le chien paresseux. " + PASSAGE, "fr", None, 12),
        (4, "The quick brown fox jumps over the lazy dog. " + PASSAGE, "en", "b", None),
        (5, "", "en", "b", 0),
        (6, None, None, "b", None),
        (7, " \t\n ", None, "c", 4),
        (8, "12345 !!! ---", "en", "c", 13),
        (9, "long " * 30_000 + "İ ß ﬁ 漢字 \x1c é <|endoftext|> <|startoftext|> \U0001f600", "en", "c", 1),
        (10, PASSAGE + " " + PASSAGE, "en", "c", 5),
        (10, PASSAGE + " " + PASSAGE, "en", "c", 5),
        (None, "A text without an id. " + PASSAGE, "en", "c", 5),
        (None, None, None, None, None),
    ]
    df = spark.createDataFrame(rows, DOCUMENTS)
    if extra:
        for name in ("spans", "score", "lang_pred", "guess", "part", "own_id", "own_hash", "found_spans", "_salt", "fp", "sequence_id", "h"):
            df = df.selectExpr("*", f"'x' AS {name}")
    return df


def no_documents(spark):
    return spark.createDataFrame([], DOCUMENTS)
