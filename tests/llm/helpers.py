"""Tables with the awkward rows that every text operator must stand."""

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, digest string, salt string, keep_id string, kept string, block string, size string"


def words(n, stem="w"):
    return " ".join(f"{stem}{i}" for i in range(n))


def awkward(spark, texts):
    """One document per text with other columns whose names operators use inside."""
    rows = [(i, t, "en", "s", 1, "a", "b", "c", "d", "e", "f") for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA)


AWKWARD = [(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "a b"), (None, None), (4, words(60)), (5, words(60)), (6, words(30_000)), (7, "x" * 200_000), (8, "é\t\x0b ü\u3000 <|endoftext|>")]
