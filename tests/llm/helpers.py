"""Tables with every kind of odd row, for the corpus operators."""

import random

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
#: Extra columns whose names an operator might use itself.
CLASHING = ("key", "class", "node", "size", "n", "id", "site", "line", "p", "score", "ids", "window", "start", "path", "part", "_kept", "_row", "_text", "_score")


def words(seed, n):
    rng = random.Random(seed)
    return ["".join(rng.choice("abdeimnorstu") for _ in range(rng.randint(2, 7))) for _ in range(n)]


def text(seed, n=60, per_line=12):
    w = words(seed, n)
    return "\n".join(" ".join(w[i:i + per_line]) for i in range(0, n, per_line))


def documents(spark, rows, clashing=False):
    df = spark.createDataFrame([(i, t, "en", s, None if t is None else len(t)) for i, t, s in rows], DOCUMENTS)
    if clashing:
        from pyspark.sql import functions as F
        df = df.select("*", *[F.lit(c).alias(c) for c in CLASHING])
    return df


def odd_rows():
    """Nulls, empty and long texts, ties and repeated rows."""
    return [
        (1, text(1), "a"), (2, text(1), "b"), (3, None, "a"), (4, "", None), (5, text(5, 4000), "c"), (None, text(6), "a"),
        (7, "one", "b"), (8, " \n\t", "b"), (9, text(9), None), (9, text(9), None), (10, text(1).replace("\n", " "), "d"),
        (11, "Ends <|endoftext|> inside.", "a"),
    ]
