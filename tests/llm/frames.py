"""Small frames with the odd cases that every operator has to take."""

import random

CLASHING = "score double, kept boolean, n_words long, spans string, held_out boolean, component_id long, n_lines long, row string, length long"


def prose(seed, n):
    rng = random.Random(seed)
    words = ["".join(rng.choice("aeioubcdlmnprst") for _ in range(rng.randint(2, 8))) for _ in range(400)]
    return " ".join(rng.choice(words) for _ in range(n))


def odd_documents(spark):
    """Null and empty texts, a null id, repeated rows, a shared id, a long text, clashing columns."""
    long = prose(7, 6_000)
    rows = [
        (1, prose(1, 120)), (2, None), (3, ""), (4, "  \n\t \n"), (5, prose(1, 120)), (5, prose(1, 120)), (None, prose(1, 120)),
        (None, None), (6, "one"), (6, "two words"), (7, long), (8, long), (9, prose(9, 60) + "\nxyz\n" + prose(3, 80)), (10, "é" * 300),
    ]
    extra = (0.5, True, 3, "s", False, 7, 1, "r", 9)
    return spark.createDataFrame([(*r, "en", *extra) for r in rows], f"doc_id long, text string, lang string, {CLASHING}")


def no_documents(spark):
    return spark.createDataFrame([], f"doc_id long, text string, lang string, {CLASHING}")


def labels(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")
