"""Rows that every text operator has to take: nulls, empty, very long, repeated, odd characters, extra columns."""

import random

SCHEMA = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT, score DOUBLE, tokens STRING, count BIGINT, h BIGINT, label STRING"


def words(seed, n):
    draw = random.Random(seed)
    return " ".join("".join(draw.choice(["an", "the", "or", "in", "st", "wh"]) for _ in range(draw.randint(1, 3))) for _ in range(n))


TEXTS = [
    (1, words(1, 60)),
    (2, words(1, 60)),  # an exact copy
    (3, words(1, 60) + " more"),
    (4, None),
    (5, ""),
    (6, "   \n\t "),
    (7, "one two"),
    (8, "one two"),
    (9, "ONE Two"),
    (10, words(2, 30_000)),  # very long
    (11, "x" * 100_000),  # one very long word
    (12, "12345 67890 !!! ???"),
    (13, "\x00 é 😀 中文 ▁▁   \x85 é"),
    (None, words(1, 60)),
    (None, None),
    (14, words(3, 40) + "\n" + words(3, 40) + "\n" + words(3, 40)),
    (1, words(1, 60)),  # a repeated row
    (15, "a | b <c> & d $ % # *"),
]


def odd_documents(spark):
    rows = [
        (i, t, None if i in (3, 12) else "en", None if i == 7 else f"src{(i or 0) % 3}", len(t or ""), 0.5, "x", 1, 2, "y") for i, t in TEXTS
    ]
    return spark.createDataFrame(rows, SCHEMA)


def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id BIGINT, quality INT, toxic INT, text STRING")
