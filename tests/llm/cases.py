"""Small tables with the awkward rows: nulls in any column, empty and long texts, repeats, clashing names."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, raw string, node string, bucket string, deleted string, h int, __x int"


def sentences(rng, n, words=12):
    letters = "abcdefghijklmnopqrstuvwxyz"
    vocabulary = ["".join(rng.choice(letters) for _ in range(rng.randint(2, 9))) for _ in range(400)]
    return [" ".join(rng.choice(vocabulary) for _ in range(words)).capitalize() + "." for _ in range(n)]


def row(doc_id, text, lang="en"):
    return (doc_id, text, lang, "s", None if text is None else len(text), "clash", "clash", None, "clash", "clash", 1, 2)


def edge_rows():
    rng = random.Random(7)
    base = sentences(rng, 12)
    long = "\n".join(sentences(rng, 900, 20))
    return [
        row(1, "\n".join(base)), row(2, "\n".join(base)), row(2, "\n".join(base)), row(3, None), row(4, ""), row(5, " \n\t "), row(6, "!!! ???"), row(7, "!!! ???"),
        row(None, "\n".join(base[:6] + sentences(rng, 6))), row(None, None), row(8, "one"), row(9, "one two three", None), row(10, long), row(11, long + " tail"),
        row(12, "\n".join(base[:11] + sentences(rng, 1))), row(13, "é" * 50 + "\n" + "ñandú " * 60, None),
    ]


def frame(spark, rows=None):
    return spark.createDataFrame(edge_rows() if rows is None else rows, SCHEMA)
