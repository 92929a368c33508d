"""Small documents with the awkward cases every operator must take."""
import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, kept boolean, row string, n long, band long"


def rows():
    """Nulls, empty and blank texts, a very long text, ties, repeated rows, copies."""
    rng = random.Random(4)
    words = [f"w{i}" for i in range(400)]
    line = "This same boilerplate line stands in many of the documents here."

    def text(n):
        return " ".join(rng.choice(words) for _ in range(n))

    base = text(120)
    out = [(1, None), (2, ""), (3, " \t\n "), (4, "one"), (5, "one two three"), (6, base), (7, base), (8, base + " tail"),
           (9, text(60) + "\n" + line), (10, line + "\n" + text(40)), (11, text(80) + "\n" + line + "\n" + line),
           (12, text(30) + "\n  " + line.upper() + "\t"), (13, text(70) + "\n" + line), (14, text(30000)),
           (15, "ünïcode ßtraße ñandú " * 30), (15, "ünïcode ßtraße ñandú " * 30), (16, "123 456 !!! ###"), (None, base), (None, None)]
    return [(i, t, None, None, None, 1.5, False, "x", 7, 3) for i, t in out]


def frame(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
