"""Small document tables with the cases every operator must handle."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns whose names operators use for their own results.
CLASHES = ["size", "taken", "score", "predicted", "kept", "shard", "start", "identity", "fp", "node", "row", "rank"]


def prose(rng, words, stems="the of and to in at er on re st nd ti".split()):
    return " ".join("".join(rng.choice(stems) for _ in range(rng.randint(1, 3))) for _ in range(words))


def documents(spark, extra=()):
    rng = random.Random(3)
    texts = [prose(rng, rng.choice([1, 2, 3, 40, 300])) for _ in range(60)]
    texts += [texts[5]] * 4 + [texts[6] + " end", "", None, "   ", "é", "日本語 テキスト", "x" * 5000, prose(rng, 6000)]
    rows = [(i, t, rng.choice(["en", "de", None]), rng.choice(["a", "a", "b", "c", None]), None if t is None else len(t)) for i, t in enumerate(texts)]
    rows += [rows[3], rows[3], (None, "no id", None, None, None), (None, None, None, None, None), (rows[9][0], "another text", "en", "b", 12), *extra]
    return spark.createDataFrame(rows, SCHEMA)


def clashing(df):
    """The same rows with extra columns named like results."""
    from pyspark.sql import functions as F

    return df.withColumns({name: F.lit("own") for name in CLASHES})
