"""Small frames with the awkward cases, and brute-force answers."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# columns that operators use as names of their own
CLASH = ["id", "tk", "list", "rank", "h", "size", "fp", "node", "label", "class", "vector", "shard", "a.b", "_t", "_id", "rows", "times", "found", "length"]

WORDS = {
    "en": "the of and to in is it that was for on are with as they at be this from have".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als".split(),
}


def prose(rng, words, n):
    return " ".join(rng.choice(words) + rng.choice(["", "", "s", "ing"]) for _ in range(n))


def documents(spark, rows=None, extra=True):
    rows = awkward() if rows is None else rows
    df = spark.createDataFrame(rows, SCHEMA)
    if extra:
        from pyspark.sql import functions as F

        for c in CLASH:
            df = df.withColumn(c, F.lit("x"))
    return df


def awkward(seed=3):
    """Nulls in every column, empty and long texts, ties, repeated ids and rows."""
    rng = random.Random(seed)
    base = prose(rng, WORDS["en"], 120)
    german = prose(rng, WORDS["de"], 90)
    rows = [
        (0, base, "en", "s1", len(base)), (1, base, "en", "s2", len(base)), (2, base + " one word more", "en", "s1", None),
        (3, german, "de", "s1", 5), (4, german.upper(), "de", None, 5), (5, "", "en", "s2", 0), (6, None, "en", "s1", None),
        (7, "12 34 -- ..", None, "s3", 11), (8, "é ß 漢字 😀 " * 40, None, "s3", 1), (9, "a" * 3000, "en", "s1", 3000),
        (10, " ".join(prose(rng, WORDS["en"], 60) for _ in range(60)), "en", "s1", 9), (11, "x", "de", "s2", 1),
        (None, base, "en", "s1", 1), (12, "twice", "en", "s2", 5), (12, "twice", "en", "s2", 5), (12, "not the same", "en", "s2", 9),
    ]
    for k in range(20, 50):
        lang = rng.choice(["en", "de"])
        text = prose(rng, WORDS[lang], rng.randint(1, 200))
        if k % 5 == 0:
            text = text + " " + base[100:700]
        rows.append((k, text, lang, f"s{k % 3}", len(text)))
    return rows
