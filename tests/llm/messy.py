"""Tables with everything that may go wrong in them."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, ord int, tie string, score string, vector int"
EXTRA = ("x", 7, "t", "s", 3)


def words(seed, n, size=400):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(size)}" for _ in range(n))


def rows():
    base, long = words(1, 60), words(2, 3000, 90_000)
    near = base.replace("w", "w", 1).split()
    near[30] = "changed"
    texts = [
        (1, base, "en"), (2, base, "en"), (2, base, "en"), (3, " ".join(near), "en"), (4, None, "en"), (5, "", None), (6, "   \n\n ", "de"),
        (7, long, "en"), (8, long + " " + words(3, 40), "de"), (9, "One.", "de"), (10, "One.", "de"), (10, "another text of one id", "de"),
        (None, base, "en"), (None, None, None), (11, "日本語 Ünïcödé ½ it's  <|endoftext|> 12 \t x", "fr"), (12, "12 34 !!", "fr"),
        (13, "ab" * 400, "fr"), (14, "z\nz\nz\n" + base + "\nz", "fr"), (-5, words(9, 4), "en"),
    ]
    return [(i, t, lang, "s", None if t is None else len(t), *EXTRA) for i, t, lang in texts]


def documents(spark, empty=False):
    return spark.createDataFrame([] if empty else rows(), SCHEMA)


def texts_of(df):
    return [(r.doc_id, r.text or "") for r in df.select("doc_id", "text").collect()]
