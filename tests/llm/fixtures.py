"""Small tables with the rows that operators must bear: nulls, empty and long texts, ties, repeats, odd characters."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, bin int, doc string, hash string, `row` int"


def prose(n, seed, kinds=400):
    rng = random.Random(seed)
    return " ".join(f"w{int(kinds * rng.random() ** 2)}" for _ in range(n))


LONG = prose(30_000, 1)
HARD = [
    (1, None, "en", "a"),
    (2, "", None, None),
    (3, " \t\n\x0b\x0c\r ", "en", "a"),
    (4, "one", "en", None),
    (5, "one two", "de", "b"),
    (6, LONG, "en", "a"),
    (7, LONG, "en", "b"),
    (8, LONG.replace(" ", "\n"), None, "a"),
    (9, "Hello's  world.\n<|startoftext|>x<|endoftext|> café́ \x1c a b '́ İI ΣΣ don't 12345 abcक़ it's,", "fr", "c"),
    (10, "a b 　 ｆｕｌｌ ﬁ ǅ क़क़ ́ab 'S .a.", "es", "c"),
    (11, prose(60, 2), "en", "a"),
    (12, prose(60, 2), "en", "a"),
    (12, prose(60, 2), "en", "a"),
    (13, "😀 😀 😀 一二三四 五六", "zh", "d"),
    (None, prose(40, 3), "en", "a"),
    (14, "x " * 500, "en", "a"),
]


def docs_of(spark, rows):
    """Rows of (doc_id, text, lang, source), with extra columns whose names operators might use themselves."""
    full = [(*r, len(r[1] or ""), 1, "d", "h", 2) for r in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(3)
