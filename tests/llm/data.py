"""Small tables with the cases every operator must stand."""

import random

LETTERS = "abcdefghijklmnopqrstuvwxyz"
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng, n):
    return " ".join("".join(rng.choice(LETTERS) for _ in range(rng.randint(1, 7))) for _ in range(n))


def nasty_texts(seed=3):
    """Texts with copies, near copies, shared passages, empty and very long ones."""
    rng = random.Random(seed)
    base = [prose(rng, rng.choice([1, 3, 4, 5, 12, 13, 14, 40, 120])) for _ in range(30)]
    shared = prose(rng, 60)
    texts = list(base)
    texts += [base[8]] * 12
    words = shared.split()
    for i in range(25):
        texts.append(prose(rng, 20) + " " + " ".join(words[:13 + i]) + "\n" + prose(rng, 15))
    for i in range(20):
        near = words.copy()
        near[rng.randrange(60)] = prose(rng, 1)
        texts.append(" ".join(near))
    texts += [None, "", " \t\n", "a", "ü x", "Σas ǅ①", "x " * 9000, "one two three four five " * 40,
              prose(rng, 6000) + " " + shared, "tab\tand\x0bform\x0cfeed\r\nhere", "naïve line"]
    rng.shuffle(texts)
    return texts


def documents(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in zip(ids, texts)]
    return spark.createDataFrame(rows, COLUMNS)


def empty(spark, schema=COLUMNS):
    return spark.createDataFrame([], schema)
