"""Plain models of the operators' definitions, and odd rows for every operator."""

import re

ODD = [
    (None, "row without an id and some words that nobody else has"),
    (900, None),
    (901, ""),
    (902, " \t\n "),
    (903, "one"),
    (904, "tab\x00nul ümlaut 😀 日本語"),
    (905, "long " * 30_000),
]


def docs(spark, rows):
    """Documents with columns that clash with names used inside the operators."""
    data = [(i, t, "en", "src", None if t is None else len(t), "n", "x") for i, t in rows]
    return spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long, "
                                       "node string, digest string")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", lower(text))


def item_words(text):
    return re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def shingles(text, n=5):
    w = tokens(text)
    return {tuple(w[k:k + n]) for k in range(max(1, len(w) - n + 1))} if w else set()


def sentences(rng, n, vocabulary=400, letters="abcdefghij"):
    words = ["".join(rng.choice(letters) for _ in range(rng.randint(2, 8))) for _ in range(vocabulary)]
    return [rng.choice(words) for _ in range(n)]
