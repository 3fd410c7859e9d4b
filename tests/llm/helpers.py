"""Small tables with nulls, empty and very long texts, ties, repeated rows and clashing names."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows):
    full = [(i, t, lang, src, len(t) if t is not None else None) for i, t, lang, src in rows]
    return spark.createDataFrame(full, DOCS)


def prose(seed, words, vocabulary=None):
    rng = random.Random(seed)
    vocabulary = vocabulary or [a + b for a in "bcdfgklmnprst" for b in ("an", "er", "ilo", "ont", "u")]
    out = []
    while len(out) < words:
        n = min(rng.randint(5, 12), words - len(out))
        out.extend([rng.choice(vocabulary) for _ in range(n)])
        out[-1] += "."
    return " ".join(out)


def odd_rows():
    """(doc_id, text, lang, source): what every operator has to take."""
    long_ = prose(1, 20_000)
    return [
        (1, None, "en", "a"),
        (2, "", None, "a"),
        (3, "  \t\n ", "en", None),
        (4, "one", "en", "b"),
        (5, long_, "en", "b"),
        (6, long_, "en", "b"),
        (7, prose(2, 120), "en", "a"),
        (7, prose(2, 120), "en", "a"),
        (8, prose(3, 80) + "\n" + prose(4, 80), "de", "é"),
        (9, "x" * 100_000, "de", None),
        (None, prose(5, 60), None, None),
    ]


def clash(df, *names):
    """``df`` with further columns of the given names."""
    return df.selectExpr("*", *[f"'kept' as `{n}`" for n in names])
