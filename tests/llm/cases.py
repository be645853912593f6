"""A small table of documents with every odd case, and helpers."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = ", n int, key string, keep_id long, kept string, _hash int, _row string, root int, shard int, s string"
EXTRA = (1, "k", 5, "no", 7, "r", 3, 2, "s")


def prose(rng, n, vocabulary=400):
    words = [f"{rng.choice('bcdfgklmnprst')}{rng.choice('aeiou')}{i % 37}" for i in range(vocabulary)]
    return " ".join(rng.choice(words) for _ in range(n))


def odd_documents():
    rng = random.Random(3)
    base = prose(rng, 90)
    near = base.split()
    near[40] = "changed"
    long = " ".join(prose(rng, 1500) for _ in range(12))
    passage = prose(rng, 70)
    texts = [
        (1, None, "en", "a"),
        (2, "", "en", "a"),
        (3, " \t\n\v\f\r ", None, "a"),
        (4, base, "en", None),
        (5, base.replace(" ", "\n\t ", 3), "en", "b"),
        (6, base, "en", "b"),
        (7, " ".join(near), "en", "b"),
        (7, " ".join(near), "en", "b"),
        (8, base.upper(), "fr", "a"),
        (9, long, "fr", "a"),
        (10, long[:-30] + " tail", "fr", "c"),
        (11, "one two three", "de", "c"),
        (12, "ONE two  three", "de", "c"),
        (13, prose(rng, 60) + "\n" + passage + "\n" + prose(rng, 30), "de", "a"),
        (14, prose(rng, 20) + "\n" + passage + " " + prose(rng, 80), "de", "a"),
        (15, passage + passage, "de", "a"),
        (16, "é漢字🎉 ▁ x" * 30, "es", "a"),
        (17, "x" * 700, "es", "a"),
        (18, "ab" * 300 + " " + "ab" * 300, "es", "a"),
        (None, prose(rng, 70), "en", "a"),
        (None, base, "en", "a"),
        (19, "12 345 !!", "en", "a"),
        (20, "tail\n\ntail\ntail \n tail", None, None),
    ]
    texts += [(100 + i, prose(rng, 30 + 3 * i), "en" if i % 3 else "fr", f"src{i % 4}") for i in range(60)]
    return [(i, t, lang, source, len(t) if t is not None else None) for i, t, lang, source in texts]


def odd_table(spark):
    rows = odd_documents()
    return spark.createDataFrame([(*r, *EXTRA) for r in rows], SCHEMA + CLASHING).repartition(5)


def empty_table(spark):
    return spark.createDataFrame([], SCHEMA + CLASHING)


def tuples(df, *columns):
    key = lambda r: tuple((x is None, x) for x in r)
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=key)
