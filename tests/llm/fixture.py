"""Small tables with every odd case: nulls, empty and very long texts, ties,
repeated rows, and columns whose names operators use inside."""

import random

CLASH = ("id", "key", "fp", "sha", "k", "word", "n", "score", "kept", "label", "host", "toxic")
WORDS = ("the house on a hill was sold to an old friend who liked green tea and long walks near the river "
         "before winter came with snow that covered every road").split()


def prose(n, seed):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + (str(r.randrange(90)) if r.random() < 0.4 else "") for _ in range(n))


def texts():
    shared = prose(80, 1)
    near = prose(300, 2)
    return [
        (1, prose(60, 11)), (2, prose(60, 11)), (3, prose(60, 11).replace(" ", "\n ")), (4, None), (5, ""),
        (6, " \t\r\n\x0b\x0c"), (7, "Ünïcödé \U0001F600 " + prose(50, 3)), (8, near), (9, near + " end"),
        (10, near[:-20]), (11, prose(30, 4) + " " + shared), (12, shared + " " + prose(30, 5)),
        (13, prose(5, 6) + " " + shared + " " + prose(5, 7)), (14, "ab" * 400), (15, "x" * 250),
        (16, prose(20_000, 8)), (17, "word"), (18, "two words"), (19, prose(60, 11)), (19, prose(60, 11)),
        (20, shared.upper()), (None, prose(60, 11)), (None, None), (21, " a@b.de "),
    ]


def documents(spark, rows=None):
    rows = texts() if rows is None else rows
    full = [(d, t, "en", "s", 0, *["clash"] * len(CLASH)) for d, t in rows]
    return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long, "
                                 + ", ".join(f"{c} string" for c in CLASH))


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
