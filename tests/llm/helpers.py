"""Small tables with the awkward rows every operator has to take."""

import random

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    # names that operators use themselves
    "score double, found string, size long, words long, shard int, copy int, key long, id long, th long, removed string"
)


def prose(seed: int, n: int, vocabulary: int = 400) -> str:
    draw = random.Random(seed)
    words = [f"{chr(97 + draw.randrange(26))}{chr(97 + draw.randrange(26))}w{draw.randrange(vocabulary)}" for _ in range(n)]
    out = []
    for i, w in enumerate(words):
        out.append(w + ("." if i % 9 == 8 else "") + ("\n" if i % 40 == 39 else " "))
    return "".join(out).strip()


def row(doc_id, text, source="s", lang="en"):
    return (doc_id, text, lang, source, None if text is None else len(text), 0.5, "f", 1, 2, 3, 4, 5, 6, 7, "r")


def awkward(more=()):
    long = prose(1, 30_000)
    same = prose(2, 120)
    rows = [
        row(1, None), row(2, ""), row(3, " \n\t "), row(4, long), row(5, same), row(6, same), row(6, same),
        row(None, prose(3, 80)), row(7, "one"), row(8, prose(4, 90), source=None, lang=None), row(9, "x" * 50_000),
        row(10, "1" * 30_000), row(11, "İÉ ñ 漢字   é"),
    ]
    return rows + list(more)


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)
