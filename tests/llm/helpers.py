"""Small documents with the odd cases that every operator must take."""

from __future__ import annotations

import random

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega".split()

# Extra columns whose names the operators use themselves.
DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp long, seed long, score double, node int, shard int, size long, x string, row long"


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + str(r.randrange(40)) for _ in range(n))


def doc(i, text, lang="en", source="s"):
    return (i, text, lang, source, None if text is None else len(text), 1, 2, 0.5, 3, 4, 5, "x", 6)


def odd_docs() -> list[tuple]:
    base = prose(1, 60)
    return [
        doc(1, base),
        doc(2, base),
        doc(3, base.upper()),
        doc(4, None),
        doc(5, ""),
        doc(6, " \t\n "),
        doc(7, "one"),
        doc(8, "a b"),
        doc(9, prose(2, 40) + " " + base + "\n" + prose(3, 30), None, None),
        doc(10, "é ñ 日本 <|endoftext|> \u00a0x  y\x1cz " + prose(4, 20), "fr"),
        doc(11, prose(5, 9000)),
        doc(12, "same " * 300),
        doc(13, prose(6, 50)),
        doc(13, prose(6, 50)),
        doc(13, prose(7, 50)),
        doc(None, base),
        doc(14, prose(8, 13)),
        doc(15, prose(9, 30) + " " + prose(8, 13)),
        doc(16, prose(2, 40)),
    ]


def frame(spark, rows=None, parts=3):
    return spark.createDataFrame(odd_docs() if rows is None else rows, DOC_SCHEMA).repartition(parts)
