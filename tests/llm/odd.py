"""Rows that every operator on texts has to take."""

import random

DOCS = "doc_id long, text string"
CLASHING = "id long, row long, of int, name string, bucket long, component long, label int, score double"


def prose(seed, words):
    pick = random.Random(seed)
    parts = ["re", "ti", "on", "ka", "lem", "é", "st", "ou", "Da", "x"]
    out = ["".join(pick.choice(parts) for _ in range(pick.randint(1, 4))) for _ in range(words)]
    return "".join(w + pick.choice([" ", " ", ", ", ".\n"]) for w in out)


def odd_rows():
    """Nulls, empty and blank texts, a very long one, copies, repeated rows, a null id."""
    long_text = prose(1, 30_000)
    return [
        (1, None),
        (2, ""),
        (3, " \n\t \n"),
        (4, "Ä"),
        (5, long_text),
        (6, prose(2, 120)),
        (7, prose(2, 120)),
        (8, prose(3, 40)),
        (8, prose(3, 40)),
        (None, prose(4, 60)),
        (9, "a\\b|c<d> ### <|endoftext|> it's 42"),
    ]
