"""A small table of documents with the odd rows that every operator has to take."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, batch string, cls string, token int, g string, n int"


def prose(rng: random.Random, n: int, lang: str = "en") -> str:
    parts = {"en": ["the", "th", "er", "ing", "on", "wh", "sh"], "fr": ["le", "é", "eau", "que", "oi", "ç"], "de": ["der", "sch", "ü", "ung", "ich", "ß"]}[lang]
    words = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 4))) for _ in range(n)]
    return " ".join(w + ("." if i % 11 == 10 else "") for i, w in enumerate(words))


def documents(seed: int = 3) -> list[tuple]:
    rng = random.Random(seed)
    rows = []
    for i in range(60):
        lang = ("en", "fr", "de")[i % 3]
        rows.append((i, prose(rng, rng.randint(30, 120), lang), lang, f"s{i % 2}"))
    base = prose(rng, 200)
    words = base.split(" ")
    for i in range(60, 80):  # near copies of one text, all different
        copy = list(words)
        for _ in range(i % 5):
            copy[rng.randrange(len(copy))] = prose(rng, 1)
        rows.append((i, " ".join(copy), "en", "s0"))
    rows += [(i, rows[5][1], "de", "s1") for i in (80, 81, 82)]  # exact copies
    rows += [(83, "one two", "en", "s0"), (84, "One TWO", "en", None), (85, "", "en", "s0"), (86, None, None, None), (87, " \t\n ", None, "s1")]
    rows += [(88, "same words " * 100, "en", "s0"), (89, "Ärger " * 3000 + prose(rng, 4000), "de", "s1"), (90, "123 !!! 456", "en", "s0")]
    rows += [(None, "a null id with " + rows[1][1], "fr", "s1"), (91, rows[0][1] + " " + rows[1][1], None, "s0")]
    rows += [(92, "twice the same row " + rows[2][1], "de", "s1")] * 2  # a repeated row
    return [(*r, None if r[1] is None else len(r[1]), "b", "c", 7, "g", 9) for r in rows]
