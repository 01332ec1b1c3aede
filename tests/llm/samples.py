"""Rows that the tests share."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, component_id string, n_words string, __salt int, node string, kept string, score string, language string"
VOCABULARY = "the of and to in a is that it was for on are as with his they at be this from have or by one had not but what all were when we there can an your which their said".split()


def sentence(rng: random.Random, n: int) -> list[str]:
    return [rng.choice(VOCABULARY) + rng.choice("abcdefgh") for _ in range(n)]


def odd_rows() -> list[tuple]:
    """Nulls in any column, empty, blank and very long texts, repeated rows and copies."""
    rng = random.Random(1)
    base = sentence(rng, 60)
    other = list(base)
    other[30] = "changed"
    long = sentence(rng, 60_000)
    rows = [
        (1, " ".join(base)),
        (2, None),
        (3, ""),
        (4, " \n\t \x0b "),
        (5, " ".join(base).upper()),
        (5, " ".join(base).upper()),
        (6, "\n".join(base)),
        (7, " ".join(other)),
        (8, "three words only"),
        (9, "Three  words\nonly"),
        (None, " ".join(base)),
        (None, None),
        (10, " ".join(long)),
        (11, " ".join(long[:30_000] + ["cut"] + long[30_000:])),
        (12, "x"),
        (-3, " ".join(base[:40])),
        (13, "word " * 300),
        (14, "é漢字 🙂 ñandú nbsp   " + " ".join(base[10:50])),
    ]
    return [(i, t, None if k % 3 == 0 else "en", None if k % 4 == 0 else "src0", None, "c", "w", 7, "n", "k", "s", "l") for k, (i, t) in enumerate(rows)]
