"""Rows that every operator has to stand."""

from __future__ import annotations

import random

#: Names that operators use inside; inputs may have them too.
CLASHING = ("id", "key", "n", "range", "chunk", "rid", "rest", "label", "score", "component", "pool", "word", "kept")


def prose(seed: int, n: int, vocabulary: int = 400) -> str:
    """``n`` invented words."""
    own = random.Random(seed)
    return " ".join(f"w{own.randrange(vocabulary)}" for _ in range(n))


#: Null, empty, blank, short, repeated rows, ties, a very long text, odd characters, a null id.
def edge_rows() -> list[tuple]:
    same = prose(1, 60)
    return [
        (1, None),
        (2, ""),
        (3, " \t\n\x0b "),
        (4, "one two"),
        (5, same),
        (5, same),
        (6, same),
        (7, same.upper()),
        (8, prose(2, 20_000)),
        (9, "x" * 50_000),
        (10, "naïve – \x1f ｆｕｌｌ \U0001f600 ́ end"),
        (11, prose(3, 30) + " " + same),
        (None, prose(4, 40)),
        (12, "a " * 500),
    ]
