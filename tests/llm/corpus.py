"""Small tables with the awkward rows that every operator must take."""

from __future__ import annotations

import random

SYLLABLES = "th er on an re he in ed nd ha at en es of or nt ea ti to it".split()


def words(r: random.Random, n: int) -> list[str]:
    return ["".join(r.choice(SYLLABLES) for _ in range(r.randint(1, 3))) for _ in range(n)]


def prose(r: random.Random, n: int) -> str:
    out, left = [], words(r, n)
    while left:
        k = r.randint(4, 14)
        out.append(" ".join(left[:k]).capitalize() + ".")
        left = left[k:]
    return " ".join(out)


def documents(n: int = 60, seed: int = 1) -> list[tuple]:
    """(doc_id, text, score): prose, copies, near copies, null and empty texts, a very long one, odd characters, a repeated row, a null id."""
    r = random.Random(seed)
    rows: list[tuple] = [(i, prose(r, r.randint(3, 150)), 0.5) for i in range(n)]
    for i in range(n, n + 10):  # near copies in a chain
        w = rows[i - n][1].split() if i == n else rows[-1][1].split()
        w[len(w) // 2 : len(w) // 2 + 1] = words(r, 1)
        rows.append((i, " ".join(w), 0.5))
    rows += [(n + 10 + k, rows[3][1], 0.5) for k in range(12)]  # copies
    long = prose(r, 30_000)
    rows += [
        (1000, None, None),
        (1001, "", 0.1),
        (1002, " \t\n ", 0.1),
        (1003, "One", 0.1),
        (1004, "one two three", 0.1),
        (1005, "One  TWO three", 0.1),
        (1006, long, 0.1),
        (1007, long + " the end", 0.1),
        (1008, "Ärger über Öl \U0001f600 é  x y \x00 z", 0.1),
        (1009, rows[5][1], 0.1),
        (1009, rows[5][1], 0.1),
        (None, rows[6][1], 0.1),
        (None, None, None),
    ]
    return rows


#: An extra column whose name an operator uses for itself.
SCHEMA = "doc_id long, text string, score double"
