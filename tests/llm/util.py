"""Small documents with every awkward case, and brute-force helpers."""

import random

SYLLABLES = ["ka", "to", "mi", "ren", "so", "lu", "pa", "vie", "dor", "ñu", "öl"]


def words(rng, n):
    return ["".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 3))) for _ in range(n)]


def documents(seed=1, n=60):
    """(doc_id, text): nulls, empty and blank texts, one-word texts, runs of one
    word, near and exact copies, shared passages, one long text, repeated rows."""
    rng = random.Random(seed)
    passage = words(rng, 60)
    rows = [(1, None), (2, ""), (3, " \t\r\n\x0b\x0c "), (4, "one"), (5, "One two"), (6, "one"), (7, "a " * 200), (8, "b a " * 90),
            (9, "x\x00y \x1c z w")]
    for i in range(10, n):
        w = words(rng, rng.randint(3, 160))
        kind = i % 5
        if kind == 0:
            at = rng.randint(0, len(w))
            w[at:at] = passage
        if kind == 1 and len(rows) > 12:
            base = rng.choice([t for _, t in rows if t and len(t.split()) > 20] or ["k"])
            w = base.split()
            for _ in range(rng.randint(0, 4)):
                w[rng.randrange(len(w))] = "changed" + str(i)
        if kind == 2:
            w = [x.upper() if rng.random() < 0.2 else x for x in w]
        text = ""
        for x in w:
            text += x + rng.choice([" ", " ", " ", "\n", "  "])
        rows.append((i, text))
    rows.append((n, " ".join(words(rng, 3000))))
    rows.append(rows[20])  # a repeated row
    rows.append((15, "same id, other text"))
    rows.append((n + 1, rows[25][1]))
    return rows


def frame(spark, rows, parts=3):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)


def key(row):
    return tuple((x is None, str(x)) for x in row)
