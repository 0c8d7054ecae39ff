"""Small documents with every awkward case, and plain re-computations to compare with."""

import random
import re

#: names that operators use inside
CLASHES = "id long, n int, component long, key string, lines string, drop string, gram long, rank int, a long, b long, lang string"


def words(text, size, rng):
    vocab = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(400)]
    return " ".join(rng.choice(vocab) for _ in range(size)) if not text else text


def awkward(seed=1):
    """(doc_id, text) rows: copies, near copies, shared lines, white space, nulls, empties, a very long text, repeated rows."""
    rng = random.Random(seed)
    rows, bases = [], []
    for k in range(12):
        base = "\n".join(words("", rng.randint(12, 40), rng) for _ in range(rng.randint(1, 5)))
        bases.append(base)
        rows.append((10 * k + 5, base))
    for k, base in enumerate(bases[:8]):
        split = base.split(" ")
        for c in range(1 + 3 * (k == 0)):
            edited = list(split)
            for _ in range(max(1, len(split) // 60)):
                edited[rng.randrange(len(edited))] = f"Edit{rng.randint(0, 99)}"
            rows.append((200 + 10 * k + c, " ".join(edited)))
    shared = words("", 60, rng)
    rows += [(400 + k, f"{words('', 15, rng)}\n{shared}\n{words('', 15, rng)}") for k in range(5)]
    rows += [(500 + k, f"{words('', 12, rng)}\nall rights reserved by owner {k}\n{words('', 13, rng)}") for k in range(7)]
    rows += [(600, bases[2]), (601, bases[2]), (602, bases[2].replace(" ", "  ", 1)), (603, bases[2].upper())]
    rows += [(700, None), (701, ""), (702, " \t\n "), (703, "one"), (704, "one"), (705, "é ß ▁ \u0000 \U0001f600 x"), (706, "\n\n")]
    rows += [(800, words("", 20_000, rng)), (801, "a" * 5000), (802, "ab " * 900)]
    rows += [(901, "again and again and again"), (901, "again and again and again"), (None, "no id"), (None, bases[3])]
    return rows


def frame(spark, rows, shuffled=True):
    """The rows with extra columns whose names the operators use themselves."""
    rows = list(rows)
    if shuffled:
        random.Random(3).shuffle(rows)
    full = [(d, t, d, 1, 2, "k", "l", "d", 3, 4, 5, 6, "en") for d, t in rows]
    return spark.createDataFrame(full, f"doc_id long, text string, {CLASHES}").repartition(3)


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def shingles(text, size):
    w = tokens(text)
    if len(w) < size:
        return {tuple(w)} if w else set()
    return {tuple(w[k: k + size]) for k in range(len(w) - size + 1)}


def groups(sets, percent=80):
    """Smallest key reachable over pairs with 100 * intersection >= percent * union."""
    parent = {k: k for k in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {k: root(k) for k in keys}
