"""Plain versions of the operators for small inputs, and inputs to try them on."""

import random

BLANKS = " \t\n\x0b\f\r"


def words(text):
    return (text or "").encode("utf-8").split()


def vocabulary(rng, n=400):
    return ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 8))) for _ in range(n)]


def corpus(seed=1, n=60):
    """Texts with copies, changed copies, shared passages, short, blank and missing texts."""
    rng = random.Random(seed)
    vocab = vocabulary(rng)
    say = lambda k: " ".join(rng.choice(vocab) for _ in range(k))
    passage = say(70)
    texts = []
    for i in range(n):
        kind = i % 10
        if kind == 0:
            texts.append(say(rng.randint(1, 8)))
        elif kind == 1 and texts:
            texts.append(rng.choice(texts))
        elif kind == 2 and texts:
            changed = (rng.choice(texts) or "x").split(" ")
            changed[rng.randrange(len(changed))] = "changed"
            texts.append(" ".join(changed))
        elif kind == 3:
            texts.append(say(30) + "\n" + passage + "\n" + say(30))
        elif kind == 4:
            texts.append("\n".join([say(12)] * 3 + [say(9)]))
        else:
            texts.append(say(rng.randint(20, 160)))
    return [*texts, "", None, "  \n\t ", " ".join([vocab[0]] * 120), "one"]


def roots(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def kept_words(docs, size=50):
    """``doc_id: (words, removed, kept text)`` for ``(doc_id, text)`` with distinct ids."""
    first = {}
    for i, text in sorted(docs, key=lambda d: d[0]):
        w = words(text)
        for s in range(len(w) - size + 1):
            first.setdefault(tuple(w[s : s + size]), i)
    out = {}
    for i, text in docs:
        w = words(text)
        gone = [False] * len(w)
        for s in range(len(w) - size + 1):
            if first[tuple(w[s : s + size])] < i:
                gone[s : s + size] = [True] * size
        out[i] = (len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode())
    return out


def shingles(text, n=5):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[s : s + n]) for s in range(max(1, len(w) - n + 1))) if w else frozenset()


def near(docs, percent):
    """``doc_id: smallest id reachable`` for ``(doc_id, text)``."""
    sets = {i: shingles(t) for i, t in docs}
    ids = sorted(sets)
    links = []
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                links.append((a, b))
    return roots(ids, links)


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]
