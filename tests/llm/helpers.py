"""Small tables with the hard cases, and plain reference computations."""
import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, label int"


def sentence(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}x{rng.randrange(7)}" for _ in range(n))


def changed(rng, text, k):
    w = text.split(" ")
    for i in rng.sample(range(len(w)), k):
        w[i] = f"new{rng.randrange(10**6)}"
    return " ".join(w)


def texts(seed=1):
    """(doc_id, text): families of copies, ties, repeats, empty, null, short and very long texts."""
    rng = random.Random(seed)
    out = [(1, ""), (2, None), (3, " \n\t\x0b "), (4, "a b c"), (5, "A  b\nC"), (6, "a b"), (7, "ß ſ K é"), (8, "\n\n"),
           (9, "x y z w v"), (10, "x y z w v")]
    base = sentence(rng, 120)
    n = 20
    for k in (0, 0, 1, 1, 2, 2, 3, 4, 5, 6, 8, 10, 15, 30):
        out.append((n, changed(rng, base, k)))
        n += 1
    for _ in range(6):
        one = sentence(rng, rng.randrange(5, 90))
        for k in (0, 0, 1, 2):
            out.append((n, changed(rng, one, min(k, 4)) + rng.choice(["", " tail", "\n" + base[:80]])))
            n += 1
    long = "\n".join(sentence(rng, 400, 5000) for _ in range(50))
    out += [(n, long), (n + 1, long + "\nmore words at the end"), (n + 2, "same words again " * 3000), (n + 3, "same words again " * 2000)]
    return out


def documents(spark, rows=None, seed=1):
    rows = texts(seed) if rows is None else rows
    return spark.createDataFrame([(i, t, "en" if (i or 0) % 3 else None, "s", len(t or ""), "clash", 5) for i, t in rows], SCHEMA)


def shingles(text, k=5):
    w = WORD.findall((text or "").translate(LOWER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)])


def jaccard_at_least(a, b, part=75, whole=100):
    i = len(a & b)
    return whole * i >= part * (len(a) + len(b) - i)


def components(ids, linked):
    """Smallest id reachable, of each id; linked: pairs."""
    least = {i: i for i in ids}

    def find(x):
        while least[x] != x:
            x = least[x]
        return x
    for a, b in linked:
        a, b = find(a), find(b)
        least[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}
