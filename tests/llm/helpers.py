"""Small tables with the awkward cases every operator must take."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size int, target string, kept string, score string"


def sentence(k: int, n: int) -> str:
    return " ".join(f"w{(k * 7919 + i * 104729) % 9973}x{i % 7}" for i in range(n))


def awkward_docs(spark):
    """Nulls, empty and long texts, near and exact copies, repeated rows, null ids, clashing columns."""
    long = sentence(1, 30_000)
    near = sentence(2, 60)
    texts = [
        (0, sentence(3, 50), "en", "a"), (1, None, "en", "a"), (2, "", None, None), (3, " \t\n ", "de", "b"), (4, "one", "en", "b"),
        (5, "one", "en", None), (6, "One", "fr", "b"), (7, long, "en", "a"), (8, long + " tail", "en", "c"),
        (9, near, "en", "a"), (10, near + " extra", "en", "a"), (11, sentence(4, 60), "es", "c"), (11, sentence(4, 60), "es", "c"),
        (None, sentence(5, 40), "en", "a"), (None, None, None, None), (12, "!!! ??? 123", "en", "b"), (13, "é è ü 漢字 \U0001F600", "fr", "b"),
        (14, "a b c", "en", "a"), (15, "A B C", "en", "a"), (16, "a b d", "en", "a"), (17, near + " other", "en", "a"),
    ]
    return spark.createDataFrame([(i, t, g, s, None, 5, "x", "y", "z") for i, t, g, s in texts], DOC_SCHEMA)


def shingle_set(text, n=4):
    words = WORD.findall((text or "").translate(UPPER))
    if len(words) < n:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i:i + n]) for i in range(len(words) - n + 1))


def components(ids, linked):
    """Smallest id reachable, by plain union-find."""
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def near_components(texts, percent=80, n=4):
    """Component of every id by brute force over all pairs of distinct sets."""
    sets = {i: shingle_set(t, n) for i, t in texts.items()}
    rep = {}
    for i in sorted(sets):
        if sets[i]:
            rep.setdefault(sets[i], i)
    linked = [(i, rep[s]) for i, s in sets.items() if s]
    distinct = sorted(rep, key=len)
    for k, a in enumerate(distinct):
        for b in distinct[k + 1:]:
            if 100 * len(a) < percent * len(b):
                break
            both = len(a & b)
            if 100 * both >= percent * (len(a) + len(b) - both):
                linked.append((rep[a], rep[b]))
    return components(list(texts), linked)
