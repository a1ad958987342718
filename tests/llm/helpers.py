"""Plain versions of what the operators compute, and odd rows."""

import re

import xxhash

ODD_TEXTS = [None, "", " ", "\n\t \r", "a", "one two", "É é ñ 中文 words", "x" * 30_000, "a b c d e f g h i j " * 4_000]


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def frame(spark, texts, **more):
    """Documents with the given texts, beside columns whose names the operators use themselves."""
    rows = [(i, t, "x", i, 1.0) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, row string, _row long, score double").repartition(3)


def fingerprint(text, size=4):
    own = words(lower(text))
    shingles = [" ".join(own[k : k + size]) for k in range(max(1, len(own) - size + 1))] if own else []
    ones = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for k in range(64):
            ones[k] += h >> k & 1
    return sum(1 << k for k in range(64) if 2 * ones[k] > len(shingles))


def groups(nodes, linked):
    """Smallest member of each node's component."""
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(nodes):
        for b in nodes[i + 1 :]:
            if linked(a, b):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def repeated(texts, window=35):
    """For each text its words and the places of words in windows that also start elsewhere."""
    seen = {}
    for t in texts:
        own = words(t)
        for k in range(len(own) - window + 1):
            key = tuple(own[k : k + window])
            seen[key] = seen.get(key, 0) + 1
    for t in texts:
        own, gone = words(t), set()
        for k in range(len(own) - window + 1):
            if seen[tuple(own[k : k + window])] > 1:
                gone.update(range(k, k + window))
        yield own, gone


def contamination(texts, items, window=10):
    """For each text its word count, words hit and items found."""
    wanted = {}
    for i, t in items:
        own = plain_words(t)
        for k in range(max(1, len(own) - window + 1)) if own and i is not None else []:
            wanted.setdefault(tuple(own[k : k + window]), set()).add(i)
    sizes = {len(w) for w in wanted}
    for t in texts:
        own, hit, found = plain_words(t), set(), set()
        for size in sizes:
            for k in range(len(own) - size + 1):
                if ids := wanted.get(tuple(own[k : k + size])):
                    hit.update(range(k, k + size))
                    found |= ids
        yield len(own), len(hit), found
