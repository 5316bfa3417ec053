"""Small tables with the awkward cases, and brute-force versions of the operators."""

import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def awkward(spark):
    """Nulls in any column, empty and blank texts, ties, repeated rows, a long text, added tokens, odd white space."""
    base = " ".join(f"word{i} of" for i in range(60))
    rows = [
        (1, None, "en", "a"), (2, "", "en", "a"), (3, " \t\n ", None, "b"), (4, "Hello  world", "en", None), (5, "Hello world", "en", "a"),
        (5, "Hello world", "en", "a"), (None, "Hello\tworld", None, None), (7, base, "de", "b"), (8, base + " end", "de", "b"), (9, base.upper(), "de", "c"),
        (10, "x" * 30_000, "en", "c"), (11, "a <|endoftext|> b <|endoftext|>", "en", "c"), (12, "é ñ   z\n\nq \r\n w ", "fr", "c"),
        (13, base + "\n" + base, "en", "b"), (14, "All rights reserved.\nAll rights reserved.\nx", "en", "a"), (15, "one two three", "en", "a"),
        (16, "🎉 ́combining 'sS don't WE'LL 12 345", "en", "a"), (17, "long " * 3000, "en", "a"), (18, " ".join(str(i) for i in range(4000)), "xx", "d"),
    ]
    return spark.createDataFrame([(i, t, la, s, len(t or "")) for i, t, la, s in rows], DOCS)


def empty(spark):
    return spark.createDataFrame([], DOCS)


def clashing(df):
    """Extra columns with names that the operators use themselves."""
    from pyspark.sql import functions as F

    return df.withColumns({c: F.lit(9) for c in ("ids", "kept", "size", "shard", "rid", "fp", "keys", "label", "sha", "taken", "bucket", "run", "node")})


def words(text):
    return WORD.findall(text or "")


def shingles(text, k):
    w = words((text or "").translate(LOWER))
    return ({tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)}) if w else set()


def components(rows, k=4, percent=80):
    """doc_id -> smallest doc_id reachable over links; rows are (doc_id, text)."""
    sets = defaultdict(set)
    parent = {i: i for i, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    where = defaultdict(list)
    for i, t in rows:
        sets[i] = shingles(t, k)
        for s in sets[i]:
            where[s].append(i)
    for i, _ in rows:
        common = Counter(j for s in sets[i] for j in where[s] if j != i)
        for j, n in common.items():
            if 100 * n >= percent * (len(sets[i]) + len(sets[j]) - n):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return {i: find(i) for i, _ in rows}


def repeats_removed(rows, window):
    """[(doc_id, n_words, kept text)] with every word of a window that starts twice left out."""
    docs = [(i, words(t)) for i, t in rows]
    times = Counter(tuple(w[p:p + window]) for _, w in docs for p in range(len(w) - window + 1))
    out = []
    for i, w in docs:
        gone = set()
        for p in range(len(w) - window + 1):
            if times[tuple(w[p:p + window])] > 1:
                gone.update(range(p, p + window))
        out.append((i, len(w), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return out
