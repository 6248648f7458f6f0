"""Plain versions of the operators, and tables for them."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(text):
    return WORD.findall(text or "")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def sources(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def rows(df):
    return [tuple(r) for r in df.collect()]


def passage(seed, n):
    return " ".join(f"w{(seed * 7919 + i * i * 31 + i) % 997}" for i in range(n))


def edge_rows():
    """Nulls, blanks, long texts, ties, repeated rows, near copies and shared passages."""
    long = passage(1, 30_000)
    base = passage(2, 200)
    near = base.replace("w", "W", 3) + " tail"
    cut = " ".join(base.split()[:150])
    shared = passage(3, 40)
    rows = [
        (1, base, "en", "a", 1),
        (2, base, "en", "a", 1),
        (3, near, None, None, None),
        (4, cut, "fr", "b", 5),
        (5, None, "fr", None, 0),
        (6, "", None, "b", None),
        (7, " \t\n\x0b\f\r ", "en", "c", 3),
        (8, "one two three", "en", "a", 3),
        (9, "One  two\nthree", "en", "c", 3),
        (10, long, "de", "a", 3),
        (11, "x " * 400, "de", "d", 3),
        (12, "x " * 300 + "y", "de", "d", 3),
        (13, f"{passage(4, 30)} {shared} {passage(5, 30)}", "en", "a", 3),
        (14, f"{passage(6, 50)}\n{shared}\n{passage(7, 3)} {shared}", "en", "a", 3),
        (14, f"{passage(6, 50)}\n{shared}\n{passage(7, 3)} {shared}", "en", "a", 3),
        (16, "ünïcode  nbsp  em 漢字 🙂 \x1c sep ſecret=abcdefgh", "de", "é", 3),
        (None, base, "en", None, 3),
        (None, "alone among nulls", None, "a", None),
        (20, "line one here\nline one here\n\nline two\nline one here\n", "en", "a", 3),
        (21, "12345 67890 ### %%%", "en", "z", 3),
        (22, "x " * 400, "de", "d", 3),
    ]
    rows += [(100 + i, " ".join(w if j % 40 != i % 40 else f"e{i}" for j, w in enumerate(passage(9, 120).split())), "en", "a", 3) for i in range(60)]
    return rows


def edges(spark):
    """The rows above with extra columns whose names operators use for their own."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(edge_rows(), SCHEMA)
    clashing = ["size", "target", "copies", "score", "lang_pred", "node", "chunk", "bucket", "copy", "piece", "kept", "fingerprint", "rule", "n_words"]
    return df.select("*", *[F.lit("other").alias(name) for name in clashing])


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def repeats(table, size=13):
    """(doc_id, n_words, n_removed, kept) of every row; a null id is the smallest."""
    key = lambda d: (d is not None, d or 0)
    first = {}
    for doc, text in table:
        w = words(text)
        for i in range(len(w) - size + 1):
            window = tuple(w[i : i + size])
            if window not in first or key(doc) < first[window]:
                first[window] = key(doc)
    out = []
    for doc, text in table:
        w = words(text)
        gone = set()
        for i in range(len(w) - size + 1):
            if first[tuple(w[i : i + size])] < key(doc):
                gone.update(range(i, i + size))
        out.append((doc, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def shingle_set(text, n=5):
    w = words(lower(text))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1)))


def near(table):
    """(doc_id, n_shingles, component_id) of every row, from all pairs."""
    sets = [shingle_set(text) for _, text in table]
    root = list(range(len(table)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(table)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                root[find(i)] = find(j)
    groups = defaultdict(list)
    for i, (doc, _) in enumerate(table):
        groups[find(i)].append(doc)
    least = {r: min((d for d in ids if d is not None), default=None) for r, ids in groups.items()}
    return [(doc, len(sets[i]), least[find(i)] if sets[i] else doc) for i, (doc, _) in enumerate(table)]


def measures(text):
    w = words(text)
    chars = sum(map(len, w))
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    lines = [x for x in (text or "").split("\n") if words(x)]
    windows = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {i + k for i in range(len(w) - 2) for k in range(3) if windows[tuple(w[i : i + 3])] > 1}
    return len(w), chars, symbols, len(lines) - len(set(lines)), len(covered)
