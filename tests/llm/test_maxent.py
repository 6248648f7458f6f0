import math
import zlib
from collections import Counter

import numpy as np
import pytest
from brute import edges, empty, lower, sources, words
from pyspark.sql import functions as F

from flakeform.llm import common, maxent
from flakeform.llm.common import Words, crc_fold


def fold(doc):
    return doc is not None and zlib.crc32(str(doc).encode()) % 7 == 2


def base(rows):
    counts = Counter()
    for doc, text in rows:
        if not fold(doc):
            counts.update([*words(lower(text)), None])
    total, distinct = sum(counts.values()), len(counts)
    out = []
    for doc, text in rows:
        tokens = [*words(lower(text)), None]
        score = sum(math.log10((counts[t] + 1) / (total + 1 * (distinct + 1))) for t in tokens)
        out.append((doc if doc is not None else -1, fold(doc), len(tokens), sum(counts[t] > 0 for t in tokens), total, round(score, 4)))
    return sorted(out)


@pytest.mark.parametrize("make", [edges, sources])
def test_base_scores(spark, monkeypatch, make):
    monkeypatch.setattr(common, "CHUNK_BYTES", 50_000)
    docs = make(spark)
    got = maxent.score_documents(docs, crc_fold(F.col("doc_id"), 7) == 2).collect()
    want = base([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()])
    names = ("held_out", "n_tokens", "n_known", "train_tokens")
    found = sorted((r["doc_id"] if r["doc_id"] is not None else -1, *[r[n] for n in names], round(r["base_score"], 4)) for r in got)
    assert [r[:-1] for r in found] == [r[:-1] for r in want]
    assert [r[-1] for r in found] == pytest.approx([r[-1] for r in want], abs=1e-3)
    assert all(r["score"] < 0 for r in got)


def test_held_out_texts_score_better_than_the_base(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [r for r in maxent.score_documents(docs, crc_fold(F.col("doc_id"), 7) == 2).collect() if r["held_out"]]
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows)
    assert sum(r["score"] > r["base_score"] for r in rows) > 0.9 * len(rows)


def test_model_is_a_distribution():
    """All known words, one unknown word for each class of other words, and the end sum to one."""
    texts = [b"the cat the dog the bird sat on a mat", b"the end"] * 3
    counted = Counter(w for t in texts for w in t.split())
    found = Words([b" ".join(counted)], True)
    top = sorted(((int(h) - (1 << 64) if h >> np.uint64(63) else int(h), n, w[-1]) for h, (w, n) in zip(found.hashes, counted.items(), strict=True)), key=lambda x: -x[1])[:3]
    tail = {}
    for w, n in counted.items():
        c, k = tail.get(w[-1], (0, 0))
        tail[w[-1]] = (c + n, k + 1)
    known = maxent.lexicon(top, tail, len(texts))
    _, classes = known.lookup(found)
    within = np.zeros(maxent.CLASSES)
    for c, n in zip(classes, counted.values(), strict=True):
        within[c] += (n + 1) / known.mass[c]
    within[maxent.TOP_CLASSES : maxent.END_CLASS] += 1 / known.mass[maxent.TOP_CLASSES : maxent.END_CLASS]
    within[maxent.END_CLASS] += (len(texts) + 1) / known.mass[maxent.END_CLASS]
    used = within > 0
    assert np.allclose(within[used], 1)
    scores = maxent.class_scores(np.random.default_rng(0).normal(size=(maxent.ROWS, maxent.CLASSES)).astype(np.float32), np.arange(50))
    assert np.allclose(np.exp(scores).sum(axis=1), 1, atol=1e-4)


def test_updates_raise_the_likelihood():
    context = np.arange(400) * 37 % 5000
    counts = np.random.default_rng(1).integers(0, 5, (400, maxent.CLASSES)).astype(np.float32) ** 3
    start = np.zeros((maxent.ROWS, maxent.CLASSES), np.float32)
    value = lambda w: (maxent.class_scores(w, context) * counts).sum()
    once, used = maxent.update(start, context, counts, 0)
    assert value(once) > value(start) and used[0] == counts.sum()


def test_empty_and_untrained(spark):
    assert maxent.score_documents(empty(spark), F.lit(False)).count() == 0
    rows = maxent.score_documents(edges(spark), F.lit(True)).collect()
    assert {r["train_tokens"] for r in rows} == {0} and {r["base_score"] for r in rows} == {0.0}
