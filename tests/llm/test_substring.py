import random

import pytest
from brute import edges, empty, repeats, sources

from flakeform.llm import common
from flakeform.llm.common import Words
from flakeform.llm.substring import _candidates, recompress, remove_repeats


def key(row):
    return tuple((x is not None, x) for x in row)


@pytest.mark.parametrize("make", [edges, sources])
@pytest.mark.parametrize("chunk_bytes", [1 << 24, 20_000])
def test_against_all_windows(spark, monkeypatch, make, chunk_bytes):
    monkeypatch.setattr(common, "CHUNK_BYTES", chunk_bytes)
    docs = make(spark)
    want = repeats([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()])
    got = [(r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in remove_repeats(docs).collect()]
    assert sorted(got, key=key) == sorted(want, key=key)


def test_small_alphabet(spark, monkeypatch):
    """Few different words: long runs, periods, and many accidental repeats."""
    monkeypatch.setattr(common, "CHUNK_BYTES", 2_000)
    draw = random.Random(5)
    texts = [" ".join(draw.choice("ab"[: 1 + i % 2] + "c" * (i % 3 == 0)) * draw.randint(1, 3) for _ in range(draw.randint(0, 90))) for i in range(150)]
    texts += ["a " * n for n in (5, 12, 13, 14, 40)] + ["a b " * n for n in (6, 7, 20, 21)]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in remove_repeats(docs).collect()]
    assert sorted(got) == sorted(repeats(rows))


def test_equal_windows_have_equal_determined_symbols():
    """A symbol that a window determines is found at the same place of every equal window."""
    draw = random.Random(3)
    common_part = [draw.choice("abcdefgh") for _ in range(40)]
    texts = [" ".join([draw.choice("abcdefgh") for _ in range(draw.randint(0, 20))] + common_part + [draw.choice("abcdefgh") for _ in range(draw.randint(0, 20))]).encode() for _ in range(30)]
    words = Words(texts, False)
    symbols = recompress(words)
    places = {}
    for name, start, left, right, owner in zip(symbols.names, symbols.starts, symbols.left, symbols.right, symbols.owner, strict=True):
        places.setdefault(int(owner), []).append((int(name), int(start), int(left), int(right)))
    inside = []
    for i, text in enumerate(texts):
        at = int(words.first[i]) + next(k for k in range(len(text.split())) if [w.decode() for w in text.split()[k : k + 40]] == common_part)
        inside.append({(n, s - at) for n, s, a, b in places[i] if a >= at and b <= at + 40})
    assert all(len(x) > 3 for x in inside)
    assert len(set(map(frozenset, inside))) == 1


def test_every_repeated_window_is_a_candidate():
    import numpy as np

    draw = random.Random(4)
    texts = [" ".join(draw.choice("abc") for _ in range(60)).encode() for _ in range(20)]
    words = Words(texts, False)
    symbols = recompress(words)
    owners = {}
    for n, o in zip(symbols.names.tolist(), symbols.owner.tolist(), strict=True):
        owners.setdefault(n, set()).add(o)
    shared = np.array([len(owners[n]) > 1 for n in symbols.names.tolist()])
    found = set(_candidates(words, symbols, shared, 6).tolist())
    by_window = {}
    for i, text in enumerate(texts):
        w = text.split()
        for k in range(len(w) - 5):
            by_window.setdefault(tuple(w[k : k + 6]), []).append((i, int(words.first[i]) + k))
    repeated = {p for places in by_window.values() if len({i for i, _ in places}) > 1 for _, p in places}
    assert repeated and repeated <= found


def test_empty(spark):
    assert remove_repeats(empty(spark)).count() == 0
