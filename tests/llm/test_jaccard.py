import random

import pytest
from brute import edges, empty, near, sources

from flakeform.llm import common, jaccard
from flakeform.llm.jaccard import components, near_duplicates, one_of_each


def key(row):
    return tuple((x is not None, x) for x in row)


def got(docs):
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in near_duplicates(docs).collect()), key=key)


@pytest.mark.parametrize("make", [edges, sources])
def test_against_all_pairs(spark, monkeypatch, make):
    monkeypatch.setattr(common, "CHUNK_BYTES", 100_000)
    docs = make(spark)
    table = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    assert got(docs) == sorted(near(table), key=key)


@pytest.mark.parametrize("heavy", [2, 32])
def test_edited_copies(spark, monkeypatch, heavy):
    """Groups of copies with more and more edits, around the threshold; short and long texts."""
    monkeypatch.setattr(jaccard, "HEAVY", heavy)
    draw = random.Random(11)
    table = []
    for length in (1, 2, 4, 5, 6, 7, 9, 20, 60, 150):
        text = [f"w{draw.randrange(400)}" for _ in range(length)]
        for _ in range(25):
            copy = list(text)
            for _ in range(draw.randrange(1 + length // 25)):
                place = draw.randrange(len(copy))
                copy[place : place + draw.randrange(3)] = [f"w{draw.randrange(400)}" for _ in range(draw.randrange(3))]
            copy += [f"t{draw.randrange(60)}" for _ in range(draw.choice([0, 0, 1, length // 6]))]
            table.append((len(table), draw.choice([" ", "  ", "\n"]).join(copy).replace("w1", draw.choice(["w1", "W1"]))))
    table += [(1000 + i, " ".join([f"p{k}" for k in range(60)] + [f"q{i}x{k}" for k in range(draw.choice([5, 15, 100]))])) for i in range(40)]
    docs = spark.createDataFrame(table, "doc_id long, text string")
    assert got(docs) == sorted(near(table))


def test_components(spark):
    draw = random.Random(2)
    links = [(i, i + 1) for i in range(60)] + [(100 + draw.randrange(40), 100 + draw.randrange(40)) for _ in range(30)] + [(500, 500 + i) for i in range(1, 50)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "left long, right long")).collect()}
    assert found == {x: find(x) for x in root if x in found}
    assert {x for a, b in links if a != b for x in (a, b)} == set(found)


def test_one_of_each(spark):
    docs = edges(spark)
    kept = one_of_each(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert {4, 5, 6, 7, 8, 10, 11} <= set(ids) and not {2, 3, 9, 22} & set(ids)
    assert ids.count(14) == 1


@pytest.mark.parametrize("parts", [1, 7])
def test_every_component_keeps_one_row(spark, parts):
    """Null ids, an id repeated with other texts and with the same one, and rows without words."""
    words = lambda x: " ".join(f"{x}{i}" for i in range(60))
    table = [
        (None, words("a")), (None, words("b")), (None, words("b") + " tail"), (None, words("c")), (None, words("c")),
        (1, words("a")), (1, words("d")), (1, words("e")), (2, words("e")), (3, words("f")), (3, words("f")),
        (4, words("g") + " tail"), (None, words("g")), (5, ""), (5, " "), (5, ""), (6, None), (None, ""), (None, None),
    ]
    docs = spark.createDataFrame(table, "doc_id long, text string").repartition(parts)
    kept = one_of_each(docs).collect()
    ids = {x: [r["doc_id"] for r in kept if (r["text"] or "").startswith(f"{x}0")] for x in "abcdefg"}
    assert ids == {"a": [1], "b": [None], "c": [None], "d": [1], "e": [1], "f": [3], "g": [4]}
    blank = sorted((r["doc_id"] or 0, r["text"] or "") for r in kept if not (r["text"] or "").strip())
    assert blank == [(0, ""), (0, ""), (5, ""), (5, " "), (6, "")]


def test_every_component_of_edges_keeps_one_row(spark):
    docs = edges(spark)
    kept = [(r["doc_id"], r["text"]) for r in one_of_each(docs).collect()]
    nodes, named = jaccard._grouped(docs)
    roots = {r["node"]: r["root"] for r in named.filter("size > 0").collect()}
    hashed = spark.createDataFrame(kept, "doc_id long, text string").selectExpr("xxhash64(coalesce(text, '')) node").collect()
    found = [roots[r["node"]] for r in hashed if r["node"] in roots]
    assert sorted(found) == sorted(set(roots.values()))
    assert (None, "alone among nulls") in kept


def test_empty(spark):
    assert near_duplicates(empty(spark)).count() == 0
