import hashlib
import random

import pytest
from brute import edges, empty, sources
from pyspark.sql import functions as F

from flakeform.llm import fingerprint as fp


def key(row):
    return (row[0] is not None, row[0] or 0, row[1])


def followed(docs):
    """(doc_id, text, next text) by one sort: nulls first, equal ids by the hash of their text."""
    coded = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("code", F.xxhash64("text"))
    rows = sorted(map(tuple, coded.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[2], r[1]))
    return [(d, t, rows[(i + 1) % len(rows)][1]) for i, (d, t, _) in enumerate(rows)]


@pytest.mark.parametrize("bucket_rows", [1, 7, 1000])
@pytest.mark.parametrize("make", [edges, sources])
def test_neighbours_and_edits(spark, make, bucket_rows):
    docs = make(spark)
    want = followed(docs)
    got = fp.with_next(docs, bucket_rows).withColumn("edited", fp.edited(F.col("text"), F.col("next_text"))).collect()
    assert sorted(((r["doc_id"], r["text"], r["next_text"]) for r in got), key=lambda r: (*key(r), r[2])) == sorted(want, key=lambda r: (*key(r), r[2]))
    for r in got:
        half = len(r["text"]) // 2
        assert r["edited"] == r["text"][: len(r["text"]) - half] + r["next_text"][:half]


def test_uneven_ids(spark):
    ids = [0, 1, 2, 3, 5, 8, 1 << 40, (1 << 62) + 5, -(1 << 62)]
    docs = spark.createDataFrame([(i, f"t{i}") for i in ids], "doc_id long, text string")
    got = {r["text"]: r["next_text"] for r in fp.with_next(docs, 2).collect()}
    ids.sort()
    assert got == {f"t{a}": f"t{b}" for a, b in zip(ids, [*ids[1:], ids[0]], strict=True)}


@pytest.mark.parametrize("ids", ["one far", "null", "one", "half", "squares"])
def test_no_bucket_holds_the_table(spark, ids):
    i = F.col("id")
    rule = {
        "one far": F.when(i == 0, F.lit(1 << 60)).otherwise(i),
        "null": F.lit(None).cast("long"),
        "one": F.lit(7).cast("long"),
        "half": F.when(i % 2 == 0, F.lit(-5).cast("long")).otherwise(i * 1000),
        "squares": F.pow(F.lit(1.02), i).cast("long"),
    }[ids]
    docs = spark.range(2000).select(rule.alias("doc_id"), F.concat(F.lit("text "), i).alias("text")).repartition(5)
    rows, names = fp._bucketed(docs.withColumn("code", F.xxhash64("text")), 16)
    assert rows.groupBy(*names).count().agg(F.max("count")).first()[0] <= 64
    order = lambda r: (*key(r), r[2])
    assert sorted(map(tuple, fp.with_next(docs, 16).collect()), key=order) == sorted(followed(docs), key=order)


def prints(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string").select("i", fp.fingerprint(F.col("text")).alias("p"))
    return [r["p"] for r in df.orderBy("i").collect()]


def test_multiset_properties(spark):
    a, b = "One line.\nTwo lines. Three?\n", "Four!\nFive lines here.\n"
    pa, pb, ab, ba, none, null, other = prints(spark, [a, b, a + b, b + a, "", None, a + "x"])
    assert ab == ba and none == null == [0] * len(pa) and pa != other
    row = spark.range(1).select(*[F.array(*[F.lit(x).cast("long") for x in p]).alias(n) for n, p in (("a", pa), ("b", pb), ("ab", ab))])
    got = row.select(fp.merge(F.col("a"), F.col("b")).alias("m"), fp.remove(F.col("ab"), F.col("b")).alias("r")).first()
    assert got["m"] == ab and got["r"] == pa


def test_lanes_wrap(spark):
    """More equal paragraphs than a lane counts."""
    many, one = prints(spark, ["a\n" * 40_000, "a\n"])
    assert many[-1] == 40_000
    for k in range(fp.NARROW):
        for lane in range(4):
            assert (many[k] >> 16 * lane) & 0x3FFF == 40_000 * ((one[k] >> 16 * lane) & 1) % 0x4000


def test_likeness_estimates_common_paragraphs(spark):
    draw = random.Random(1)
    line = lambda: " ".join(f"w{draw.randrange(10**6)}" for _ in range(5)) + "\n"
    rows = []
    for share in (0.0, 0.3, 0.6, 0.9, 1.0):
        for _ in range(20):
            common = [line() for _ in range(int(60 * share))]
            left, right = (common + [line() for _ in range(60 - len(common))] for _ in range(2))
            draw.shuffle(right)
            rows.append((share, "".join(left), "".join(right)))
    df = spark.createDataFrame(rows, "share double, a string, b string")
    got = df.groupBy("share").agg(F.avg(fp.likeness(fp.fingerprint(F.col("a")), fp.fingerprint(F.col("b")))).alias("near"))
    for r in got.collect():
        assert r["near"] == pytest.approx(r["share"], abs=0.08)


def test_likeness_of_long_texts(spark):
    """More paragraphs on one side only than a lane counts."""
    lines = [f"line {i}\n" for i in range(50_000)]
    rows = [(0, 15_000), (0, 25_000), (0, 49_000), (40_000, 50_000), (0, 50_000)]
    df = spark.createDataFrame([("".join(lines), "".join(lines[a:b])) for a, b in rows], "a string, b string")
    pair = df.select(fp.fingerprint(F.col("a")).alias("a"), fp.fingerprint(F.col("b")).alias("b"))
    got = pair.select(fp.likeness(F.col("a"), F.col("b")), fp.likeness(F.col("b"), F.col("a"))).collect()
    for (a, b), both in zip(rows, got, strict=True):
        assert list(both) == pytest.approx([2 * (b - a) / (50_000 + b - a)] * 2, abs=0.12)
    none = spark.createDataFrame([("a\n" * 0x8000, "")], "a string, b string")
    assert none.select(fp.likeness(fp.fingerprint(F.col("a")), fp.fingerprint(F.col("b")))).first()[0] == 0


def test_query_digests(spark):
    from flakeform.llm.queries import op4_fingerprint

    rows = op4_fingerprint(spark, "/root/testdata/sf0.001").collect()
    text = {r["doc_id"]: r["text"] for r in sources(spark).collect()}
    ids = sorted(text)
    by_print = {}
    for r in rows:
        t, n = text[r["doc_id"]], text[ids[(ids.index(r["doc_id"]) + 1) % len(ids)]]
        half = len(t) // 2
        assert r["n_chars"] == len(t)
        edited = t[: len(t) - half] + n[:half]
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= r["near_next"] <= 1 and 0 <= r["near_edited"] <= 1
        assert by_print.setdefault(r["fingerprint"], t) == t
    assert sum(r["near_edited"] > r["near_next"] for r in rows) > 0.8 * len(rows)


def test_empty(spark):
    assert fp.fingerprints(empty(spark)).count() == 0
