"""Quality by perplexity: an interpolated modified Kneser-Ney model of trusted text, joined with every document's n-grams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flakeform.llm.common import CHUNK_BYTES, mapped, release_kept, texts
from flakeform.operators.lookup import lookup
from flakeform.sources.staging import stage

#: The model predicts a byte from so many bytes less one.
ORDER = 4
#: Share of a language's trusted documents that its threshold keeps, and what the threshold adds to that quantile.
QUANTILE, MARGIN = 0.99, 1.1
#: Shards of n-grams in which groups of documents ask for their costs, and groups that ask in one task.
SHARDS, GROUPS_AT_ONCE = 256, 4096
_SLICE = 4 << 20
#: Scatters n-grams over shards; odd, so that no two n-grams share a place, and small enough for a long.
_SCATTER = 0x5851F42D


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Ids that labels call good and not toxic; null labels do not."""
    return labels.filter("quality = 1 and toxic = 0 and doc_id is not null").select("doc_id").distinct()


def _slices(batch: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """N-grams of all texts, as numbers, and the number of each one's text; a few million at a time, whatever a text's length.

    A text stands after ``ORDER - 1`` marks and before one, so its end is an n-gram of its own.
    """
    some: list[bytes] = []
    owner: list[int] = []
    size = 0

    def grams() -> tuple[np.ndarray, np.ndarray]:
        code = np.frombuffer(b"".join(some), np.uint8).astype(np.uint32)
        found = code[:-3] << 24 | code[1:-2] << 16 | code[2:-1] << 8 | code[3:]
        counts = np.fromiter(map(len, some), np.int64, len(some)) - (ORDER - 1)
        inside = np.ones(len(found), bool)
        ends = np.cumsum(counts + ORDER - 1)[:-1]
        for k in range(1, ORDER):
            inside[ends - k] = False
        return found[inside], np.repeat(np.array(owner), counts)

    for i, text in enumerate(batch):
        data = b"\0" * (ORDER - 1) + text.replace(b"\0", b" ") + b"\0"
        for at in range(0, len(text) + 1, _SLICE):
            some.append(data[at : at + _SLICE + ORDER - 1])
            owner.append(i)
            size += len(some[-1])
            if size >= _SLICE:
                yield grams()
                some, owner, size = [], [], 0
    if some:
        yield grams()


def grams(docs: DataFrame) -> DataFrame:
    """(``gram``, ``n``): every n-gram of all texts, and how often trusted texts (``trusted``) have it, 0 if never."""

    def count(batch: pa.RecordBatch) -> pa.Table:
        good = np.array(batch.column("trusted").to_pylist(), bool)
        found = []
        for keys, owner in _slices(texts(batch)):
            for flag in (False, True):
                some, n = np.unique(keys[good[owner] == flag], return_counts=True)
                found.append((some.astype(np.int64), n * flag))
        none = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        keys, n = (np.concatenate(x) for x in zip(*(found or none), strict=True))
        return pa.table({"gram": pa.array(keys), "n": pa.array(n.astype(np.int64))})

    counted = mapped(docs.select(F.col("text").cast("string"), "trusted"), count, "gram long, n long")
    return counted.groupBy("gram").agg(F.sum("n").alias("n"))


def discounts(counts: DataFrame) -> list[float]:
    """What counts of one, two, and more give up, from the numbers of n-grams that were seen one to four times."""
    seen = counts.agg(*[F.count_if(F.col("n") == k).alias(f"n{k}") for k in range(1, 5)]).first()
    n1, n2, n3, n4 = (seen[f"n{k}"] for k in range(1, 5))
    y = n1 / (n1 + 2 * n2) if n1 else 0.5
    some = [k - (k + 1) * y * b / a if a and b else 0.5 * k for k, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]
    return [min(max(d, 0.05 * k), 0.95 * k) for k, d in zip((1, 2, 3), some, strict=True)]


def _low(gram: Column, size: int) -> Column:
    """The last ``size`` bytes of an n-gram."""
    return gram.bitwiseAND(F.lit((1 << 8 * size) - 1))


def _probabilities(wanted: DataFrame, counts: DataFrame, lower: DataFrame) -> DataFrame:
    """(``gram``, ``p``) of all wanted n-grams of one order, from counts of it and the probabilities of the order below.

    A context's discounts are its rest, which goes to the lower order; without a count of the context that is all.
    Each join is on the n-gram, its context, or its shorter form, sharded by their hashes.
    """
    one, two, more = discounts(counts)
    take = F.when(F.col("n") == 1, one).when(F.col("n") == 2, two).otherwise(more)
    split = counts.select("gram", F.shiftright("gram", 8).alias("context"), "n", take.alias("take"))
    totals = split.groupBy("context").agg(F.sum("n").alias("total"), F.sum("take").alias("taken"))
    return (
        wanted.withColumn("context", F.shiftright("gram", 8))
        .join(split.select("gram", "n", "take"), "gram", "left")
        .join(totals, "context", "left")
        .join(lower.withColumnsRenamed({"gram": "shorter", "p": "below"}), F.col("short") == F.col("shorter"))
        .select(
            "gram",
            (
                F.coalesce((F.col("n") - F.col("take")) / F.col("total"), F.lit(0.0))
                + F.coalesce(F.col("taken") / F.col("total"), F.lit(1.0)) * F.col("below")
            ).alias("p"),
        )
    )


def costs(all_grams: DataFrame) -> DataFrame | None:
    """(``gram``, ``bits``): what the model of the trusted counts charges for every n-gram that any document has.

    Lower orders count the different bytes before an n-gram, as Kneser-Ney wants; below the first is a uniform share.
    None if nothing is trusted. ``all_grams`` is a staged result of :func:`grams`.
    """
    tables = [all_grams.filter("n > 0")]
    wanted = [all_grams.select("gram")]
    for size in range(ORDER - 1, 0, -1):
        shorter = _low(F.col("gram"), size).alias("gram")
        tables.append(stage(tables[-1].select(shorter).groupBy("gram").agg(F.count(F.lit(1)).alias("n")), f"grams-{size}"))
        wanted.append(wanted[-1].select(shorter).distinct())
    sizes = tables[-1].agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds")).first()
    if not sizes["total"]:
        return None
    share = (F.col("n") - 0.5) / F.lit(float(sizes["total"]))
    uniform = 0.5 * sizes["kinds"] / sizes["total"] / 256
    found = wanted[-1].join(tables[-1], "gram", "left").select("gram", (F.coalesce(share, F.lit(0.0)) + F.lit(uniform)).alias("p"))
    for size in range(2, ORDER + 1):
        here = wanted[ORDER - size].withColumn("short", _low(F.col("gram"), size - 1))
        found = stage(_probabilities(here, tables[ORDER - size], found), f"order-{size}")
    return found.select("gram", (-F.log2("p")).cast("float").alias("bits"))


def _scattered(grams: np.ndarray) -> np.ndarray:
    """Places of n-grams among 2^32, no two alike; the leading bits number the shard."""
    return (grams.astype(np.uint64) * np.uint64(_SCATTER)).astype(np.uint32)


def _distinct(batch: list[bytes]) -> np.ndarray:
    """Scattered places of all n-grams of some texts, each once, in order."""
    found = [np.unique(keys) for keys, _ in _slices(batch)]
    return np.sort(_scattered(np.unique(np.concatenate([np.zeros(0, np.uint32), *found]))))


def perplexity(docs: DataFrame, model: DataFrame) -> DataFrame:
    """Per row ``doc_id``, ``lang``, ``trusted``, ``n_bytes`` and ``perplexity`` (per byte, the end included).

    Documents are dealt to groups of a few megabytes, and texts are shuffled to them once. A group lists its distinct n-grams, cut
    into shards; in each shard they meet the costs of :func:`costs`, and the answers go back to the group, which sums them over each
    whole text. So a document costs one entry per n-gram of its group, and no task holds the model. Groups and rows
    in a shard follow the input in number, not in size. A null text is empty.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.col("lang").cast("string"), F.col("text").cast("string"), "trusted")
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 64
    total = rows.agg(F.coalesce(F.sum(size), F.lit(0)).alias("n")).first()["n"]
    groups = max(1, -(-total // CHUNK_BYTES))
    spread = F.xxhash64("doc_id", F.octet_length("text"), F.monotonically_increasing_id())
    grouped = rows.withColumn("group", F.pmod(spread, F.lit(groups)).cast("int"))
    shard_bits = SHARDS.bit_length() - 1

    def ask(table: pa.Table) -> pa.Table:
        release_kept()
        keys = _distinct(texts(table.select(["text"]).combine_chunks()))
        cut = np.searchsorted(keys, np.arange(SHARDS + 1, dtype=np.uint64) << np.uint64(32 - shard_bits))
        shards = [s for s in range(SHARDS) if cut[s] < cut[s + 1]]
        return pa.table(
            {
                "shard": pa.array(shards, pa.int32()),
                "group": pa.array([table.column("group")[0].as_py()] * len(shards), pa.int32()),
                "keys": pa.array([keys[cut[s] : cut[s + 1]].tobytes() for s in shards], pa.binary()),
            }
        )

    def answer(asked: pa.Table, known: pa.Table) -> pa.Table:
        release_kept()
        keys = _scattered(known.column("gram").to_numpy())
        order = np.argsort(keys)
        keys, bits = keys[order], known.column("bits").to_numpy()[order]
        payload = [bits[np.searchsorted(keys, np.frombuffer(x, np.uint32))].tobytes() for x in asked.column("keys").to_pylist()]
        return pa.table({"group": asked.column("group"), "shard": asked.column("shard"), "bits": pa.array(payload, pa.binary())})

    def score(table: pa.Table, answers: pa.Table) -> pa.Table:
        release_kept()
        found = texts(table.select(["text"]).combine_chunks())
        keys = _distinct(found)
        parts = sorted(zip(answers.column("shard").to_pylist(), answers.column("bits").to_pylist(), strict=True))
        bits = np.frombuffer(b"".join(x for _, x in parts), np.float32)
        total = np.zeros(len(found))
        for some, owner in _slices(found):
            total += np.bincount(owner, bits[np.searchsorted(keys, _scattered(some))], len(found))
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        columns = {name: table.column(name) for name in ("doc_id", "lang", "trusted")}
        return pa.table({**columns, "n_bytes": pa.array(lengths), "perplexity": pa.array(2.0 ** (total / (lengths + 1)))})

    parts = -(-groups // GROUPS_AT_ONCE)
    asked = grouped.groupBy("group").applyInArrow(ask, "shard int, group int, keys binary")
    asked = asked.withColumn("part", F.floor(F.col("group") / GROUPS_AT_ONCE).cast("int"))
    place = (F.col("gram") * F.lit(_SCATTER)).bitwiseAND(F.lit((1 << 32) - 1))
    known = model.select(
        "gram",
        "bits",
        F.shiftright(place, 32 - shard_bits).cast("int").alias("shard"),
        F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"),
    )
    answered = asked.groupBy("shard", "part").cogroup(known.groupBy("shard", "part"))
    answers = answered.applyInArrow(answer, "group int, shard int, bits binary")
    scored = grouped.groupBy("group").cogroup(answers.groupBy("group"))
    return scored.applyInArrow(score, "doc_id long, lang string, trusted boolean, n_bytes long, perplexity double")


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document ``doc_id``, ``lang``, ``n_bytes``, ``perplexity``, ``threshold`` and ``kept``.

    The model counts all trusted documents. A language's threshold is a high quantile of the perplexities of its
    trusted documents, with a margin; a language without any, or null, takes that of all trusted documents together.
    Documents up to the threshold are kept; without trusted documents all are, and perplexity is null. Repeated rows
    stay. A null text is empty; its perplexity is that of the end alone. Columns of the input other than ``doc_id``,
    ``lang`` and ``text`` are not read. ``docs`` must be a scan or a staged table.
    """
    trusted = stage(trusted_ids(labels).withColumn("trusted", F.lit(True)), "trusted")
    rows = lookup(docs.select("doc_id", "lang", "text"), trusted.withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType)), ["doc_id"], ["trusted"])
    rows = rows.withColumn("trusted", F.coalesce("trusted", F.lit(False)))
    model = costs(stage(grams(rows), "grams"))
    if model is None:
        none = F.lit(None).cast("double")
        size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
        return rows.select(
            F.col("doc_id").cast("long"), "lang", size.alias("n_bytes"), none.alias("perplexity"), none.alias("threshold"), F.lit(True).alias("kept")
        )
    scored = stage(perplexity(rows, model), "perplexity")
    quantile = F.percentile_approx("perplexity", QUANTILE, 10_000) * F.lit(MARGIN)
    good = scored.filter("trusted")
    by_language = stage(good.filter("lang is not null").groupBy("lang").agg(quantile.alias("own")), "thresholds")
    overall = good.agg(quantile.alias("overall")).first()["overall"]
    limit = F.coalesce("own", F.lit(overall).cast("double"))
    return lookup(scored, by_language, ["lang"], ["own"]).select(
        "doc_id",
        "lang",
        "n_bytes",
        "perplexity",
        limit.alias("threshold"),
        F.coalesce(F.col("perplexity") <= limit, F.lit(True)).alias("kept"),
    )
