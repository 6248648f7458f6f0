"""Language-model scores: a hashed maximum-entropy model with a class-factored softmax."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flakeform.llm.census import FRAGMENT, answers, block_bits, fragments, settle
from flakeform.llm.common import Words, chunked, mapped, sliced, texts
from flakeform.sources.staging import stage

#: Frequent words that are symbols of their own; all others are symbols by their last byte.
TOP_WORDS = 1000
#: Classes of frequent words, of one word each as long as they are frequent enough; classes of other words.
TOP_CLASSES, TAIL_CLASSES = 31, 16
CLASSES = TOP_CLASSES + TAIL_CLASSES + 1
END_CLASS = CLASSES - 1
#: Symbols: frequent words, other words, the end, and what is before a text.
SYMBOLS = TOP_WORDS + TAIL_CLASSES + 2
END_SYMBOL, START_SYMBOL = SYMBOLS - 2, SYMBOLS - 1
#: Rows of the weight table, of which the pairs of symbols are hashed to the last ones.
ROWS = 8192
#: Rounds of updates; shards that make them side by side; contexts of one update; step.
ROUNDS, SHARDS, BATCH, RATE = 6, 8, 512, 0.5


@dataclass(frozen=True)
class Lexicon:
    """Frequent words with their symbols and classes, and the total (count + 1) of each class."""

    hashes: np.ndarray
    symbol: np.ndarray
    word_class: np.ndarray
    mass: np.ndarray

    def lookup(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """Symbol and class of every word."""
        tail = (words.data[words.ends - 1] % TAIL_CLASSES).astype(np.int64)
        if not len(self.hashes):
            return TOP_WORDS + tail, TOP_CLASSES + tail
        at = np.minimum(np.searchsorted(self.hashes, words.hashes), len(self.hashes) - 1)
        hit = self.hashes[at] == words.hashes
        return np.where(hit, self.symbol[at], TOP_WORDS + tail), np.where(hit, self.word_class[at], TOP_CLASSES + tail)


def lexicon(top: list[tuple[int, int, int]], tail: dict[int, tuple[int, int]], ends: int) -> Lexicon:
    """From the frequent words (hash, count, last byte), by count; and per last byte, count and number of all words.

    Classes of frequent words have about equal shares of their total count.
    """
    counts = np.array([c for _, c, _ in top], np.int64)
    mass = np.zeros(CLASSES)
    classes, now, used = [], 0, 0.0
    left = float(counts.sum())
    for count in counts.tolist():
        if used and used + count / 2 > left / max(1, TOP_CLASSES - now) and now < TOP_CLASSES - 1:
            left -= used
            now, used = now + 1, 0.0
        classes.append(now)
        used += count
    np.add.at(mass, np.array(classes, np.int64), counts + 1)
    for byte, (total, distinct) in tail.items():
        mass[TOP_CLASSES + byte % TAIL_CLASSES] += total + distinct
    for _, count, byte in top:
        mass[TOP_CLASSES + byte % TAIL_CLASSES] -= count + 1
    mass[TOP_CLASSES : TOP_CLASSES + TAIL_CLASSES] += 1
    mass[END_CLASS] += ends + 1
    hashes = np.array([h & (1 << 64) - 1 for h, *_ in top], np.uint64)
    order = np.argsort(hashes)
    return Lexicon(hashes[order], np.arange(len(top))[order], np.array(classes, np.int64)[order], np.maximum(mass, 1.0))


def contexts(words: Words, known: Lexicon) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every token, ends included: its context (the two symbols before it), its class, and its text."""
    symbol, word_class = known.lookup(words)
    n = len(words.first) - 1
    owner = words.owner
    place = np.arange(len(symbol)) + owner
    total = len(symbol) + n
    symbols, classes = np.full(total, END_SYMBOL), np.full(total, END_CLASS)
    symbols[place], classes[place] = symbol, word_class
    begin = words.first[:-1] + np.arange(n)
    text = np.repeat(np.arange(n), words.counts + 1)
    offset = np.arange(total) - begin[text]
    one = np.where(offset >= 1, np.roll(symbols, 1), START_SYMBOL)
    two = np.where(offset >= 2, np.roll(symbols, 2), START_SYMBOL)
    return two * SYMBOLS + one, classes, text


def features(context: np.ndarray) -> np.ndarray:
    """Rows of the weight table that are active in a context: bias, last word, skipped word, and both, hashed."""
    two, one = np.divmod(context, SYMBOLS)
    first = 1 + 2 * SYMBOLS
    pair = (context.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(20)
    pair = first + (pair % np.uint64(ROWS - first)).astype(np.int64)
    return np.stack([np.zeros_like(one), 1 + one, 1 + SYMBOLS + two, pair], 1)


def class_scores(weights: np.ndarray, context: np.ndarray) -> np.ndarray:
    """Natural logarithm of the probability of each class in each context."""
    rows = features(context)
    z = weights[rows[:, 0]] + weights[rows[:, 1]] + weights[rows[:, 2]] + weights[rows[:, 3]]
    z -= z.max(axis=1, keepdims=True)
    return z - np.log(np.exp(z).sum(axis=1, keepdims=True))


def update(weights: np.ndarray, context: np.ndarray, counts: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """One pass of adaptive gradient steps over contexts with their class counts (a matrix).

    Returns the new weights, and how many tokens used each row of them.
    """
    weights = weights.copy()
    squares = np.full((ROWS, 1), 1e-2, np.float32)
    order = np.random.default_rng(seed).permutation(len(context))
    for at in range(0, len(order), BATCH):
        some = order[at : at + BATCH]
        n = counts[some].sum(axis=1, keepdims=True)
        wrong = (np.exp(class_scores(weights, context[some])) * n - counts[some]) / n.sum()
        rows = features(context[some])
        flat = rows.ravel()
        touched, inverse = np.unique(flat, return_inverse=True)
        gradient = np.zeros((len(touched), CLASSES), np.float32)
        np.add.at(gradient, inverse.reshape(rows.shape), wrong[:, None, :].astype(np.float32))
        squares[touched] += (gradient**2).sum(axis=1, keepdims=True)
        weights[touched] -= RATE * gradient / np.sqrt(squares[touched])
    used = np.bincount(features(context).ravel(), np.repeat(counts.sum(axis=1), 4), ROWS)
    return weights, used.astype(np.float32)


def train(statistics: DataFrame, mass: np.ndarray) -> np.ndarray:
    """Weights after rounds of updates, made side by side on shards of the contexts and averaged row by row,
    weighted by the tokens that used the row: a pair of symbols is in one shard and keeps its whole step.

    ``statistics``: (``context``, ``word_class``, ``n``), the counts of all training tokens. There are at most
    ``SYMBOLS`` squared contexts however large the corpus, so shards stay small; each round brings
    ``SHARDS`` weight tables of 1.6 MB to the driver.
    """
    weights = np.zeros((ROWS, CLASSES), np.float32)
    weights[0] = np.log(mass / mass.sum())
    spark = statistics.sparkSession
    shards = statistics.withColumn("shard", F.pmod(F.xxhash64("context"), F.lit(SHARDS)).cast("int"))
    shards = stage(shards, "contexts")

    def step(shared, turn: int):
        def run(table: pa.Table) -> pa.Table:
            context, inverse = np.unique(table.column("context").to_numpy(), return_inverse=True)
            counts = np.zeros((len(context), CLASSES), np.float32)
            np.add.at(counts, (inverse, table.column("word_class").to_numpy()), table.column("n").to_numpy())
            new, used = update(shared.value, context, counts, turn)
            return pa.table({"used": pa.array([used.tobytes()], pa.binary()), "weights": pa.array([new.tobytes()], pa.binary())})

        return run

    for turn in range(ROUNDS):
        shared = spark.sparkContext.broadcast(weights)
        got = shards.groupBy("shard").applyInArrow(step(shared, turn), "used binary, weights binary").collect()
        if not got:
            break
        used = np.stack([np.frombuffer(r["used"], np.float32) for r in got])
        tables = np.stack([np.frombuffer(r["weights"], np.float32).reshape(ROWS, CLASSES) for r in got])
        share = used / np.maximum(used.sum(axis=0), 1e-9)
        weights = np.where(used.sum(axis=0)[:, None] > 0, np.einsum("sr,src->rc", share, tables), weights).astype(np.float32)
        shared.unpersist()
    return weights


def _totals(values: np.ndarray, starts: np.ndarray, run: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values >> np.uint64(8), starts)[run]


def _summary(keys: np.ndarray, values: np.ndarray, starts: np.ndarray) -> bytes:
    """Rows (key, count, last byte) of the block's most frequent words, then rows (byte, count, words) of all."""
    total = np.add.reduceat((values >> np.uint64(8)).astype(np.int64), starts)
    byte = (values[starts] & np.uint64(255)).astype(np.int64)
    seen = total > 0
    top = np.lexsort((keys, -total))[:TOP_WORDS]
    top = top[seen[top]]
    counts = np.bincount(byte[seen], total[seen], 256).astype(np.int64)
    words = np.bincount(byte[seen], minlength=256)
    first = np.column_stack([keys[top].view(np.int64), total[top], byte[top]])
    rest = np.column_stack([np.arange(256), counts, words])
    return np.concatenate([[[len(top), 0, 0]], first, rest[words > 0]]).astype(np.int64).tobytes()


def _parsed(batch: pa.RecordBatch) -> pa.Table:
    out = []
    for data in batch.column("payload").to_pylist():
        rows = np.frombuffer(data, np.int64).reshape(-1, 3)
        top = np.arange(1, len(rows)) <= rows[0, 0]
        out.append(np.column_stack([top, rows[1:]]))
    rows = np.concatenate([np.zeros((0, 4), np.int64), *out])
    return pa.table({"top": pa.array(rows[:, 0] == 1), **{n: pa.array(rows[:, k]) for k, n in ((1, "key"), (2, "n"), (3, "value"))}})


def score_documents(docs: DataFrame, held_out: Column) -> DataFrame:
    """One row per document: ``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``.

    Tokens are words in lower case (A-Z only), then one end. ``base_score`` is the smoothed unigram log10
    probability from counts of all training documents. ``score`` is the model's: the class of each token
    given the two tokens before it, times the smoothed share of the token in its class. A null text is empty and has
    the end as its only token. Repeated rows stay, and count each. Without training documents
    all counts are 0 and the classes' weights uniform over the mass of one.

    A census brings each group of documents the counts of its own words; no table of all words is ever in
    one place. The frequent words, the class totals and the weights have fixed sizes.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), held_out.alias("held_out"))
    dealt_rows, chunks = chunked(rows)
    dealt = dealt_rows.repartition(chunks, "chunk")
    bits = block_bits(chunks)

    def words_of(table: pa.Table) -> Words:
        return Words([b"" if x is None else x for x in table.column("text").cast(pa.binary()).to_pylist()], lower=True)

    def count(table: pa.Table) -> pa.Table:
        words = words_of(table)
        keys, first, inverse = np.unique(words.hashes, return_index=True, return_inverse=True)
        learned = ~np.array(table.column("held_out").to_pylist(), bool)[words.owner]
        counts = np.bincount(inverse[learned], minlength=len(keys)).astype(np.uint64)
        last = words.data[words.ends[first] - 1].astype(np.uint64)
        return fragments(table.column("chunk")[0].as_py(), keys, counts << np.uint64(8) | last, bits)

    counted = dealt.groupBy("chunk").applyInArrow(count, FRAGMENT)
    told = stage(settle(counted, np.uint64, _totals, summary=_summary), "counts")
    facts = stage(mapped(told.filter("chunk = -1").select("payload"), _parsed, "top boolean, key long, n long, value long"), "facts")
    top = [tuple(r) for r in facts.filter("top").select("key", "n", "value").orderBy(F.desc("n"), "key").limit(TOP_WORDS).collect()]
    # Keys are compared as the signed numbers they are stored as, in every step alike.
    sums = facts.filter("not top").groupBy("key").agg(F.sum("n").alias("n"), F.sum("value").alias("words")).collect()
    tail = {r["key"]: (r["n"], r["words"]) for r in sums}
    ends = rows.filter(~F.col("held_out")).count()
    tokens = sum(n for n, _ in tail.values()) + ends
    distinct = sum(w for _, w in tail.values()) + (ends > 0)
    known = lexicon(top, tail, ends)

    def tally(batch: pa.RecordBatch) -> pa.Table:
        parts = []
        for some in sliced(texts(batch), 2 << 20):
            context, word_class, _ = contexts(Words(some, lower=True), known)
            parts.append(np.unique(context * CLASSES + word_class, return_counts=True))
        every = np.concatenate([np.zeros(0, np.int64), *[a for a, _ in parts]])
        seen, place = np.unique(every, return_inverse=True)
        n = np.bincount(place, np.concatenate([np.zeros(0), *[b for _, b in parts]]), len(seen)).astype(np.int64)
        return pa.table({"context": pa.array(seen // CLASSES), "word_class": pa.array((seen % CLASSES).astype(np.int32)), "n": pa.array(n)})

    tallied = mapped(rows.filter(~F.col("held_out")).select("text"), tally, "context long, word_class int, n long")
    weights = train(tallied.groupBy("context", "word_class").agg(F.sum("n").alias("n")), known.mass)
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    log_mass = np.log10(known.mass)
    floor = np.log10(tokens + 1.0 * (distinct + 1))

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        names = ("doc_id", "held_out", "n_tokens", "n_known", "base_score", "score")
        types = (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64())
        if not left.num_rows:
            return pa.table({n: pa.array([], t) for n, t in zip(names, types, strict=True)})
        words = words_of(left)
        keys, inverse = np.unique(words.hashes, return_inverse=True)
        seen = answers(right, keys, bits, np.uint64)[inverse].astype(np.float64)
        owner, n = words.owner, left.num_rows
        logs = np.bincount(owner, np.log10(seen + 1), n) + np.log10(ends + 1)
        context, word_class, text = contexts(words, known)
        some, place = np.unique(context, return_inverse=True)
        table = np.concatenate([class_scores(shared.value, some[i : i + 8192]) for i in range(0, len(some), 8192)])
        of_class = table[place, word_class] / np.log(10) - log_mass[word_class]
        n_tokens = words.counts + 1
        columns = (
            left.column("doc_id"),
            left.column("held_out"),
            n_tokens,
            np.bincount(owner, seen > 0, n).astype(np.int64) + (ends > 0),
            logs - n_tokens * floor,
            logs + np.bincount(text, of_class, n),
        )
        return pa.table({m: c if isinstance(c, pa.ChunkedArray) else pa.array(c, t) for m, c, t in zip(names, columns, types, strict=True)})

    asked = told.filter("chunk >= 0")
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    scored = dealt.groupBy("chunk").cogroup(asked.groupBy("chunk")).applyInArrow(score, schema)
    return scored.withColumn("train_tokens", F.lit(int(tokens)).cast("long"))
