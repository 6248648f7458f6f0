"""Language of every word, and so of a document, by a linear-chain conditional random field."""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flakeform.llm.common import release_kept, texts, trim

#: Labelled documents per language that the model is fitted on, chosen by a hash of the id.
SAMPLE_PER_LANGUAGE = 200
#: Longer documents (bytes) are sampled only where a language has too few others. Sampled texts are used whole.
LONG_SAMPLE = 100_000
#: Languages up to which batches, caches and documents per language have their full size; with more, they shrink.
#: Every language is learned, from ``LEAST_PER_LANGUAGE`` documents at least where it has them; its weights take 1 MB.
MANY_LANGUAGES = 64
LEAST_PER_LANGUAGE = 20
#: Words that one training chain has; rounds over all chains, at least and at most, for about so many steps in all.
CHAIN, EPOCHS, STEPS = 32, (2, 12), 30_000
#: Words that one chain has in prediction; a line is cut into chains of so many.
LONGEST_CHAIN = 256
#: Characters of a token; a longer word is cut into so many.
LONGEST_TOKEN = 40
FEATURES = 1 << 18
UNDETERMINED = "und"
#: Documents with a lower score are rejected by :func:`known_language`.
MIN_SCORE = 0.5
_LETTER = re.compile(r"[^\W\d_]")
_STEP = 200_000
#: Words whose features are held at once.
_SLICE = 20_000


def _fewer(size: int, languages: int) -> int:
    """A size that is full for ``MANY_LANGUAGES`` and shrinks as languages grow."""
    return max(1, size * MANY_LANGUAGES // max(MANY_LANGUAGES, languages))


def tokens(words: list[str]) -> list[str]:
    """The words, long ones cut into tokens of ``LONGEST_TOKEN`` characters: a line of a script without spaces is one word."""
    if max(map(len, words), default=0) <= LONGEST_TOKEN:
        return words
    return [w[at : at + LONGEST_TOKEN] for w in words for at in range(0, len(w), LONGEST_TOKEN)]


def byte_tokens(words: list[bytes]) -> list[bytes]:
    """As :func:`tokens`, for words in UTF-8."""
    if max(map(len, words), default=0) <= LONGEST_TOKEN:
        return words
    out: list[bytes] = []
    for w in words:
        out += [w] if len(w) <= LONGEST_TOKEN else [t.encode() for t in tokens([w.decode("utf-8", "replace")])]
    return out


def word_features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of words: the numbers of all features, and where each word's begin.

    N-grams of two and three characters with marked word ends, affixes of three letters, and the
    whole word for the lexicon.
    """
    marked = [f"^{w}$" for w in words]
    codes = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    sizes = np.fromiter(map(len, marked), np.int64, len(marked))
    first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    word = np.repeat(np.arange(len(words)), sizes)
    left = sizes[word] - (np.arange(len(codes)) - first[word])
    prime = np.uint64(0x9E3779B97F4A7C15)

    def rolled(n: int) -> tuple[np.ndarray, np.ndarray]:
        at = np.flatnonzero(left >= n)
        h = np.full(len(at), n, np.uint64)
        for k in range(n):
            h = (h ^ codes[at + k]) * prime
            h ^= h >> np.uint64(29)
        return at, h

    owners, hashes = [], []
    for n in (2, 3):
        at, h = rolled(n)
        owners.append(word[at])
        hashes.append(h)
    at, h = rolled(4)
    for keep, salt in ((at == first[word[at]], 11), (left[at] == 4, 13)):
        owners.append(word[at[keep]])
        hashes.append((h[keep] ^ np.uint64(salt)) * prime)
    owners.append(np.arange(len(words)))
    hashes.append(np.fromiter((zlib.crc32(w.encode("utf-8", "surrogatepass")) for w in words), np.uint64, len(words)) * prime)
    owner, number = np.concatenate(owners), (np.concatenate(hashes) >> np.uint64(40)) % np.uint64(FEATURES)
    order = np.argsort(owner, kind="stable")
    starts = np.searchsorted(owner[order], np.arange(len(words)))
    return number[order].astype(np.int64), starts


@dataclass(frozen=True)
class Model:
    languages: list[str]
    weights: np.ndarray
    transitions: np.ndarray

    def emissions(self, words: list[str]) -> np.ndarray:
        if not words:
            return np.zeros((0, len(self.languages)), np.float32)
        sums = []
        step = _fewer(_SLICE, len(self.languages))
        for at in range(0, len(words), step):
            number, starts = word_features(words[at : at + step])
            sums.append(np.add.reduceat(self.weights[number], starts, axis=0))
        return np.concatenate(sums)


def posteriors(
    emission: np.ndarray, sizes: np.ndarray, transitions: np.ndarray, pairs: np.ndarray | None = None
) -> np.ndarray:
    """Label probabilities of every word by forward-backward, all chains at once.

    ``emission``: scores of the words of all chains, one chain after another; ``sizes``: words in each.
    Chains are sorted by length, so that step t handles those that have a t-th word. Expected
    numbers of label pairs are added to ``pairs``, where given.
    """
    if not len(emission):
        return emission
    k = emission.shape[1]
    order = np.argsort(-sizes, kind="stable")
    starts = (np.cumsum(sizes) - sizes)[order]
    active = np.searchsorted(-sizes[order], -np.arange(1, sizes.max() + 1), side="right")
    step = np.exp(transitions - transitions.max()).astype(np.float32)
    local = np.exp(emission - emission.max(axis=1, keepdims=True))
    forward = np.empty_like(local)
    now = np.full((len(sizes), k), 1 / k, np.float32)
    for t, n in enumerate(active):
        at = starts[:n] + t
        now = (now[:n] if t == 0 else now[:n] @ step) * local[at]
        now /= now.sum(axis=1, keepdims=True)
        forward[at] = now
    back = np.ones((len(sizes), k), np.float32)
    ahead = np.zeros((0, k), np.float32)
    for t in range(len(active) - 1, -1, -1):
        n = active[t]
        at = starts[:n] + t
        if pairs is not None and len(ahead):
            here = forward[at[: len(ahead)]]
            pairs += step * ((here / ((here @ step) * ahead).sum(axis=1, keepdims=True)).T @ ahead)
        ahead = local[at] * back[:n]
        forward[at] *= back[:n]
        message = ahead @ step.T
        back[:n] = message / message.sum(axis=1, keepdims=True)
    return forward / forward.sum(axis=1, keepdims=True)


def fit(samples: dict[str, list[str]], seed: int = 7) -> Model:
    """Fit to labelled texts by stochastic gradients of the chains' conditional log-likelihood.

    A training chain joins pieces of two documents, half of the time in two languages, so that the
    transitions learn code switching. Gradients are expected less observed feature counts.
    """
    languages = sorted(samples)
    k, draw = len(languages), np.random.default_rng(seed)
    parts: list[tuple[int, list[str]]] = []
    for label, name in enumerate(languages):
        for text in samples[name]:
            words = [w.decode() for w in byte_tokens(text.encode().split())]
            parts += [(label, words[at : at + CHAIN // 2]) for at in range(0, len(words), CHAIN // 2)]
    weights, transitions = np.zeros((FEATURES, k), np.float32), np.zeros((k, k), np.float32)
    if k < 2 or not parts:
        return Model(languages, weights, transitions)
    vocabulary = {w: i for i, w in enumerate(sorted({w for _, words in parts for w in words}))}
    number, starts = word_features(list(vocabulary))
    ends = np.append(starts[1:], len(number))
    square_w, square_t = np.full((FEATURES, 1), 1e-3, np.float32), np.full((k, k), 1e-3, np.float32)
    by_label = [[i for i, (label, _) in enumerate(parts) if label == x] for x in range(k)]
    for _ in range(min(EPOCHS[1], max(EPOCHS[0], STEPS // len(parts)))):
        order = draw.permutation(len(parts))
        for at in range(0, len(order), 256):
            chains = []
            for i in order[at : at + 256]:
                other = draw.choice(by_label[draw.integers(k)] or [i]) if draw.random() < 0.5 else i
                chains.append([parts[i], parts[other]] if other != i else [parts[i]])
            ids = np.array([vocabulary[w] for chain in chains for _, words in chain for w in words])
            gold = np.array([label for chain in chains for label, words in chain for _ in words])
            sizes = np.array([sum(len(words) for _, words in chain) for chain in chains])
            emission = _sums(weights, number, starts, ends, ids)
            expected = np.zeros((k, k), np.float32)
            wrong = posteriors(emission, sizes, transitions, expected)
            first = np.zeros(len(ids), bool)
            first[np.cumsum(sizes) - sizes] = True
            pairs = np.flatnonzero(~first)
            observed = np.zeros((k, k), np.float32)
            np.add.at(observed, (gold[pairs - 1], gold[pairs]), 1)
            wrong[np.arange(len(ids)), gold] -= 1
            counts = ends[ids] - starts[ids]
            rows = np.repeat(np.arange(len(ids)), counts)
            used = number[np.repeat(starts[ids] - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())]
            touched, inverse = np.unique(used, return_inverse=True)
            gradient = np.stack([np.bincount(inverse, wrong[rows, x], len(touched)) for x in range(k)], 1) / len(chains)
            square_w[touched, 0] += (gradient**2).sum(axis=1)
            weights[touched] -= 0.3 * gradient / np.sqrt(square_w[touched])
            gradient = (expected - observed) / len(chains)
            square_t += gradient**2
            transitions -= 0.1 * gradient / np.sqrt(square_t)
    return Model(languages, weights, transitions)


def _sums(weights: np.ndarray, number: np.ndarray, starts: np.ndarray, ends: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Sums of the features' weights for the words ``ids``."""
    some, inverse = np.unique(ids, return_inverse=True)
    counts = ends[some] - starts[some]
    places = np.repeat(starts[some] - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
    return np.add.reduceat(weights[number[places]], np.cumsum(counts) - counts, axis=0)[inverse]


def training_sample(labelled: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> dict[str, list[str]]:
    """Texts of a hash sample of every language: at most ``per_language`` documents of each, fewer of each
    beyond ``MANY_LANGUAGES`` languages.

    Rows are chosen by id and a hash of the text, without the texts; rows with both equal count once. The chosen whole texts
    come to the driver, so their number is bounded, whatever ids repeat.
    """
    keyed = labelled.filter("lang is not null and text is not null and doc_id is not null").select(
        "lang", "doc_id", "text", F.xxhash64("text").alias("code")
    )
    languages = keyed.select("lang").distinct().count()
    per_language = min(per_language, max(LEAST_PER_LANGUAGE, _fewer(per_language, languages)))
    key = ["lang", "doc_id", "code"]
    long = F.octet_length("text") > LONG_SAMPLE
    order = Window.partitionBy("lang").orderBy("long", F.xxhash64("doc_id"), "doc_id", "code")
    some = keyed.select(*key, long.alias("long")).distinct()
    chosen = some.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= per_language).select(*key)
    rows = keyed.join(F.broadcast(chosen), key, "left_semi").groupBy(*key).agg(F.min("text").alias("text"))
    samples: dict[str, list[str]] = {}
    for row in rows.orderBy("lang", "doc_id", "text").collect():
        samples.setdefault(row["lang"], []).append(row["text"])
    return samples


def train(labelled: DataFrame) -> Model:
    """Learn from the ``lang`` and ``text`` of labelled documents; rows with a null in either are left out."""
    return fit(training_sample(labelled))


def _document_scores(model: Model, batch: list[bytes], cache: dict[bytes, int], table: list[np.ndarray]) -> np.ndarray:
    """Summed word posteriors of each text, and the number of its words in the last column."""
    k = len(model.languages)
    total = np.zeros((len(batch), k + 1))
    chains: list[list[bytes]] = []
    owner: list[int] = []
    pending = 0

    def flush() -> None:
        nonlocal pending
        words = [w for chain in chains for w in chain]
        new = list(set(words) - cache.keys())
        if len(cache) + len(new) > _fewer(400_000, k):
            cache.clear()
            table.clear()
            new = list(set(words))
        for w in new:
            cache[w] = len(cache)
        if new:
            table.append(model.emissions([w.decode("utf-8", "replace") for w in new]))
            table[:] = [np.concatenate(table)]
        sizes = np.fromiter(map(len, chains), np.int64, len(chains))
        emission = table[0][np.fromiter((cache[w] for w in words), np.int64, len(words))]
        sums = np.add.reduceat(posteriors(emission, sizes, model.transitions), np.cumsum(sizes) - sizes, axis=0)
        np.add.at(total, np.array(owner), np.column_stack([sums, sizes]))
        chains.clear()
        owner.clear()
        pending = 0

    for i, text in enumerate(batch):
        for line in text.split(b"\n"):
            words = byte_tokens(line.split())
            for at in range(0, len(words), LONGEST_CHAIN):
                chains.append(words[at : at + LONGEST_CHAIN])
                owner.append(i)
                pending += len(chains[-1])
                if pending >= _fewer(_STEP, k):
                    flush()
    if chains:
        flush()
    return total


def identify(
    docs: DataFrame, model: Model, names: tuple[str, str] = ("lang_pred", "score"), text: str = "text"
) -> DataFrame:
    """The input with ``lang_pred`` and ``score`` (0 to 1) added, or under other ``names``, from the whole text of each row.

    Every word gets label probabilities by forward-backward along its line (cut into chains of
    ``LONGEST_CHAIN`` words, long words into several); a document's language has the largest sum, the first in code-point order
    on a tie, and the score is its mean. Null texts, texts without a letter, and a model without
    languages give ``und`` with score 0. Columns named like the added ones are replaced.
    """
    kept = docs.drop(*names)
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)

    def run(batches):
        release_kept()
        model, cache, table = shared.value, {}, []
        for batch in batches:
            given = texts(batch, text)
            total = _document_scores(model, given, cache, table) if model.languages else np.zeros((len(given), 1))
            found, scores = [], []
            for raw, row in zip(given, total, strict=True):
                if not model.languages or not row[-1] or not _LETTER.search(raw.decode("utf-8", "replace")):
                    found.append(UNDETERMINED)
                    scores.append(0.0)
                else:
                    best = int(np.argmax(row[:-1]))
                    found.append(model.languages[best])
                    scores.append(float(min(1.0, max(0.0, row[best] / row[-1]))))
            extra = [pa.array(found, pa.string()), pa.array(scores, pa.float64())]
            yield pa.record_batch([*batch.columns, *extra], [*batch.schema.names, *names])
        cache.clear()
        table.clear()
        trim()

    from pyspark.sql.types import DoubleType, StringType, StructType

    schema = StructType([*kept.schema.fields]).add(names[0], StringType()).add(names[1], DoubleType())
    return kept.mapInArrow(run, schema)


def known_language(docs: DataFrame, model: Model, min_score: float = MIN_SCORE) -> DataFrame:
    """Documents whose language is told with at least ``min_score``, with the columns of the input, whatever their names."""
    names, given = ("_told_language", "_told_score"), [f"_given{place}" for place in range(len(docs.columns))]
    renamed = docs.select(*[F.col(f"`{old}`").alias(new) for old, new in zip(docs.columns, given, strict=True)])
    found = identify(renamed, model, names, given[docs.columns.index("text")])
    kept = found.filter((F.col(names[0]) != UNDETERMINED) & (F.col(names[1]) >= min_score))
    return kept.select(*[F.col(new).alias(old) for old, new in zip(docs.columns, given, strict=True)])
