"""Repeated passages by recompression: equal word sequences get equal interior symbols."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flakeform.llm.census import FRAGMENT, answers, block_bits, fragments, settle
from flakeform.llm.common import Words, chunked, mix, window_hashes

#: Words of a window.
WINDOW = 13
#: Rounds of naming pairs, after runs of words are named.
LEVELS = 3
_RUN, _PAIR = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)


class Symbols:
    """A sequence of symbols over all texts: ``names``, and the first word and the word after the last of each.

    ``left`` and ``right`` say how far a window must reach beyond a symbol so that the symbol is formed
    alike wherever the window occurs: the first word and the word after the last on which it depends.
    """

    def __init__(self, names, starts, ends, left, right, owner):
        self.names, self.starts, self.ends, self.left, self.right, self.owner = names, starts, ends, left, right, owner


def _runs(s: Symbols) -> Symbols:
    """Name maximal runs of one symbol. A run depends on the symbols beside it, which must differ."""
    if not len(s.names):
        return s
    new = np.ones(len(s.names), bool)
    new[1:] = (s.names[1:] != s.names[:-1]) | (s.owner[1:] != s.owner[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(new)) - 1
    size = (last - first + 1).astype(np.uint64)
    names = np.where(size > 1, mix(s.names[first] * _RUN + size), s.names[first])
    before, after = np.maximum(first - 1, 0), np.minimum(last + 1, len(new) - 1)
    same_left = (first > 0) & (s.owner[first] == s.owner[before])
    same_right = (last + 1 < len(new)) & (s.owner[last] == s.owner[after])
    # At the end of its text a run could go on elsewhere, and no window reaches beyond the text.
    left = np.where(same_left, np.minimum(s.left[first], s.left[before]), s.starts[first] - 1)
    right = np.where(same_right, np.maximum(s.right[last], s.right[after]), s.ends[last] + 1)
    return Symbols(names, s.starts[first], s.ends[last], left, right, s.owner[first])


def _pairs(s: Symbols, level: int) -> Symbols:
    """Name pairs of a left and a right symbol; a hash of the name says which of both a symbol is.

    Whether two neighbours become a pair depends on them alone. A right symbol that stays single depends on its
    left neighbour, a left one on its right neighbour.
    """
    n = len(s.names)
    if n < 2:
        return s
    is_right = (mix(s.names + np.uint64(level)) & np.uint64(1)).astype(bool)
    near = s.owner[1:] == s.owner[:-1]
    joins = np.zeros(n, bool)
    joins[:-1] = ~is_right[:-1] & is_right[1:] & near
    second = np.zeros(n, bool)
    second[1:] = joins[:-1]
    head = np.flatnonzero(~second)
    pair = joins[head]
    tail = head + pair
    names = np.where(pair, mix(s.names[head] * _PAIR + mix(s.names[tail] ^ _PAIR)), s.names[head])
    left, right = s.left[head], s.right[tail]
    before, after = np.maximum(head - 1, 0), np.minimum(tail + 1, n - 1)
    lone_right = ~pair & is_right[head]
    lone_left = ~pair & ~is_right[head]
    has_before = (head > 0) & (s.owner[before] == s.owner[head])
    has_after = (tail + 1 < n) & (s.owner[after] == s.owner[tail])
    left = np.where(lone_right, np.where(has_before, np.minimum(left, s.left[before]), s.starts[head] - 1), left)
    right = np.where(lone_left, np.where(has_after, np.maximum(right, s.right[after]), s.ends[tail] + 1), right)
    return Symbols(names, s.starts[head], s.ends[tail], left, right, s.owner[head])


def recompress(words: Words, levels: int = LEVELS) -> Symbols:
    """Symbols after so many rounds. Names are hashes of what they stand for, so all tasks name alike.

    Runs are named once, among words: each round of runs widens what a symbol depends on by its neighbours, and a
    window is only 13 words wide.
    """
    at = np.arange(len(words.hashes))
    s = _runs(Symbols(words.hashes, at, at + 1, at, at + 1, words.owner))
    for level in range(levels):
        s = _pairs(s, level)
    return s


def _window_starts(words: Words, size: int) -> np.ndarray:
    """First words of all windows inside one text."""
    at = np.arange(max(0, len(words.hashes) - size + 1))
    owner = words.owner
    return at[owner[at] == owner[at + size - 1]] if len(at) else at


def _candidates(words: Words, symbols: Symbols, shared: np.ndarray, size: int) -> np.ndarray:
    """Windows all of whose determined symbols are shared by two texts.

    A window that occurs in two texts has the same determined symbols in both, so none is lost. Symbols that
    are not shared forbid every window that determines them.
    """
    starts = _window_starts(words, size)
    bad = ~shared
    low, high = symbols.right[bad] - size, symbols.left[bad]
    # Windows from low to high determine the symbol: they begin at or before its left, and end at or after its right.
    some = low <= high
    marks = np.zeros(len(words.hashes) + 2, np.int64)
    np.add.at(marks, np.maximum(low[some], 0), 1)
    np.add.at(marks, np.maximum(high[some] + 1, 0), -1)
    return starts[np.cumsum(marks)[starts] == 0]


class _Chunk:
    """A group of documents in id order, with words, symbols and windows."""

    def __init__(self, table: pa.Table, size: int):
        # Null ids come first and so count as the smallest.
        order = sorted(range(table.num_rows), key=lambda i, ids=table.column("doc_id").to_pylist(): (ids[i] is not None, ids[i] or 0))
        table = table.take(pa.array(order, pa.int64()))
        self.ids = table.column("doc_id").to_pylist()
        self.text = [b"" if x is None else x for x in table.column("text").cast(pa.binary()).to_pylist()]
        self.words = Words(self.text, lower=False)
        self.symbols = recompress(self.words)
        self.size = size

    def symbol_keys(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct symbols, and the number of texts that have them, up to 2."""
        s = self.symbols
        keys, first, inverse = np.unique(s.names, return_index=True, return_inverse=True)
        several = np.zeros(len(keys), bool)
        several[inverse[s.owner != s.owner[first][inverse]]] = True
        return keys, (1 + several).astype(np.uint8)

    def windows(self, right: pa.Table, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """First words and names of the windows that may repeat."""
        keys, inverse = np.unique(self.symbols.names, return_inverse=True)
        known = right.filter(pc.equal(right.column("census"), 0))
        shared = answers(known, keys, bits, bool)[inverse] if len(keys) else np.zeros(0, bool)
        starts = _candidates(self.words, self.symbols, shared, self.size)
        return starts, window_hashes(self.words.hashes, self.size)[starts] if len(starts) else np.zeros(0, np.uint64)

    def owners(self, starts: np.ndarray) -> np.ndarray:
        """Ids of the windows' documents; a null id sorts before all others."""
        least = np.iinfo(np.int64).min
        ids = np.array([least if x is None else x for x in self.ids], np.int64)
        return ids[self.words.owner[starts]]


def _shared(values: np.ndarray, starts: np.ndarray, run: np.ndarray) -> np.ndarray:
    return (np.add.reduceat(values.astype(np.int64), starts) > 1)[run]


def _smaller_elsewhere(values: np.ndarray, starts: np.ndarray, run: np.ndarray) -> np.ndarray:
    return np.minimum.reduceat(values, starts)[run] < values


def remove_repeats(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """Remove words of windows that also start in a document with a smaller id.

    Returns per row ``doc_id``, ``n_words``, ``n_removed``, ``kept`` (the words that stay, joined by one space) and
    ``kept_sha256``. Null text has no words. Windows are judged on the input. Rows with one id are one
    document and do not remove each other's words; null ids count as one smallest id.

    Documents are shuffled once, to groups of bounded size. Rounds name runs and pairs of
    symbols; a census says which symbols two documents share. Only windows all of whose inner symbols are
    shared go to the second census, which tells each group which of its windows have a smaller document
    elsewhere. A window's name is a 64-bit hash of its 13 words.
    """
    rows, chunks = chunked(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")))
    dealt = rows.repartition(chunks, "chunk")
    bits = block_bits(chunks)

    def name_symbols(table: pa.Table) -> pa.Table:
        keys, several = _Chunk(table, size).symbol_keys()
        return fragments(table.column("chunk")[0].as_py(), keys, several, bits, narrow=True)

    def name_windows(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return fragments(0, np.zeros(0, np.uint64), np.zeros(0, np.int64), bits)
        group = _Chunk(left, size)
        starts, names = group.windows(right, bits)
        keys, first = np.unique(names, return_index=True)
        return fragments(left.column("chunk")[0].as_py(), keys, group.owners(starts[first]), bits)

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        out = {"doc_id": [], "n_words": [], "n_removed": [], "kept": [], "kept_sha256": []}
        if left.num_rows:
            group = _Chunk(left, size)
            starts, names = group.windows(right, bits)
            keys, first, inverse = np.unique(names, return_index=True, return_inverse=True)
            elsewhere = answers(right.filter(pc.equal(right.column("census"), 1)), keys, bits, bool)
            owner = group.owners(starts)
            repeated = starts[elsewhere[inverse] | (owner[first][inverse] < owner)] if len(starts) else starts
            marks = np.zeros(len(group.words.hashes) + 1, np.int64)
            np.add.at(marks, repeated, 1)
            np.add.at(marks, repeated + size, -1)
            removed = np.cumsum(marks)[:-1] > 0
            per_text = np.add.reduceat(np.append(removed, 0), np.minimum(group.words.first[:-1], len(removed)))
            per_text = np.where(group.words.counts > 0, per_text, 0)
            for i, text in enumerate(group.text):
                a, b = group.words.first[i], group.words.first[i + 1]
                words = text.split()
                if per_text[i]:
                    words = [w for w, gone in zip(words, removed[a:b].tolist(), strict=True) if not gone]
                kept = b" ".join(words)
                for name, value in zip(out, (group.ids[i], int(b - a), int(per_text[i]), kept, hashlib.sha256(kept).hexdigest()), strict=True):
                    out[name].append(value)
        types = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.string())
        table = pa.table({n: pa.array(v, t) for (n, v), t in zip(out.items(), types, strict=True)})
        return table.set_column(3, "kept", table.column("kept").cast(pa.string()))

    shared = settle(dealt.groupBy("chunk").applyInArrow(name_symbols, FRAGMENT), np.uint8, _shared, narrow=True)
    shared = shared.withColumn("census", F.lit(0))
    named = dealt.groupBy("chunk").cogroup(shared.groupBy("chunk")).applyInArrow(name_windows, FRAGMENT)
    smaller = settle(named, np.int64, _smaller_elsewhere).withColumn("census", F.lit(1))
    known = shared.unionByName(smaller)
    result = "doc_id long, n_words long, n_removed long, kept string, kept_sha256 string"
    return dealt.groupBy("chunk").cogroup(known.groupBy("chunk")).applyInArrow(finish, result)
