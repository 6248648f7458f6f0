"""Token sequences packed by bounded-space online best fit."""

from __future__ import annotations

import gc
import json
import re
import zlib
from collections.abc import Iterator
from itertools import chain, filterfalse, pairwise
from struct import pack as pack_ids

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flakeform.llm.common import kept_by_worker, mapped, release_kept, sliced, texts
from flakeform.sources.staging import stage

SEQUENCE = 2048
#: Bins that a packer holds open.
OPEN_BINS = 512
#: Pieces that one packer takes; the number of packers follows the input.
PIECES_PER_PACKER = 32768
#: Levels of packers: bins that are still open at the end of one level are items of the next.
LEVELS = 2
#: Encoded words that a Python worker keeps, in two generations.
CACHED_WORDS = 600_000
#: Words that the tokenizer takes in one call; its results hold far more than the ids.
ENCODED_AT_ONCE = 8192
#: Bytes of texts whose distinct words are looked up together.
ENCODED_BYTES = 4 << 20
#: Words of letters that are encoded as one text.
WORDS_IN_LINE = 64
#: Rows of a batch whose texts are held at once.
ROWS_AT_ONCE = 1000
END = b"\0\0\0\0"
_SPECIAL = b"<|"
#: A line with one word: its letters, the punctuation after them, and the rest, empty for most words. ``<|`` is no punctuation.
_SIMPLE = re.compile(r"([a-zà-öø-ÿ]*)((?:(?!<\|)[!-&(-/:-@\[-`{-~])*)(.*)\n")


def byte_letters(text: str) -> str:
    """The characters by which byte-level vocabularies name the UTF-8 bytes of letters up to ÿ; spaces stay."""
    return text if text.isascii() else text.encode().decode("latin-1").replace("\xa0", "\u0142").replace("\xad", "\u0143")


class WordEncoder:
    """Token ids of whole texts, from ids of their words.

    The vocabulary's rules never join characters across white space, so a text's ids are its words'
    ids in order. Most words are letters and then punctuation: their letters are encoded many at a time
    without the general rules; every other word goes through the whole tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.whole = Tokenizer.from_file(path)
        self.letters = Tokenizer.from_file(path)
        self.letters.normalizer = normalizers.Sequence([])
        self.letters.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        suffix = json.loads(self.whole.to_str())["model"].get("end_of_word_suffix")
        self.ends = np.zeros(self.whole.get_vocab_size(), bool)
        if suffix:
            self.ends[[i for token, i in self.whole.get_vocab().items() if token.endswith(suffix)]] = True
        self.words: dict[bytes, bytes] = {}
        self.earlier: dict[bytes, bytes] = {}
        self.marks: dict[str, bytes] = {"": b""}

    def _encode(self, tokenizer, pieces: list[str]) -> list[bytes]:
        out: list[bytes] = []
        for at in range(0, len(pieces), ENCODED_AT_ONCE):
            got = tokenizer.encode_batch_fast(pieces[at : at + ENCODED_AT_ONCE], add_special_tokens=False)
            out += [pack_ids(f"<{len(x)}I", *x.ids) for x in got]
        return out

    def _encode_letters(self, words: list[str]) -> list[bytes]:
        """Ids of words of letters: many make one text, whose ids are parted where a token ends a word."""
        out: list[bytes] = []
        for at in range(0, len(words), ENCODED_AT_ONCE):
            some = words[at : at + ENCODED_AT_ONCE]
            lines = [some[k : k + WORDS_IN_LINE] for k in range(0, len(some), WORDS_IN_LINE)]
            got = self.letters.encode_batch_fast([byte_letters(" ".join(line)) for line in lines], add_special_tokens=False)
            for line, found in zip(lines, got, strict=True):
                ids = np.array(found.ids, "<u4")
                ends = np.flatnonzero(self.ends[ids]) + 1
                if len(ends) != len(line):
                    out += self._encode(self.letters, [byte_letters(word) for word in line])
                    continue
                data, places = ids.tobytes(), [0, *(4 * ends).tolist()]
                out += [data[i:j] for i, j in zip(places[:-1], places[1:], strict=True)]
        return out

    def learn(self, words: list[bytes]) -> None:
        """Bring all these distinct words into ``words``, encoding those that are not known yet.

        Words are kept in two generations. When the later one is full the earlier one goes, so that a word is dropped
        only if it was not used since the turn before; rare words go, and frequent ones are encoded once.
        """
        missing = list(filterfalse(self.words.__contains__, words))
        if len(self.words) + len(missing) > CACHED_WORDS // 2:
            self.words, self.earlier, missing = {}, self.words, words
        known, earlier = self.words, self.earlier
        kept = {word: ids for word in missing if (ids := earlier.get(word)) is not None}
        known.update(kept)
        new = list(filterfalse(kept.__contains__, missing))
        rows = _SIMPLE.findall(b"\n".join([*new, b""]).decode())
        stems = list({stem for stem, _, rest in rows if not rest} - {""})
        letters = dict(zip(stems, self._encode_letters(stems), strict=True))
        letters[""] = b""
        ends = {mark for _, mark, rest in rows if not rest}
        if len(self.marks) + len(ends) > CACHED_WORDS // 8:
            self.marks = {"": b""}
        unknown = list(ends - self.marks.keys())
        self.marks.update(zip(unknown, self._encode(self.whole, unknown), strict=True))
        marks = self.marks
        known.update({word: letters[stem] + marks[mark] for word, (stem, mark, rest) in zip(new, rows, strict=True) if not rest})
        other = [word for word, (_, _, rest) in zip(new, rows, strict=True) if rest]
        known.update(zip(other, self._encode(self.whole, [word.decode() for word in other]), strict=True))

    def encode(self, batch: list[bytes]) -> Iterator[bytes]:
        """Little-endian unsigned 32-bit ids of each text, with the end id.

        Words are lower-cased before they are looked up, as the tokenizer does, but for those that may hold one of its
        special tokens: these have one spelling only.
        """
        for some in sliced(batch, ENCODED_BYTES):
            lowered = [_lowered(text) for text in some]
            split = pc.ascii_split_whitespace(pa.array(lowered, pa.binary()).cast(pa.string()))
            found = split.values.dictionary_encode()
            words = found.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()
            collecting = gc.isenabled()
            gc.disable()  # there are no cycles here, but very many tuples that the collector would look at
            try:
                self.learn(words)
            finally:
                if collecting:
                    gc.enable()
            ids = pa.array(map(self.words.__getitem__, words), pa.large_binary()).take(found.indices)
            _, places, data = ids.buffers()
            limits = np.frombuffer(places, np.int64)[split.offsets.to_numpy()]
            for i, j in pairwise(limits.tolist()):
                yield data[i:j].to_pybytes() + END


def _lowered(text: bytes) -> bytes:
    if _SPECIAL in text:
        return b" ".join([word if _SPECIAL in word else word.lower() for word in text.split()])
    return text.lower()


def encoder(path: str) -> WordEncoder:
    """The Python worker's encoder, kept between tasks."""
    return kept_by_worker(f"encoder {path}", lambda: WordEncoder(path))


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def pieces(docs: DataFrame, path: str | None = None, length: int = SEQUENCE) -> DataFrame:
    """Token pieces: ``doc_id``, ``copy``, ``piece``, ``start``, ``length``, ``ids_crc32``.

    Only a document longer than a sequence is cut, into whole sequences and a rest. Null text is the
    empty text, whose only id is the end. ``copy`` tells rows with the same id and text apart.
    ``path`` names the vocabulary file on every machine; by default the installed public one.
    """

    def cut(batch: pa.RecordBatch) -> pa.Table:
        encode = encoder(path or tokenizer_path()).encode
        out: list[list] = [[], [], [], [], [], []]
        parts = [batch.slice(at, ROWS_AT_ONCE) for at in range(0, batch.num_rows, ROWS_AT_ONCE)]
        ids = (zip(x.column("doc_id").to_pylist(), x.column("copy").to_pylist(), encode(texts(x)), strict=True) for x in parts)
        for doc, copy, data in chain.from_iterable(ids):
            for k in range(0, len(data), 4 * length):
                part = data[k : k + 4 * length]
                row = (doc, copy, k // (4 * length), k // 4, len(part) // 4, zlib.crc32(part))
                for column, value in zip(out, row, strict=True):
                    column.append(value)
        types = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        names = ("doc_id", "copy", "piece", "start", "length", "ids_crc32")
        return pa.table({n: pa.array(c, t) for n, c, t in zip(names, out, types, strict=True)})

    rows = docs.select(
        F.col("doc_id").cast("long"), F.monotonically_increasing_id().alias("copy"), F.col("text").cast("string")
    )
    return mapped(rows, cut, "doc_id long, copy long, piece int, start long, length long, ids_crc32 long", keeps=True)


class BestFit:
    """A fixed number of open bins. Bit f of ``free`` is set while a bin with f free places is open."""

    def __init__(self, capacity: int, open_bins: int):
        self.capacity, self.most = capacity, open_bins
        self.free = 0
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.count = self.made = 0

    def _take(self, free: int) -> int:
        stack = self.bins[free]
        number = stack.pop()
        if not stack:
            self.free &= ~(1 << free)
        self.count -= 1
        return number

    def _open(self, number: int, free: int) -> None:
        self.bins[free].append(number)
        self.free |= 1 << free
        self.count += 1

    def put(self, size: int) -> tuple[int, int]:
        """Bin and offset for an item: the fullest open bin with room, or a new one."""
        fits = self.free >> size
        if fits:
            free = size + (fits & -fits).bit_length() - 1
            number = self._take(free)
        else:
            free, number = self.capacity, self.made
            self.made += 1
            if free > size and self.count >= self.most:
                self._take((self.free & -self.free).bit_length() - 1)
        if free > size:
            self._open(number, free - size)
        return number, self.capacity - free

    def still_open(self) -> dict[int, int]:
        """Used places of each open bin."""
        return {number: self.capacity - free for free, stack in enumerate(self.bins) for number in stack}


def _packed(items: DataFrame, capacity: int, open_bins: int, level: int) -> DataFrame:
    """Pack each partition's items by ``length``: adds ``bin``, ``offset``, and ``used`` if the bin is still open."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        release_kept()
        base = (level << 56) + (TaskContext.get().partitionId() << 36)
        fit, rows = BestFit(capacity, open_bins), []
        for batch in batches:
            rows.append((batch, [fit.put(n) for n in batch.column("length").to_pylist()]))
        used = fit.still_open()
        for batch, places in rows:
            extra = {
                "bin": pa.array([base + b for b, _ in places], pa.int64()),
                "offset": pa.array([o for _, o in places], pa.int64()),
                "used": pa.array([used.get(b) for b, _ in places], pa.int64()),
            }
            yield pa.record_batch([*batch.columns, *extra.values()], [*batch.schema.names, *extra])

    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in items.schema.fields)
    return items.mapInArrow(run, f"{kept}, bin long, offset long, used long")


def _dealt(items: DataFrame, *keys: str) -> DataFrame:
    """Items in hash order over as many packers as their number asks for; equal on every rerun."""
    packers = max(1, -(-items.count() // PIECES_PER_PACKER))
    order = F.xxhash64(*keys)
    return items.repartition(packers, order).sortWithinPartitions(order, *keys)


def pack(parts: DataFrame, capacity: int = SEQUENCE, open_bins: int = OPEN_BINS, levels: int = LEVELS) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces with ``doc_id``, ``copy``, ``piece`` and ``length``.

    Pieces are dealt to packers by hash, about ``PIECES_PER_PACKER`` each. A packer keeps ``open_bins``
    bins; a piece goes to the fullest one with room, and when a new bin is needed beyond that number the
    fullest one closes. Bins that are open at the end of a packer are items of the next level's fewer
    packers, so what stays half empty does not grow with the number of packers. A bin is filled from 0
    without gaps, so it moves as one item. Places are staged, as are the pieces: nothing is packed twice.
    """
    keys = ("doc_id", "copy", "piece")
    staged = stage(parts, "pieces")
    placed = stage(_packed(_dealt(staged, *keys), capacity, open_bins, 0), "places")
    for level in range(1, levels):
        items = placed.filter("used is not null").groupBy("bin").agg(F.first("used").alias("length"))
        items = stage(items.withColumnRenamed("bin", "item"), "open-bins")
        moved = _packed(_dealt(items, "item"), capacity, open_bins, level).select(
            "item", F.col("bin").alias("_bin"), F.col("offset").alias("_offset"), F.col("used").alias("_used")
        )
        still = placed.filter("used is not null").join(moved, F.col("bin") == F.col("item"))
        still = still.select(
            *staged.columns,
            F.col("_bin").alias("bin"),
            (F.col("offset") + F.col("_offset")).alias("offset"),
            F.col("_used").alias("used"),
        )
        placed = placed.filter("used is null").unionByName(still)
        if level < levels - 1:
            placed = stage(placed, "places")
    return placed.drop("used").withColumnRenamed("bin", "sequence_id")


def pack_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Pieces of all documents with their places; an empty table gives an empty one."""
    return pack(pieces(docs, path))
