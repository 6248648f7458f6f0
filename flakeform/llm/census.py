"""Counting keys over all groups of documents, and bringing each group what it must know of its own keys.

Documents are dealt to groups (``chunk``). A group lists each of its 64-bit keys once, sorted, with a value;
keys are cut into blocks by their leading bits, and a row holds one group's part of one block. So a
frequent key costs one entry per group, wherever its copies are, and no group or block grows with it.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

FRAGMENT = "block int, chunk int, keys binary, payload binary"
ANSWER = "chunk int, block int, payload binary"


def block_bits(chunks: int) -> int:
    """Bits that number the blocks: about one block for each group of documents, so both grow alike."""
    return max(3, (chunks - 1).bit_length())


def fragments(chunk: int, keys: np.ndarray, values: np.ndarray, bits: int, narrow: bool = False) -> pa.Table:
    """Rows of one group: sorted distinct keys and their values, by block. ``narrow`` keeps 32 bits of a key in its block."""
    cut = np.searchsorted(keys, np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits))
    cut = [0, *cut.tolist(), len(keys)]
    kept = (keys >> np.uint64(32 - bits)).astype(np.uint32) if narrow else keys
    rows = [(b, i, j) for b, (i, j) in enumerate(zip(cut[:-1], cut[1:], strict=True)) if j > i]
    return pa.table(
        {
            "block": pa.array([b for b, *_ in rows], pa.int32()),
            "chunk": pa.array([chunk] * len(rows), pa.int32()),
            "keys": pa.array([kept[i:j].tobytes() for _, i, j in rows], pa.binary()),
            "payload": pa.array([values[i:j].tobytes() for _, i, j in rows], pa.binary()),
        }
    )


def settle(
    parts: DataFrame,
    value: type,
    answer: Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray],
    narrow: bool = False,
    summary: Callable[[np.ndarray, np.ndarray, np.ndarray], bytes] | None = None,
) -> DataFrame:
    """One answer for every fragment: what ``answer`` says of its keys, in the fragment's order.

    ``answer`` gets a block's values in key order, the place where each key's run begins, and the number of
    each value's run; it returns one number per value. Booleans are packed into bits. ``summary`` gets a block's
    distinct keys, the values in key order, and where each key's run begins; what it returns is the payload of
    a further row, of chunk -1.
    """
    key = np.uint32 if narrow else np.uint64

    def run(table: pa.Table) -> pa.Table:
        keys = [np.frombuffer(x, key) for x in table.column("keys").to_pylist()]
        values = np.concatenate([np.frombuffer(x, value) for x in table.column("payload").to_pylist()])
        sizes = np.cumsum([0, *map(len, keys)])
        every = np.concatenate(keys)
        order = np.argsort(every, kind="stable")
        every = every[order]
        new = np.concatenate([[True], every[1:] != every[:-1]])
        starts = np.flatnonzero(new)
        said = answer(values[order], starts, np.cumsum(new) - 1)
        out = np.empty(len(said), said.dtype)
        out[order] = said
        pack = np.packbits if out.dtype == bool else np.asarray
        chunks, blocks = table.column("chunk").to_pylist(), table.column("block").to_pylist()
        payload = [pack(out[i:j]).tobytes() for i, j in zip(sizes[:-1], sizes[1:], strict=True)]
        if summary:
            chunks, blocks = [*chunks, -1], [*blocks, blocks[0]]
            payload.append(summary(every[starts], values[order], starts))
        return pa.table(
            {"chunk": pa.array(chunks, pa.int32()), "block": pa.array(blocks, pa.int32()), "payload": pa.array(payload, pa.binary())}
        )

    return parts.groupBy("block").applyInArrow(run, ANSWER)


def answers(table: pa.Table, keys: np.ndarray, bits: int, kind: type) -> np.ndarray:
    """The answers to a group's sorted keys, put together from its blocks."""
    out = np.zeros(len(keys), kind)
    blocks, first = np.unique(keys >> np.uint64(64 - bits), return_index=True)
    place = dict(zip(blocks.tolist(), zip(first.tolist(), [*first[1:].tolist(), len(keys)], strict=True), strict=True))
    for block, data in zip(table.column("block").to_pylist(), table.column("payload").to_pylist(), strict=True):
        if block in place and data is not None:
            i, j = place[block]
            got = np.frombuffer(data, np.uint8 if kind is bool else kind)
            out[i:j] = np.unpackbits(got, count=j - i).astype(bool) if kind is bool else got
    return out

