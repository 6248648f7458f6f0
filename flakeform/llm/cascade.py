"""Quality rules as a short-circuit cascade, cheapest rejection first."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flakeform.llm.common import mapped, texts

#: Documents on which cost and selectivity of the rules are estimated. It orders the rules, no more.
SAMPLE_ROWS = 2000
#: Fixed values of the symbols that count.
SYMBOLS = b"#*$%&|<>"
_BLANKS = b" \t\n\x0b\f\r"
_BLANKS_AND_TAILS = _BLANKS + bytes(range(0x80, 0xC0))
_NOT_SYMBOLS = bytes(set(range(256)) - set(SYMBOLS))
_UPPER = bytes(range(65, 91))
_NOT_UPPER = bytes(set(range(256)) - set(_UPPER))
_NOT_ASCII_LETTER = bytes(set(range(256)) - set(_UPPER) - set(range(97, 123)))


class Measured:
    """Measures of one text, each computed when first asked for."""

    def __init__(self, text: bytes):
        self.text = text

    @cached_property
    def words(self) -> list[bytes]:
        return self.text.split()

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        """Code points outside white space: bytes that start one."""
        return len(self.text.translate(None, _BLANKS_AND_TAILS))

    @cached_property
    def n_symbols(self) -> int:
        return len(self.text.translate(None, _NOT_SYMBOLS))

    @cached_property
    def n_upper(self) -> int:
        return len(self.text.translate(None, _NOT_UPPER))

    @cached_property
    def n_letters(self) -> int:
        return len(self.text.translate(None, _NOT_ASCII_LETTER))

    @cached_property
    def lines(self) -> list[bytes]:
        """Lines with at least one word."""
        return [line for line in self.text.split(b"\n") if line.strip(_BLANKS)]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        """Words inside a three-word window that is found at least twice."""
        n = self.n_words
        if n < 4:
            return 0
        ids: dict[bytes, int] = {}
        a = np.fromiter((ids.setdefault(w, len(ids)) for w in self.words), np.int64, n)
        base = len(ids)
        pairs = a[:-1] * base + a[1:]
        if base >= 1 << 20:
            pairs = np.unique(pairs, return_inverse=True)[1]
        windows = pairs[:-1] * base + a[2:]
        order = np.argsort(windows, kind="stable")
        same = windows[order][1:] == windows[order][:-1]
        if not same.any():
            return 0
        starts = np.concatenate([order[1:][same], order[:-1][same]])
        covered = np.zeros(n, bool)
        for k in range(3):
            covered[starts + k] = True
        return int(covered.sum())


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Measured], bool]


#: The first two are the base rules of the contract.
RULES = (
    Rule("few_words", lambda m: m.n_words < 50),
    Rule("repeated_windows", lambda m: 100 * m.n_repeat_words > 50 * m.n_words),
    Rule("symbols", lambda m: 100 * m.n_symbols > 10 * m.word_chars),
    Rule("duplicate_lines", lambda m: 100 * m.n_dup_lines > 50 * max(1, len(m.lines))),
    Rule("word_length", lambda m: not 2 * m.n_words <= m.word_chars <= 20 * m.n_words),
    Rule("capitals", lambda m: 100 * m.n_upper > 60 * max(1, m.n_letters)),
)


def rule_order(docs: DataFrame, rules: Sequence[Rule] = RULES, sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """Rules by rejected documents per second on a bounded hash sample, highest first.

    Order changes the work only, never the verdict: a document is kept if no rule rejects it.
    Rules that reject nothing come last, the cheapest first.
    """
    ids = docs.select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    sample = docs.select("doc_id", "text").join(F.broadcast(ids.distinct()), "doc_id", "left_semi")

    def measure(batch: pa.RecordBatch) -> pa.RecordBatch:
        seconds, hits = np.zeros(len(rules)), np.zeros(len(rules), np.int64)
        for text in texts(batch):
            for k, rule in enumerate(rules):
                start = time.perf_counter()
                hits[k] += rule.rejects(Measured(text))
                seconds[k] += time.perf_counter() - start
        return pa.record_batch(
            {"rule": pa.array(range(len(rules)), pa.int32()), "seconds": seconds, "hits": pa.array(hits)}
        )

    rows = mapped(sample, measure, "rule int, seconds double, hits long").groupBy("rule").agg(
        F.sum("seconds").alias("seconds"), F.sum("hits").alias("hits")
    )
    cost = {r["rule"]: (r["seconds"], r["hits"]) for r in rows.collect()}
    rank = [(-cost[k][1] / max(cost[k][0], 1e-9), cost[k][0], k) if k in cost else (0, 0, k) for k in range(len(rules))]
    return [rules[k] for *_, k in sorted(rank)]


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def run_cascade(docs: DataFrame, rules: Sequence[Rule] = RULES, measures: Sequence[str] = MEASURES) -> DataFrame:
    """One row per document: ``doc_id``, the asked measures, ``kept`` and ``rejected_by``.

    Rules run in the order of :func:`rule_order` and stop at the first rejection; measures that no
    rule needed are computed only if asked for. Null text counts as empty. Repeated rows stay.
    ``rejected_by`` names the rule that rejected first; which one that is may differ between runs.
    """
    ordered = rule_order(docs, rules)
    names = list(measures)

    def judge(batch: pa.RecordBatch) -> pa.RecordBatch:
        rejected, values = [], []
        for text in texts(batch):
            measured = Measured(text)
            rejected.append(next((rule.name for rule in ordered if rule.rejects(measured)), None))
            values.append([getattr(measured, name) for name in names])
        columns = np.array(values, np.int64).reshape(len(values), len(names))
        out = {"doc_id": batch.column("doc_id").cast(pa.int64())}
        out |= {name: pa.array(columns[:, k]) for k, name in enumerate(names)}
        out["kept"] = pa.array([r is None for r in rejected], pa.bool_())
        out["rejected_by"] = pa.array(rejected, pa.string())
        return pa.record_batch(out)

    schema = ", ".join(["doc_id long", *[f"{name} long" for name in names], "kept boolean", "rejected_by string"])
    return mapped(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), judge, schema)


def quality_rules(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Only the documents that no rule rejects, with the columns of the input."""
    ordered = rule_order(docs, rules)

    def passes(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [Measured(text) for text in texts(batch)]
        return batch.filter(pa.array([not any(rule.rejects(m) for rule in ordered) for m in found], pa.bool_()))

    return docs.mapInArrow(lambda batches: (passes(b) for b in batches), docs.schema)
