"""Homomorphic multiset hashes of documents: sums of vectors hashed from their paragraphs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flakeform.operators.lookup import lookup
from flakeform.operators.sequence import dense_sequence
from flakeform.sources.staging import stage

#: A paragraph ends after a line break or a sentence; every character belongs to one paragraph.
PARAGRAPH_END = r"(?<=\n)|(?<=[.!?] )"
#: 64-bit words of narrow lanes (four lanes of 14 bits each), and of wide lanes (62 bits each).
NARROW, WIDE = 32, 2
#: Documents that one bucket of neighbours holds; one with four times as many is cut again, so often at most.
BUCKET_ROWS, MOST_CUTS = 256, 16
_LANES = 0x3FFF3FFF3FFF3FFF
_BITS = 0x0001000100010001
_WIDE_MASK = (1 << 62) - 1


def paragraphs(text: Column) -> Column:
    """Paragraphs of a text; none for empty or null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), PARAGRAPH_END), lambda p: p != "")


def merge(left: Column, right: Column) -> Column:
    """Fingerprint of both documents' paragraphs together: insertion without reading the text again."""
    parts = [
        (F.element_at(left, k + 1) + F.element_at(right, k + 1)).bitwiseAND(F.lit(_LANES if k < NARROW else _WIDE_MASK))
        for k in range(NARROW + WIDE + 1)
    ]
    return F.array(*parts)


def remove(left: Column, right: Column) -> Column:
    """Fingerprint of the paragraphs of ``left`` without those of ``right``, which it must contain."""

    def lanes(a: Column, b: Column) -> Column:
        parts = [
            F.shiftleft(
                (F.shiftrightunsigned(a, 16 * k) - F.shiftrightunsigned(b, 16 * k)).bitwiseAND(F.lit(0x3FFF)), 16 * k
            )
            for k in range(4)
        ]
        return parts[0].bitwiseOR(parts[1]).bitwiseOR(parts[2]).bitwiseOR(parts[3])

    parts = []
    for k in range(NARROW + WIDE + 1):
        a, b = F.element_at(left, k + 1), F.element_at(right, k + 1)
        parts.append(lanes(a, b) if k < NARROW else (a - b).bitwiseAND(F.lit(_WIDE_MASK)))
    return F.array(*parts)


def fingerprint(text: Column) -> Column:
    """Array of longs: 32 words of four narrow lanes, two wide lanes, the number of paragraphs.

    Each paragraph adds one bit to each of the 128 narrow lanes (modulo 2^14) and 62 bits to each wide
    lane (modulo 2^62). Order does not matter; :func:`merge` inserts and :func:`remove` deletes
    paragraphs. The empty and the null text have all zeros. One pass over the text, in the JVM.
    """

    def add(total: Column, paragraph: Column) -> Column:
        a, b = F.xxhash64(paragraph), F.xxhash64(F.lit(1), paragraph)
        narrow = [
            (F.element_at(total, k + 1) + F.shiftright(a if k < 16 else b, k % 16).bitwiseAND(F.lit(_BITS))).bitwiseAND(
                F.lit(_LANES)
            )
            for k in range(NARROW)
        ]
        wide = [
            (F.element_at(total, NARROW + k + 1) + h.bitwiseAND(F.lit(_WIDE_MASK))).bitwiseAND(F.lit(_WIDE_MASK))
            for k, h in enumerate((F.xxhash64(F.lit(2), paragraph), F.xxhash64(F.lit(3), paragraph)))
        ]
        count = F.element_at(total, NARROW + WIDE + 1) + 1
        return F.array(*narrow, *wide, count)

    zero = F.array(*[F.lit(0).cast("long")] * (NARROW + WIDE + 1))
    return F.aggregate(paragraphs(text), zero, add)


def digest(print_: Column) -> Column:
    """A fingerprint as fixed-width lowercase hex."""
    return F.lower(F.concat_ws("", F.transform(print_, lambda x: F.lpad(F.hex(x), 16, "0"))))


def likeness(left: Column, right: Column) -> Column:
    """Estimated share of common paragraphs, 0 to 1; exactly 1 for equal fingerprints.

    A lane counts ones, so twice a lane's difference less the difference in paragraphs is a sum of
    random signs over the paragraphs that only one side has: its mean square over all lanes estimates
    their number, from fingerprints alone. Lanes tell that sum modulo 2^15, and the value next to 0 is taken:
    right for texts of any length, as long as no paragraph is repeated more than thousands of times on one side
    only. The number is at least the difference in paragraphs.
    """
    size = lambda f: F.element_at(f, NARROW + WIDE + 1)
    more = size(left) - size(right)

    def lane(a: Column, b: Column, k: int) -> Column:
        d = (F.shiftrightunsigned(a, 16 * k) - F.shiftrightunsigned(b, 16 * k)).bitwiseAND(F.lit(0x3FFF))
        d = F.pmod(2 * d - more + 0x4000, F.lit(0x8000)) - 0x4000
        return (d * d).cast("double")

    narrow = lambda f: F.slice(f, 1, NARROW)
    squares = F.zip_with(narrow(left), narrow(right), lambda a, b: sum((lane(a, b, k) for k in range(1, 4)), lane(a, b, 0)))
    apart = F.aggregate(squares, F.lit(0.0), lambda total, x: total + x) / F.lit(4.0 * NARROW)
    apart = F.greatest(apart, F.abs(more).cast("double"))
    total = size(left) + size(right)
    near = F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1.0 - apart / total))
    return F.when(left == right, F.lit(1.0)).when(total == 0, F.lit(1.0)).otherwise(near)


def _bucketed(rows: DataFrame, bucket_rows: int) -> tuple[DataFrame, list[str]]:
    """Deal rows with ``doc_id`` and ``code`` to buckets in their order: the rows with columns that order the buckets, and these columns.

    Buckets are ranges of ids of equal width at first. One that holds too many rows is cut again over the ids it has, until
    such a bucket has one id only, as one far id or many near ones ask for; and then by ranges of the text's hash, as
    null ids and repeated ones do. Only buckets with too many rows are looked up, by their measured size.
    """
    low, high, n = rows.agg(F.min("doc_id"), F.max("doc_id"), F.count(F.lit(1))).first()
    if low is None:
        low = high = 0
    wide = "decimal(20,0)"
    width = max(1, -(-(high - low + 1) * bucket_rows // max(1, n)))
    first = F.coalesce(F.floor((F.col("doc_id").cast(wide) - F.lit(low)) / F.lit(width)), F.lit(-1)).cast("long")
    rows, names = rows.withColumn("b0", first), ["b0"]
    full = F.col("n") > 4 * bucket_rows
    pieces = F.ceil(F.col("n") / bucket_rows)
    while True:
        found = rows.groupBy(*names).agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
        crowded = stage(found.filter(full), "crowded")
        mixed = crowded.filter("high > low")
        if len(names) == MOST_CUTS or mixed.isEmpty():
            break
        name = f"b{len(names)}"
        span = F.col("high").cast(wide) - F.col("low").cast(wide) + 1
        cuts = stage(mixed.select(*names, F.col("low").alias("_low"), F.ceil(span / pieces).cast(wide).alias("_step")), "cuts")
        place = F.floor((F.col("doc_id").cast(wide) - F.col("_low")) / F.col("_step")).cast("long")
        rows = lookup(rows, cuts, names, ["_low", "_step"]).withColumn(name, F.coalesce(place, F.lit(0).cast("long"))).drop("_low", "_step")
        names = [*names, name]
    same = crowded.filter("low is null or low = high")
    if not same.isEmpty():
        cuts = stage(same.select(*names, pieces.cast("double").alias("_pieces")), "cuts")
        share = F.col("code").cast("double") / F.lit(2.0**64) + 0.5
        place = F.least(F.floor(share * F.col("_pieces")), F.col("_pieces") - 1).cast("long")
        rows = lookup(rows, cuts, names, ["_pieces"]).withColumn("bcode", F.coalesce(place, F.lit(0).cast("long"))).drop("_pieces")
        names = [*names, "bcode"]
    return rows, names


def with_next(docs: DataFrame, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Add ``next_text`` of the row with the next larger id (after the last: of the first).

    Null ids come first, rows with equal ids by a hash of their text. Rows are dealt to buckets, ranges of that order with
    a bounded number of rows, whatever the ids are (only rows equal in id and text are never parted); the first
    row of each bucket is also sent to the bucket before it, so one shuffle of the texts is enough and no task sees
    more than a bucket. Returns ``doc_id``, ``text`` (empty for null) and ``next_text``.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    rows = docs.select(F.col("doc_id").cast("long"), text).withColumn("code", F.xxhash64("text"))
    rows, names = _bucketed(rows, bucket_rows)
    firsts = rows.groupBy(*names).agg(F.min(F.struct("doc_id", "code", "text")).alias("first"))
    numbered = dense_sequence(firsts.select(*names), names, "place")
    buckets = numbered.count()
    before = numbered.select(
        *[F.col(name).alias(f"to_{name}") for name in names], ((F.col("place") + 1) % F.lit(max(1, buckets))).alias("place")
    )
    ghosts = numbered.join(before, "place").join(firsts, names).select("first.*", *[F.col(f"to_{name}").alias(name) for name in names])
    everything = rows.withColumn("ghost", F.lit(False)).unionByName(ghosts.withColumn("ghost", F.lit(True)))
    by_id = Window.partitionBy(*names).orderBy("ghost", "doc_id", "code", "text")
    return (
        everything.withColumn("next_text", F.lead("text").over(by_id))
        .filter(~F.col("ghost"))
        .select("doc_id", "text", "next_text")
    )


def edited(text: Column, next_text: Column) -> Column:
    """The text whose last half of code points gives way to as many first ones of the next text."""
    half = F.floor(F.char_length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.char_length(text) - half), F.substring(next_text, F.lit(1), half))


def fingerprints(docs: DataFrame) -> DataFrame:
    """Per document its fingerprint, its edited text's and its successor's, all as arrays.

    Columns: ``doc_id``, ``text``, ``edited``, ``print``, ``edited_print``, ``next_print``. Null text is empty.
    The successor's fingerprint is computed from its text, which is at hand, not joined.
    """
    pairs = with_next(docs).withColumn("edited", edited(F.col("text"), F.col("next_text")))
    return pairs.select(
        "doc_id",
        "text",
        "edited",
        fingerprint(F.col("text")).alias("print"),
        fingerprint(F.col("edited")).alias("edited_print"),
        fingerprint(F.col("next_text")).alias("next_print"),
    )
