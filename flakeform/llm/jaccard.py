"""Near-duplicate documents: a size-aware heavy-light join of shingle sets by Jaccard similarity."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flakeform.llm.census import FRAGMENT, answers, block_bits, fragments, settle
from flakeform.llm.common import Words, chunked, mapped, mix, release_kept, window_hashes
from flakeform.sources.staging import stage

#: Words of a shingle; similarity as a fraction.
SHINGLE, ALIKE = 5, (75, 100)
#: A key with more sets than this is heavy: its sets meet one head at a time instead of each other.
HEAVY = 32
#: Cost of a subset, which is written, shuffled and matched as a row of its own, in entries of a list that is scanned.
SUBSET_COST = 4
#: Rounds in which the sets of a heavy key meet a head, before what is left meets directly.
HEAD_ROUNDS = 2


def shingles(words: Words, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of every text: numbers of texts, and hashes sorted within each text.

    A text with fewer than n words, but one, has its whole sequence as its only shingle.
    """
    counts, first = words.counts, words.first[:-1]
    at = np.arange(max(0, len(words.hashes) - n + 1))
    owner = words.owner
    inside = at[owner[at] == owner[at + n - 1]] if len(at) else at
    short = np.flatnonzero((counts > 0) & (counts < n))
    padded = np.concatenate([words.hashes, np.zeros(n, np.uint64)])
    total = mix(counts[short].astype(np.uint64))
    for k in range(n - 1):
        total = mix(total ^ np.where(k < counts[short], padded[first[short] + k], np.uint64(k)))
    values = np.concatenate([window_hashes(words.hashes, n)[inside] if len(inside) else np.zeros(0, np.uint64), total])
    texts = np.concatenate([owner[inside], short])
    order = np.lexsort((values, texts))
    texts, values = texts[order], values[order]
    new = np.ones(len(texts), bool)
    new[1:] = (texts[1:] != texts[:-1]) | (values[1:] != values[:-1])
    return texts[new], values[new]


def prefix_size(n: np.ndarray, extra: int = 0) -> np.ndarray:
    """Elements of a set of n, rarest first, of which any similar set has at least ``extra + 1`` among its own."""
    a, b = ALIKE
    return np.minimum(n, n - -(-n * a // b) + 1 + extra)


class _Group:
    """Distinct texts of a group of documents: their nodes and shingles."""

    def __init__(self, table: pa.Table, wanted: pa.Array):
        table = table.filter(pc.is_in(table.column("node"), wanted))
        nodes = table.column("node").to_numpy()
        _, first = np.unique(nodes, return_index=True)
        self.nodes = nodes[first]
        batch = table.column("text").cast(pa.binary()).take(pa.array(first)).to_pylist()
        self.words = Words([b"" if x is None else x for x in batch], lower=True)
        self.owner, self.values = shingles(self.words)
        self.sizes = np.bincount(self.owner, minlength=len(self.nodes)).astype(np.int64)


def _rarity(values: np.ndarray, starts: np.ndarray, run: np.ndarray) -> np.ndarray:
    """0 for a shingle of one text, else a code that grows with its number of texts."""
    total = np.add.reduceat(values.astype(np.int64), starts)
    code = np.where(total > 1, np.minimum(255, 1 + 8 * np.log2(np.maximum(total, 1))), 0)
    return code.astype(np.uint8)[run]


def prefixes(docs: DataFrame) -> DataFrame:
    """One row per distinct text: ``node``, ``size``, and the shared part of its prefix.

    ``elements`` are the shingles of the prefix that other texts have, rarest first, ``places`` their places in
    the text's order, and ``shared`` all its shingles that other texts have, sorted, as 64-bit numbers. A shingle
    of one text only comes first in the order and links nothing, so a text with many of them has
    no elements: it is done here. The census counts texts, not copies.
    """
    rows, chunks = chunked(docs)
    rows = rows.select("chunk", "doc_id", "node", "text")
    dealt = rows.repartition(chunks, "chunk")
    size = F.octet_length("text")
    firsts = docs.groupBy("node", size.alias("bytes")).agg(F.min("doc_id").alias("doc_id"))
    place = F.pmod(F.xxhash64("doc_id", "bytes"), F.lit(chunks)).cast("int")
    chosen = firsts.select(
        place.alias("chunk"), F.lit(-1).alias("block"), F.lit(None).cast("binary").alias("payload"), F.col("node").alias("node")
    )
    bits = block_bits(chunks)

    def count(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return fragments(0, np.zeros(0, np.uint64), np.zeros(0, np.uint16), bits)
        release_kept()
        group = _Group(left, right.column("node").combine_chunks())
        keys, number = np.unique(group.values, return_counts=True)
        return fragments(left.column("chunk")[0].as_py(), keys, np.minimum(number, 65535).astype(np.uint16), bits, narrow=True)

    def choose(left: pa.Table, right: pa.Table) -> pa.Table:
        out: dict[str, list] = {"node": [], "size": [], "elements": [], "places": [], "shared": []}
        if left.num_rows:
            release_kept()
            nodes = right.filter(pc.equal(right.column("block"), -1)).column("node").combine_chunks()
            group = _Group(left, nodes)
            keys, inverse = np.unique(group.values, return_inverse=True)
            code = answers(right, keys, bits, np.uint8)[inverse]
            order = np.lexsort((group.values, code, group.owner))
            first = np.cumsum(group.sizes) - group.sizes
            place = np.arange(len(order)) - first[group.owner]
            code, value = code[order], group.values[order]
            limit = prefix_size(group.sizes, 1)[group.owner]
            taken = (code > 0) & (place < limit)
            for i, node in enumerate(group.nodes.tolist()):
                a, b = first[i], first[i] + group.sizes[i]
                some = np.flatnonzero(taken[a:b]) + a
                out["node"].append(node)
                out["size"].append(int(group.sizes[i]))
                if len(some):
                    out["elements"].append(value[some].view(np.int64).tolist())
                    out["places"].append(place[some].tolist())
                    out["shared"].append(np.sort(value[a:b][code[a:b] > 0]).tobytes())
                else:
                    for name in ("elements", "places", "shared"):
                        out[name].append(None)
        types = (pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary())
        return pa.table({n: pa.array(v, t) for (n, v), t in zip(out.items(), types, strict=True)})

    counted = dealt.groupBy("chunk").cogroup(chosen.groupBy("chunk")).applyInArrow(count, FRAGMENT)
    rare = settle(counted, np.uint16, _rarity, narrow=True).withColumn("node", F.lit(None).cast("long"))
    known = rare.unionByName(chosen)
    schema = "node long, size int, elements array<bigint>, places array<int>, shared binary"
    return dealt.groupBy("chunk").cogroup(known.groupBy("chunk")).applyInArrow(choose, schema)


def boundary(sets: DataFrame) -> int:
    """The size up to which enumerating pairs of elements costs less than scanning inverted lists.

    A set of s shared elements costs s(s-1)/2 subsets, or a scan of the lists of its s elements. Both are summed by
    set size; the table has a row for each size and comes to the driver.
    """
    listed = sets.filter("elements is not null").select("size", F.explode("elements").alias("element"), "node")
    lengths = listed.groupBy("element").agg(F.count(F.lit(1)).alias("length"))
    # The list lengths by size: each list is scanned once for every set in it.
    scans = listed.groupBy("element", "size").agg(F.count(F.lit(1)).alias("sets")).join(lengths, "element")
    scans = scans.groupBy("size").agg(F.sum(F.col("sets") * F.least("length", F.lit(HEAVY))).alias("scan"))
    n = F.size("elements").cast("long")
    subsets = sets.filter("elements is not null").groupBy("size").agg(F.sum((n * (n - 1) / 2 + n) * SUBSET_COST).alias("subsets"))
    costs = sorted(tuple(row) for row in subsets.join(scans, "size").select("size", "subsets", "scan").collect())
    best, limit, saved = 0.0, 1, 0.0
    for size, subset_cost, scan_cost in costs:
        saved += scan_cost - subset_cost
        if saved > best:
            best, limit = saved, size
    return limit


def keys(sets: DataFrame, limit: int) -> DataFrame:
    """Keys under which candidates meet: ``key``, ``heavy_kind``, ``node``, ``size``, ``place``.

    Sets up to ``limit`` enumerate the pairs of their extended prefix: two similar ones share a pair (a set of
    one element has itself). Larger sets, and those smaller ones that can be similar to a larger one, are
    in the inverted list of each element of their plain prefix.
    """
    a, b = ALIKE
    some = sets.filter("elements is not null").withColumn("pairs", F.arrays_zip("elements", "places"))
    plain = F.col("size") - F.ceil(F.col("size") * a / b) + 1
    small = some.filter(F.col("size") <= limit)
    one = small.filter("size = 1").select(
        F.col("elements")[0].alias("key"), F.lit(0).alias("kind"), "node", "size", F.lit(0).alias("place")
    )
    both = (
        small.filter("size > 1")
        .select("node", "size", "pairs", F.posexplode("pairs").alias("at", "left"))
        .select("node", "size", "left", F.explode(F.expr("slice(pairs, at + 2, size(pairs))")).alias("right"))
        .select(
            F.xxhash64("left.elements", "right.elements").alias("key"),
            F.lit(1).alias("kind"),
            "node",
            "size",
            F.col("right.places").alias("place"),
        )
    )
    large = (
        some.filter(F.col("size") * b > limit * a)
        .select("node", "size", plain.alias("plain"), F.explode("pairs").alias("element"))
        .filter(F.col("element.places") < F.col("plain"))
        .select(F.col("element.elements").alias("key"), F.lit(2).alias("kind"), "node", "size", F.col("element.places").alias("place"))
    )
    return one.unionByName(both).unionByName(large)


def _may_link(limit: int, left: str, right: str) -> Column:
    """Sizes and places allow a similarity, and the kind of key is the one for these sizes."""
    a, b = ALIKE
    size = lambda side: F.col(f"{side}.size")
    low, high = F.least(size(left), size(right)), F.greatest(size(left), size(right))
    need = F.ceil((size(left) + size(right)) * a / (a + b))
    most = F.least(*[size(x) - F.col(f"{x}.place") for x in (left, right)])
    most = most + F.when(F.col(f"{left}.kind") == 1, 1).otherwise(0)
    right_kind = F.when(F.col(f"{left}.kind") == 2, high > limit).otherwise(high <= limit)
    return (high * a <= low * b) & (most >= need) & right_kind


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (``left``, ``right``) that are similar: exact, from the shared shingles and the sizes of both sets."""
    a, b = ALIKE
    side = sets.filter("shared is not null")
    joined = pairs.join(
        side.select(F.col("node").alias("left"), F.col("size").alias("left_size"), F.col("shared").alias("left_set")), "left"
    ).join(
        side.select(F.col("node").alias("right"), F.col("size").alias("right_size"), F.col("shared").alias("right_set")),
        "right",
    )

    def check(batch: pa.RecordBatch) -> pa.RecordBatch:
        left, right = (batch.column(f"{x}_set").to_pylist() for x in ("left", "right"))
        sizes = batch.column("left_size").to_numpy() + batch.column("right_size").to_numpy()
        both = np.array(
            [len(np.intersect1d(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), True)) for x, y in zip(left, right, strict=True)],
            np.int64,
        )
        return batch.select(["left", "right"]).filter(pa.array(b * both >= a * (sizes - both), pa.bool_()))

    return mapped(joined.select("left", "right", "left_size", "right_size", "left_set", "right_set"), check, "left long, right long")


def components(links: DataFrame) -> DataFrame:
    """(``node``, ``root``) for every node in a link: the smallest node that links reach.

    Alternates two steps until nothing changes: every node's larger neighbours go to its smallest one, and
    every node's smaller neighbours do. Each step is staged, keeps the number of links, and
    doubles how far a root is known, so long chains end in few rounds.
    """
    def both(df: DataFrame) -> DataFrame:
        return df.unionByName(df.select(F.col("right").alias("left"), F.col("left").alias("right")))

    current = stage(links.filter("left <> right").select(F.greatest("left", "right").alias("left"), F.least("left", "right").alias("right")).distinct(), "links")
    while True:
        # Large step: link larger neighbours to the smallest of the neighbourhood.
        near = both(current)
        least = near.groupBy("left").agg(F.min("right").alias("least"))
        least = least.select("left", F.least("left", "least").alias("least"))
        large = near.join(least, "left").filter("right > left").select(F.col("right").alias("left"), F.col("least").alias("right")).distinct()
        large = stage(large, "links")
        # Small step: link smaller neighbours, and the node, to the smallest.
        least = large.groupBy("left").agg(F.min("right").alias("least"))
        small = large.join(least, "left").select(F.col("right").alias("left"), F.col("least").alias("right"))
        small = small.unionByName(least.select("left", F.col("least").alias("right"))).filter("left <> right").distinct()
        small = stage(small, "links")
        if small.exceptAll(current).isEmpty() and current.exceptAll(small).isEmpty():
            break
        current = small
    roots = small.select(F.col("left").alias("node"), F.col("right").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())


def link_texts(sets: DataFrame) -> DataFrame:
    """Links that connect every pair of similar texts, directly or over others. ``sets``: staged :func:`prefixes`.

    Under a light key all sets meet. Under a heavy key they meet its head, the set with the fewest rarer
    shingles; those that the links so far do not connect to the head meet a second head. Then
    whatever is not in the key's largest component meets all others under the key. Pairs in one
    component are never formed again, so a large group of copies costs its size, not its square.
    """
    limit = boundary(sets)
    listed = stage(keys(sets, limit), "keys")
    lengths = listed.groupBy("kind", "key").agg(F.count(F.lit(1)).alias("length")).filter("length > 1")
    listed = stage(listed.join(lengths, ["kind", "key"]), "keys")
    pair = [F.least("a.node", "b.node").alias("left"), F.greatest("a.node", "b.node").alias("right")]
    same = (F.col("a.kind") == F.col("b.kind")) & (F.col("a.key") == F.col("b.key"))

    light = listed.filter(F.col("length") <= HEAVY)
    pairs = light.alias("a").join(light.alias("b"), same & (F.col("a.node") < F.col("b.node")) & _may_link(limit, "a", "b"))
    links = stage(verified(pairs.select(*pair).distinct(), sets), "links")
    heavy = listed.filter(F.col("length") > HEAVY)
    if heavy.isEmpty():
        return links

    def headed(rows: DataFrame) -> DataFrame:
        head = F.min(F.struct("place", "size", "node")).alias("head")
        heads = rows.groupBy("kind", "key").agg(head)
        heads = heads.select("kind", "key", "head.*")
        met = rows.alias("a").join(heads.alias("b"), same & (F.col("a.node") != F.col("b.node")) & _may_link(limit, "a", "b"))
        return met.select(*pair).distinct()

    def rooted(rows: DataFrame) -> DataFrame:
        roots = components(links)
        return rows.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))

    active = heavy
    for _ in range(HEAD_ROUNDS):
        links = stage(links.unionByName(verified(headed(active), sets)).distinct(), "links")
        ranked = rooted(heavy)
        sizes = ranked.groupBy("kind", "key", "root").agg(F.count(F.lit(1)).alias("sets"))
        largest = sizes.groupBy("kind", "key").agg(F.max(F.struct("sets", "root"))["root"].alias("largest"))
        ranked = stage(ranked.join(largest, ["kind", "key"]), "roots")
        active = ranked.filter("root <> largest").drop("root", "largest")
    apart = ranked.filter("root <> largest")
    met = apart.alias("a").join(ranked.alias("b"), same & (F.col("a.root") != F.col("b.root")) & _may_link(limit, "a", "b"))
    return stage(links.unionByName(verified(met.select(*pair).distinct(), sets)), "links")


def _grouped(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (``doc_id``, ``node``), and texts (``node``, ``size``, ``root``) with the root of their component; staged."""
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("node", F.xxhash64("text"))
    sets = stage(prefixes(rows), "sets")
    roots = stage(components(link_texts(sets)), "components")
    ids = stage(rows.select("doc_id", "node"), "nodes")
    named = sets.select("node", "size").join(roots, "node", "left")
    return ids, stage(named.withColumn("root", F.coalesce("root", "node")), "named")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id``, ``n_shingles``, ``component_id``.

    ``component_id`` is the smallest id that links reach, the document itself included. Equal texts are one set.
    Texts without words have no shingle, link with nothing and keep their own id. Rows with a null id
    take part; their component is named by the smallest id that is not null, if there is one. Repeated
    rows stay.
    """
    ids, named = _grouped(docs)
    named = stage(named.join(ids.groupBy("node").agg(F.min("doc_id").alias("least")), "node"), "named")
    least = named.groupBy("root").agg(F.min("least").alias("component"))
    of_node = named.select("node", "size", "root").join(least, "root").select("node", "size", "component")
    return ids.join(of_node, "node").select(
        "doc_id",
        F.col("size").cast("long").alias("n_shingles"),
        F.when(F.col("size") > 0, F.col("component")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def survivors(ids: DataFrame, named: DataFrame) -> DataFrame:
    """The row that stays of every component with words: ``_id``, ``_node``, and its ``copies`` in the table.

    The smallest id that is not null, else null; among texts with that id, the one with the smallest hash.
    """
    rows = ids.groupBy("doc_id", "node").agg(F.count(F.lit(1)).alias("copies"))
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "node", "copies")
    firsts = rows.groupBy("node").agg(F.min(first).alias("first"))
    chosen = named.filter("size > 0").join(firsts, "node").groupBy("root").agg(F.min("first").alias("first"))
    return chosen.select(F.col("first.doc_id").alias("_id"), F.col("first.node").alias("_node"), F.col("first.copies").alias("copies"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """One document of each group of near copies: of those with the smallest id, nulls last, the one whose
    text has the smallest hash. Columns as in the input.

    Documents without words stay. Of rows repeated with id and text one stays, the first by a hash of all
    columns; rows without words and id are not taken for repeats.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    wordless = ~text.rlike(r"[^\x20\x09-\x0D]")
    kept = stage(survivors(*_grouped(docs)), "kept")
    marked = docs.withColumns({"_id": F.col("doc_id").cast("long"), "_node": F.xxhash64(text)})

    def first(rows: DataFrame) -> DataFrame:
        order = Window.partitionBy("_node", "_null", "_key").orderBy(F.xxhash64(*[F.col(c) for c in docs.columns]))
        return rows.withColumn("_rank", F.row_number().over(order)).filter("_rank = 1").drop("_rank")

    def keyed(rows: DataFrame) -> DataFrame:
        return rows.withColumns({"_null": F.col("_id").isNull(), "_key": F.coalesce("_id", F.lit(0))}).drop("_id")

    with_words = keyed(marked.filter(~wordless))
    if not kept.filter("copies > 1").isEmpty():
        with_words = first(with_words)
    with_words = with_words.join(keyed(kept), ["_node", "_null", "_key"], "left_semi")
    blank = marked.filter(wordless)
    named = first(keyed(blank.filter("_id is not null")))
    return with_words.select(*docs.columns).unionByName(named.select(*docs.columns)).unionByName(
        blank.filter("_id is null").select(*docs.columns)
    )
