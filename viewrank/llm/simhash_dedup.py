"""Near-duplicates by SimHash: fingerprints that differ in few bits, found in BK-trees.

All fingerprints are never in one place. They are dealt into shards so that two within the radius
always share one: the 64 bits are cut into `radius + 1` blocks, and two fingerprints that differ in
at most `radius` bits agree in a whole block. A shard is all fingerprints with one value of one
block; one with more than `shard_limit` members is dealt again by its free bits, by the same rule.
Each shard is a BK-tree, children keyed by the Hamming distance to their parent; a fingerprint is
looked up by following only edges within the radius of its own distance. The tree is built in the
task that its queries are shuffled to, which stands in for a broadcast of shard trees: that would
send fingerprints of all documents through the driver.

A shard yields one link per member to its local component, not all pairs. Components over all shards
are then joined by star contraction.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewrank.llm.common import as_bytes, group_starts, in_batches, kept_table, packed, same, sorted_groups
from viewrank.llm.components import components

SHINGLE = 3
RADIUS = 2
SHARD_LIMIT = 2000
BITS = 64
SHINGLES_AT_ONCE = 100_000
SEED = 42  # fixed value


def fingerprint(text: bytes | None, shingle: int) -> int:
    """SimHash over word shingles of the text with A-Z in lower case; zero without words."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        shingles: Iterable[bytes] = [b" ".join(words)]
        total = 1
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
        total = len(words) - shingle + 1
    ones = np.zeros(BITS, dtype=np.int64)
    hashes = (xxhash.xxh64_intdigest(s, SEED) for s in shingles)
    for at in range(0, total, SHINGLES_AT_ONCE):
        count = min(SHINGLES_AT_ONCE, total - at)
        some = np.fromiter(hashes, dtype=">u8", count=count)
        ones += np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > total).view(">u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """`doc_id, text_hash, print` (the fingerprint as a signed long), one row per document."""
    schema = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("print", pa.int64())])

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for part in batches:
            prints = [fingerprint(text, shingle) for text in part.column("text").to_pylist()]
            marks = np.array(prints, dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(marks)], schema=schema)

    return in_batches(as_bytes(docs), mark, "doc_id long, text_hash long, print long")


class BKTree:
    """Integers by Hamming distance."""

    def __init__(self):
        self.root: tuple[int, dict] | None = None

    def add(self, value: int) -> None:
        if self.root is None:
            self.root = (value, {})
            return
        node = self.root
        while distance := (node[0] ^ value).bit_count():
            child = node[1].get(distance)
            if child is None:
                node[1][distance] = (value, {})
                return
            node = child

    def within(self, value: int, radius: int) -> list[int]:
        found, open_nodes = [], [self.root] if self.root else []
        while open_nodes:
            own, children = open_nodes.pop()
            distance = (own ^ value).bit_count()
            if distance <= radius:
                found.append(own)
            if children:
                for d in range(max(1, distance - radius), distance + radius + 1):
                    if child := children.get(d):
                        open_nodes.append(child)
        return found


def _local_links(members: list[int], radius: int) -> Iterator[tuple[int, int]]:
    """Each member that is linked within the shard, with the smallest member it reaches there."""
    tree, above = BKTree(), {m: m for m in members}

    def top(m: int) -> int:
        while above[m] != m:
            above[m] = m = above[above[m]]
        return m

    for member in members:
        for other in tree.within(member, radius):
            one, two = sorted((top(member), top(other)))
            above[two] = one
        tree.add(member)
    return ((m, top(m)) for m in members if top(m) != m)


def _search(radius: int):
    schema = pa.schema([("node", pa.int64()), ("root", pa.int64())])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for table in sorted_groups(batches, ["mask", "value"], 5000):
            starts = group_starts(table, ["mask", "value"])
            prints = table.column("print").to_numpy().view(np.uint64)
            ends = np.append(starts[1:], len(prints))
            links: list[tuple[int, int]] = []
            for k in np.flatnonzero(ends - starts > 1):
                links += _local_links(prints[starts[k] : ends[k]].tolist(), radius)
            pairs = np.array(links, dtype=np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], schema=schema)

    return search


def _split(mask: int, parts: int) -> list[int]:
    """Masks of the fixed bits and one of `parts` blocks of the free bits each."""
    free = [b for b in range(BITS) if not mask >> b & 1]
    cuts = [len(free) * i // parts for i in range(parts + 1)]
    return [mask | sum(1 << b for b in free[cuts[i] : cuts[i + 1]]) for i in range(parts)]


def _signed(mask: int) -> int:
    return mask - 2**64 if mask >= 2**63 else mask


def _dealt(prints: DataFrame, masks: Column) -> DataFrame:
    return prints.select("print", F.explode(masks).alias("mask")).select(
        "print", "mask", F.col("print").bitwiseAND(F.col("mask")).alias("value")
    )


def links(prints: DataFrame, radius: int = RADIUS, shard_limit: int = SHARD_LIMIT) -> DataFrame:
    """`node, root`: links that connect all fingerprints (distinct longs `print`) within the radius."""
    masks = _split(0, radius + 1)
    dealt = _dealt(prints, F.array(*(F.lit(_signed(m)) for m in masks)))
    small = []
    while True:
        sizes = dealt.groupBy("mask", "value").agg(F.count(F.lit(1)).alias("size"))
        large = sizes.filter(F.col("size") > shard_limit).select("mask", "value")
        large = kept_table(large, "large-shards")
        if len(_split(masks[0], radius + 1)) * (radius + 1) > BITS - masks[0].bit_count() or large.isEmpty():
            small.append(dealt)
            break
        small.append(dealt.join(large, ["mask", "value"], "left_anti"))
        children = {m: _split(m, radius + 1) for m in masks}
        next_masks = F.when(F.lit(False), F.array().cast("array<long>"))
        for mask, own in children.items():
            next_masks = next_masks.when(
                F.col("mask") == _signed(mask), F.array(*(F.lit(_signed(m)) for m in own))
            )
        hot = dealt.join(large, ["mask", "value"], "left_semi")
        dealt = _dealt(hot.withColumn("masks", next_masks).drop("value").withColumnRenamed("mask", "old"), F.col("masks"))
        masks = [m for own in children.values() for m in own]
    shards = small[0]
    for more in small[1:]:
        shards = shards.unionByName(more)
    ordered = shards.repartition("mask", "value").sortWithinPartitions("mask", "value", "print")
    return in_batches(ordered, _search(radius), "node long, root long")


def _grouped(docs: DataFrame, shingle: int, radius: int, shard_limit: int) -> DataFrame:
    """`doc_id, text_hash, print, component_id, root`, one row per document; `root` is one fingerprint per component."""
    marked = kept_table(fingerprints(docs, shingle), "fingerprints")
    nodes = marked.groupBy("print").agg(F.min("doc_id").alias("first_id"))
    roots = components(links(nodes.select("print"), radius, shard_limit))
    placed = nodes.join(roots, nodes["print"] == roots["node"], "left").select(
        "print", "first_id", F.coalesce("root", "print").alias("root")
    )
    placed = kept_table(placed, "fingerprint-roots")
    first = placed.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = placed.join(first, "root").select("print", "component_id", "root")
    return marked.join(named, "print").select("doc_id", "text_hash", "print", "component_id", "root")


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, shard_limit: int = SHARD_LIMIT
) -> DataFrame:
    """`doc_id, text_hash, fingerprint, component_id`, one row per document.

    `component_id` is the smallest doc_id reachable over links (null ids are passed over, so it is null
    where a component has no other). Null, empty and blank texts have fingerprint zero and link like any
    other. Repeated rows link to each other.
    """
    return _grouped(docs, shingle, radius, shard_limit).select(
        "doc_id",
        "text_hash",
        F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"),
        "component_id",
    )


def first_of_each_group(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One document of each group of near-duplicates: that with the smallest id, ids that are null last.

    Of several texts with that id the one with the smallest hash stays, of repeated rows any one. Groups are
    told apart by their fingerprints, so each keeps its own where an id repeats with other texts.
    """
    found = _grouped(docs, shingle, radius, SHARD_LIMIT)
    counted = found.groupBy("root", "doc_id", "text_hash").agg(F.count(F.lit(1)).alias("rows"))
    best = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash", "rows")).alias("best")
    firsts = counted.groupBy("root").agg(best).select(
        F.col("best.doc_id").alias("first_id"),
        F.col("best.text_hash").alias("first_hash"),
        (F.col("best.rows") > 1).alias("repeated"),
    )
    firsts = kept_table(firsts, "first-documents")
    own = F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("text_hash") == F.col("first_hash"))
    kept = packed(docs).join(firsts, own)
    if not firsts.filter("repeated").isEmpty():  # texts move once more
        kept = kept.dropDuplicates(["doc_id", "text_hash"])
    return kept.select("row.*")
