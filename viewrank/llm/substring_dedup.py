"""Repeated passages, found with prefix-partitioned suffix trees.

A window is `WINDOW` consecutive words of one document; a word goes if a window over it stands
anywhere else too. Windows are suffixes cut to the depth that matters. To spread them:

1. Every window picks the `PREFIX`-word run in it with the smallest hash (its anchor). Equal windows
   pick equal anchors at equal offsets, so an anchor's words are a prefix that partitions them, and
   neighbouring windows mostly share one anchor: they travel together as one segment of words.
2. Anchors are counted. Those that stand once hold nothing repeated. Where all segments of an
   anchor are equal, all their windows are repeated. Only the others need a tree.
3. Equal segments are counted together before they are shuffled. A group of one prefix with at most
   `group_limit` different segments fits into memory: its suffixes are sorted, neighbours give the
   depth of the tree's internal nodes, and a node at depth `WINDOW` with two leaves is a repeat. A
   larger group gets longer prefixes, up to the whole window, where counting leaves is all that
   remains; so no group is gathered whole and none is cut.

Anchors to look at are passed to the tasks as bitmaps of at most `2**MAX_BITS` bits. When they fill
up with very much input, more segments travel; the result stays the same, as joins decide.

Null and empty texts have no words; a text under `WINDOW` words keeps them all. Copies of a
document, its repeated rows included, remove each other whole.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewrank.llm.common import (
    WORDS_AT_ONCE,
    RangeHashes,
    WordHashes,
    as_bytes,
    in_batches,
    kept_table,
    mixed,
    replaced_text,
    same,
    sorted_groups,
)

WINDOW = 35
PREFIX = 8
GROUP_LIMIT = 4096
MIN_BITS, MAX_BITS = 16, 28
GAPS = re.compile(rb"([\x20\x09-\x0D]+)")


class _Segments:
    """Segments of some documents, one array entry each: document number, first word, anchor, content."""

    def __init__(self, hashes: np.ndarray, lengths: list[int], window: int, prefix: int):
        self.hashes = hashes
        total, spread = len(hashes), window - prefix + 1
        ends = np.cumsum(lengths)
        starts = np.repeat(ends - lengths, lengths)
        self.document = np.repeat(np.arange(len(lengths)), lengths)
        self.starts = starts
        ranges = RangeHashes(mixed(hashes))
        runs = np.arange(max(0, total - prefix + 1))
        grams = mixed(ranges.of(runs, runs + prefix))
        # Smallest run of each window, the leftmost of equal ones, by doubling the reach.
        best, reach = runs.copy(), 1
        while reach < spread:
            step = min(reach, spread - reach)
            left, right = best[: max(0, len(best) - step)], best[step:]
            best = np.where(grams[right] < grams[left], right, left)
            reach += step
        window_starts = np.arange(max(0, total - window + 1))
        inside = self.document[window_starts] == self.document[window_starts + window - 1]
        at = window_starts[inside]
        anchors = best[at]
        first = np.ones(len(at), dtype=bool)
        first[1:] = (anchors[1:] != anchors[:-1]) | (at[1:] != at[:-1] + 1)
        opening = np.flatnonzero(first)
        self.low = at[opening]
        self.windows = np.diff(np.append(opening, len(at)))
        self.end = self.low + self.windows + window - 1
        self.anchor = grams[anchors[opening]]
        # The anchor's place counts as content: the same words around it at another offset differ.
        offset = (anchors[opening] - self.low).astype(np.uint64)
        self.content = mixed(ranges.of(self.low, self.end) + mixed(offset + self.windows.astype(np.uint64)))


def _stretches(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[tuple[int | None, int, int, np.ndarray]]:
    """Document, text hash, first word and word hashes; a long document comes in stretches whose windows
    are all of its windows, each once."""
    memory = WordHashes()
    for part in batches:
        for doc_id, text_hash, text in zip(*(part.column(i).to_pylist() for i in range(3)), strict=True):
            words = (text or b"").split()
            for at in range(0, len(words), WORDS_AT_ONCE):
                yield doc_id, text_hash, at, memory.of(words[at : at + WORDS_AT_ONCE + window - 1])


def _documents(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[tuple[list[tuple], list[int], np.ndarray]]:
    """(Document, text hash, first word), word counts and word hashes of some documents at a time."""
    names, lengths, hashes, words = [], [], [], 0
    for *name, own in _stretches(batches, window):
        names.append(tuple(name)), lengths.append(len(own)), hashes.append(own)
        words += len(own)
        if words >= WORDS_AT_ONCE:
            yield names, lengths, np.concatenate(hashes)
            names, lengths, hashes, words = [], [], [], 0
    if words:
        yield names, lengths, np.concatenate(hashes)


def _count_anchors(window: int, prefix: int):
    schema = pa.schema([("anchor", pa.int64()), ("content", pa.int64()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for _, lengths, hashes in _documents(batches, window):
            found = _Segments(hashes, lengths, window, prefix)
            order = np.lexsort((found.content, found.anchor))
            anchor, content = found.anchor[order], found.content[order]
            new = np.ones(len(order), dtype=bool)
            new[1:] = (anchor[1:] != anchor[:-1]) | (content[1:] != content[:-1])
            opening = np.flatnonzero(new)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(anchor[opening].view(np.int64)),
                    pa.array(content[opening].view(np.int64)),
                    pa.array(np.diff(np.append(opening, len(order))).astype(np.int64)),
                ],
                schema=schema,
            )

    return count


def _bitmap(anchors: DataFrame, bits: int) -> np.ndarray:
    """The highest `bits` bits of all anchors, as a bitmap of 2**bits bits."""
    place = F.shiftrightunsigned("anchor", 64 - bits)
    blocks = (
        anchors.groupBy(F.shiftright(place, 15).alias("block"))
        .agg(F.bitmap_construct_agg(place.bitwiseAND(32767)).alias("bits"))
        .toArrow()
    )
    out = np.zeros(max(1, 2**bits // 2**15) * 4096, dtype=np.uint8)
    for block, own in zip(blocks.column("block").to_pylist(), blocks.column("bits").to_pylist(), strict=True):
        out[block * 4096 : (block + 1) * 4096] = np.frombuffer(own, dtype=np.uint8)
    return out


def _holds(bitmap: np.ndarray, bits: int, anchors: np.ndarray) -> np.ndarray:
    place = (anchors >> np.uint64(64 - bits)).astype(np.int64)
    return (bitmap[place >> 3] >> (place & 7).astype(np.uint8)) & 1 > 0


_FOUND = pa.schema(
    [
        ("anchor", pa.int64()),
        ("content", pa.int64()),
        ("doc_id", pa.int64()),
        ("text_hash", pa.int64()),
        ("low", pa.int32()),
        ("windows", pa.int32()),
        ("mixed", pa.bool_()),
        ("words", pa.binary()),
    ]
)
_FOUND_SCHEMA = (
    "anchor long, content long, doc_id long, text_hash long, low int, windows int, mixed boolean, words binary"
)


def _find(window: int, prefix: int, bits: int, repeated, different):
    """Segments of anchors that may be repeated; words where a tree may be needed, once per task and content."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        sent: set[int] = set()
        for names, lengths, hashes in _documents(batches, window):
            found = _Segments(hashes, lengths, window, prefix)
            some = np.flatnonzero(_holds(repeated.value, bits, found.anchor))
            trees = _holds(different.value, bits, found.anchor[some])
            short = mixed(found.hashes).astype(np.uint32)
            words: list[bytes | None] = [None] * len(some)
            for k in np.flatnonzero(trees):
                content = int(found.content[some[k]])
                if content not in sent:
                    if len(sent) >= 200_000:
                        sent.clear()
                    sent.add(content)
                    words[k] = short[found.low[some[k]] : found.end[some[k]]].tobytes()
            first = found.low[some]
            own = [names[d] for d in found.document[first]]
            low = first - found.starts[first] + np.array([name[2] for name in own], dtype=np.int64)
            for at in range(0, len(some), 20_000):
                to, part = slice(at, at + 20_000), some[at : at + 20_000]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(found.anchor[part].view(np.int64)),
                        pa.array(found.content[part].view(np.int64)),
                        pa.array([name[0] for name in own[to]], pa.int64()),
                        pa.array([name[1] for name in own[to]], pa.int64()),
                        pa.array(low[to].astype(np.int32)),
                        pa.array(found.windows[part].astype(np.int32)),
                        pa.array(trees[to]),
                        pa.array(words[to], pa.binary()),
                    ],
                    schema=_FOUND,
                )

    return find


def _suffixes(words: list[bytes], window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of some segments as rows of word hashes; the segment and the offset of each."""
    rows, segment, offset = [], [], []
    for k, own in enumerate(words):
        values = np.frombuffer(own, dtype=np.uint32)
        n = len(values) - window + 1
        rows.append(np.lib.stride_tricks.sliding_window_view(values, window))
        segment.append(np.full(n, k))
        offset.append(np.arange(n))
    return np.concatenate(rows), np.concatenate(segment), np.concatenate(offset)


def _grow_trees(window: int):
    """Repeated windows of whole groups, as one bit per window of a segment."""
    schema = pa.schema([("anchor", pa.int64()), ("content", pa.int64()), ("repeats", pa.int64())])

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for table in sorted_groups(batches, ["anchor"], 5000):
            anchor, content = table.column("anchor").to_numpy(), table.column("content").to_numpy()
            times = table.column("n").to_numpy()
            rows, segment, offset = _suffixes(table.column("words").to_pylist(), window)
            # Groups stay apart: the anchor leads each row.
            lead = anchor[segment].view(np.uint32).reshape(-1, 2)
            keyed = np.ascontiguousarray(np.concatenate([lead, rows], axis=1))
            order = np.argsort(keyed.view(f"V{keyed.shape[1] * 4}").ravel(), kind="stable")
            keyed = keyed[order]
            # Depth at which neighbouring suffixes part; full depth: leaves of one deep internal node.
            alike = np.ones(len(order), dtype=bool)
            alike[0] = False
            alike[1:] = (keyed[1:] == keyed[:-1]).all(axis=1)
            node = np.cumsum(~alike) - 1
            leaves = np.bincount(node, weights=times[segment[order]])
            repeats = np.zeros(len(anchor), dtype=np.int64)
            deep = order[leaves[node] >= 2]
            np.bitwise_or.at(repeats, segment[deep], np.int64(1) << offset[deep])
            some = repeats > 0
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchor[some]), pa.array(content[some]), pa.array(repeats[some])], schema=schema
            )

    return grow


def _spell_windows(window: int):
    """Each window of each segment under its whole length as prefix."""
    schema = pa.schema(
        [(c, pa.int64()) for c in ("anchor", "content", "n", "place", "one", "other")]
    )

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for part in batches:
            if not part.num_rows:
                continue
            rows, segment, offset = _suffixes(part.column("words").to_pylist(), window)
            at = np.arange(len(rows)) * window
            flat = rows.ravel().astype(np.uint64)
            columns = [part.column(c).to_numpy()[segment] for c in ("anchor", "content", "n")]
            columns.append(offset.astype(np.int64))
            columns += [RangeHashes(mixed(flat + np.uint64(s))).of(at, at + window).view(np.int64) for s in (1, 2)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=schema)

    return spell


def repeated_windows(
    docs: DataFrame, window: int = WINDOW, prefix: int = PREFIX, group_limit: int = GROUP_LIMIT
) -> DataFrame:
    """`doc_id, text_hash, low, repeats`: window `low + b` of the document is repeated where bit b is set."""
    if not 0 < prefix <= window < prefix + 63:
        raise ValueError("a window needs 1 to 63 runs of prefix words")
    spark = docs.sparkSession
    texts = as_bytes(docs)
    counted = in_batches(texts, _count_anchors(window, prefix), "anchor long, content long, n long")
    anchors = kept_table(
        counted.groupBy("anchor")
        .agg(F.sum("n").alias("n"), F.min("content").alias("content"), F.max("content").alias("other"))
        .filter("n > 1")
        .select("anchor", "content", (F.col("content") != F.col("other")).alias("mixed")),
        "anchors",
    )
    number = anchors.count()
    bits = max(MIN_BITS, min(MAX_BITS, (16 * number).bit_length()))
    repeated = spark.sparkContext.broadcast(_bitmap(anchors, bits))
    different = spark.sparkContext.broadcast(_bitmap(anchors.filter("mixed"), bits))
    found = kept_table(
        in_batches(texts, _find(window, prefix, bits, repeated, different), _FOUND_SCHEMA), "segments"
    )
    segments = found.filter("mixed").groupBy("anchor", "content").agg(
        F.count(F.lit(1)).alias("n"), F.first("words", ignorenulls=True).alias("words")
    )
    segments = kept_table(segments, "different-segments")
    sizes = segments.groupBy("anchor").agg(F.count(F.lit(1)).alias("size"))
    sized = segments.join(sizes, "anchor")
    trees = in_batches(
        sized.filter(F.col("size").between(2, group_limit))
        .select("anchor", "content", "n", "words")
        .repartition("anchor")
        .sortWithinPartitions("anchor"),
        _grow_trees(window),
        "anchor long, content long, repeats long",
    )
    spelled = in_batches(
        sized.filter(F.col("size") > group_limit).select("anchor", "content", "n", "words"),
        _spell_windows(window),
        "anchor long, content long, n long, place long, one long, other long",
    )
    often = spelled.groupBy("one", "other").agg(F.sum("n").alias("times")).filter("times > 1")
    large = (
        spelled.join(often, ["one", "other"])
        .groupBy("anchor", "content")
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(place as int))")).alias("repeats"))
    )
    # A segment that stands once cannot occur among equal ones, hence n > 1 above.
    whole = anchors.filter("not mixed").select("anchor", "content", F.lit(-1).cast("long").alias("repeats"))
    repeats = whole.unionByName(trees).unionByName(large)
    return found.select("anchor", "content", "doc_id", "text_hash", "low", "windows").join(
        repeats, ["anchor", "content"]
    ).select(
        "doc_id",
        "text_hash",
        "low",
        F.col("repeats").bitwiseAND(F.expr("shiftleft(1L, windows) - 1")).alias("repeats"),
    )


def _covered(n: int, spans: list[dict], window: int) -> np.ndarray:
    """Which of n words a repeated window covers."""
    edges = np.zeros(n + 1, dtype=np.int32)
    for span in spans:
        low, bits = span["low"], span["repeats"]
        while bits:
            place = (bits & -bits).bit_length() - 1
            edges[low + place] += 1
            edges[low + place + window] -= 1
            bits &= bits - 1
    return np.cumsum(edges[:n]) > 0


def _without(text: bytes, spans: list[dict], window: int) -> bytes:
    """The text without its covered words; each kept word keeps the white space after it."""
    gone = _covered(len(text.split()), spans, window)
    pieces = GAPS.split(text)
    lead = b""
    if pieces[0] == b"":
        lead, pieces = b"".join(pieces[:2]), pieces[2:]
    pairs = (b"".join(pieces[i : i + 2]) for i in range(0, len(pieces), 2))
    return lead + b"".join(p for p, g in zip(pairs, gone, strict=False) if not g)


def _digest(window: int):
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("text_hash", pa.int64()),
            ("n_words", pa.int64()),
            ("n_removed", pa.int64()),
            ("kept_sha256", pa.string()),
        ]
    )

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for part in batches:
            out: dict[str, list] = {name: [] for name in schema.names}
            rows = zip(*(part.column(c).to_pylist() for c in ("doc_id", "text_hash", "text", "spans")), strict=True)
            for doc_id, text_hash, text, spans in rows:
                words = (text or b"").split()
                gone = _covered(len(words), spans or [], window)
                kept = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
                out["doc_id"].append(doc_id), out["text_hash"].append(text_hash)
                out["n_words"].append(len(words)), out["n_removed"].append(len(words) - len(kept))
                out["kept_sha256"].append(hashlib.sha256(b" ".join(kept)).hexdigest())
            yield pa.RecordBatch.from_pydict(out, schema=schema)

    return digest


def _spans(docs: DataFrame, window: int, prefix: int, group_limit: int) -> DataFrame:
    """`doc_id, text_hash, spans`: the repeated windows of each document that has any."""
    found = repeated_windows(docs, window, prefix, group_limit)
    return found.groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("low", "repeats")).alias("spans"))


def count_repeats(
    docs: DataFrame, window: int = WINDOW, prefix: int = PREFIX, group_limit: int = GROUP_LIMIT
) -> DataFrame:
    """`doc_id, text_hash, n_words, n_removed, kept_sha256` (of the kept words joined by one space), a row per document."""
    spans, texts = _spans(docs, window, prefix, group_limit), as_bytes(docs)
    joined = texts.join(spans, same(texts, spans, "doc_id", "text_hash"), "left").select(
        texts["doc_id"], texts["text_hash"], "text", "spans"
    )
    return in_batches(
        joined, _digest(window), "doc_id long, text_hash long, n_words long, n_removed long, kept_sha256 string"
    )


def remove_repeats(
    docs: DataFrame, window: int = WINDOW, prefix: int = PREFIX, group_limit: int = GROUP_LIMIT
) -> DataFrame:
    """The documents, all columns, with repeated passages cut from the text."""
    spans = _spans(docs, window, prefix, group_limit)
    return replaced_text(docs, spans, "spans", lambda text, own: _without(text, own, window))
