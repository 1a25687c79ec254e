"""Line dedup by pairwise alignment: common blocks of lines go from the later of two documents.

Later means the larger doc_id. Overlapping documents are found through passages of lines that follow
each other: from and to each line the shortest one with `min_words` words, each two neighbours with
as many, and the whole document. A passage that stands in several documents leads each of them to the
first one that holds it, its source. Any block that two documents share and that is large enough to
delete consists of such passages, so each of its lines is aligned with a source that has it and its
neighbours. A passage in n documents gives n - 1 pairs, not n * n, a group of copies aligns with its
first member, and no frequency cap is needed. For each pair all lines of both documents are compared.

A block is missed only if the source of each of its passages holds other lines in such an order that
the chain passes it by, while a further holder would not.

The common lines of a pair are aligned with patience diff: lines that stand once on either side are
anchors, the longest increasing chain of anchors splits both sides, the rest is aligned between the
anchors in the same way, and equal lines next to a match are taken along. A block is a run of
aligned lines that follow each other in both documents (blank lines aside); it is deleted from the
later document if it holds at least `min_words` words.

Null and empty texts have no lines. Documents without an id are neither sources nor changed, as they
have no order. Repeated rows count as one document. A line counts by all its characters but trailing
white space.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewrank.llm.common import as_bytes, batch, in_batches, kept_table, replaced_text, same

MIN_WORDS = 5


def _chain(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest chain of pairs that increase on both sides; `pairs` ascend on the first."""
    tops: list[int] = []
    last: list[tuple] = []
    for a, b in pairs:
        at = bisect_left(tops, b)
        entry = (a, b, last[at - 1] if at else None)
        if at == len(tops):
            tops.append(b), last.append(entry)
        else:
            tops[at], last[at] = b, entry
    out, entry = [], last[-1] if last else None
    while entry:
        out.append((entry[0], entry[1]))
        entry = entry[2]
    return out[::-1]


def patience(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Matching places of two lists of line hashes, ascending on both sides."""
    matches: list[tuple[int, int]] = []
    work = [(0, len(a), 0, len(b))]
    while work:
        a_low, a_high, b_low, b_high = work.pop()
        while a_low < a_high and b_low < b_high and a[a_low] == b[b_low]:
            matches.append((a_low, b_low))
            a_low, b_low = a_low + 1, b_low + 1
        while a_low < a_high and b_low < b_high and a[a_high - 1] == b[b_high - 1]:
            a_high, b_high = a_high - 1, b_high - 1
            matches.append((a_high, b_high))
        if a_low == a_high or b_low == b_high:
            continue
        chain = _chain(_once_on_both_sides(a, a_low, a_high, b, b_low, b_high))
        if not chain:
            continue
        matches += chain
        edges = [(a_low - 1, b_low - 1), *chain, (a_high, b_high)]
        work += [(p + 1, r, q + 1, s) for (p, q), (r, s) in zip(edges, edges[1:], strict=False)]
    return sorted(matches)


def _once_on_both_sides(a, a_low, a_high, b, b_low, b_high) -> list[tuple[int, int]]:
    places: list[dict[int, int]] = []
    for lines, low, high in ((a, a_low, a_high), (b, b_low, b_high)):
        own: dict[int, int] = {}
        for i in range(low, high):
            own[lines[i]] = -1 if lines[i] in own else i
        places.append(own)
    return [(i, j) for line, i in places[0].items() if i >= 0 and (j := places[1].get(line, -1)) >= 0]


def _blocks(later: list[tuple[int, int, int]], earlier: list[tuple[int, int]], min_words: int) -> list[int]:
    """Places to delete. `later`: place, line, words; `earlier`: place, line; both ascending."""
    matches = patience([line for _, line, _ in later], [line for _, line in earlier])
    out: list[int] = []
    run: list[int] = []
    words, before = 0, (-2, -2)
    for i, j in [*matches, (None, None)]:
        here = (later[i][0], earlier[j][0]) if i is not None else (-9, -9)
        if here != (before[0] + 1, before[1] + 1):
            if words >= min_words:
                out += run
            run, words = [], 0
        if i is not None:
            run.append(here[0])
            words += later[i][2]
        before = here
    return out


def lines_of(docs: DataFrame) -> DataFrame:
    """`doc_id, text_hash, lines, words`: the lines of a document that hold a word, as hashes, and their sizes."""
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("text_hash", pa.int64()),
            ("lines", pa.list_(pa.int64())),
            ("words", pa.list_(pa.int32())),
        ]
    )

    def split(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for part in batches:
            held = [held_lines(text) for text in part.column("text").to_pylist()]
            columns = [
                part.column("doc_id"),
                part.column("text_hash"),
                pa.array([[_hash(line) for line in own] for own in held], schema.field("lines").type),
                pa.array([[len(line.split()) for line in own] for own in held], schema.field("words").type),
            ]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return in_batches(
        as_bytes(docs).filter("doc_id is not null"),
        split,
        "doc_id long, text_hash long, lines array<long>, words array<int>",
    )


def _hash(content: bytes) -> int:
    return xxhash.xxh64_intdigest(content, 11) - 2**63


def passages(words: list[int], min_words: int) -> set[tuple[int, int]]:
    """First line and end of the passages that lead a document to its sources, for the sizes of its lines."""
    out: set[tuple[int, int]] = set()
    low, held = 0, 0
    for end, size in enumerate(words, 1):
        before = low + (held >= min_words)  # the shortest from there has ended
        held += size
        while low < end and held - words[low] >= min_words:
            held -= words[low]
            low += 1
        if held >= min_words:
            out.add((low, end))  # the shortest that ends here
            # The shortest from a line ends with the first line that makes it large enough.
            out.update((start, end) for start in range(before, low))
        if end > 1 and words[end - 2] + size >= min_words:
            out.add((end - 2, end))
    if sum(words) >= min_words:
        out.add((0, len(words)))
    return out


def _passage_hashes(min_words: int):
    schema = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("passage", pa.int64())])

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for part in batches:
            for doc_id, text_hash, lines, words in zip(*(c.to_pylist() for c in part.columns), strict=True):
                packed = np.array(lines, dtype=np.int64).tobytes()
                own = list({_hash(packed[8 * low : 8 * end]) for low, end in passages(words, min_words)})
                if own:
                    columns = [[doc_id] * len(own), [text_hash] * len(own), own]
                    yield pa.RecordBatch.from_pydict(dict(zip(schema.names, columns, strict=True)), schema=schema)

    return mark


def held_lines(text: bytes | None) -> list[bytes]:
    """Lines with a word, without trailing white space."""
    return [line for raw in (text or b"").split(b"\n") if (line := raw.rstrip()).strip()]


def _align(min_words: int):
    schema = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("gone", pa.list_(pa.int32()))])

    def align(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        """Rows of one document follow each other, its own lines (no source) first."""
        document, lines, words, gone = None, [], [], set()

        def found() -> Iterator[pa.RecordBatch]:
            if gone:
                yield batch(schema, doc_id=[document[0]], text_hash=[document[1]], gone=[sorted(gone)])

        for part in batches:
            for doc_id, text_hash, source, own, sizes in zip(*(c.to_pylist() for c in part.columns), strict=True):
                if source is None:
                    yield from found()
                    document, lines, words, gone = (doc_id, text_hash), own, sizes, set()
                    continue
                common = set(lines).intersection(own)
                later = [(i, x, words[i]) for i, x in enumerate(lines) if x in common]
                gone.update(_blocks(later, [(i, x) for i, x in enumerate(own) if x in common], min_words))
        yield from found()

    return align


def deleted_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """`doc_id, text_hash, gone`: places of the lines to delete, for documents that lose any."""
    lines = kept_table(lines_of(docs).distinct(), "lines")
    held = in_batches(lines, _passage_hashes(min_words), "doc_id long, text_hash long, passage long")
    held = kept_table(held, "passages")
    holder = F.struct("doc_id", "text_hash")
    shared = (
        held.groupBy("passage")
        .agg(F.min(holder).alias("first"), F.max(holder).alias("last"))
        .filter("first != last")
        .select("passage", F.col("first.doc_id").alias("source_id"), F.col("first.text_hash").alias("source_hash"))
    )
    # Read back, so that each join is between two plain shuffles and Spark can split a frequent passage or source.
    shared = kept_table(shared, "passage-sources")
    pairs = held.join(shared, "passage").filter("doc_id != source_id or text_hash != source_hash")
    pairs = kept_table(pairs.select("doc_id", "text_hash", "source_id", "source_hash").distinct(), "pairs")
    sources = lines.select(
        F.col("doc_id").alias("source_id"), F.col("text_hash").alias("source_hash"), "lines", F.lit(None).cast("array<int>").alias("words")
    )
    found = pairs.join(sources, ["source_id", "source_hash"]).select(
        "doc_id", "text_hash", F.col("source_id").alias("source"), "lines", "words"
    )
    own = lines.select("doc_id", "text_hash", F.lit(None).cast("long").alias("source"), "lines", "words")
    ordered = (
        own.unionByName(found).repartition("doc_id", "text_hash").sortWithinPartitions("doc_id", "text_hash", "source")
    )
    return in_batches(ordered, _align(min_words), "doc_id long, text_hash long, gone array<int>")


def _without(text: bytes, gone: list[int]) -> bytes:
    drop, place, out = set(gone), 0, []
    for raw in text.split(b"\n"):
        if raw.strip():
            place += 1
            if place - 1 in drop:
                continue
        out.append(raw)
    return b"\n".join(out)


def count_deleted(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """`doc_id, text_hash, n_lines, n_removed, kept_sha256` (of the text that is left), one row per document."""
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("text_hash", pa.int64()),
            ("n_lines", pa.int64()),
            ("n_removed", pa.int64()),
            ("kept_sha256", pa.string()),
        ]
    )

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for part in batches:
            out: dict[str, list] = {name: [] for name in schema.names}
            rows = zip(*(part.column(c).to_pylist() for c in ("doc_id", "text_hash", "text", "gone")), strict=True)
            for doc_id, text_hash, text, gone in rows:
                text = text or b""
                out["doc_id"].append(doc_id), out["text_hash"].append(text_hash)
                out["n_lines"].append(len(held_lines(text))), out["n_removed"].append(len(gone or []))
                out["kept_sha256"].append(hashlib.sha256(_without(text, gone) if gone else text).hexdigest())
            yield pa.RecordBatch.from_pydict(out, schema=schema)

    texts, gone = as_bytes(docs), deleted_lines(docs, min_words)
    joined = texts.join(gone, same(texts, gone, "doc_id", "text_hash"), "left").select(
        texts["doc_id"], texts["text_hash"], "text", "gone"
    )
    return in_batches(
        joined, digest, "doc_id long, text_hash long, n_lines long, n_removed long, kept_sha256 string"
    )


def remove_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The documents, all columns, without the blocks that an earlier document holds."""
    return replaced_text(docs, deleted_lines(docs, min_words), "gone", _without)
