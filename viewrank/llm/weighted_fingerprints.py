"""Document fingerprints by consistent weighted sampling.

The terms of a document are its words (`[^\\x20\\x09-\\x0D]+`, unchanged), each weighted by its
occurrences. Sample d draws for every term, from the term's hash alone, r and c from Gamma(2, 1) and b
from U(0, 1). A term of weight S gets t = floor(ln S / r + b) and a = c / exp(r (t - b + 1)); the sample is
the (term, t) with the smallest a. A gamma is drawn as a sum of two exponentials; that of r parts it into r b
and r (1 - b), which are independent, so that a = c u with a uniform u wherever S is 1. Two documents draw the same sample with the probability of their
generalised Jaccard similarity, sum of min(S, S') over sum of max(S, S'). A fingerprint holds SAMPLES samples
of 16 bits each as hexadecimal digits; `likeness` is the share of samples on which two agree.

Words stand for nothing but themselves, so reordered words keep their fingerprint. A null text is an
empty one; texts without words have the fingerprint of zeros and are like each other only.

`with_neighbours` compares each document with an edited form of itself and with the next one. Documents
are ordered by id, nulls last, and by text hash where ids repeat; rows equal in id and text are one document
and get the same result, one row each. After the last comes the first; a single document is its own next.
Texts are dealt once, by ranges of that order whose first documents (one per range, on the driver) are known
beforehand; the first document of a range also goes to the range before it, so no task sees more than its range
and one document. Each task reads its rows in order and holds one batch. Only the named columns are read.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewrank.llm.common import RangeHashes, in_batches, mixed

SAMPLES = 64
# Bytes whose words are cut out and terms whose draws are held at once: texts go in groups, long ones in parts.
BYTES_AT_ONCE = 1_000_000
TERMS_AT_ONCE = 4096
# Rows of one repeated document that are returned at once.
ROWS_AT_ONCE = 500
BLANK = re.compile(rb"[\x20\x09-\x0D]")

_DIGITS = 4  # of a sample
_BYTES = mixed(np.arange(1, 257, dtype=np.uint64))
_HALF = np.uint64(32)


def _unit(bits: np.ndarray, below: int) -> np.ndarray:
    """Numbers between 0 and 1 from the 24 bits that stand above the lowest `below`."""
    part = (bits >> np.uint64(below)).astype(np.uint32) & np.uint32(0xFFFFFF)
    return (part.astype(np.int32).astype(np.float32) + np.float32(0.5)) * np.float32(2.0**-24)


def _word_hashes(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of a text, and where each starts."""
    values = np.frombuffer(text, np.uint8)
    blank = np.ones(len(values) + 2, dtype=bool)
    blank[1:-1] = (values == 32) | ((values >= 9) & (values <= 13))
    edges = np.flatnonzero(blank[1:] != blank[:-1])
    starts, ends = edges[::2], edges[1::2]
    return mixed(RangeHashes(_BYTES[values]).of(starts, ends) + (ends - starts).astype(np.uint64)), starts


def _pieces(text: bytes) -> Iterator[bytes]:
    """A long text in pieces that end at a blank."""
    at = 0
    while at < len(text):
        blank = BLANK.search(text, at + BYTES_AT_ONCE)
        end = blank.start() if blank else len(text)
        yield text[at:end]
        at = end


def _weighted(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different words, ascending, and their occurrences."""
    words = np.sort(words)
    first = np.flatnonzero(np.concatenate(([True], words[1:] != words[:-1])))[: len(words)]
    return words[first], np.diff(np.append(first, len(words)))


def _words_of_each(texts: list[bytes]) -> Iterator[np.ndarray]:
    """The word hashes of each text; short texts are cut up together."""
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size + len(texts[end]) <= BYTES_AT_ONCE):
            size += len(texts[end]) + 1
            end += 1
        if end == at + 1:
            parts = [_word_hashes(piece)[0] for piece in _pieces(texts[at])]
            yield np.concatenate(parts) if parts else np.zeros(0, np.uint64)
        else:
            words, starts = _word_hashes(b" ".join(texts[at:end]))
            ends = np.cumsum([len(text) + 1 for text in texts[at:end]])
            yield from np.split(words, np.searchsorted(starts, ends[:-1]))
        at = end


class Sampler:
    """Fingerprints of texts as arrays of 16-bit samples."""

    def __init__(self, samples: int = SAMPLES):
        self.samples = samples
        numbers = np.arange(1, 2 * samples + 1, dtype=np.uint64).reshape(2, samples)
        self.seeds = mixed(numbers * np.uint64(0x9E3779B97F4A7C15))

    def _draws(self, words: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per weighted word and sample a, and 16 bits that stand for (word, t)."""
        low, high = (self._bits(words, seeds) for seeds in self.seeds)
        u = _unit(low, 40)
        c = -np.log(_unit(high, 40) * _unit(high, 16))
        marks = low.astype(np.uint16)
        a = c * u  # t is 0 for a weight of one
        heavy = np.flatnonzero(weights > 1)
        if len(heavy):
            rest, share = -np.log(u[heavy]), -np.log(_unit(low[heavy], 16))
            r = share + rest
            t = np.floor((np.log(weights[heavy]).astype(np.float32)[:, None] + share) / r)
            a[heavy] = c[heavy] * np.exp(share - r * (t + 1))
            marks[heavy] += (t * 40503).astype(np.uint64).astype(np.uint16)
        return a, marks

    @staticmethod
    def _bits(words: np.ndarray, seeds: np.ndarray) -> np.ndarray:
        """64 random bits per word and sample; hashes and seeds are well mixed already."""
        x = words[:, None] ^ seeds
        x *= np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> _HALF
        x *= np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> _HALF
        return x

    def of(self, texts: list[bytes]) -> np.ndarray:
        """A row of samples for each text. What texts share is drawn once per group of terms."""
        best = np.full((len(texts), self.samples), np.inf, dtype=np.float32)
        marks = np.zeros((len(texts), self.samples), dtype=np.uint16)
        held: list[tuple[int, np.ndarray, np.ndarray]] = []
        for number, words in enumerate(_words_of_each(texts)):
            words, weights = _weighted(words)
            for at in range(0, len(words), TERMS_AT_ONCE):
                held.append((number, words[at : at + TERMS_AT_ONCE], weights[at : at + TERMS_AT_ONCE]))
                if sum(len(part) for _, part, _ in held) >= TERMS_AT_ONCE:
                    self._draw(held, best, marks)
                    held = []
        if held:
            self._draw(held, best, marks)
        return marks

    def _draw(self, held: list, best: np.ndarray, marks: np.ndarray) -> None:
        words = np.concatenate([part for _, part, _ in held])
        weights = np.concatenate([part for _, _, part in held])
        terms = mixed(words + weights.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        _, first, places = np.unique(terms, return_index=True, return_inverse=True)
        a, found = self._draws(words[first], weights[first])
        samples, at = np.arange(self.samples), 0
        for number, part, _ in held:
            rows = places[at : at + len(part)]
            at += len(part)
            row = rows[a[rows].argmin(axis=0)]
            smaller = a[row, samples] < best[number]
            best[number] = np.where(smaller, a[row, samples], best[number])
            marks[number] = np.where(smaller, found[row, samples], marks[number])


def _hex(marks: np.ndarray) -> str:
    return marks.astype(">u2").tobytes().hex()


def likeness(left: Column, right: Column, samples: int = SAMPLES) -> Column:
    """Share of equal samples of two fingerprints: an estimate of the generalised Jaccard similarity."""
    starts = F.sequence(F.lit(1), F.lit(samples * _DIGITS), F.lit(_DIGITS))
    equal = F.filter(starts, lambda at: F.substr(left, at, F.lit(_DIGITS)) == F.substr(right, at, F.lit(_DIGITS)))
    return F.size(equal) / F.lit(float(samples))


def _rows(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.xxhash64(text).alias("text_hash"),
        text.cast("binary").alias("text"),
    )


def fingerprints(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """`doc_id, text_hash, fingerprint` of every document, without a shuffle."""
    schema = "doc_id bigint, text_hash bigint, fingerprint string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = Sampler(samples)
        for rows in batches:
            found = list(map(_hex, sampler.of(rows.column("text").to_pylist())))
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), rows.column("text_hash"), pa.array(found, pa.string())],
                names=["doc_id", "text_hash", "fingerprint"],
            )

    return in_batches(_rows(docs), run, schema)


# Documents in order, a range to a task


def _key(doc_id: int | None, text_hash: int) -> tuple[bool, int, int]:
    return doc_id is None, doc_id or 0, text_hash


def _range_starts(rows: DataFrame, ranges: int) -> list[tuple[bool, int, int]]:
    """The first document of each range, ascending: at most `ranges` of them.

    Any documents would do, so long as the first of all is among them.
    """
    order = [F.col("doc_id").asc_nulls_last(), F.col("text_hash").asc()]
    ids = rows.select("doc_id", "text_hash").repartitionByRange(ranges, *order)
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("first")
    starts = ids.groupBy(F.spark_partition_id()).agg(first).select("first.doc_id", "first.text_hash").collect()
    return sorted(_key(*row) for row in starts)


def _dealt(starts: list[tuple[bool, int, int]]):
    """Rows with the number of their range; the first document of a range once more for the range before it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            keys = list(map(_key, rows.column("doc_id").to_pylist(), rows.column("text_hash").to_pylist()))
            ranges = [bisect_right(starts, key) - 1 for key in keys]
            firsts = [n for n, key in enumerate(keys) if starts[ranges[n]] == key]
            taken = rows.take(pa.array([*range(len(keys)), *firsts], pa.int64()))
            numbers = [*ranges, *((ranges[n] - 1) % len(starts) for n in firsts)]
            follows = [False] * len(keys) + [True] * len(firsts)
            yield pa.RecordBatch.from_arrays(
                [*taken.columns, pa.array(numbers, pa.int32()), pa.array(follows, pa.bool_())],
                names=[*taken.schema.names, "range", "follows"],
            )

    return run


_COMPARED = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _edited(text: str, following: str) -> str:
    """The last quarter of the code points replaced by the first as many of the following text."""
    cut = len(text) // 4
    return text[: len(text) - cut] + following[:cut]


def _compared(samples: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = Sampler(samples)
        # Documents in order with the number of their rows; the last one waits for the next batch.
        waiting: list[tuple[tuple, bytes, int]] = []
        for rows in batches:
            for follows, doc_id, text_hash, text in zip(
                *(rows.column(c).to_pylist() for c in ("follows", "doc_id", "text_hash", "text")), strict=True
            ):
                document = follows, doc_id, text_hash
                if waiting and waiting[-1][0] == document:
                    waiting[-1] = document, text, waiting[-1][2] + 1
                elif not follows or not waiting[-1][0][0]:
                    waiting.append((document, text, 1))
            yield from _results(sampler, waiting)
            del waiting[:-1]

    return run


def _results(sampler: Sampler, documents: list[tuple[tuple, bytes, int]]) -> Iterator[pa.RecordBatch]:
    """Rows of all documents but the last."""
    texts = []
    for (_, text, _), (_, following, _) in pairwise(documents):
        texts += [text, _edited(text.decode(), following.decode()).encode()]
    marks = sampler.of([*texts, documents[-1][1]])
    own, edited = marks[0::2], marks[1::2]
    columns = {
        "doc_id": pa.array([document[1] for document, _, _ in documents[:-1]], pa.int64()),
        "n_chars": pa.array([len(text.decode()) for text in texts[0::2]], pa.int64()),
        "edited_sha256": pa.array([hashlib.sha256(text).hexdigest() for text in texts[1::2]], pa.string()),
        "fingerprint": pa.array(map(_hex, own[:-1]), pa.string()),
        "edited_fingerprint": pa.array(map(_hex, edited), pa.string()),
        "near_edited": pa.array((own[:-1] == edited).mean(axis=1), pa.float64()),
        "near_next": pa.array((own[:-1] == own[1:]).mean(axis=1), pa.float64()),
    }
    found = pa.RecordBatch.from_pydict(columns)
    once = [n for n, (_, _, times) in enumerate(documents[:-1]) if times == 1]
    yield found.take(pa.array(once, pa.int64()))
    for n, (_, _, times) in enumerate(documents[:-1]):
        for at in range(0, times if times > 1 else 0, ROWS_AT_ONCE):
            yield found.take(pa.array([n] * min(ROWS_AT_ONCE, times - at), pa.int64()))


def with_neighbours(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """Fingerprints of each document and of its edited text, and how near it is to that and to the next one."""
    rows = _rows(docs)
    starts = _range_starts(rows, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    if not starts:
        return docs.sparkSession.createDataFrame([], _COMPARED)
    dealt = in_batches(rows, _dealt(starts), "doc_id bigint, text_hash bigint, text binary, range int, follows boolean")
    in_order = dealt.repartitionById(len(starts), "range").sortWithinPartitions(
        F.col("follows"), F.col("doc_id").asc_nulls_last(), F.col("text_hash")
    )
    return in_batches(in_order, _compared(samples), _COMPARED)
