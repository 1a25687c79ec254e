"""Language-model scores by logistic context mixing over the bytes of words.

A text is its words in order, each with a closing blank, and one end mark. The bits of every byte are
predicted, highest first, by several predictors. Each looks at another context (the last byte, the last
two, three, five, all of the word so far), hashed into a table of zeros and ones seen there. With
`borders`, the last bytes are those of the text, over blanks into the words before; the text begins after
blanks. Without, contexts end at the start of the word and a text is scored as a bag of words.
A mixer adds their log odds with weights that are chosen by two gates: how often the longer contexts
were seen, and the bits of this byte so far. A last map refines the mixed probability from what
followed such probabilities before. Bits add up to the log10 probability of a word where it stands.

Words that were seen are also predicted as wholes: from the words of one kind of document (by default
one language; kind 0 is all documents), with what a discount takes from their counts left to all
documents, and then to the bits. A text's probability is the mean over kinds, weighted by how many
learning words each has; its own kind is no input.

A byte's contexts are the five bytes before it and the word so far. So a byte with a blank among the four before it
depends on those five bytes only (a border: the six bytes are a gram), and all further bytes of a word on the word
only (its body: a blank, the word and the closing blank, of which the first five are given):

1. Words of all documents are counted, those of learning documents apart, and the grams of learning documents with
   them. This also gives the base.
2. Each partition of grams and bodies (of words without `borders`) adds up its tables; sums over partitions are the
   tables of the corpus.
3. Grams and bodies are dealt by their hash into parts of about `WORDS_A_PART`. Each part goes through them once in
   their order, online: predict, compare, correct weights and map. An occurrence is predicted from the others,
   its own count left out. The weights of all parts are averaged by the bits they saw, the counts of the map
   are added, in the order of parts: neither depends on how Spark partitions the work.
4. Every body is scored once. Borders are scored where the texts are, each different gram once as long as a task
   remembers it. Frequent words are broadcast to the texts; the others join the scored words by a shuffle, each
   occurrence with the score of its border. Sums of frequent words pass it under keys of their own.

What is broadcast is bounded: tables of `2**SIZES[k]` entries, and frequent words of `FREQUENT_BYTES` at most
with `FREQUENT_NUMBERS` numbers in all. Every kind has its own counts; the names of the kinds and two totals of
each reach the driver, and a word carries a number for each, so kinds are meant to be labels like languages.
Null texts are empty; an empty text is one end mark. Documents without an id are learned from.
Repeated rows count each. Without documents to learn from, the base is zero and every bit costs one bit.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewrank.llm.common import RangeHashes, as_bytes, in_batches, kept_table, mixed

# Bytes looked back at by each predictor (0: the whole word so far), and entries of its table as a power of two.
CONTEXTS = (1, 2, 3, 5, 0)
SIZES = (16, 18, 19, 20, 20)
OFFSETS = tuple(int(x) for x in np.concatenate([[0], np.cumsum([2**s for s in SIZES])]))
BLOCK = 4096  # entries of a table that travel together
FIRST_GATES, SECOND_GATES = 6 * 5 * 8, 256
MAP_STEPS, MAP_REACH = 33, 8.0
RATE = 0.5
LITTLE = 0.05  # what a count has before anything is seen
MAP_WEIGHT = 30.0  # how many bits the unlearned map counts for
BYTES_AT_ONCE = 8192
WORDS_HELD = 300_000
WORDS_A_PART = 50_000
PARTS_AT_ONCE = 64  # states of parts that one task adds up
FREQUENT_NUMBERS, FREQUENT_BYTES = 1_400_000, 64
END = b""  # the end mark as a word; no word is empty
GIVEN = max(CONTEXTS)  # bytes before a predicted one that its contexts reach
BLANK, NEWLINE = 32, 10
GRAMS_HELD = 2_000_000
BORDER = GIVEN - 1  # bytes of a token at its border at most
SLOTS = 21  # grams, and borders, that a task remembers at most, as a power of two
NO_NUMBER = 0x2020202020202020  # no gram, being of six bytes, and no border, whose token would begin with a blank
LEAD = 11  # stands for a blank before a text; no other byte is this once all blanks are plain ones
PLAIN = bytes(BLANK if x in b"\t\n\v\f\r" else x for x in bytes(range(256)).lower())
TEXT_BYTES_AT_ONCE = 1_000_000
LOWEST = -280.0  # beneath this power of ten, probabilities are left to the bits alone

DISCOUNT = 0.75


class _Tokens:
    """The tokens of some texts: words in order, and an end mark after those of each text.

    `stream` has each text behind as many blanks as are given, with one blank behind a word and a newline for
    the end mark. A token begins there at `first` and has `sizes` bytes, its closing blank with it.
    """

    def __init__(self, texts: list[bytes | None]):
        start = bytes([LEAD]) * GIVEN
        spelled = (b" \n" + start).join([(text or b"").translate(PLAIN) for text in texts])
        spelled = np.frombuffer(start + spelled + b" \n", dtype=np.uint8)
        kept = spelled != BLANK
        kept[1:] |= kept[:-1] & (spelled[:-1] != LEAD)  # of blanks in a row the first; none before a text
        self.stream = spelled[kept]
        self.stream[self.stream == LEAD] = BLANK

        blank = self.stream == BLANK
        edges = np.flatnonzero(np.diff(blank, append=True)) + 1
        self.first = edges[0::2]
        is_end = self.stream[self.first] == NEWLINE
        lengths = np.where(is_end, 0, edges[1::2] - self.first)
        self.sizes = lengths + 1
        ends = np.zeros(len(lengths) + 1, dtype=np.int32)
        np.cumsum(lengths, out=ends[1:])
        letters = self.stream[~(blank | (self.stream == NEWLINE))]
        self.words = pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(ends), pa.py_buffer(letters)])
        self.n_tokens = np.diff(np.flatnonzero(is_end), prepend=-1)
        self.text = np.repeat(np.arange(len(texts)), self.n_tokens)

    def borders(self) -> np.ndarray:
        """The border of each token as one number: the four bytes before the blank before it, and its first four.

        Of a shorter token with its closing blank, the last bytes are zero.
        """
        spelled = np.concatenate([self.stream, np.zeros(BORDER, dtype=np.uint8)])
        four = np.ndarray(len(self.stream), ">u4", spelled, 0, (1,))  # any four bytes in a row
        own = four[self.first].astype(np.uint64)
        cut = (BORDER - np.minimum(self.sizes, BORDER)).astype(np.uint64) * np.uint64(8)
        return four[self.first - GIVEN].astype(np.uint64) << np.uint64(32) | own >> cut << cut


def _some_texts(part: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, _Tokens]]:
    """A batch in slices of bounded length (a longer text comes alone), and the tokens of their texts."""
    texts = part.column("text").to_pylist()
    for low, high in _cuts([len(text or b"") for text in texts], TEXT_BYTES_AT_ONCE):
        yield part.slice(low, high - low), _Tokens(texts[low:high])


def _cuts(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Neighbours that have `most` together, or one that has more."""
    ends = np.cumsum(sizes)
    low = 0
    while low < len(sizes):
        before = ends[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield low, high
        low = high


def _grams(borders: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every predicted byte of borders behind the five before it, as one number; and how many a border has."""
    before, own = borders >> np.uint64(32), borders & np.uint64(0xFFFFFFFF)
    spelled = own.astype(">u4").view(np.uint8).reshape(-1, BORDER)
    closing = (spelled == BLANK) | (spelled == NEWLINE)
    sizes = np.where(closing.any(axis=1), np.argmax(closing, axis=1) + 1, BORDER)
    grams = np.empty((len(borders), BORDER), dtype=np.uint64)
    for k in range(BORDER):
        up = np.uint64(8 * k)
        grams[:, k] = before << up + np.uint64(16) | np.uint64(BLANK) << up + np.uint64(8) | own >> np.uint64(24) - up
    grams &= np.uint64(2 ** (8 * GIVEN + 8) - 1)
    return grams[np.arange(BORDER) < sizes[:, None]], sizes


def _gram_bytes(grams: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(grams.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 7 - GIVEN :]).reshape(-1)


def _added(numbers: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different numbers, and the sum of their times."""
    different, inverse = np.unique(numbers, return_inverse=True)
    return different, np.bincount(inverse, weights=times, minlength=len(different)).astype(np.int64)


class _Held:
    """Counts of words by kind."""

    def __init__(self):
        self.parts: list[tuple[pa.Array, np.ndarray, np.ndarray]] = []

    def __len__(self) -> int:
        return sum(len(words) for words, _, _ in self.parts)

    def add(self, words: pa.Array, kinds: np.ndarray, times: np.ndarray | None = None) -> None:
        encoded = words.dictionary_encode()
        different = np.int64(max(len(encoded.dictionary), 1))
        both = (kinds + np.int64(1)) * different + encoded.indices.to_numpy()  # kinds begin at -1
        both, times = np.unique(both, return_counts=True) if times is None else _added(both, times)
        self.parts.append((encoded.dictionary.take(pa.array(both % different)), both // different - 1, times))

    def merge(self) -> None:
        words, kinds, times = zip(*self.parts, strict=True)
        self.parts.clear()
        self.add(pa.concat_arrays(words), np.concatenate(kinds), np.concatenate(times))

    def batches(self, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        for words, kinds, times in self.parts:
            whole = pa.RecordBatch.from_arrays([words, pa.array(kinds.astype(np.int32)), pa.array(times)], schema=schema)
            yield from (whole.slice(at, 50_000) for at in range(0, len(words), 50_000))
        self.parts.clear()


def _sum_words(borders: bool):
    def sum_words(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        """Words of the texts with their numbers, by kind of learning document (-1: not learned from).

        With `borders` also the grams of learning documents, which unlike words hold a blank.
        """
        schema = pa.schema([("word", pa.binary()), ("kind", pa.int32()), ("times", pa.int64())])
        counts = _Held()
        held: list[np.ndarray] = []  # borders
        grams, times = np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64)

        def flush():
            counts.merge()
            yield from counts.batches(schema)

        def spell_out():
            """Adds the held borders to the grams."""
            nonlocal grams, times
            every, each = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            for at in range(0, len(every), GRAMS_HELD // BORDER):
                some, sizes = _grams(every[at : at + GRAMS_HELD // BORDER])
                some, n = _added(some, np.repeat(each[at : at + GRAMS_HELD // BORDER], sizes))
                grams, times = _added(np.concatenate([grams, some]), np.concatenate([times, n]))

        def flush_grams():
            nonlocal grams, times
            for at in range(0, len(grams), 50_000):
                some = grams[at : at + 50_000]
                ends = np.arange(len(some) + 1, dtype=np.int32) * (GIVEN + 1)
                buffers = [None, pa.py_buffer(ends), pa.py_buffer(_gram_bytes(some))]
                spelled = pa.Array.from_buffers(pa.binary(), len(some), buffers)
                columns = [spelled, pa.array(np.zeros(len(some), np.int32)), pa.array(times[at : at + 50_000])]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)
            grams, times = grams[:0], times[:0]

        for part in batches:
            for some, tokens in _some_texts(part):
                kinds = some.column("kind").to_numpy()[tokens.text]
                counts.add(tokens.words, kinds)
                if len(counts) > 4 * WORDS_HELD:
                    counts.merge()
                    if len(counts) > 2 * WORDS_HELD:
                        yield from counts.batches(schema)
                if borders:
                    held.append(tokens.borders()[kinds >= 0])
                    if sum(map(len, held)) > GRAMS_HELD:
                        spell_out()
                        if len(grams) > GRAMS_HELD // 2:
                            yield from flush_grams()
        if counts.parts:
            yield from flush()
        if held:
            spell_out()
        yield from flush_grams()

    return sum_words


class _Bytes:
    """The bytes of some words, one array entry each, with the hashes of their contexts.

    `given`: how many bytes come before the first that is predicted. Words are then spelled out already,
    and the word so far begins after the last blank among the given bytes.
    """

    def __init__(self, words: list[bytes] | pa.Array, given: int = 0):
        spelled = pa.array(words, pa.binary())
        if not given:
            spelled = pc.if_else(pc.equal(spelled, END), b"\n", pc.binary_join_element_wise(spelled, b" ", b""))
        ends = np.frombuffer(spelled.buffers()[1], dtype=np.int32)[spelled.offset : spelled.offset + len(spelled) + 1]
        letters = np.frombuffer(spelled.buffers()[2], dtype=np.uint8)[ends[0] : ends[-1]]
        self._lay_out(letters, np.diff(ends).astype(np.int64), given)

    @classmethod
    def of_grams(cls, grams: np.ndarray) -> _Bytes:
        spelled = cls.__new__(cls)
        spelled._lay_out(_gram_bytes(grams), np.full(len(grams), GIVEN + 1), GIVEN)
        return spelled

    def _lay_out(self, spelled: np.ndarray, lengths: np.ndarray, given: int) -> None:
        first = np.cumsum(lengths) - lengths
        predicted = lengths - given
        self.word = np.repeat(np.arange(len(lengths)), predicted)
        places = np.arange(len(self.word)) + (self.word + 1) * given
        self.byte = spelled[places]
        of_word = first
        if given:
            blanks = spelled[first[:, None] + np.arange(given - 1, -1, -1)] == BLANK
            of_word = first + given - np.argmax(blanks, axis=1)
        starts, of_word = first[self.word], of_word[self.word]
        ranges = RangeHashes(mixed(spelled.astype(np.uint64) + np.uint64(1)))
        self.contexts = []
        for k, back in enumerate(CONTEXTS):
            low = of_word if back == 0 else np.maximum(starts, places - back)
            reach = (places - low).astype(np.uint64)
            self.contexts.append(mixed(ranges.of(low, places) + reach * np.uint64(0x9E3779B1) + np.uint64(k)))

    def bits(self) -> Iterator[tuple[int, np.ndarray, np.ndarray, list[np.ndarray]]]:
        """Bit number, earlier bits of the byte, the bit and the place in each table, for all bytes."""
        before = np.ones(len(self.byte), dtype=np.uint64)
        for k in range(8):
            bit = (self.byte >> (7 - k)) & 1
            own = before * np.uint64(0x9E3779B97F4A7C15)
            places = []
            for j, context in enumerate(self.contexts):
                mark = (context ^ own) * np.uint64(0xD6E8FEB86659FD93)
                mark >>= np.uint64(64 - SIZES[j])
                mark += np.uint64(OFFSETS[j])
                places.append(mark.view(np.int64))
            yield k, before.view(np.int64), bit, places
            before = before * np.uint64(2) + bit


def _pieces(words: pa.Array, *numbers: np.ndarray) -> Iterator[tuple[pa.Array, list[np.ndarray]]]:
    """Words and numbers of them, some ten thousand bytes at a time."""
    ends = np.cumsum(pc.binary_length(words).to_numpy() + np.int64(1))
    low = 0
    while low < len(words):
        before = ends[low - 1] if low else 0
        high = min(int(np.searchsorted(ends, before + BYTES_AT_ONCE)) + 1, len(words))
        yield words.slice(low, high - low), [n[low:high] for n in numbers]
        low = high


def _add_tables(given: int):
    def add_tables(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        """This partition's tables, in blocks that hold anything."""
        tables = np.zeros((2, OFFSETS[-1]))
        for part in batches:
            for words, (learned,) in _pieces(part.column("word"), part.column("learned").to_numpy()):
                spelled = _Bytes(words, given)
                times = learned[spelled.word].astype(np.float64)
                for _, _, bit, places in spelled.bits():
                    side = bit.astype(np.int64) * OFFSETS[-1]
                    for place in places:
                        np.add.at(tables.reshape(-1), place + side, times)
        schema = pa.schema([("block", pa.int32()), ("counts", pa.binary())])
        for block in range(OFFSETS[-1] // BLOCK):
            own = tables[:, block * BLOCK : (block + 1) * BLOCK]
            if own.any():
                yield pa.RecordBatch.from_pydict({"block": [block], "counts": [own.tobytes()]}, schema=schema)

    return add_tables


def _add_blocks(rows: pd.DataFrame) -> pd.DataFrame:
    total = np.sum([np.frombuffer(c) for c in rows["counts"]], axis=0)
    return pd.DataFrame({"block": rows["block"].iloc[:1], "counts": [total.tobytes()]})


def _tables(words: DataFrame, given: int = 0) -> np.ndarray:
    """Zeros and ones seen per context, over all partitions: a fixed number of entries."""
    parts = in_batches(words, _add_tables(given), "block int, counts binary")
    summed = parts.groupBy("block").applyInPandas(_add_blocks, "block int, counts binary").toArrow()
    out = np.zeros((2, OFFSETS[-1]), order="F")  # zeros and ones of an entry lie side by side
    for block, counts in zip(summed.column("block").to_pylist(), summed.column("counts").to_pylist(), strict=True):
        out[:, block * BLOCK : (block + 1) * BLOCK] = np.frombuffer(counts).reshape(2, BLOCK)
    return out


class _Odds:
    """Log odds of all entries of the tables, and how often those of the two longest contexts were seen."""

    def __init__(self, tables: np.ndarray):
        zeros, ones = tables.astype(np.float32)
        self.odds = np.log((ones + np.float32(LITTLE)) / (zeros + np.float32(LITTLE)))
        zeros, ones = zeros[OFFSETS[-3] :], ones[OFFSETS[-3] :]
        self.levels = np.minimum(np.log2(zeros + ones + 1).astype(np.uint8), 5)


class Mixer:
    """Weights by gate, and the map that refines what they give."""

    def __init__(self):
        inputs = len(CONTEXTS) + 1
        self.first = np.full((FIRST_GATES, inputs), 0.1)
        self.second = np.full((SECOND_GATES, inputs), 0.1)
        steps = np.linspace(-MAP_REACH, MAP_REACH, MAP_STEPS)
        start = 1 / (1 + np.exp(-steps))
        self.start = MAP_WEIGHT * np.stack([1 - start, start])  # zeros and ones, alike for all contexts
        self.map = np.zeros((2, SECOND_GATES * MAP_STEPS))
        self.bits = 0.0
        self.settled: tuple[np.ndarray, np.ndarray] | None = None

    def state(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return self.first, self.second, self.map

    @classmethod
    def of(cls, state: tuple[np.ndarray, np.ndarray, np.ndarray]) -> Mixer:
        mixer = cls()
        mixer.first, mixer.second, mixer.map = state
        return mixer

    def inputs(self, tables, bit_number, before, places, known=None):
        """Log odds of each predictor, and the first gate. `known`: the bits, to leave an occurrence out."""
        odds = np.empty((len(CONTEXTS) + 1, len(before)), dtype=np.float64)
        pairs = np.ascontiguousarray(tables.T).view(np.complex128)[:, 0]  # both counts in one read
        levels = []
        for j, place in enumerate(places):
            found = pairs.take(place)
            zeros, ones = found.real, found.imag
            if known is not None:
                zeros = np.maximum(zeros - (known == 0), 0)
                ones = np.maximum(ones - (known == 1), 0)
            # Single precision is enough from here on: counts stay exact, only their logarithms are rounded.
            zeros, ones = zeros.astype(np.float32), ones.astype(np.float32)
            odds[j] = np.log((ones + np.float32(LITTLE)) / (zeros + np.float32(LITTLE)))
            if j >= len(CONTEXTS) - 2:
                levels.append(np.minimum(np.log2(zeros + ones + 1).astype(np.int64), 5 if j + 1 == len(CONTEXTS) else 4))
        odds[-1] = 0.3
        return odds, (levels[1] * 5 + levels[0]) * 8 + bit_number

    def looked_up(self, seen: _Odds, bit_number, places):
        """The same for unknown bits, from logarithms taken before."""
        odds = np.empty((len(CONTEXTS) + 1, len(places[0])), dtype=np.float64)
        for j, place in enumerate(places):
            odds[j] = seen.odds.take(place)
        odds[-1] = 0.3
        shorter, longer = (seen.levels[place - OFFSETS[-3]].astype(np.int64) for place in places[-2:])
        return odds, (longer * 5 + np.minimum(shorter, 4)) * 8 + bit_number

    def mix(self, odds, gate, before):
        return np.einsum("ij,ji->j", odds, self.first[gate] + self.second[before])

    def predict(self, odds, gate, before):
        """`refine` of `mix`, with sums of weights and quotients of the map that are taken once."""
        if self.settled is None:
            zeros, ones = self.map.reshape(2, SECOND_GATES, MAP_STEPS) + self.start[:, None, :]
            weights = (self.first[:, None] + self.second).reshape(FIRST_GATES * SECOND_GATES, -1)
            self.settled = weights, (ones / (zeros + ones)).reshape(-1)
        weights, mapped = self.settled
        mixed_odds = np.einsum("ij,ji->j", odds, weights.take(gate * SECOND_GATES + before, axis=0))
        place, _, share = self._map_places(mixed_odds, before)
        low = mapped.take(place)
        plain = 1 / (1 + np.exp(-np.clip(mixed_odds, -30, 30)))
        return np.clip((plain + low + share * (mapped.take(place + 1) - low)) / 2, 1e-7, 1 - 1e-7)

    def _map_places(self, mixed_odds, before):
        at = (np.clip(mixed_odds, -MAP_REACH, MAP_REACH) + MAP_REACH) * (MAP_STEPS - 1) / (2 * MAP_REACH)
        low = np.minimum(at.astype(np.int64), MAP_STEPS - 2)
        return before * MAP_STEPS + low, low, at - low

    def refine(self, mixed_odds, before):
        """Probability of a one: half the mixer's, half the map's between its two nearest steps."""
        place, low, share = self._map_places(mixed_odds, before)
        mapped = 0.0
        for step, part in ((0, 1 - share), (1, share)):
            zeros = self.map[0, place + step] + self.start[0, low + step]
            ones = self.map[1, place + step] + self.start[1, low + step]
            mapped = mapped + part * ones / (zeros + ones)
        plain = 1 / (1 + np.exp(-np.clip(mixed_odds, -30, 30)))
        return np.clip((plain + mapped) / 2, 1e-7, 1 - 1e-7)

    def learn(self, odds, gate, before, mixed_odds, bit, times):
        self.settled = None
        place, _, share = self._map_places(mixed_odds, before)
        place = place + bit.astype(np.int64) * self.map.shape[1]
        np.add.at(self.map.reshape(-1), place, (1 - share) * times)
        np.add.at(self.map.reshape(-1), place + 1, share * times)
        error = (bit - 1 / (1 + np.exp(-np.clip(mixed_odds, -30, 30)))) * times
        for weights, own in ((self.first, gate), (self.second, before)):
            size = len(weights)
            total = np.bincount(own, weights=times, minlength=size) + 1.0
            for j in range(weights.shape[1]):
                weights[:, j] += RATE * np.bincount(own, weights=error * odds[j], minlength=size) / total
        self.bits += float(times.sum())


def _train(tables, given: int):
    def train(words: pa.Table) -> pa.Table:
        mixer = Mixer()
        rows = words.sort_by("word").combine_chunks()
        for some, (learned,) in _pieces(rows.column("word").chunk(0), rows.column("learned").to_numpy()):
            spelled = _Bytes(some, given)
            times = learned[spelled.word].astype(np.float64)
            for k, before, bit, places in spelled.bits():
                odds, gate = mixer.inputs(tables.value, k, before, places, bit)
                mixer.learn(odds, gate, before, mixer.mix(odds, gate, before), bit, times)
        numbers = [np.array([mixer.bits]), *(x.ravel() * mixer.bits for x in (mixer.first, mixer.second)), mixer.map.ravel()]
        return pa.table({"part": words.column("part")[:1], "state": [np.concatenate(numbers).tobytes()]}, schema=_STATE)

    return train


def _add_states(rows: pa.Table) -> pa.Table:
    """The sum of some parts' states, in the order of the parts."""
    rows = rows.sort_by("part")
    total = sum(np.frombuffer(state) for state in rows.column("state").to_pylist())
    return pa.table({"part": rows.column("above")[:1], "state": [total.tobytes()]}, schema=_STATE)


_STATE = pa.schema([("part", pa.int64()), ("state", pa.binary())])


def _mixer(words: DataFrame, different: int, tables, given: int = 0) -> Mixer:
    """Weights averaged over parts of the words; some 150 KB each, added in a tree of tasks."""
    parts = max(1, -(-different // WORDS_A_PART))
    dealt = words.withColumn("part", F.pmod(F.xxhash64("word"), F.lit(parts)))
    states = dealt.groupBy("part").applyInArrow(_train(tables, given), "part long, state binary")
    while parts > 1:
        above = states.withColumn("above", F.expr(f"part div {PARTS_AT_ONCE}"))
        states = above.groupBy("above").applyInArrow(_add_states, "part long, state binary")
        parts = -(-parts // PARTS_AT_ONCE)
    mixer = Mixer()
    if (row := states.first()) is not None:
        total = np.frombuffer(bytes(row["state"]))
        cut = np.cumsum([1, mixer.first.size, mixer.second.size])
        mixer.first = (total[cut[0] : cut[1]] / total[0]).reshape(mixer.first.shape)
        mixer.second = (total[cut[1] : cut[2]] / total[0]).reshape(mixer.second.shape)
        mixer.map = total[cut[2] :].reshape(mixer.map.shape).copy()
    return mixer


def _logs(spelled: _Bytes, seen: _Odds, mixer: Mixer, words: int) -> np.ndarray:
    """Log10 probability of the predicted bytes of each word."""
    of_bytes = np.ones(len(spelled.byte))
    for k, before, bit, places in spelled.bits():
        odds, gate = mixer.looked_up(seen, k, places)
        one = mixer.predict(odds, gate, before)
        of_bytes *= np.where(bit == 1, one, 1 - one)
    return np.bincount(spelled.word, weights=np.log10(of_bytes), minlength=words)


def _score_words(tables, state, given: int = 0):
    """The batches with a column more, of words or of their bodies; a word that is all border has none."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        mixer, seen = Mixer.of(state.value), _Odds(tables.value)
        for part in batches:
            words = part.column("word")
            scores = np.zeros(len(words))
            own = np.arange(len(words))
            if given:
                own = np.flatnonzero(pc.binary_length(words).to_numpy() + 1 >= given)
                words = pc.binary_join_element_wise(b" ", words.take(pa.array(own)), b" ", b"")
            for some, (places,) in _pieces(words, own):
                scores[places] = _logs(_Bytes(some, given), seen, mixer, len(some))
            names = [*part.schema.names, "bits_score"]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(scores)], names=names)

    return score


class _Remembered:
    """What was computed for numbers, in a table of bounded size where a later number may replace another."""

    def __init__(self, compute: Callable[[np.ndarray], np.ndarray]):
        self.compute = compute
        self.numbers = np.full(2**SLOTS, NO_NUMBER, dtype=np.uint64)
        self.logs = np.zeros(2**SLOTS)

    def _slots(self, numbers: np.ndarray) -> np.ndarray:
        return (numbers * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - SLOTS)).astype(np.int64)

    def of(self, numbers: np.ndarray) -> np.ndarray:
        slots = self._slots(numbers)
        out = self.logs[slots]
        new = np.flatnonzero(self.numbers[slots] != numbers)
        if len(new):
            own, inverse = np.unique(numbers[new], return_inverse=True)
            logs = self.compute(own)
            out[new] = logs[inverse]
            slots = self._slots(own)
            self.numbers[slots], self.logs[slots] = own, logs
        return out


class _Borders:
    """Log10 probabilities of borders, the sums over their grams; both are remembered."""

    def __init__(self, tables, state):
        self.mixer, self.seen = Mixer.of(state.value), _Odds(tables.value)
        self.grams = _Remembered(self._of_grams)
        self.borders = _Remembered(self._of_borders)

    def _of_grams(self, grams: np.ndarray) -> np.ndarray:
        logs = np.empty(len(grams))
        for at in range(0, len(grams), BYTES_AT_ONCE):
            some = grams[at : at + BYTES_AT_ONCE]
            logs[at : at + len(some)] = _logs(_Bytes.of_grams(some), self.seen, self.mixer, len(some))
        return logs

    def _of_borders(self, borders: np.ndarray) -> np.ndarray:
        grams, sizes = _grams(borders)
        return np.add.reduceat(self.grams.of(grams), np.cumsum(sizes) - sizes)

    def of_tokens(self, tokens: _Tokens) -> np.ndarray:
        return self.borders.of(tokens.borders())


_PARTS = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("text_hash", pa.int64()),
        ("held_out", pa.bool_()),
        ("word", pa.binary()),
        ("border", pa.float64()),
        ("sums", pa.list_(pa.float64())),  # of a text: rows, tokens and bytes as well
    ]
)
_PARTS_SCHEMA = "doc_id long, text_hash long, held_out boolean, word binary, border double, sums array<double>"
OF_ROWS = 3  # sums of a text before those of its words


def _split_texts(frequent, left: list[float], tables=None, state=None):
    """A row for each occurrence of a word that is not frequent, and one for each text with the sums over those that are.

    With `tables`, words are scored behind the words before them. `left`: what each kind leaves to the bits.
    """

    def split(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        places: dict[bytes, int]
        numbers: np.ndarray
        places, numbers = frequent.value
        borders = None if tables is None else _Borders(tables, state)
        for part in batches:
            for some, tokens in _some_texts(part):
                scores = np.zeros(len(tokens.words)) if borders is None else borders.of_tokens(tokens)
                words = tokens.words.dictionary_encode()
                spelled = words.dictionary.to_numpy(zero_copy_only=False)  # far faster than to_pylist
                at = np.fromiter(map(places.get, spelled, repeat(-1)), np.int64, len(spelled))
                at = at[words.indices.to_numpy()]
                often, rest = np.flatnonzero(at >= 0), np.flatnonzero(at < 0)
                own = numbers.take(at[often], axis=0)
                bits = own[:, 1] + scores[often]
                power = 10 ** np.maximum(bits, LOWEST)
                columns = [own[:, 2] > 0, own[:, 0], *(np.log10(own[:, k + 2] + rate * power) for k, rate in enumerate(left))]
                if len(low := np.flatnonzero(bits < LOWEST)):
                    for logs in columns[2:]:
                        logs[low] = bits[low] + math.log10(DISCOUNT)
                n_texts = len(tokens.n_tokens)
                text = tokens.text[often]
                sums = [np.bincount(text, weights=x, minlength=n_texts) for x in columns]
                n_bytes = np.bincount(tokens.text, weights=tokens.sizes)

                named = [some.column(c) for c in ("doc_id", "text_hash", "held_out")]
                of_text = pa.array(tokens.text[rest])
                rows = [tokens.words.take(pa.array(rest)), pa.array(scores[rest]), pa.nulls(len(rest), _PARTS.field("sums").type)]
                yield pa.RecordBatch.from_arrays([*(c.take(of_text) for c in named), *rows], schema=_PARTS)
                # Keys that no word has, since they begin with a blank.
                ids = zip(named[0].to_pylist(), named[1].to_pylist(), strict=True)
                keys = pa.array([b" %d %d" % (doc_id or 0, text_hash) for doc_id, text_hash in ids], pa.binary())
                each = np.stack([np.ones(n_texts), tokens.n_tokens, n_bytes, *sums], axis=1)
                ends = pa.array(np.arange(n_texts + 1, dtype=np.int32) * each.shape[1])
                rows = [keys, pa.array(np.zeros(n_texts)), pa.ListArray.from_arrays(ends, pa.array(each.reshape(-1)))]
                yield pa.RecordBatch.from_arrays([*named, *rows], schema=_PARTS)

    return split


def _kept_alone(df: DataFrame, name: str) -> DataFrame:
    """`kept_table`, and the shuffles behind it leave the disk at once, not when the driver collects its garbage."""
    key, conf = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", df.sparkSession.conf
    before = conf.get(key, None)
    conf.set(key, "true")
    try:
        return kept_table(df, name)
    finally:
        if before is None:
            conf.unset(key)
        else:
            conf.set(key, before)


def score_texts(
    docs: DataFrame, held_out: Column, kind: Column | None = None, borders: bool = False
) -> DataFrame:
    """`doc_id, text_hash, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte`, a row per document.

    Learns from documents where `held_out` is not true. `kind` names the kind of a learning document.
    With `borders`, contexts reach over the blank before a word, so the order of words matters. Scores are log10
    probabilities.
    """
    spark = docs.sparkSession
    kind = F.lit(None) if kind is None else kind
    held_out = F.coalesce(held_out, F.lit(False))
    told = docs.select(held_out.alias("held_out"), kind.cast("string").alias("kind")).filter("not held_out and kind is not null")
    kinds = sorted(row["kind"] for row in told.select("kind").distinct().collect())
    number = F.lit(0)
    if kinds:
        numbers_of = F.create_map(*(F.lit(x) for k, name in enumerate(kinds, 1) for x in (name, k)))
        number = F.coalesce(F.element_at(numbers_of, F.coalesce(kind.cast("string"), F.lit(kinds[0]))), F.lit(0))
        number = F.when(kind.isNull(), 0).otherwise(number)
    number = F.when(held_out, -1).otherwise(number)
    texts = as_bytes(docs, held_out.alias("held_out"), number.cast("int").alias("kind"))

    times = F.col("times")
    # Tasks have added up their words, so rows are dealt by word as they are: one shuffle for the sums by kind and over kinds.
    counted = in_batches(texts, _sum_words(borders), "word binary, kind int, times long").repartition("word")
    counted = counted.groupBy("word", "kind").agg(F.sum("times").alias("times"))
    own_kind = F.collect_list(F.when(F.col("kind") > 0, F.struct("kind", "times")))  # one for each kind at most
    summed_words = counted.groupBy("word").agg(
        F.sum("times").alias("seen"),
        F.sum(F.when(F.col("kind") >= 0, times).otherwise(0)).alias("learned"),
        F.map_from_entries(own_kind).alias("by_kind"),
    )
    counts = _kept_alone(summed_words, "words")
    is_gram = F.contains("word", F.lit(b" "))
    words = counts.filter(~is_gram)
    overall_totals = words.agg(
        F.coalesce(F.sum("seen"), F.lit(0)).alias("seen"),
        F.coalesce(F.sum("learned"), F.lit(0)).alias("tokens"),
        F.count_if(F.col("learned") > 0).alias("different"),
    ).first()
    tokens = [overall_totals["tokens"]] + [0] * len(kinds)
    different = [overall_totals["different"]] + [0] * len(kinds)
    by_kind = words.select(F.explode("by_kind").alias("kind", "times")).groupBy("kind")
    for row in by_kind.agg(F.sum("times").alias("tokens"), F.count(F.lit(1)).alias("different")).collect():
        tokens[row["kind"]], different[row["kind"]] = row["tokens"], row["different"]

    given, learned, learned_pieces = 0, words.filter("learned > 0").select("word", "learned"), different[0]
    if borders:
        given = GIVEN
        bodies = learned.filter(F.octet_length("word") + 1 >= given)
        bodies = bodies.select(F.concat(F.lit(b" "), "word", F.lit(b" ")).alias("word"), "learned")
        learned = bodies.union(counts.filter(is_gram).select("word", "learned"))
        learned_pieces = learned.count()
    tables = spark.sparkContext.broadcast(_tables(learned, given))
    state = spark.sparkContext.broadcast(_mixer(learned, learned_pieces, tables, given).state())
    schema = "word binary, seen long, learned long, by_kind map<int, long>, bits_score double"
    scored = kept_table(in_batches(words, _score_words(tables, state, given), schema), "scored-words")

    # A word's probability in one kind is its discounted share there and what the discount leaves for all documents; in
    # these again its share and what is left for the bits: with the bits' probability p, `share + left * p`.
    left = [DISCOUNT * d / t if t else 1.0 for d, t in zip(different, tokens, strict=True)]

    def own_share(times: Column, tokens: Column) -> Column:
        return F.when(tokens > 0, F.greatest(times - F.lit(DISCOUNT), F.lit(0.0)) / tokens).otherwise(0.0)

    numbers = [
        F.log10((F.col("learned") + 1) / F.lit(float(tokens[0] + different[0] + 1))),
        F.col("bits_score"),
        F.col("share"),
    ]
    by_word = F.array(*numbers)
    if kinds:
        each = F.array(*(F.struct(F.lit(k).alias("k"), F.lit(float(tokens[k])).alias("t"), F.lit(left[k]).alias("left"))
                         for k in range(1, len(kinds) + 1)))
        in_kind = F.transform(
            each,
            lambda x: own_share(F.coalesce(F.try_element_at("by_kind", x["k"]), F.lit(0)), x["t"]) + x["left"] * F.col("share"),
        )
        by_word = F.concat(by_word, in_kind)
    width = len(numbers) + len(kinds)
    scored = scored.withColumn("share", own_share(F.col("learned"), F.lit(float(tokens[0]))))
    scored = scored.select("word", "seen", by_word.alias("numbers"))
    left = [left[0], *(x * left[0] for x in left[1:])]

    share = FREQUENT_NUMBERS // width  # at most this many words are seen so often
    often = scored.filter((F.col("seen") * share >= overall_totals["seen"]) & (F.octet_length("word") <= FREQUENT_BYTES))
    table = often.select("word", "numbers").toArrow()
    places = {word: place for place, word in enumerate(table.column("word").to_pylist())}
    matrix = np.array(table.column("numbers").to_pylist(), dtype=np.float64).reshape(len(places), width)
    frequent = spark.sparkContext.broadcast((places, matrix))
    of_borders = (tables, state) if borders else ()
    parts = in_batches(texts, _split_texts(frequent, left, *of_borders), _PARTS_SCHEMA)

    # A hash table of the words of a partition: each word is there once, and the far more rows of texts need no sort.
    numbered = scored.select("word", "numbers").hint("shuffle_hash")
    joined = parts.join(numbered, "word", "left").withColumn("bits", F.col("border") + F.get("numbers", F.lit(1)))
    joined = joined.withColumn("p", F.pow(F.lit(10.0), F.greatest("bits", F.lit(LOWEST))))

    def log(k: int) -> Column:
        # Very long words of no count lie beneath what a double holds; the bits alone score them.
        whole = F.log10(F.get("numbers", F.lit(k + 2)) + F.lit(left[k]) * F.col("p"))
        return F.when(F.col("bits") < LOWEST, F.col("bits") + math.log10(DISCOUNT)).otherwise(whole)

    def total(i: int, of_rest: Column) -> Column:
        of_frequent = F.coalesce(F.get("sums", F.lit(OF_ROWS + i)), F.lit(0.0))
        return F.sum(of_frequent + F.when(F.col("numbers").isNull(), 0.0).otherwise(of_rest))

    rest = [(F.get("numbers", F.lit(2)) > 0).cast("double"), F.get("numbers", F.lit(0)), *map(log, range(len(left)))]
    summed = joined.groupBy("doc_id", "text_hash", "held_out").agg(
        *(F.sum(F.get("sums", F.lit(i))).cast("long").alias(c) for i, c in enumerate(("rows", "n_tokens", "n_bytes"))),
        F.array(*(total(i, x) for i, x in enumerate(rest))).alias("sums"),
    )
    # Repeated rows were added up together: each gets its share.
    each = summed.select(
        "*",
        F.transform("sums", lambda x: x / F.col("rows")).alias("own"),
        F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))).alias("row"),
    )
    weights = [1.0, *(float(t) for t in tokens[1:])]
    shares = [math.log10((w or 1.0) / max(1.0, sum(weights[1:]))) for w in weights]
    scores = F.array(*(F.get("own", F.lit(k + 2)) + F.lit(share) for k, share in enumerate(shares)))
    best = F.array_max("scores")
    mean = best + F.log10(F.aggregate("scores", F.lit(0.0), lambda a, x: a + F.pow(F.lit(10.0), x - best)))
    if len(kinds) == 0:
        mean = F.get("own", F.lit(2))
    named = each.withColumn("scores", scores).select(
        "doc_id",
        "text_hash",
        "held_out",
        F.expr("n_tokens div rows").alias("n_tokens"),
        F.round(F.get("own", F.lit(0))).cast("long").alias("n_known"),
        F.lit(tokens[0]).cast("long").alias("train_tokens"),
        F.get("own", F.lit(1)).alias("base_score"),
        mean.alias("score"),
        (F.col("n_bytes") / F.col("rows")).alias("n_bytes"),
    )
    return named.withColumn("bits_per_byte", -F.col("score") * math.log2(10) / F.col("n_bytes")).drop("n_bytes")
