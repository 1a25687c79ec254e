"""SentencePiece models on the tokenizers library: encoding to ids and decoding back.

The model file is read as the protobuf it is: pieces with scores and kinds, trainer and normaliser
settings. From it a tokenizer is rebuilt: the normaliser's character map, blanks to the word-start mark
and the mark before the text, a unigram model with its scores or a BPE model whose merges follow from
its scores, and byte fallback for characters without a piece. Batches are encoded by the library's
threads.

In vocabularies where no piece holds a mark after another character, segmentation never reaches over
the start of a word, so each different word of a batch is encoded once and texts are put together from
words; decoding goes the same way. With BPE, words without mark or blank are encoded and decoded `JOINED`
at a time, as the text that they make in a row. Others are taken whole. Either way `verify` holds the
tokenizer against the SentencePiece library, on each different stretch by itself; where they differ, that
library's ids are taken and the row says so.

Null texts give null ids, empty ones no ids. The ids depend on the text only, so repeated rows agree.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import chain, repeat
from operator import eq

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from viewrank.llm.common import as_bytes, in_batches

MARK = "▁"  # fixed value
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = range(1, 7)  # fixed values: kinds of pieces
UNIGRAM, BPE = 1, 2  # fixed values: kinds of models
JOINED = 256
# Stretches, and their characters, that a task remembers; when it is full, those that were looked up only once are
# forgotten, and if that is not enough, all.
REMEMBERED = 200_000
REMEMBERED_CHARACTERS = 8_000_000
BYTES_AT_ONCE = 2_000_000


@dataclass
class Piece:
    text: str = ""
    score: float = 0.0
    kind: int = NORMAL


@dataclass
class Model:
    pieces: list[Piece] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    characters: bytes = b""
    add_mark: bool = True
    squeeze: bool = True
    escape: bool = True


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Number and value of each field of a protobuf message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = number()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, number()
            continue
        size = number() if kind == 2 else {1: 8, 5: 4}[kind]
        yield tag >> 3, data[at : at + size]
        at += size


def read_model(data: bytes) -> Model:
    """The parts of a model file that encoding needs. Field numbers are those of the public format."""
    model = Model()
    for name, value in _fields(data):
        if name == 1:
            piece = Piece()
            for part, own in _fields(value):
                if part == 1:
                    piece.text = own.decode()
                elif part == 2:
                    piece.score = float(np.frombuffer(own, dtype="<f4")[0])
                elif part == 3:
                    piece.kind = own
            model.pieces.append(piece)
        elif name == 2:
            own = dict(_fields(value))
            model.kind = own.get(3, UNIGRAM)
            model.byte_fallback = bool(own.get(35, 0))
        elif name == 3:
            own = dict(_fields(value))
            model.characters = own.get(2, b"")
            model.add_mark, model.squeeze, model.escape = (bool(own.get(i, 1)) for i in (3, 4, 5))
    return model


def _merges(pieces: list[Piece]) -> list[tuple[str, str]]:
    """Pairs of pieces that make a piece, best score of the made piece first."""
    known = {p.text for p in pieces if p.kind in (NORMAL, USER, UNUSED)}
    found = []
    for rank, piece in enumerate(pieces):
        if piece.kind == NORMAL:
            for cut in range(1, len(piece.text)):
                left, right = piece.text[:cut], piece.text[cut:]
                if left in known and right in known:
                    found.append((-piece.score, rank, cut, left, right))
    return [(left, right) for *_, left, right in sorted(found)]


def build(data: bytes):
    """A tokenizers library tokenizer from the content of a model file; and whether words stand alone."""
    from tokenizers import Regex, Tokenizer, decoders, models, normalizers

    model = read_model(data)
    unknown = next((i for i, p in enumerate(model.pieces) if p.kind == UNKNOWN), 0)
    if model.kind == UNIGRAM:
        scores = [(p.text, p.score) for p in model.pieces]
        tokenizer = Tokenizer(models.Unigram(scores, unknown, model.byte_fallback))
    elif model.kind == BPE:
        vocabulary = {p.text: i for i, p in enumerate(model.pieces)}
        tokenizer = Tokenizer(
            models.BPE(
                vocab=vocabulary,
                merges=_merges(model.pieces),
                unk_token=model.pieces[unknown].text,
                fuse_unk=True,
                byte_fallback=model.byte_fallback,
            )
        )
    else:
        raise ValueError("only unigram and BPE models")
    steps = []
    if model.characters:
        steps.append(normalizers.Precompiled(model.characters))
    if model.squeeze:
        steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
    if model.add_mark:
        steps.append(normalizers.Prepend(MARK if model.escape else " "))
    if model.escape:
        steps.append(normalizers.Replace(" ", MARK))
    tokenizer.normalizer = normalizers.Sequence(steps)
    ends = [decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()]
    tokenizer.decoder = decoders.Sequence(ends + ([decoders.Strip(" ", 1, 0)] if model.add_mark else []))
    alone = model.add_mark and model.escape and not model.squeeze and not model.characters
    alone = alone and not any(MARK in p.text.lstrip(MARK) for p in model.pieces)
    # Each stretch then begins with a piece, so runs of bytes end with it in decoding as well.
    alone = alone and any(p.text == MARK and p.kind == NORMAL for p in model.pieces)
    return tokenizer, alone


def _stretches(text: str) -> list[str]:
    """The text cut at the first blank of each run of blanks: encoding puts a mark in that blank's place.

    Blanks at the text's ends stay with its first and last stretch.
    """
    body = text.strip(" ")
    if not body:
        return [text]
    lead, low = len(text) - len(text.lstrip(" ")), 0
    out, at = [], text.find(" ", lead)
    end = lead + len(body)
    while 0 <= at < end:
        out.append(text[low:at])
        low = at + 1
        while text[at] == " ":
            at += 1
        at = text.find(" ", at)
    out.append(text[low:])
    return out


class Codec:
    """Encodes and decodes batches of texts in one task.

    What is known of stretches lies in flat tables: the ids of all of them in a row, where each one's begin
    and how many there are, whether both libraries agree on them, and what they decode to.
    """

    def __init__(self, data: bytes, verify: bool):
        import sentencepiece

        self.tokenizer, self.alone = build(data)
        model = read_model(data)
        self.begins = np.array([p.text.startswith(MARK) for p in model.pieces])
        self.joins = self.alone and model.kind == BPE
        self.check = sentencepiece.SentencePieceProcessor(model_proto=data) if verify else None
        self._forget()

    def _forget(self) -> None:
        self.known = {"": 0}  # nothing to encode
        self.characters = 0
        self.flat, self.starts, self.sizes = np.empty(0, np.int32), np.zeros(1, np.int64), np.zeros(1, np.int64)
        self.same, self.returns, self.back = np.ones(1, bool), np.ones(1, bool), [""]
        self.used = np.zeros(1, np.int64)

    def _forget_rare(self) -> None:
        """Keeps what was looked up again, all the less often the longer ago."""
        places = np.flatnonzero(self.used > 1)
        places = np.concatenate([[0], places[places > 0]])
        names = list(self.known)  # in the order of their places
        kept = [names[p] for p in places]
        self.flat, _ = self.ids_of(places, np.zeros(1, np.int64))
        self.known, self.characters = dict(zip(kept, range(len(kept)), strict=True)), sum(map(len, kept))
        self.sizes, self.same, self.returns = self.sizes[places], self.same[places], self.returns[places]
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.back = [self.back[p] for p in places]
        self.used = self.used[places] // 2

    def _places(self, stretches: list[str]) -> np.ndarray:
        """The place of each of different stretches in the tables."""
        places, new = self._look(stretches)
        self.used[places[places >= 0]] += 1
        if self._full(new):
            self._forget_rare()
            places, new = self._look(stretches)
        if self._full(new):
            self._forget()
            places, new = self._look(stretches)
        self.characters += sum(map(len, new))
        joined = [s for s in new if " " not in s and MARK not in s] if self.joins else []
        if joined:
            self._learn(joined, True)
        if len(joined) < len(new):
            self._learn([s for s in new if s not in self.known], False)
        places[places < 0] = np.fromiter(map(self.known.__getitem__, new), np.int64, len(new))
        return places

    def _look(self, stretches: list[str]) -> tuple[np.ndarray, list[str]]:
        """The places of known stretches, -1 for the others, and these."""
        places = np.fromiter(map(self.known.get, stretches, repeat(-1)), np.int64, len(stretches))
        return places, [stretches[i] for i in np.flatnonzero(places < 0)]

    def _full(self, new: list[str]) -> bool:
        characters = self.characters + sum(map(len, new))
        return len(self.known) + len(new) > REMEMBERED or characters > REMEMBERED_CHARACTERS

    def _encode_each(self, stretches: list[str], joined: bool) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all stretches in a row, and how many each has."""
        if joined:
            texts = [" ".join(stretches[at : at + JOINED]) for at in range(0, len(stretches), JOINED)]
            ids, _ = _in_a_row([e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)])
            starts = np.flatnonzero(self.begins[ids])  # a mark begins each stretch, and is nowhere else
            if len(starts) == len(stretches) and starts[0] == 0:
                return ids, np.diff(starts, append=len(ids))
        return _in_a_row([e.ids for e in self.tokenizer.encode_batch_fast(stretches, add_special_tokens=False)])

    def _decode_each(self, ids: np.ndarray, sizes: np.ndarray, joined: bool) -> list[str]:
        bounds = np.concatenate([[0], np.cumsum(sizes)])

        def single(low: int, high: int) -> list[str]:
            return self.decode([ids[a:b].tolist() for a, b in zip(bounds[low:high], bounds[low + 1 : high + 1], strict=True)])

        if not joined:
            return single(0, len(sizes))
        cuts = [(low, min(low + JOINED, len(sizes))) for low in range(0, len(sizes), JOINED)]
        out = []
        for (low, high), text in zip(cuts, self.decode([ids[bounds[a] : bounds[b]].tolist() for a, b in cuts]), strict=True):
            parts = text.split(" ")
            out += parts if len(parts) == high - low else single(low, high)
        return out

    def _learn(self, stretches: list[str], joined: bool) -> None:
        ids, sizes = self._encode_each(stretches, joined)
        agreed = np.ones(len(sizes), bool)
        if self.check is not None:  # each stretch by itself
            theirs, their_sizes = _in_a_row(self.check.encode(stretches, num_threads=-1))
            agreed = _alike(ids, sizes, theirs, their_sizes)
            ids, sizes = theirs, their_sizes
        back = self._decode_each(ids, sizes, joined)
        first = len(self.flat)
        self.known.update(zip(stretches, range(len(self.back), len(self.back) + len(sizes)), strict=True))
        self.flat = np.concatenate([self.flat, ids])
        self.starts = np.concatenate([self.starts, first + np.cumsum(sizes) - sizes])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.same = np.concatenate([self.same, agreed])
        returns = np.fromiter(map(eq, stretches, back), bool, len(back))
        self.returns = np.concatenate([self.returns, returns])
        self.back += [own if same else other for own, other, same in zip(stretches, back, returns.tolist(), strict=True)]
        self.used = np.concatenate([self.used, np.ones(len(sizes), np.int64)])

    def _cut(self, texts: pa.Array) -> pa.ListArray:
        """The stretches of each text."""
        if not self.alone:
            return pa.ListArray.from_arrays(pa.array(np.arange(len(texts) + 1), pa.int32()), texts)
        # Without a blank beside another one or at an end, each blank is a cut.
        odd = pc.match_substring_regex(texts, "^ |  | $").to_numpy(zero_copy_only=False)
        if not odd.any():
            return pc.split_pattern(texts, " ")
        plain = pc.split_pattern(texts.filter(pa.array(~odd)), " ")
        other = pa.array([_stretches(t) for t in texts.filter(pa.array(odd)).to_pylist()], plain.type)
        order = np.argsort(np.concatenate([np.flatnonzero(~odd), np.flatnonzero(odd)]))
        return pa.concat_arrays([plain, other]).take(pa.array(order))

    def look_up(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The places of all stretches of all texts, and where those of each text begin and end."""
        lists = self._cut(texts.fill_null(""))
        found = lists.flatten().dictionary_encode()
        places = self._places(found.dictionary.to_pylist())[found.indices.to_numpy()]
        bounds = lists.offsets.to_numpy().astype(np.int64)
        return places, bounds - bounds[0]

    def ids_of(self, places: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and where those of each text begin and end."""
        sizes = self.sizes[places]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        ids = self.flat[np.repeat(self.starts[places] - ends[:-1], sizes) + np.arange(ends[-1])]
        return ids, ends[bounds]

    def agreed(self, places: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Whether both libraries agree on each text."""
        return _all_within(self.same[places], bounds)

    def returned(self, texts: pa.Array, places: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Whether each text's ids decode to the text: they do if each stretch's do, else the whole is compared."""
        returned = _all_within(self.returns[places], bounds)
        for i in np.flatnonzero(~returned):
            decoded = " ".join(self.back[p] for p in places[bounds[i] : bounds[i + 1]])
            returned[i] = decoded == (texts[i].as_py() or "")
        return returned

    def encode(self, texts: list[str | None]) -> tuple[list[list[int] | None], list[bool]]:
        """Ids of each text, and whether both libraries agree on it."""
        places, bounds = self.look_up(pa.array(texts, pa.string()))
        ids, ends = self.ids_of(places, bounds)
        cut = [None if t is None else ids[a:b].tolist() for t, a, b in zip(texts, ends, ends[1:], strict=False)]
        return cut, self.agreed(places, bounds).tolist()

    def decode(self, ids: list[list[int] | None]) -> list[str | None]:
        found = iter(self.tokenizer.decode_batch([own for own in ids if own is not None], skip_special_tokens=False))
        return [None if own is None else next(found) for own in ids]


def _in_a_row(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(chain.from_iterable(lists), np.int32, int(sizes.sum())), sizes


def _alike(ids: np.ndarray, sizes: np.ndarray, others: np.ndarray, other_sizes: np.ndarray) -> np.ndarray:
    """Whether two libraries gave each stretch the same ids."""
    ends, other_ends = np.cumsum(sizes), np.cumsum(other_sizes)
    if np.array_equal(sizes, other_sizes):
        return _all_within(ids == others, np.concatenate([[0], ends]))
    bounds = zip(ends - sizes, ends, other_ends - other_sizes, other_ends, strict=True)
    return np.array([np.array_equal(ids[a:b], others[c:d]) for a, b, c, d in bounds], bool)


def _all_within(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Whether all flags between each two neighbouring bounds are set."""
    unset = np.concatenate([[0], np.cumsum(~flags)])[bounds]
    return unset[1:] == unset[:-1]


def _some_at_once(part: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """A batch in slices of bounded length (a longer text comes alone), and their texts."""
    texts = part.column("text").cast(pa.string())
    ends = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy())
    at = 0
    while at < part.num_rows:
        before = ends[at - 1] if at else 0
        n = max(1, int(np.searchsorted(ends, before + BYTES_AT_ONCE, side="right")) - at)
        yield part.slice(at, n), texts.slice(at, n)
        at += n


def encode(docs: DataFrame, model: bytes, verify: bool = True) -> DataFrame:
    """`doc_id, text_hash, ids, agrees`, one row per document."""
    schema = pa.schema(
        [("doc_id", pa.int64()), ("text_hash", pa.int64()), ("ids", pa.list_(pa.int32())), ("agrees", pa.bool_())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        codec = Codec(model, verify)
        for part in batches:
            for some, texts in _some_at_once(part):
                found = codec.look_up(texts)
                ids, ends = codec.ids_of(*found)
                lists = pa.ListArray.from_arrays(
                    pa.array(ends, pa.int32()), pa.array(ids), mask=texts.is_null()
                )
                columns = [some.column("doc_id"), some.column("text_hash"), lists, pa.array(codec.agreed(*found))]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return in_batches(as_bytes(docs), run, "doc_id long, text_hash long, ids array<int>, agrees boolean")


def decode(encoded: DataFrame, model: bytes) -> DataFrame:
    """`doc_id, text_hash, text` from `doc_id, text_hash, ids`."""
    schema = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        codec = Codec(model, False)
        for part in batches:
            for at in range(0, part.num_rows, 200):
                some = part.slice(at, 200)
                texts = codec.decode(some.column("ids").to_pylist())
                columns = [some.column("doc_id"), some.column("text_hash"), pa.array(texts, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    wanted = encoded.select("doc_id", "text_hash", "ids")
    return in_batches(wanted, run, "doc_id long, text_hash long, text string")


def round_trips(docs: DataFrame, model: bytes) -> DataFrame:
    """`doc_id, n_tokens, ids_hash, agrees, round_trip`: what encoding each text and decoding it again gives.

    `ids_hash` is over the ids in order. Counts and flags of a null text are null. Texts are encoded and
    decoded in one task, so ids don't travel.
    """
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("n_tokens", pa.int64()),
            ("ids_hash", pa.int64()),
            ("agrees", pa.bool_()),
            ("round_trip", pa.bool_()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        import xxhash

        codec = Codec(model, True)
        for part in batches:
            for some, texts in _some_at_once(part):
                found = codec.look_up(texts)
                ids, ends = codec.ids_of(*found)
                null = texts.is_null().to_numpy(zero_copy_only=False)
                marks = [xxhash.xxh64_intdigest(ids[a:b]) - 2**63 for a, b in zip(ends, ends[1:], strict=False)]
                columns = [
                    some.column("doc_id"),
                    pa.array(np.diff(ends), pa.int64(), mask=null),
                    pa.array(np.array(marks, np.int64), pa.int64(), mask=null),
                    pa.array(codec.agreed(*found), mask=null),
                    pa.array(codec.returned(texts, *found), mask=null),
                ]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return in_batches(
        as_bytes(docs).select("doc_id", "text"),
        run,
        "doc_id long, n_tokens long, ids_hash long, agrees boolean, round_trip boolean",
    )
