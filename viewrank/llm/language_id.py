"""Language identification by unigrams over pieces, summed over all segmentations.

Pieces are those of a fixed public vocabulary; each language has a probability for every piece. A
word's probability in a language is the sum over all ways to cut it into pieces, by a forward pass;
a text's is the product over its words. The language with the highest posterior is returned.

Piece probabilities are learned by expectation maximisation from the words of labelled documents:
how often a piece is expected in a word's segmentations, times how often the language has the word.
Words are counted first, so each different word is cut once per round. Counts per piece and language
are bounded by the vocabulary; they alone reach the driver and are broadcast.

Words are runs without white space, lower-cased, with a mark for the word start. Characters outside
the vocabulary count as one unknown piece each. A word of any length is
one word: where its sums could leave the range of doubles, their logarithms are carried from place to
place. Memory grows with the longest word.
A text that is null or has no letter is `und` with score 0; so is every text if there is nothing to
learn from. Null labels teach nothing; an empty label is a label. Equal posteriors go to the first label.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewrank.llm.common import as_bytes, in_batches, kept_table
from viewrank.llm.sentencepiece_codec import read_model

UNKNOWN_LANGUAGE = "und"  # fixed value
MARK = "▁"  # fixed value: the vocabulary's word start
ROUNDS = 1
FLOOR = 0.5  # what every piece counts before anything is seen, spread over the vocabulary's own shares
SCALE = 64.0  # keeps sums over segmentations near one; taken back in the logarithm
SAFE = 600.0  # what the logarithm of a sum may reach before it is carried instead of the sum
WORDS_HELD = 300_000
REMEMBERED = 1_000_000
AT_ONCE = 20_000
CHARACTER_BITS = 21  # fixed value: what a code point takes
# Places in the words of one lattice.
CELLS = 60_000


class Trie(NamedTuple):
    """Pieces as a tree of characters, in arrays, so that many words descend at once. The root is node 0."""

    edges: np.ndarray  # node and character in one number, ascending
    children: np.ndarray  # the node each edge leads to
    pieces: np.ndarray  # the piece that ends at a node, -1 for what only begins one

    def step(self, nodes: np.ndarray, characters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the nodes have an edge with their character, and the nodes these lead to."""
        asked = nodes << CHARACTER_BITS | characters
        at = np.minimum(np.searchsorted(self.edges, asked), len(self.edges) - 1)
        found = np.flatnonzero(self.edges[at] == asked)
        return found, self.children[at[found]]


class Lattice:
    """All pieces inside some words, as edges from place to place."""

    def __init__(self, trie: Trie, longest: int, words: list[str]):
        self.count = len(words)
        self.lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        self.size = int(self.lengths.max(initial=0)) + 1
        characters = np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4").astype(np.int64)
        owner = np.repeat(np.arange(self.count), self.lengths)
        place = np.arange(len(owner)) - np.repeat(np.cumsum(self.lengths) - self.lengths, self.lengths)
        left = self.lengths[owner] - place
        start, length, piece = [], [], []
        here, nodes = np.arange(len(owner)), np.zeros(len(owner), dtype=np.int64)
        for n in range(1, longest + 1):
            inside = left[here] >= n
            here, nodes = here[inside], nodes[inside]
            if not len(here):
                break
            found, nodes = trie.step(nodes, characters[here + n - 1])
            here = here[found]
            whole = np.flatnonzero(trie.pieces[nodes] >= 0)
            start.append(here[whole]), piece.append(trie.pieces[nodes[whole]])
            if n == 1:  # a character that is no piece counts as the unknown one, numbered behind the others
                unknown = np.ones(len(owner), dtype=bool)
                unknown[start[0]] = False
                other = np.flatnonzero(unknown)
                start[0] = np.concatenate([start[0], other])
                piece[0] = np.concatenate([piece[0], np.full(len(other), trie.pieces.max() + 1)])
            length.append(np.full(len(start[-1]), n))
        at, length, self.piece = (np.concatenate([np.zeros(0, dtype=np.int64), *x]) for x in (start, length, piece))
        self.word, self.start = owner[at], place[at]
        self.end = self.start + length

    def _by(self, key: np.ndarray) -> list[np.ndarray]:
        """Edges by a place, those of one word together."""
        order = np.argsort(key * self.count + self.word, kind="stable")
        cuts = np.searchsorted(key[order], np.arange(self.size + 1))
        return [order[cuts[k] : cuts[k + 1]] for k in range(self.size)]

    def forward(self, weight: np.ndarray) -> np.ndarray:
        """Sums over the ways to reach each place of each word. `weight`: pieces x languages."""
        sums = np.zeros((self.count * self.size, weight.shape[1]))
        sums[np.arange(self.count) * self.size] = 1
        for end, edges in enumerate(self._by(self.end)):
            if end and len(edges):
                word = self.word[edges]
                came = sums[word * self.size + self.start[edges]] * weight[self.piece[edges]]
                first = np.flatnonzero(np.diff(word, prepend=-1))
                sums[word[first] * self.size + end] = np.add.reduceat(came, first, axis=0)
        return sums.reshape(self.count, self.size, -1)

    def backward(self, weight: np.ndarray) -> np.ndarray:
        """Sums over the ways from each place of each word to its end."""
        sums = np.zeros((self.count * self.size, weight.shape[1]))
        sums[np.arange(self.count) * self.size + self.lengths] = 1
        groups = self._by(self.start)
        for start in range(self.size - 1, -1, -1):
            edges = groups[start]
            if len(edges):
                word = self.word[edges]
                came = sums[word * self.size + self.end[edges]] * weight[self.piece[edges]]
                first = np.flatnonzero(np.diff(word, prepend=-1))
                sums[word[first] * self.size + start] = np.add.reduceat(came, first, axis=0)
        return sums.reshape(self.count, self.size, -1)

    def plain(self, weight: np.ndarray) -> bool:
        """Whether no sum over the words' segmentations can leave the range of doubles."""
        steepest = max(1.0, -np.log(weight.min(initial=1)), np.log(SCALE))
        return (self.size - 1) * steepest < SAFE

    def _log_pass(self, weight: np.ndarray, first: np.ndarray, onto: np.ndarray, came_from: np.ndarray, places) -> np.ndarray:
        """Logarithms of the sums at each place; edges lead from `came_from` onto `onto`. All weights are positive."""
        sums = np.full((self.count * self.size, weight.shape[1]), -np.inf)
        sums[first] = 0
        weight, groups = np.log(weight), self._by(onto)
        for place in places:
            edges = groups[place]
            if len(edges):
                word = self.word[edges]
                came = sums[word * self.size + came_from[edges]] + weight[self.piece[edges]]
                new = np.diff(word, prepend=-1) != 0
                starts = np.flatnonzero(new)
                top = np.maximum.reduceat(came, starts, axis=0)
                came = np.exp(came - top[np.cumsum(new) - 1])
                sums[word[starts] * self.size + place] = top + np.log(np.add.reduceat(came, starts, axis=0))
        return sums.reshape(self.count, self.size, -1)

    def log_forward(self, weight: np.ndarray) -> np.ndarray:
        """Logarithms of the forward sums, for words of any length."""
        return self._log_pass(weight, np.arange(self.count) * self.size, self.end, self.start, range(1, self.size))

    def log_backward(self, weight: np.ndarray) -> np.ndarray:
        """Logarithms of the backward sums, for words of any length."""
        last = np.arange(self.count) * self.size + self.lengths
        return self._log_pass(weight, last, self.start, self.end, range(self.size - 1, -1, -1))

    def log_sums(self, weight: np.ndarray) -> np.ndarray:
        """Logarithm of each word's sum over all segmentations, per language; scale taken back."""
        last = np.arange(self.count), self.lengths
        found = np.log(self.forward(weight)[last]) if self.plain(weight) else self.log_forward(weight)[last]
        return found - self.lengths[:, None] * np.log(SCALE)

    def expected(self, weight: np.ndarray, times: np.ndarray) -> np.ndarray:
        """How often each piece is expected per language, for words that occur `times` (words x languages)."""
        last = np.arange(self.count), self.lengths
        if self.plain(weight):
            ahead, behind = self.forward(weight), self.backward(weight)
            whole = ahead[last]
            share = ahead[self.word, self.start] * weight[self.piece] * behind[self.word, self.end] / whole[self.word]
        else:
            ahead, behind = self.log_forward(weight), self.log_backward(weight)
            share = ahead[self.word, self.start] + np.log(weight)[self.piece] + behind[self.word, self.end]
            share = np.exp(share - ahead[last][self.word])
        own = share * times[self.word]
        return np.column_stack([np.bincount(self.piece, own[:, k], len(weight)) for k in range(own.shape[1])])


def by_length(texts: list[str]) -> Iterator[np.ndarray]:
    """Places of texts of similar lengths, some at a time: a lattice is as wide as its longest text."""
    lengths = np.array([len(t) for t in texts])
    order = np.argsort(lengths, kind="stable")
    low = 0
    while low < len(order):
        high = low + max(1, CELLS // (int(lengths[order[low]]) + 1))
        high = low + max(1, CELLS // (int(lengths[order[min(high, len(order)) - 1]]) + 1))
        yield order[low:high]
        low = high


def marked(word: bytes) -> str:
    """A word in lower case with its mark."""
    return MARK + word.decode("utf-8", "replace").lower()


def _scaled(probability: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    return probability * SCALE ** lengths[:, None]


def _vocabulary(model: bytes) -> tuple[Trie, np.ndarray]:
    """The pieces in lower case, each once; the length of each, the unknown piece last."""
    pieces: dict[str, int] = {}
    for text in (p.text.lower() for p in read_model(model).pieces if p.kind == 1):
        pieces.setdefault(text, len(pieces))
    return with_beginnings(pieces), np.array([*map(len, pieces), 1])


def with_beginnings(pieces: dict[str, int]) -> Trie:
    """The tree of some numbered pieces."""
    nodes = {"": 0}
    for text in pieces:
        for n in range(1, len(text) + 1):
            nodes.setdefault(text[:n], len(nodes))
    named = [(nodes[text[:-1]] << CHARACTER_BITS | ord(text[-1]), node) for text, node in nodes.items() if text]
    edges = np.array(sorted(named) or [(-1, 0)], dtype=np.int64)
    ends = np.full(len(nodes), -1, dtype=np.int64)
    ends[[nodes[text] for text in pieces]] = list(pieces.values())
    return Trie(edges[:, 0].copy(), edges[:, 1].copy(), ends)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
    schema = pa.schema([("word", pa.binary()), ("lang", pa.string()), ("times", pa.int64())])
    counts: dict[str, Counter] = defaultdict(Counter)

    def flush():
        for lang, own in counts.items():
            words = list(own)
            for at in range(0, len(words), 50_000):
                some = words[at : at + 50_000]
                columns = [some, [lang] * len(some), [own[w] for w in some]]
                yield pa.RecordBatch.from_pydict(dict(zip(schema.names, columns, strict=True)), schema=schema)
        counts.clear()

    for part in batches:
        for text, lang in zip(part.column("text").to_pylist(), part.column("lang").to_pylist(), strict=True):
            counts[lang].update((text or b"").split())
            if sum(map(len, counts.values())) > WORDS_HELD:
                yield from flush()
    yield from flush()


def _expect(langs: list[str], shared):
    """Expected piece counts of a partition's words, per language."""
    schema = pa.schema([("piece", pa.int32()), ("counts", pa.list_(pa.float64()))])

    def expect(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        arrays, lengths, probability = shared.value
        trie = Trie(*arrays)
        longest = int(lengths.max())
        weight = _scaled(probability, lengths)
        if (weight == weight[:, :1]).all():  # before anything is learned, one column stands for all languages
            weight = weight[:, :1]
        total = np.zeros((len(lengths), len(langs)))
        for part in batches:
            times = np.array(part.column("counts").to_pylist(), dtype=np.float64).reshape(-1, len(langs))
            texts = [marked(word) for word in part.column("word").to_pylist()]
            for some in by_length(texts):
                total += Lattice(trie, longest, [texts[i] for i in some]).expected(weight, times[some])
        some = np.flatnonzero(total.any(axis=1))
        yield pa.RecordBatch.from_pydict(
            {"piece": some.astype(np.int32), "counts": list(total[some])}, schema=schema
        )

    return expect


def learn(
    docs: DataFrame, vocabulary: tuple[Trie, np.ndarray], learns: Column, rounds: int = ROUNDS
) -> tuple[list[str], np.ndarray]:
    """The languages, and the probability of every piece (the unknown one last) in each.

    The number of languages is that of different labels, by which the tables of counts grow.
    """
    spark = docs.sparkSession
    told = docs.filter(learns & F.col("lang").isNotNull())
    counted = in_batches(as_bytes(told, "lang"), _count_words, "word binary, lang string, times long")
    langs = sorted(row["lang"] for row in told.select("lang").distinct().collect())
    trie, lengths = vocabulary
    probability = np.full((len(lengths), max(1, len(langs))), 1 / len(lengths))
    if not langs:
        return langs, probability
    each = [F.sum(F.when(F.col("lang") == lang, F.col("times")).otherwise(0)) for lang in langs]
    words = kept_table(counted.groupBy("word").agg(F.array(*each).alias("counts")), "language-words")
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast((tuple(trie), lengths, probability))
        expected = in_batches(words, _expect(langs, shared), "piece int, counts array<double>")
        sums = [F.sum(F.get("counts", F.lit(i))).alias(f"c{i}") for i in range(len(langs))]
        table = expected.groupBy("piece").agg(*sums).toArrow()  # a row per piece of the vocabulary at most
        counts = np.zeros((len(lengths), len(langs)))
        counts[table.column("piece").to_numpy()] = np.column_stack(
            [table.column(f"c{i}").to_numpy() for i in range(len(langs))]
        )
        shares = (counts.sum(axis=1) + FLOOR) / (counts.sum() + FLOOR * len(lengths))
        pull = 1000.0  # pieces' worth of all languages together that each language starts from
        probability = (counts + pull * shares[:, None]) / (counts.sum(axis=0) + pull)
    return langs, probability


def _predict(langs: list[str], shared):
    schema = pa.schema(
        [("doc_id", pa.int64()), ("text_hash", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64())]
    )

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        arrays, lengths, probability = shared.value
        trie = Trie(*arrays)
        longest = int(lengths.max())
        weight = _scaled(probability, lengths)
        known: dict[bytes, int] = {}
        scores = np.zeros((REMEMBERED + AT_ONCE, weight.shape[1]))

        def look_up(words: list[bytes]) -> None:
            texts, low = [marked(word) for word in words], len(known)
            known.update((word, low + n) for n, word in enumerate(words))
            for some in by_length(texts):
                scores[low + some] = Lattice(trie, longest, [texts[i] for i in some]).log_sums(weight)

        for part in batches:
            counted = [Counter((text or b"").split()) for text in part.column("text").to_pylist()]
            labels, sure, waiting, new = [], [], [], {}

            def settle(waiting=waiting, new=new, labels=labels, sure=sure):
                if new:
                    look_up(list(new))
                for own in waiting:
                    total = np.zeros(weight.shape[1])
                    if own:
                        times = np.fromiter(own.values(), dtype=np.float64, count=len(own))
                        total = times @ scores[[known[w] for w in own]]
                    best = int(total.argmax())
                    labels.append(langs[best])
                    sure.append(float(1 / np.exp(total - total[best]).sum()))
                waiting.clear(), new.clear()

            for own in counted:
                if len(own) > AT_ONCE:  # a very long text in parts
                    settle()
                    total, items = np.zeros(weight.shape[1]), list(own.items())
                    for at in range(0, len(items), AT_ONCE):
                        some = items[at : at + AT_ONCE]
                        known.clear()
                        look_up([w for w, _ in some])
                        total += np.array([t for _, t in some], dtype=np.float64) @ scores[[known[w] for w, _ in some]]
                    best = int(total.argmax())
                    labels.append(langs[best])
                    sure.append(float(1 / np.exp(total - total[best]).sum()))
                    continue
                if len(new) + len(own) > AT_ONCE:
                    settle()
                if len(known) + len(new) + len(own) > REMEMBERED:
                    settle()
                    known.clear()
                new.update((w, None) for w in own if w not in known)
                waiting.append(own)
            settle()
            for i, text in enumerate(part.column("text").to_pylist()):
                if text is None or not any(map(str.isalpha, text.decode("utf-8", "replace"))):
                    labels[i], sure[i] = UNKNOWN_LANGUAGE, 0.0
            columns = [part.column(c) for c in ("doc_id", "text_hash", "held_out")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(labels, pa.string()), pa.array(sure)], schema=schema)

    return predict


def predict_languages(docs: DataFrame, model: bytes, held_out: Column, rounds: int = ROUNDS) -> DataFrame:
    """`doc_id, text_hash, held_out, lang_pred, score`, one row per document.

    Learns from documents where `held_out` is not true. `score` is the posterior of `lang_pred`, all
    languages alike before the text is seen. `model` is the vocabulary file's content.
    """
    held_out = F.coalesce(held_out, F.lit(False))
    vocabulary = _vocabulary(model)
    langs, probability = learn(docs, vocabulary, ~held_out, rounds)
    texts = as_bytes(docs, held_out.alias("held_out"))
    if not langs:
        return texts.select(
            "doc_id", "text_hash", "held_out", F.lit(UNKNOWN_LANGUAGE).alias("lang_pred"), F.lit(0.0).alias("score")
        )
    shared = docs.sparkSession.sparkContext.broadcast((tuple(vocabulary[0]), vocabulary[1], probability))
    schema = "doc_id long, text_hash long, held_out boolean, lang_pred string, score double"
    return in_batches(texts, _predict(langs, shared), schema)
