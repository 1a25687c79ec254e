"""Each operator on the cases its docstring names, held against brute force or an exact round trip."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from viewrank.llm import (
    best_fit_packing,
    components,
    context_mixing,
    hash_forest,
    language_id,
    license_scan,
    line_dedup,
    quality_rules,
    sentencepiece_codec,
    simhash_dedup,
    substring_dedup,
)
from viewrank.llm.queries import vocabulary

PROSE = " ".join(f"w{i * 7 % 31}x{i}" for i in range(60))
SCHEMA = "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG, words STRING, anchor INT"


def table(spark, texts, langs=None):
    """Documents with further columns whose names operators use inside."""
    rows = [
        (i, t, (langs or {}).get(i, "en"), f"src{n % 3}", len(t) if t else None, "own", n)
        for n, (i, t) in enumerate(texts)
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and blank texts, repeated rows, ids and texts, ties, a very long word."""
    one, two = PROSE, PROSE.replace("w7x1 ", "other ")
    texts = [
        (1, one), (2, two), (3, None), (4, ""), (5, " \n\t "), (6, one), (6, one), (7, f"start {one} end"),
        (None, one), (None, None), (8, "a " * 90), (8, "b c " * 40), (9, "é日本 " * 30), (10, "x" * 5000),
        (11, f"{one}\n{one}"), (12, "word"),
    ]
    return table(spark, texts)


def words_of(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())


def collected(df, *columns):
    return sorted((tuple(row[c] for c in columns) for row in df.collect()), key=repr)


# Substring dedup


def brute_repeats(texts, window):
    seen = Counter(tuple(w[i : i + window]) for w in map(words_of, texts) for i in range(len(w) - window + 1))
    out = []
    for own in map(words_of, texts):
        gone = [False] * len(own)
        for i in range(len(own) - window + 1):
            if seen[tuple(own[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        kept = b" ".join(w for w, g in zip(own, gone, strict=True) if not g)
        out.append((len(own), sum(gone), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("group_limit", [substring_dedup.GROUP_LIMIT, 1])
def test_repeated_passages_equal_brute_force(odd, group_limit):
    rows = odd.collect()
    expected = brute_repeats([r.text for r in rows], 35)
    got = substring_dedup.count_repeats(odd, group_limit=group_limit)
    assert collected(got, "doc_id", "n_words", "n_removed", "kept_sha256") == sorted(
        ((r.doc_id, *e) for r, e in zip(rows, expected, strict=True)), key=repr
    )


def test_small_windows_over_few_words_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    texts = [" ".join(rng.choice(list("abc"), size=rng.integers(0, 40))) for _ in range(60)]
    docs = table(spark, list(enumerate(texts)))
    got = substring_dedup.count_repeats(docs, window=6, prefix=2)
    assert collected(got, "doc_id", "n_words", "n_removed", "kept_sha256") == sorted(
        ((i, *e) for i, e in enumerate(brute_repeats(texts, 6))), key=repr
    )


def test_cut_text_keeps_columns_and_white_space(spark):
    docs = table(spark, [(1, f"  lead\n{PROSE}\ttail  end"), (2, f"other {PROSE}"), (3, None)])
    got = {r.doc_id: r for r in substring_dedup.remove_repeats(docs).collect()}
    assert got[1].text == "  lead\ntail  end" and got[1].n_chars == 16 and got[3].text is None
    assert got[2].text == "other " and got[2].words == "own" and got[2].asDict().keys() == set(docs.columns)


# SimHash


def brute_print(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, radius):
    root = list(range(len(prints)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(prints):
        for j, b in enumerate(prints[:i]):
            if (a ^ b).bit_count() <= radius:
                root[top(i)] = top(j)
    return [top(i) for i in range(len(prints))]


def test_fingerprints_and_components_equal_brute_force(odd):
    rows = odd.collect()
    prints = [brute_print(r.text) for r in rows]
    tops = brute_components(prints, 2)
    first = {
        t: min((r.doc_id for r, u in zip(rows, tops, strict=True) if u == t and r.doc_id is not None), default=None)
        for t in tops
    }
    expected = [(r.doc_id, format(p, "016x"), first[t]) for r, p, t in zip(rows, prints, tops, strict=True)]
    got = collected(simhash_dedup.near_duplicates(odd), "doc_id", "fingerprint", "component_id")
    assert got == sorted(expected, key=repr)


@pytest.mark.parametrize("shard_limit", [2000, 3])
def test_links_over_planted_chains_equal_brute_force(spark, shard_limit):
    rng = np.random.default_rng(5)
    prints = [int(x) for x in rng.integers(0, 2**63, size=40)]
    for start in list(prints):
        value = start
        for _ in range(4):
            value ^= 1 << int(rng.integers(0, 63)) | 1 << int(rng.integers(0, 63))
            prints.append(value)
    prints = sorted(set(prints))
    df = spark.createDataFrame([(p,) for p in prints], "print LONG")
    roots = dict(components.components(simhash_dedup.links(df, 2, shard_limit)).collect())
    tops = brute_components(prints, 2)
    groups = {t: min(p for p, u in zip(prints, tops, strict=True) if u == t) for t in tops}
    assert {p: roots.get(p, p) for p in prints} == {p: groups[t] for p, t in zip(prints, tops, strict=True)}


def test_one_document_of_each_group_stays(spark, odd):
    kept = collected(simhash_dedup.first_of_each_group(odd), "doc_id")
    ids = [i for (i,) in kept]
    # Rows without an id are in groups of documents that have one.
    assert ids.count(1) == 1 and 6 not in ids and ids.count(3) == 1 and 4 not in ids and ids.count(None) == 0
    other = " ".join(f"v{i}" for i in range(80))
    docs = table(spark, [(None, other), (None, other), (None, other), (None, PROSE), (5, PROSE)])
    assert collected(simhash_dedup.first_of_each_group(docs), "doc_id", "text") == sorted([(5, PROSE), (None, other)], key=repr)


def test_columns_of_any_name_travel_along(spark):
    lines = "\n".join(BLOCK)
    texts = [(1, f"start {PROSE} end"), (2, f"other {PROSE} tail"), (3, lines), (4, f"own line\n{lines}"), (5, "a b"), (6, "a b")]
    docs = table(spark, texts)
    names = ["__hash", "__id", "__text", "__cut", "__kept", "row", "kept", "cut", "text_hash", "found_id", "kept_id",
             "first_id", "repeated", "a.b", "ro`w"]
    odd_names = docs.select("*", *(F.concat(F.lit(n), F.col("doc_id")).alias(n) for n in names))
    labels = spark.createDataFrame([], "doc_id LONG, quality INT, toxic INT")
    for stage in (
        lambda d: quality_rules.keep_good(d, labels),
        line_dedup.remove_lines,
        simhash_dedup.first_of_each_group,
        substring_dedup.remove_repeats,
    ):
        plain, got = stage(docs).select("doc_id", "text").collect(), stage(odd_names)
        assert got.columns == odd_names.columns
        found = got.collect()
        assert sorted((r.doc_id, r.text) for r in plain) == sorted((r.doc_id, r.text) for r in found)
        assert all(r[n] == f"{n}{r.doc_id}" for r in found for n in names)


def test_each_group_keeps_a_document_where_ids_repeat(spark, odd):
    assert collected(simhash_dedup.first_of_each_group(odd).filter("doc_id = 8"), "text") == [("a " * 90,), ("b c " * 40,)]
    other = " ".join(f"v{i}" for i in range(80))
    docs = table(spark, [(1, PROSE), (1, other), (1, other), (2, PROSE), (3, other)])
    assert collected(simhash_dedup.first_of_each_group(docs), "doc_id", "text") == sorted([(1, PROSE), (1, other)])


# Line dedup

BLOCK = ["the first line of five words", "another line with some words", "a third one to end it"]


def test_blocks_go_from_later_documents(spark):
    docs = table(
        spark,
        [
            (1, "\n".join(["unique one", *BLOCK, "unique two"])),
            (2, "\n".join(["own text here", "", *BLOCK, "and more own"])),
            (3, "\n".join([BLOCK[2], BLOCK[0]])),
            (4, "short\nunique one"),
            (5, None), (6, ""), (1, "\n".join(["unique one", *BLOCK, "unique two"])), (None, "\n".join(BLOCK)),
        ],
    )
    got = {r.doc_id: r.text for r in line_dedup.remove_lines(docs).filter("doc_id is not null").collect()}
    assert got[2] == "own text here\n\nand more own"
    # Crossed lines cannot both be aligned; the chain takes one of them.
    assert got[3] in (BLOCK[0], BLOCK[2])
    assert got[4] == "short\nunique one"  # a block under five words stays
    assert got[1].startswith("unique one") and got[5] is None and got[6] == ""


def brute_deleted(texts, min_words):
    """Places that go when each document is aligned with every earlier one."""
    held = [line_dedup.held_lines(t.encode()) for t in texts]
    out = []
    for d, own in enumerate(held):
        gone = set()
        for other in held[:d]:
            later = [(i, x, len(x.split())) for i, x in enumerate(own) if x in other]
            gone.update(line_dedup._blocks(later, [(i, x) for i, x in enumerate(other) if x in own], min_words))
        out.append((d, sorted(gone)))
    return out


def test_blocks_of_overlapping_documents_equal_all_pairs(spark):
    # The common block of 2 and 3 has six words; each of its lines stood first elsewhere.
    texts = ["x y z", "u v w", "x y z\nu v w", "x y z\nu v w"]
    rng = np.random.default_rng(4)
    lines = [" ".join(f"l{i}w{j}" for j in range(1 + i % 4)) for i in range(60)]
    for _ in range(60):
        runs = [(low, low + int(rng.integers(1, 9))) for low in sorted(rng.choice(60, 5, replace=False).tolist())]
        texts.append("\n".join(lines[i] for i in sorted({i for low, high in runs for i in range(low, min(high, 60))})))
    texts += texts[10:14]
    got = {r.doc_id: r.gone for r in line_dedup.deleted_lines(table(spark, list(enumerate(texts)))).collect()}
    expected = brute_deleted(texts, line_dedup.MIN_WORDS)
    assert expected[3] == (3, [0, 1]) and [(i, got.get(i, [])) for i, _ in expected] == expected


def test_patience_gives_common_subsequences():
    rng = np.random.default_rng(1)
    for _ in range(200):
        a, b = (rng.integers(0, 8, size=rng.integers(0, 15)).tolist() for _ in range(2))
        found = line_dedup.patience(a, b)
        assert all(a[i] == b[j] for i, j in found)
        assert all(p < r and q < s for (p, q), (r, s) in zip(found, found[1:], strict=False))
    assert line_dedup.patience([1, 2, 3, 9], [9, 1, 2, 3]) == [(0, 1), (1, 2), (2, 3)]


# Quality rules


def test_statistics_equal_brute_force(odd):
    expected = []
    for r in odd.collect():
        text = r.text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        runs = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
        repeat = [False] * len(words)
        for i in range(len(words) - 7):
            if runs[tuple(words[i : i + 8])] > 1:
                repeat[i : i + 8] = [True] * 8
        lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
        expected.append(
            (r.doc_id, len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
             len(lines) - len(set(lines)), sum(repeat))
        )
    names = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert collected(quality_rules.statistics(odd), *names) == sorted(expected, key=repr)


def test_rules_reject_what_labels_call_bad(spark):
    good = [(i, " ".join(f"word{(i % 89 + 1) * j % 97}" for j in range(1, 40))) for i in range(1, 301)]
    bad = [(i, " ".join(f"a#{(i % 89 + 1) * j % 97}$" for j in range(1, 40))) for i in range(301, 401)]
    docs = table(spark, [*good, *bad])
    labels = [(i, int(i <= 300), 0) for i in range(1, 401) if i % 2] + [(None, 0, 0), (3, None, 1), (9999, 0, 0)]
    told = spark.createDataFrame(labels, "doc_id LONG, quality INT, toxic INT")
    verdict = dict(collected(quality_rules.judge(docs, told), "doc_id", "kept"))
    assert verdict == {i: i <= 300 for i in range(1, 401)}
    assert {r.doc_id for r in quality_rules.keep_good(docs, told).collect()} == set(range(1, 301))
    nothing = told.limit(0)
    assert all(r.kept for r in quality_rules.judge(docs, nothing).collect())


# LM scoring


def test_base_scores_equal_their_formula(odd):
    rows = odd.collect()
    tokens = [[*re.findall(rb"[^\x20\x09-\x0D]+", (r.text or "").encode().lower()), b""] for r in rows]
    held = [r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 7 == 2 for r in rows]
    counts = Counter(t for own, h in zip(tokens, held, strict=True) if not h for t in own)
    total, kinds = sum(counts.values()), len(counts)
    expected = sorted(
        (repr(r.doc_id), h, len(own), sum(counts[t] > 0 for t in own), total,
         round(sum(math.log10((counts[t] + 1) / (total + kinds + 1)) for t in own), 6))
        for r, h, own in zip(rows, held, tokens, strict=True)
    )
    scored = context_mixing.score_texts(odd, F.crc32(F.col("doc_id").cast("string")) % 7 == 2, F.col("lang")).collect()
    assert expected == sorted(
        (repr(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in scored
    )
    assert all(math.isfinite(r.score) and r.score < 0 for r in scored)


def test_scores_equal_a_plain_mean_over_kinds_and_any_partitioning(spark):
    """Twenty kinds; the bits of single words come from the operator, what is made of them is done here again."""
    rng = np.random.default_rng(8)
    texts, langs = [], {}
    for i in range(200):
        texts.append((i, " ".join(f"w{k}" for k in rng.zipf(1.6, size=rng.integers(0, 30)) % 300) + f" l{i % 20}"))
        langs[i] = f"kind{i % 20}" if i % 9 else None
    docs, held = table(spark, texts, langs), F.col("doc_id") % 7 == 2

    def run(partitions):
        before = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
        try:
            found = context_mixing.score_texts(docs.repartition(partitions), held, F.col("lang")).collect()
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", before)
        return {r.doc_id: r.score for r in found}

    few, many = run(2), run(9)
    assert few.keys() == many.keys() and np.allclose([few[i] for i in few], [many[i] for i in few], rtol=1e-9)

    tokens = {i: [*words_of(t.lower()), b""] for i, t in texts}
    learned = [i for i, _ in texts if i % 7 != 2]
    every = Counter(t for i in learned for t in tokens[i])
    own = {k: Counter(t for i in learned if langs[i] == k for t in tokens[i]) for k in set(langs.values()) - {None}}
    seen = spark.createDataFrame([(w, n) for w, n in every.items()], "word BINARY, learned LONG")
    tables = spark.sparkContext.broadcast(context_mixing._tables(seen))
    state = spark.sparkContext.broadcast(context_mixing._mixer(seen, len(every), tables).state())
    words = pa.RecordBatch.from_pydict({"word": pa.array(sorted({t for o in tokens.values() for t in o}), pa.binary())})
    bits = {}
    for part in context_mixing._score_words(tables, state)(iter([words])):
        bits.update(zip(part.column("word").to_pylist(), part.column("bits_score").to_pylist(), strict=True))

    def shared(counts, word, rest):
        total = sum(counts.values())
        return max(counts[word] - 0.75, 0) / total + 0.75 * len(counts) / total * rest

    of_all = sum(sum(c.values()) for c in own.values())
    for i, text in tokens.items():
        overall = [shared(every, w, 10 ** bits[w]) for w in text]
        sums = []
        for counts in own.values():
            logs = sum(math.log10(shared(counts, w, p)) for w, p in zip(text, overall, strict=True))
            sums.append(logs + math.log10(sum(counts.values()) / of_all))
        sums.append(sum(map(math.log10, overall)) + math.log10(1 / of_all))
        best = max(sums)
        assert math.isclose(few[i], best + math.log10(sum(10 ** (x - best) for x in sums)), rel_tol=1e-9)


def test_parts_of_words_are_added_up_in_their_order(spark, monkeypatch):
    monkeypatch.setattr(context_mixing, "WORDS_A_PART", 7)
    monkeypatch.setattr(context_mixing, "PARTS_AT_ONCE", 3)
    words = {f"w{i * i}".encode(): i % 5 + 1 for i in range(120)}
    seen = spark.createDataFrame(list(words.items()), "word BINARY, learned LONG")
    tables = spark.sparkContext.broadcast(context_mixing._tables(seen))
    one, other = (context_mixing._mixer(rows, len(words), tables) for rows in (seen, seen.repartition(5)))
    assert all(np.array_equal(a, b) for a, b in zip(one.state(), other.state(), strict=True))
    spelled = sum(8 * (len(w) + 1) * n for w, n in words.items())
    assert math.isclose(one.map.sum(), spelled)  # every bit is in the map once


def test_the_mixer_predicts_better_than_chance_and_sums_to_one():
    words = [b"the", b"then", b"than", b"that", b""]
    tables = np.zeros((2, context_mixing.OFFSETS[-1]), dtype=np.float32)
    mixer = context_mixing.Mixer()
    spelled = context_mixing._Bytes(words)
    for _, before, _, places in spelled.bits():
        odds, gate = mixer.inputs(tables, 0, before, places)
        one = mixer.refine(mixer.mix(odds, gate, before), before)
        assert ((one > 0) & (one < 1)).all()


def test_contexts_reach_over_the_border_of_words(spark):
    """Each byte behind the five before it and the word so far, spelled out here for whole texts."""
    rng = np.random.default_rng(5)
    vocabulary = [b"a", b"of", b"the", b"word", b"words", b"wording", b"\xc3\xa9t\xc3\xa9", b"x" * 30, *(b"w%d" % i for i in range(40))]
    texts = [(i, " ".join(vocabulary[k].decode() for k in rng.integers(0, 48, size=i % 30))) for i in range(80)]
    texts += [(100, "Words of the\nword"), (101, "the word of words"), (102, None), (103, "never seen here"), (103, "never seen here")]
    docs, held = table(spark, texts), F.col("doc_id") % 7 == 2

    def run(partitions):
        found = context_mixing.score_texts(docs.repartition(partitions), held, borders=True).collect()
        return sorted((r.doc_id, r.score) for r in found)

    few, many = run(1), run(7)
    assert [i for i, _ in few] == [i for i, _ in many] and np.allclose([x for _, x in few], [x for _, x in many], rtol=1e-9)
    scores = dict(few)
    assert abs(scores[100] - scores[101]) > 1e-3  # the same words in another order

    def behind(text):
        """Every word with its closing blank behind the five bytes before it."""
        before = b" " * 5
        for word in [*words_of((text or "").lower()), b""]:
            spelled = word + b" " if word else b"\n"
            yield word, before + spelled
            before = (before + spelled)[-5:]

    learned = [t for i, t in texts if i % 7 != 2]
    words, pieces = Counter(), Counter()
    for text in learned:
        for word, spelled in behind(text):
            words[word] += 1
            pieces.update(spelled[i : i + 6] for i in range(min(4, len(spelled) - 5)))
            if len(word) >= 4:
                pieces[b" " + word + b" "] += 1
    seen = spark.createDataFrame(list(pieces.items()), "word BINARY, learned LONG")
    tables = context_mixing._tables(seen, 5)
    bytes_learned = sum(len(s) - 5 for t in learned for _, s in behind(t))
    assert tables.sum() == bytes_learned * 8 * len(context_mixing.CONTEXTS)  # every bit is in each table once
    shared = spark.sparkContext.broadcast(tables)
    mixer, odds = context_mixing._mixer(seen, len(pieces), shared, 5), context_mixing._Odds(tables)
    total = sum(words.values())
    for i, text in dict(texts).items():
        spelled = context_mixing._Bytes([s for _, s in behind(text)], 5)
        bits = context_mixing._logs(spelled, odds, mixer, len(list(behind(text))))
        expected = sum(
            math.log10((max(words[word] - 0.75, 0) + 0.75 * len(words) * 10**x) / total)
            for (word, _), x in zip(behind(text), bits, strict=True)
        )
        assert math.isclose(scores[i], expected, rel_tol=1e-9)


def test_tokens_and_borders_equal_those_of_plain_words():
    """Texts are split as arrays; each border becomes one number, from which its grams come back."""
    texts = [None, b"", b" \t", b"One", b"  two\t\nWORDS \x0b", b"a b\x0cc", b"\0\0\0\0\0 \0", "\u00c9t\u00e9 longer".encode(), b"two words"]
    tokens = context_mixing._Tokens(texts)
    words = [[*re.findall(rb"[^\x20\x09-\x0D]+", (t or b"").lower()), b""] for t in texts]
    assert tokens.words.to_pylist() == [w for own in words for w in own]
    assert tokens.n_tokens.tolist() == [len(own) for own in words]
    assert tokens.text.tolist() == [i for i, own in enumerate(words) for _ in own]
    assert tokens.sizes.tolist() == [len(w) + 1 for own in words for w in own]
    expected, sizes = [], []
    for own in words:
        before = b" " * 5
        for word in own:
            spelled = before + (word + b" " if word else b"\n")
            sizes.append(min(4, len(spelled) - 5))
            expected += [spelled[i : i + 6] for i in range(sizes[-1])]
            before = spelled[-5:]
    grams, found = context_mixing._grams(tokens.borders())
    assert found.tolist() == sizes and context_mixing._gram_bytes(grams).tobytes() == b"".join(expected)


def test_a_border_is_computed_once_however_often_it_occurs():
    computed = []

    def compute(numbers):
        computed.extend(numbers.tolist())
        return numbers.astype(np.float64)

    remembered = context_mixing._Remembered(compute)
    for _ in range(3):
        numbers = context_mixing._Tokens([b"the same words and the same words again"] * 50).borders()
        assert np.array_equal(remembered.of(numbers), numbers.astype(np.float64))
    assert sorted(computed) == sorted(set(numbers.tolist())) and len(computed) < len(numbers) / 40
    zero = np.zeros(2, dtype=np.uint64)  # four zero bytes before a blank, four behind it
    assert np.array_equal(remembered.of(zero), [0.0, 0.0]) and computed[-1] == 0


def test_words_are_counted_by_kind_over_merges(monkeypatch):
    monkeypatch.setattr(context_mixing, "WORDS_HELD", 5)
    monkeypatch.setattr(context_mixing, "GRAMS_HELD", 8)
    monkeypatch.setattr(context_mixing, "TEXT_BYTES_AT_ONCE", 20)
    texts = [f"w{i % 9} w{i % 4} W1" for i in range(40)] + [None]
    kinds = [i % 4 - 1 for i in range(41)]
    part = pa.RecordBatch.from_pydict({"text": pa.array([t and t.encode() for t in texts], pa.binary()), "kind": pa.array(kinds, pa.int32())})
    found, grams = Counter(), Counter()
    for out in context_mixing._sum_words(True)(iter([part, part.slice(0, 0), part])):
        for word, kind, times in zip(*(out.column(c).to_pylist() for c in ("word", "kind", "times")), strict=True):
            (grams if b" " in word else found)[(word, kind)] += times
    expected, spelled = Counter(), Counter()
    for text, kind in zip(texts, kinds, strict=True):
        before = b" " * 5
        for word in [*(text or "").lower().encode().split(), b""]:
            expected[(word, kind)] += 2
            stream = before + (word + b" " if word else b"\n")
            if kind >= 0:
                spelled.update({(stream[i : i + 6], 0): 2 for i in range(min(4, len(stream) - 5))})
            before = stream[-5:]
    assert found == expected and grams == spelled


def test_bits_looked_up_equal_those_of_the_counts():
    tables = np.random.default_rng(3).integers(0, 9, (2, context_mixing.OFFSETS[-1])).astype(np.float64)
    mixer, seen = context_mixing.Mixer(), context_mixing._Odds(tables)
    for k, before, _, places in context_mixing._Bytes([b"some", b"words", b""]).bits():
        odds, gate = mixer.inputs(tables, k, before, places)
        looked_up, own_gate = mixer.looked_up(seen, k, places)
        assert np.array_equal(odds, looked_up) and np.array_equal(gate, own_gate)


# SentencePiece


def test_ids_equal_the_library_and_decode_back(spark, odd):
    import sentencepiece

    model = vocabulary()
    library = sentencepiece.SentencePieceProcessor(model_proto=model)
    texts = ["", " ", "   ", " a", "a ", "a  b ", "  two  words  ", "tab\tline\nend", "日本語 é 🎉", "▁mark", "<s> </s> <0x41>"]
    codec = sentencepiece_codec.Codec(model, True)
    ids, agrees = codec.encode([*texts, None])
    assert ids == [*(library.encode(t) for t in texts), None]
    assert all(agrees)
    back = codec.decode(ids)
    assert [b for t, b in zip(texts, back, strict=False) if "▁" not in t and "<" not in t] == [
        t for t in texts if "▁" not in t and "<" not in t
    ]
    for row in sentencepiece_codec.round_trips(odd, model).collect():
        assert row.round_trip in (True, None) and (row.n_tokens is None) == (row.agrees is None)


def test_stretches_decode_like_whole_texts(spark, odd):
    model = vocabulary()
    codec = sentencepiece_codec.Codec(model, True)
    texts = [None, "", " ", "a  b ", "▁ ▁", "<s> x", "� é 🎉  🎉", "日本 \x00語", "x\n y", "word " * 3000, "a b"]
    ids, _ = codec.encode(texts)
    back = codec.decode(ids)
    column = pa.array(texts, pa.string())
    told = codec.returned(column, *codec.look_up(column))
    assert [t is None or t == b for t, b in zip(texts, back, strict=True)] == told.tolist()
    docs = odd.union(odd.limit(0)).select("doc_id", "text")
    encoded = sentencepiece_codec.encode(docs, model)
    decoded = collected(sentencepiece_codec.decode(encoded, model), "doc_id", "text")
    assert sorted(map(repr, decoded)) == sorted(map(repr, collected(docs, "doc_id", "text")))
    assert encoded.filter("ids is null").count() == docs.filter("text is null").count()


def test_stretches_in_a_row_and_forgotten_ones_keep_their_ids(monkeypatch):
    import sentencepiece

    model = vocabulary()
    library = sentencepiece.SentencePieceProcessor(model_proto=model)
    monkeypatch.setattr(sentencepiece_codec, "REMEMBERED", 100)
    codec, asked = sentencepiece_codec.Codec(model, True), Counter()
    learn = codec._learn

    def counted(stretches, joined):
        asked.update(stretches)
        learn(stretches, joined)

    codec._learn = counted
    odd = ["\u2581", "a\u2581b", "<s>", "<0x41>", "\x00", "é🎉", "\ufffd", "日本", "x" * 300, "\n", "1,000.00", "<unk>"]
    for i in range(40):
        own = [f"often{k}" for k in range(9)] + [f"w{i}x{k}" for k in range(25)] + odd
        texts = [" ".join(own), " ".join(reversed(own)), f"  {own[i % 9]}  {odd[i % 12]} ", "", " "]
        ids, agrees = codec.encode([*texts, None])
        assert ids == [*(library.encode(t) for t in texts), None] and all(agrees)
        assert len(codec.known) <= 100
    assert max(asked[f"often{k}"] for k in range(9)) <= 3  # all were forgotten together before
    column = pa.array(texts, pa.string())
    told = codec.returned(column, *codec.look_up(column)).tolist()
    assert told == [t == b for t, b in zip(texts, codec.decode(ids), strict=False)]
    one = library.encode("one")
    alike = sentencepiece_codec._alike(*sentencepiece_codec._in_a_row([[1], [2, 3], one]),
                                       *sentencepiece_codec._in_a_row([[1], [2], one]))
    assert alike.tolist() == [True, False, True]


# Language identification


def test_forward_sums_over_all_segmentations():
    pieces = {p: i for i, p in enumerate(["▁", "a", "b", "ab", "▁a", "▁ab", "ba"])}
    probability = np.arange(1, 9, dtype=float)[:, None] / 36
    lengths = np.array([*map(len, pieces), 1])

    def brute(text):
        if not text:
            return 1.0
        return sum(
            probability[pieces[text[:n]], 0] * brute(text[n:]) for n in range(1, len(text) + 1) if text[:n] in pieces
        )

    texts = ["▁", "▁a", "▁ab", "▁abab", "▁baab"]
    found = language_id.Lattice(language_id.with_beginnings(pieces), 3, texts).log_sums(language_id._scaled(probability, lengths))
    assert np.allclose(np.exp(found[:, 0]), [brute(t) for t in texts])


def test_long_words_keep_their_sums_and_shares():
    pieces = {p: i for i, p in enumerate(["▁", "a", "b", "ab", "ba"])}
    probability = np.array([[1, 2], [1, 3], [4, 1], [2, 2], [1, 5], [1, 1]]) / 1e5
    lengths = np.array([*map(len, pieces), 1])
    weight = language_id._scaled(probability, lengths)
    texts = ["▁" + "ab" * 400, "▁" + "ba" * 137 + "日" * 300, "▁ab"]
    lattice = language_id.Lattice(language_id.with_beginnings(pieces), 2, texts)
    assert not lattice.plain(weight)

    def brute(text, own):
        """The logarithm of the sum and the expected pieces, rescaled by hand at every place."""
        last, here, scale = 0.0, 1.0, 0.0
        for n in range(1, len(text) + 1):
            one = own[pieces.get(text[n - 1], 5)] * here
            two = own[pieces[text[n - 2 : n]]] * last if text[n - 2 : n] in pieces and n > 1 else 0.0
            total = one + two
            last, here, scale = here / total, 1.0, scale + math.log(total)
        return scale

    expected = [[brute(t, probability[:, k]) for k in range(2)] for t in texts]
    assert np.allclose(lattice.log_sums(weight), expected)
    # Every character stands in one piece, so pieces times lengths give the text back.
    shares = lattice.expected(weight, np.ones((3, 2)))
    assert np.allclose(lengths @ shares, sum(map(len, texts)))
    short = language_id.Lattice(language_id.with_beginnings(pieces), 2, texts[2:])
    assert short.plain(weight)
    assert np.allclose(np.exp(short.log_forward(weight)), short.forward(weight))
    assert np.allclose(np.exp(short.log_backward(weight)), short.backward(weight))


def test_languages_are_told_apart(spark):
    english, german = "the quick brown fox jumps over the lazy dog and runs", "der schnelle braune fuchs springt über den hund"
    texts, langs = [], {}
    for i in range(80):
        own = (english, german)[i % 2].split()
        texts.append((i, " ".join(own[(i * k) % len(own)] for k in range(1, 30))))
        langs[i] = ("en", "de")[i % 2]
    texts += [(100, None), (101, "12 34 !"), (102, "")]
    langs |= {100: None, 101: "en", 102: None}
    docs = table(spark, texts, langs)
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    found = {r.doc_id: r for r in language_id.predict_languages(docs, vocabulary(), held).collect()}
    assert all(found[i].lang_pred == langs[i] and 0 <= found[i].score <= 1 for i in range(80))
    assert {found[i].lang_pred for i in (100, 101, 102)} == {"und"} and sum(r.held_out for r in found.values()) > 5


# Licences


def test_licences_are_found_in_lines_and_whole_texts(spark):
    mit = license_scan.TEMPLATES["MIT text"]
    docs = table(spark, [(1, "some words\nReleased under the MIT License.\nmore"), (2, mit.upper()), (3, mit + " x" * 400),
                         (4, None), (5, ""), (6, "Released under the other terms")])
    got = collected(license_scan.scan(docs), "doc_id", "unit", "license", "dice")
    # Repeats within a text make no further bigrams: document 3 still matches.
    assert [g[:3] for g in got] == [(1, 2, "MIT"), (2, 0, "MIT text"), (3, 0, "MIT text")]
    assert got[0][3] == got[1][3] == 1.0 > got[2][3] > 0.9


# Neighbours


def test_neighbours_recall_ties_and_bad_vectors(spark):
    rng = np.random.default_rng(2)
    vectors = rng.normal(size=(1500, 16)).astype(np.float32)
    vectors[700:760] = vectors[100]
    rows = [(i, v.tolist(), 0) for i, v in enumerate(vectors)]
    rows += [(3000, None, 0), (3100, [0.0] * 16, 0), (3200, [float("nan")] * 16, 0), (3300, [None] * 16, 0), (None, [1.0] * 16, 0), (3400, [1.0], 0)]
    df = spark.createDataFrame(rows, "vec_id LONG, embedding ARRAY<FLOAT>, label INT")
    found = hash_forest.neighbours_of(df, every=100, block_size=600).toPandas()
    wide = vectors.astype(np.float64)
    hits = 0
    for query, own in found.groupby("query_id"):
        own = own.sort_values("rank")
        distance = np.sqrt(((wide - wide[query]) ** 2).sum(axis=1))
        assert np.allclose(distance[own.vec_id], own.score) and own["rank"].tolist() == list(range(1, 11))
        best = [i for i in np.lexsort((np.arange(len(wide)), distance)) if i != query][:10]
        hits += len(set(best) & set(own.vec_id))
    assert sorted(found.query_id.unique()) == list(range(0, 1500, 100)) and hits >= 0.9 * len(found)
    assert found[found.query_id == 100].sort_values("rank").vec_id.tolist() == list(range(700, 710))


# Packing


def test_packing_keeps_words_limits_and_conflicts(odd):
    for capacity, shard_size in ((50, 8192), (7, 5)):
        packed = best_fit_packing.pack_documents(odd, capacity, shard_size).toPandas()
        assert packed.n_words.sum() == sum(len(words_of(r.text)) for r in odd.collect())
        assert packed.groupby("bin_id").n_words.sum().max() <= capacity
        known = packed[packed.cluster.notna()]
        assert not known.duplicated(["bin_id", "cluster"]).any() and not packed.duplicated(["bin_id", "source"]).any()
        assert not packed.duplicated(["bin_id", "place"]).any()


def test_the_tightest_compatible_bin_is_taken():
    bins = best_fit_packing.Bins(10)
    assert bins.put(7, 1, 1)[0] == 0 and bins.put(6, 2, 2)[0] == 1
    assert bins.put(3, 1, 4)[0] == 1  # bin 0 is tighter but holds the source
    assert bins.put(3, 2, 8)[0] == 0 and bins.put(1, 4, 1)[0] == 1


# Empty tables


def test_empty_tables_give_empty_results(spark, odd):
    none = odd.limit(0)
    labels = spark.createDataFrame([], "doc_id LONG, quality INT, toxic INT")
    model = vocabulary()
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    vectors = spark.createDataFrame([], "vec_id LONG, embedding ARRAY<FLOAT>, label INT")
    for empty in (
        quality_rules.judge(none, labels),
        context_mixing.score_texts(none, held, F.col("lang")),
        line_dedup.count_deleted(none),
        license_scan.scan(none),
        substring_dedup.count_repeats(none),
        simhash_dedup.near_duplicates(none),
        hash_forest.neighbours_of(vectors, every=100),
        sentencepiece_codec.round_trips(none, model),
        language_id.predict_languages(none, model, held),
        best_fit_packing.pack_documents(none),
    ):
        assert empty.collect() == []
