"""Filter audit, embedding whitening and fingerprints against plain Python."""

from __future__ import annotations

import hashlib
from collections import Counter
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from viewrank.llm import feast_whitening, filter_audit, weighted_fingerprints
from viewrank.llm.weighted_fingerprints import Sampler

SCHEMA = "doc_id LONG, text STRING, lang STRING, part STRING, mask INT, n LONG"


def documents(spark, rows):
    """Documents with further columns whose names the operator uses inside."""
    return spark.createDataFrame([(i, text, lang, "own", 7, 9) for i, text, lang in rows], SCHEMA)


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id LONG, quality INT, toxic INT, extra STRING")


# Filter audit


def brute_audit(rows, named):
    """Every document walks along every order."""
    out = Counter()
    parts = {lang or "" for _, _, lang in rows}
    orders = ["".join(o) for o in permutations("ABCDE")]
    for i, text, lang in rows:
        text, part = text or "", lang or ""
        words = text.encode().split()
        alike = [j for j, t, _ in rows if (t or "") == text and j is not None]
        fails = {
            "A": len(words) < 100,
            "B": 100 * len(set(words)) < 80 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text),
            "D": any(c in "#$%&*|" for c in text),
            "E": i is not None and min(alike) < i,
        }
        good = any(j == i and j is not None and q == 1 for j, q, _, _ in named)
        toxic = any(j == i and j is not None and t == 1 for j, _, t, _ in named)
        for order in orders:
            gone = False
            for step, letter in enumerate(order, 1):
                key = (part, order, step)
                out[key, "kept"] += not gone and not fails[letter]
                out[key, "redundant"] += fails[letter] and gone
                out[key, "unique_fails"] += fails[letter] and sum(fails.values()) == 1
                if fails[letter] and not gone:
                    out[key, "removed"] += 1
                    out[key, "good_lost"] += good
                    out[key, "toxic_lost"] += toxic
                    out[part, letter] += 1
                    gone = True
    return sorted(
        (part, order, step, *(out[(part, order, step), c] for c in filter_audit.COUNTS), out[part, order[step - 1]])
        for part in parts
        for order in orders
        for step in range(1, 6)
    )


LONG = " ".join(f"w{i}" for i in range(120))
ODD = [
    (1, LONG, "en"), (2, LONG, "en"), (2, LONG, "en"), (3, LONG, None), (4, None, None), (5, "", ""),
    (None, LONG, "de"), (None, None, "de"), (6, "AB c", "en"), (7, "a # b", "fr"), (8, "x " * 200, "fr"),
    (9, f"{LONG} $", "en"), (9, "other", "en"), (10, "ÄÖ é日本\u00a0x", "de"), (1, LONG, "fr"), (11, "  \t\n ", "en"),
    (12, "y" * 300_000, "en"), (13, "Z " * 400_000, "en"),
]
NAMED = [(1, 1, 0, "x"), (1, 0, 1, "x"), (2, 0, 1, "x"), (3, None, None, "x"), (None, 1, 1, "x"), (9, 1, 1, "x"), (99, 1, 1, "x")]


@pytest.mark.parametrize("bytes_at_once", [filter_audit.BYTES_AT_ONCE, 3])
def test_words_are_counted_alike_in_pieces(monkeypatch, bytes_at_once):
    monkeypatch.setattr(filter_audit, "BYTES_AT_ONCE", bytes_at_once)
    for text in (b"", b"  ", b"a", b" a\x0bb  a\tcde ab ", b"abcdefgh abcdefgh x", b"\xc2\xa0a \x1cb"):
        words = text.split()
        assert filter_audit._counted_words(text) == (len(words), len(set(words)))


def test_audit_equals_walking_every_document_along_every_order(spark):
    got = filter_audit.audit(documents(spark, ODD), labels(spark, NAMED))
    assert got.columns == ["part", "filter_order", "step", *filter_audit.COUNTS, "shapley"]
    assert sorted(tuple(row) for row in got.collect()) == brute_audit(ODD, NAMED)


def test_audit_of_empty_tables(spark):
    assert filter_audit.audit(documents(spark, []), labels(spark, [])).collect() == []
    got = filter_audit.audit(documents(spark, ODD[:2]), labels(spark, []))
    assert sorted(tuple(row) for row in got.collect()) == brute_audit(ODD[:2], [])


# Document fingerprints


def marks_hex(text, samples=weighted_fingerprints.SAMPLES):
    return Sampler(samples).of([text.encode()])[0].astype(">u2").tobytes().hex()


def test_samples_agree_as_often_as_weights_overlap():
    rng, sampler = np.random.default_rng(1), Sampler(4096)
    for shared in (0.0, 0.3, 0.6, 0.9):
        words = [f"w{i}" for i in range(60)]
        own, other = rng.dirichlet(np.full(60, 0.3)), rng.dirichlet(np.full(60, 0.3))
        left = list(rng.choice(words, 300, p=own))
        right = list(rng.choice(words, 200, p=shared * own + (1 - shared) * other))
        a, b = Counter(left), Counter(right)
        jaccard = sum((a & b).values()) / sum((a | b).values())
        marks = sampler.of([" ".join(left).encode(), " ".join(right).encode()])
        error = (jaccard * (1 - jaccard) / 4096) ** 0.5
        assert abs((marks[0] == marks[1]).mean() - jaccard) < 5 * error


def test_samples_do_not_depend_on_how_texts_are_cut_up(monkeypatch):
    rng = np.random.default_rng(2)
    texts = [" ".join(rng.choice(list("abcdefgh"), n)).encode() for n in (0, 1, 5, 40, 300)]
    texts += [b"", b" \n ", " é日本 a\x0bb\u00a0c ".encode(), b"\t".join(texts), b"w" * 5000]
    whole = Sampler().of(texts)
    monkeypatch.setattr(weighted_fingerprints, "TERMS_AT_ONCE", 3)
    monkeypatch.setattr(weighted_fingerprints, "BYTES_AT_ONCE", 7)
    assert (Sampler().of(texts) == whole).all()
    assert (Sampler().of(texts[::-1]) == whole[::-1]).all() and not whole[[0, 5, 6]].any()
    # Words are all that counts, with their number.
    one, two, three = Sampler().of([b"a b  b", b"b\na b", b"a b"])
    assert (one == two).all() and (one != three).any()


def expected_neighbours(spark, rows):
    """Distinct documents in order, each with the next one, as many rows as it has."""
    times = Counter((i, text or "") for i, text in rows)
    order = spark.createDataFrame(list(times), "doc_id LONG, text STRING").select("doc_id", "text", F.xxhash64("text"))
    ordered = sorted(order.collect(), key=lambda row: (row[0] is None, row[0] or 0, row[2]))
    out = []
    for n, (doc_id, text, _) in enumerate(ordered):
        following = ordered[(n + 1) % len(ordered)][1]
        cut = len(text) // 4
        edited = text[: len(text) - cut] + following[:cut]
        marks = Sampler().of([text.encode(), edited.encode(), following.encode()])
        near = [float((marks[0] == marks[k]).mean()) for k in (1, 2)]
        row = (doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), marks_hex(text), marks_hex(edited), *near)
        out += [row] * times[doc_id, text]
    return sorted(out, key=repr)


NEIGHBOURS = [(i * 37 % 101, " ".join(f"w{i * j % 53}" for j in range(i + 1))) for i in range(60)]
NEIGHBOURS += [(7, None), (7, ""), (7, " \n"), (None, "no id here"), (None, "no id here"), (None, None), (3, "é日本語 Zeichen")]
NEIGHBOURS += [(50, "same row again and again")] * 1200 + [(51, "long " * 200_000), (-5, "word " * 3 + "x" * 100_000)]


@pytest.mark.parametrize("rows", [NEIGHBOURS, NEIGHBOURS[:1], [(1, None)] * 3, NEIGHBOURS[:2], NEIGHBOURS[57:66]])
def test_each_document_is_compared_with_its_edited_text_and_the_next(spark, rows):
    docs = spark.createDataFrame(
        [(i, text, "own", True, 1) for i, text in rows],
        "doc_id LONG, text STRING, text_hash STRING, follows BOOLEAN, range INT",
    ).repartition(5)
    got = weighted_fingerprints.with_neighbours(docs)
    columns = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    assert got.columns == columns
    assert sorted((tuple(row) for row in got.collect()), key=repr) == expected_neighbours(spark, rows)


def test_fingerprints_of_an_empty_table_and_their_likeness(spark):
    docs = spark.createDataFrame(NEIGHBOURS[:20], "doc_id LONG, text STRING")
    assert weighted_fingerprints.with_neighbours(docs.limit(0)).collect() == []
    signed = weighted_fingerprints.fingerprints(docs)
    assert {(r.doc_id, r.fingerprint) for r in signed.collect()} == {(i, marks_hex(t)) for i, t in NEIGHBOURS[:20]}
    both = weighted_fingerprints.with_neighbours(docs).withColumn(
        "again", weighted_fingerprints.likeness(F.col("fingerprint"), F.col("edited_fingerprint"))
    )
    assert all(row.again == row.near_edited for row in both.collect())


# Embedding whitening


def brute_whitened(rows, most):
    """`{vec_id: (n, deviation, [whitened up to sign])}` and the shares, from a full decomposition."""
    usable = [(i, v) for i, v in rows if v and all(c is not None and np.isfinite(c) for c in v)]
    lengths = Counter(len(v) for _, v in usable)
    length = max(lengths, key=lambda k: (lengths[k], k))
    usable = [(i, v) for i, v in usable if len(v) == length]
    x = [[int(np.floor(64 * np.float64(c))) + 1_000_000 for c in v] for _, v in usable]
    n, sums = len(x), [sum(column) for column in zip(*x)]
    deviations = [sum((n * c - s) ** 2 for c, s in zip(v, sums)) for v in x]
    centred = np.array([[(n * c - s) / n for c, s in zip(v, sums)] for v in x])
    covariance = centred.T @ centred / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:most], vectors[:, ::-1][:, :most]
    with np.errstate(divide="ignore", invalid="ignore"):
        whitened = centred @ vectors / np.sqrt(values)
    return usable, n, deviations, whitened, values / np.trace(covariance)


def whitening_rows(rng):
    rows = [(i, v.tolist()) for i, v in enumerate(rng.standard_normal((300, 40)) * np.linspace(1, 3, 40))]
    rows += [(400, None), (401, []), (402, [1.0] * 39 + [None]), (403, [float("nan")] * 40), (404, [float("inf")] * 40)]
    rows += [(405, [1.0, 2.0]), (0, rows[0][1]), (0, rows[0][1]), (None, [0.0] * 40), (406, [-0.0] * 40)]
    return rows


def test_whitened_rows_equal_a_full_decomposition(spark):
    rows = whitening_rows(np.random.default_rng(4))
    table = spark.createDataFrame(
        [(i, v, 1, "own") for i, v in rows], "vec_id LONG, embedding ARRAY<FLOAT>, n INT, component STRING"
    ).repartition(5)
    got = feast_whitening.whiten(table)
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    usable, n, deviations, whitened, shares = brute_whitened(
        [(i, v and [c if c is None else float(np.float32(c)) for c in v]) for i, v in rows], 32
    )
    found = sorted(((r.vec_id, r.component, r.n, r.deviation) for r in got.collect()), key=repr)
    assert found == sorted(
        ((i, k, n, d) for (i, _), d in zip(usable, deviations) for k in range(1, 33)), key=repr
    )
    assert len({r.identity_error for r in got.collect()}) == 1 and got.first().identity_error < 1e-10
    by_component = {k: {} for k in range(1, 33)}
    for r in got.collect():
        by_component[r.component][r.vec_id] = r.whitened
        assert abs(r.explained - shares[r.component - 1]) < 1e-12
    for k, own in by_component.items():
        expected = {i: w for (i, _), w in zip(usable, whitened[:, k - 1])}
        sign = np.sign(own[5] * expected[5])
        assert all(abs(own[i] - sign * expected[i]) < 1e-9 for i in expected)


@pytest.mark.parametrize("kind", ["random", "steep", "equal", "clusters", "low rank", "single", "tiny", "powers"])
def test_contours_find_the_largest_components_and_miss_none(kind):
    rng = np.random.default_rng(5)
    turn = np.linalg.qr(rng.standard_normal((30, 30)))[0]
    matrix = {
        "random": np.cov(rng.standard_normal((90, 64)).T),
        "steep": np.cov((rng.standard_normal((90, 64)) * np.logspace(0, -4, 64)).T),
        "equal": np.eye(20) * 3,
        "clusters": turn @ np.diag([5.0] * 10 + [5 + 1e-9] * 3 + [1.0] * 17) @ turn.T,
        "low rank": np.cov(rng.standard_normal((10, 40)).T),
        "single": np.array([[4.0]]),
        "tiny": np.eye(3) * 1e-30,
        "powers": turn @ np.diag(10.0 ** -np.arange(30)) @ turn.T,
    }[kind]
    matrix = (matrix + matrix.T) / 2
    parts = feast_whitening.intervals(matrix, 32)
    found = [feast_whitening.components(matrix, *part) for part in parts]
    assert [len(values) for values, _ in found] == [count for _, _, count in parts]
    values, vectors = feast_whitening.refined(matrix, np.hstack([vectors for _, vectors in found]))
    expected = np.linalg.eigvalsh(matrix)[::-1]
    assert len(values) >= min(32, len(matrix))
    assert np.abs(values - expected[: len(values)]).max() < 1e-13 * expected[0]
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-10
    assert np.abs(matrix @ vectors - vectors * values).max() < 1e-12 * expected[0]


def test_inertia_counts_eigenvalues():
    rng = np.random.default_rng(6)
    matrix = rng.standard_normal((25, 25))
    matrix += matrix.T
    values, inertia = np.linalg.eigvalsh(matrix), feast_whitening.Inertia(matrix)
    for shift in rng.uniform(values[0] - 1, values[-1] + 1, 50):
        assert inertia.above(shift) == (values >= shift).sum()


def test_large_entries_are_added_up_exactly(spark):
    rng = np.random.default_rng(7)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(rng.uniform(-(2**45), 2**45, (50, 3)))]
    rows += [(90, [2.0**60, 0.0, 0.0]), (91, [0.5, -0.5, 2.0**45])]
    got = feast_whitening.whiten(spark.createDataFrame(rows, "vec_id LONG, embedding ARRAY<DOUBLE>"))
    usable, n, _, whitened, shares = brute_whitened([row for row in rows if row[0] != 90], 32)
    assert got.count() == 51 * 3 and got.filter("deviation IS NOT NULL").count() == 0
    assert all(abs(r.explained - shares[r.component - 1]) < 1e-12 and r.n == n == 51 for r in got.collect())


def test_whitening_without_variance_or_rows(spark):
    schema = "vec_id LONG, embedding ARRAY<FLOAT>"
    for rows in ([], [(1, None)], [(1, []), (2, [float("nan")])]):
        assert feast_whitening.whiten(spark.createDataFrame(rows, schema)).collect() == []
    got = feast_whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0])] * 2, schema))
    assert sorted(tuple(r) for r in got.collect()) == [(1, k, 2, 0, None, 0.0, 0.0) for k in (1, 1, 2, 2)]
    flat = feast_whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [3.0, 2.0])], schema))
    rows = {(r.vec_id, r.component): (r.whitened, r.explained) for r in flat.collect()}
    assert sorted(rows[i, 1][0] for i in (1, 2)) == [-1, 1] and rows[1, 2] == rows[2, 2] == (None, 0.0)
