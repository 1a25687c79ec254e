"""The pipeline on a small folder, each stage held against a plain version on that stage's own input."""

from __future__ import annotations

import re
from collections import Counter

import corpus_pipeline
from viewrank.llm import line_dedup

PASSAGE = " ".join(f"p{i}" for i in range(50))
BLOCK = "a block of lines that\nstands in several documents here"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_stages_equal_plain_versions(spark, tmp_path):
    from test_operators import brute_components, brute_print  # beside this file

    own = {i: " ".join(f"d{i}w{j}" for j in range(40 + i)) for i in range(12)}
    texts = [*own.items(), (20, own[3]), (21, own[4]), (None, own[5]), (30, f"{own[0][::-1]}\n{BLOCK}"),
             (31, f"{BLOCK}\n{own[1][::-1]}"), (40, f"{own[6][::-1]} {PASSAGE}"), (41, f"{PASSAGE} {own[7][::-1]}"),
             (50, "too short"), (51, None), (52, "again and again " * 30)]
    rows = [(i, t, "en", f"s{n % 3}", len(t or "")) for n, (i, t) in enumerate(texts)]
    schema = "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id LONG, quality INT, toxic INT").write.parquet(f"{tmp_path}/labels.parquet")

    docs, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.kept_table(stage(spark, docs, str(tmp_path)), "tested")
        assert docs.columns == schema.replace("LONG", "").replace("STRING", "").replace(" ", "").split(",")
        seen[name] = sorted(((r.doc_id, r.text) for r in docs.collect()), key=repr)

    # Without labels only the base rules reject: short texts and those that repeat themselves.
    assert seen["quality rules"] == sorted((x for x in texts if x[0] not in (50, 51, 52)), key=repr)

    # Equal documents lose all their lines to the first; the block goes from the later of its two documents.
    before, after = seen["quality rules"], dict(seen["line dedup"])
    assert len(seen["line dedup"]) == len(before)
    assert after[30] == dict(before)[30] and after[31] == own[1][::-1] and after[20] == after[21] == ""
    assert {after[i] for i in own} >= {own[i] for i in own if i != 5} and line_dedup.MIN_WORDS <= len(words(BLOCK))

    # One document of each group, that with the smallest id.
    before = seen["line dedup"]
    tops = brute_components([brute_print(t) for _, t in before], 2)
    firsts = {}
    for row, top in zip(before, tops, strict=True):
        firsts[top] = min(firsts.get(top, row), row, key=lambda x: (x[0] is None, x[0] or 0))
    assert seen["SimHash near-dedup"] == sorted(firsts.values(), key=repr)

    # Words that a repeated window of 35 covers are gone.
    before = seen["SimHash near-dedup"]
    counted = Counter(tuple(w[i : i + 35]) for w in (words(t) for _, t in before) for i in range(len(w) - 34))
    expected = []
    for i, text in before:
        w = words(text)
        gone = {k for j in range(len(w) - 34) if counted[tuple(w[j : j + 35])] > 1 for k in range(j, j + 35)}
        expected.append((i, [x for k, x in enumerate(w) if k not in gone]))
    assert [(i, words(t)) for i, t in seen["substring dedup"]] == expected
    assert not any("p7" in w for _, w in expected)

    # Each document in one bin, no bin with two of one source; the run gives the same documents.
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).toPandas()
    assert sorted(zip(packed.doc_id, packed.n_words, strict=True)) == sorted((i, len(w)) for i, w in expected)
    assert not packed.duplicated(["bin_id", "source"]).any() and packed.groupby("bin_id").n_words.sum().max() <= 2048
    ran = corpus_pipeline.run(spark, str(tmp_path)).toPandas()
    assert sorted(zip(ran.doc_id, ran.n_words, strict=True)) == sorted(zip(packed.doc_id, packed.n_words, strict=True))
