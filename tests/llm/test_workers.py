"""Tasks run where workers have no copy of the package: it is on the driver's path only."""

from __future__ import annotations

import os
import subprocess
import sys
from pathlib import Path

SCRIPT = """
import sys
from pyspark.sql import functions as F
sys.path.insert(0, sys.argv[1])
from viewrank.session import build_session
from viewrank.llm import context_mixing, language_id, sentencepiece_codec
from viewrank.llm.queries import vocabulary

spark = build_session("bare", "local[2]", spark__ui__enabled="false", spark__sql__shuffle__partitions="2",
                      spark__checkpoint__dir=sys.argv[2])
def asks(batches):
    try:
        import viewrank
        there = True
    except ImportError:
        there = False
    for _ in batches:
        pass
    import pyarrow as pa
    yield pa.RecordBatch.from_pydict({"there": [there]})
assert not any(r.there for r in spark.range(1).mapInArrow(asks, "there boolean").collect())
docs = spark.createDataFrame([(i, ("the dog runs", "der hund läuft")[i % 2], ("en", "de")[i % 2]) for i in range(12)],
                             "doc_id LONG, text STRING, lang STRING")
held = F.col("doc_id") > 9
assert all(r.round_trip for r in sentencepiece_codec.round_trips(docs, vocabulary()).collect())
encoded = sentencepiece_codec.encode(docs, vocabulary())
assert sentencepiece_codec.decode(encoded, vocabulary()).join(docs, ["doc_id", "text"]).count() == 12
assert [r.lang_pred for r in language_id.predict_languages(docs, vocabulary(), held).orderBy("doc_id").collect()] == ["en", "de"] * 6
assert context_mixing.score_texts(docs, held, F.col("lang")).count() == 12
print("done")
"""


def test_workers_need_no_copy_of_the_package(tmp_path):
    script, shared = tmp_path / "bare.py", tmp_path / "shared"
    script.write_text(SCRIPT)
    shared.mkdir()
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    root = str(Path(__file__).resolve().parents[2])
    ran = subprocess.run(
        [sys.executable, str(script), root, str(shared)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300
    )
    assert ran.returncode == 0 and ran.stdout.endswith("done\n"), ran.stderr[-3000:]
