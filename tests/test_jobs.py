from __future__ import annotations

import json
import time

import pytest

import viewrank.__main__
from viewrank.__main__ import main
from viewrank.session import new_work_folder, shared_folder
from viewrank.sources.store import TierStore

BODIES = [
    '{"videoId": "film_7", "timestamp": "2023-03-09T08:15:00"}',
    '{"videoId": "film_7", "timestamp": "2023-03-09T08:16:00"}',
    '{"videoId": "film_2", "timestamp": "2023-03-09T07:41:00"}',
    '{"videoId": "", "timestamp": "2023-03-09T07:41:00"}',
]


def test_jobs_from_request_to_response(spark, capsys):
    folder = new_work_folder(spark, "jobs")
    store = ["--store", f"{folder}/store"]
    spark.createDataFrame([(b,) for b in BODIES], "value STRING").write.text(f"{folder}/in")
    main(["count", *store, "--path", f"{folder}/in", "--once", "--as-of", "2023-03-09T08:20:00"])

    def answer(timeframe):
        main(["top", *store, "--timeframe", timeframe, "--k", "5"])
        return json.loads(capsys.readouterr().out)

    both = [{"video_id": "film_7", "count": 2}, {"video_id": "film_2", "count": 1}]
    assert answer("last day") == {"timeframe": "last day", "k": 5, "videos": both}
    main(["maintain", *store, "--as-of", "2023-03-10T08:05:00"])
    assert answer("last day")["videos"] == both[:1]
    main(["refresh", *store, "--as-of", "2023-03-11T08:05:00"])
    assert answer("last day")["videos"] == []
    assert answer("all time")["videos"] == both
    with pytest.raises(ValueError):
        main(["top", *store, "--timeframe", "last week", "--k", "5"])


def test_work_folders_lie_in_the_named_shared_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark) == named
    first, second = new_work_folder(spark, "x"), new_work_folder(spark, "x")
    assert first != second and first.startswith(f"{named}/viewrank/x-")


def test_counting_does_not_wait_for_answers(spark, monkeypatch):
    """The first refresh lasts until all files are counted, one failing refresh changes nothing."""
    folder = new_work_folder(spark, "beside")
    for body in BODIES[:3]:
        spark.createDataFrame([(body,)], "value STRING").coalesce(1).write.mode("append").text(f"{folder}/in")
    waited, refresh = [], viewrank.__main__.refresh_snapshot

    def slow(store, clock):
        until = time.monotonic() + 120
        while not waited and len(store.batches()) < 3 and time.monotonic() < until:
            time.sleep(0.2)
        waited.append(len(store.batches()))
        if len(waited) == 1:
            raise RuntimeError("answers failed")
        return refresh(store, clock)

    monkeypatch.setattr(viewrank.__main__, "refresh_snapshot", slow)
    main(["count", "--store", f"{folder}/store", "--path", f"{folder}/in", "--once", "--refresh-every", "0.1",
          "--as-of", "2023-03-09T08:20:00", "--option", "maxFilesPerTrigger=1"])
    assert waited[0] == waited[-1] == 3 and len(waited) > 1
    store = TierStore(spark, f"{folder}/store")
    assert store.snapshot().filter("timeframe = 'all time' AND rank = 1 AND count = 2").count() == 1
