"""Tiers on disk: a base version, the deltas that came after it, and the published answers.

Layout under one root, which must be a folder every executor reaches:

    checkpoint/                 the stream's own progress
    deltas/batch_id=N/          what micro-batch N counted: video_id, hour_bucket, count
    summaries/batch_id=N/       its most viewed ids, as a state that merges: state, views
    rejects/batch_id=N/         requests that micro-batch N refused: reason, body
    refused/v=N-<id>/parts.json the folders that hold what batches up to N refused, a folder per run and day:
    refused_runs/run=N-<id>/tier=refused/span=D/
    runs/run=N-<id>/tier=T/span=S/   folded rows of some batches, sorted by bucket and id (see `runs`)
    tops/run=N-<id>/            the first rows of that run's all-time counts
    base/v=N-<id>/parts.json    the folders that together hold all batches up to N
    snapshot/v=N-b<batch>-t<as_of>-<id>/   the top-K lists; the highest batch, then moment, wins

Every write goes to a directory of its own and becomes visible when the store has put its own marker
there, whatever markers Spark's writers leave; a write that is not visible afterwards is an error. A
replayed micro-batch overwrites its directory with the same rows, so it counts once; for that, one
stream writes a root. A new checkpoint on the same root goes on behind the batches that are there: its
first number lies in the checkpoint folder. Jobs that compact or publish at the same moment write
different directories, each complete in itself, and readers take one of them.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, replace
from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from viewrank.clock import Clock, day_text, hour_text
from viewrank.functions.buckets import day_of, month_of, wall_clock
from viewrank.operators.counting import Tiers, as_tier, fold
from viewrank.operators.ranking import CountedRuns, best_first
from viewrank.schema import BUCKET_COLUMN, SNAPSHOT, TIER_KEYS, TIER_SCHEMA
from viewrank.sources.runs import (
    FAN_OUT,
    LATER,
    Part,
    as_text,
    from_text,
    full_levels,
    keeps_from,
    retained,
    span_of,
    split_for_merge,
    within,
)

_REJECT_SCHEMA = StructType([StructField("reason", StringType()), StructField("body", StringType())])
_TEXT_COLUMNS = ("bucket", "video_id", "run", "tier", "span")
_RUN_SCHEMA = StructType(
    [*(StructField(name, StringType()) for name in _TEXT_COLUMNS), StructField("count", LongType())]
)
_REFUSED_SCHEMA = StructType(
    [*_REJECT_SCHEMA, StructField("batch_id", LongType()), StructField("span", StringType())]
)
# Rows of a run's list of the most viewed; MAX_K at least, more make its bound sharper.
TOP_ROWS = 1000


def _too_old(clock: Clock) -> Column:
    tier, bucket = F.col("tier"), F.col("bucket")
    old = [(tier == name) & (bucket < first) for name, first in keeps_from(clock).items()]
    return reduce(Column.__or__, old)


def _every_tier(hours: DataFrame, clock: Clock) -> DataFrame:
    """Hour rows as rows of every tier that keeps them, with their span: one scan for all tiers."""
    hour = F.col("hour_bucket")
    buckets = {"hour": hour, "day": day_of(hour), "month": month_of(hour), "all_time": F.lit("")}
    forms = [
        F.struct(F.lit(tier).alias("tier"), span_of(tier, bucket, clock).alias("span"), bucket.alias("bucket"))
        for tier, bucket in buckets.items()
    ]
    return hours.select(F.inline(F.array(*forms)), "video_id", "count").filter(~_too_old(clock))


def _tier_form(base: DataFrame, tier: str) -> DataFrame:
    """One tier of the base; the filter prunes the directories of the others."""
    rows = base.filter(F.col("tier") == tier)
    if tier in BUCKET_COLUMN:
        rows = rows.withColumnRenamed("bucket", BUCKET_COLUMN[tier])
    return rows.select(*TIER_SCHEMA[tier].names)


@dataclass(frozen=True)
class Base:
    """The folders of a version, what was counted while they were written, and what retention kept."""

    version: int
    parts: list[Part]
    told: dict
    keeps_from: dict[str, str]


@dataclass(frozen=True)
class Recent:
    """What the answers of a moment need: the last micro-batch that counts, hours, days, all-time counts."""

    batch_id: int
    hour: DataFrame
    day: DataFrame
    all_time: CountedRuns


# The marker of a complete directory; readers of Parquet pass over such names.
_COMPLETE = "_COMPLETE"
_PARTS = "parts.json"


def _numbered(paths) -> dict[int, str]:
    """N -> path for directories named `<key>=N` or `<key>=N-<id>`, ascending."""
    found = sorted((int(path.rsplit("=", 1)[1].split("-")[0]), path) for path in paths)
    return dict(found)


def _empty(spark: SparkSession, schema: StructType) -> DataFrame:
    """No rows, known to the optimizer, which then drops the union around it."""
    columns = [F.lit(None).cast(field.dataType).alias(field.name) for field in schema]
    return spark.range(0, 1, 1, 1).select(*columns).limit(0)


class TierStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.checkpoint = f"{self.root}/checkpoint"

    # Deltas

    def first_batch(self) -> int:
        """What is added to the batch numbers of the present checkpoint: fixed at its first start."""
        path, fs = self._path(f"{self.checkpoint}/first_batch")
        if fs.exists(path):
            stream = fs.open(path)
            try:
                return stream.readLong()
            finally:
                stream.close()
        offsets, _ = self._path(f"{self.checkpoint}/offsets")
        first = 0 if fs.exists(offsets) else max([self.base_version(), *self.batches()]) + 1
        stream = fs.create(path, False)
        stream.writeLong(first)
        stream.close()
        return first

    def write_summary(self, batch_id: int, summary: DataFrame) -> None:
        """The summary of a micro-batch's views (see `summaries`); to be written before its delta."""
        path = f"{self.root}/summaries/batch_id={batch_id}"
        summary.write.mode("overwrite").parquet(path)
        self._complete("summaries", path)

    def write_delta(self, batch_id: int, delta: DataFrame) -> None:
        path, seen = self._delta(batch_id), Observation()
        rows = delta.select(*TIER_SCHEMA["hour"].names)
        rows.observe(seen, F.sum("count").alias("views")).write.mode("overwrite").parquet(path)
        self._complete("deltas", path, {"views": seen.get["views"] or 0})

    def delta_is_empty(self, batch_id: int) -> bool:
        """As observed when it was written: no second read."""
        return not self._told(self._delta(batch_id))["views"]

    def write_rejects(
        self, batch_id: int, rejects: DataFrame, received: Callable[[], int] | None = None, day: str | None = None
    ) -> None:
        """Refused requests of a micro-batch, the number of all it `received`, and the day of its arrival.

        An empty batch leaves one small file, so that a replay replaces what it wrote before.
        """
        path, seen = f"{self.root}/rejects/batch_id={batch_id}", Observation()
        rejects.observe(seen, F.count(F.lit(1)).alias("refused")).write.mode("overwrite").parquet(path)
        told = {"refused": seen.get["refused"], "day": day or day_text(Clock.now().as_of)}
        self._complete("rejects", path, {**told, "received": received() if received else None})

    def rejects(self) -> DataFrame:
        """All refused requests: `reason, body`."""
        return self.dated_rejects().select("reason", "body")

    def dated_rejects(self) -> DataFrame:
        """`day, batch_id, reason, body`: the merged ones, of which a filter on the day reads its folders only,
        and those of batches since."""
        base, pending = self._refused()
        merged = self._refused_rows(base.parts).withColumnRenamed("span", "day")
        recent = self._pending_rejects(pending).withColumnRenamed("span", "day")
        return merged.unionByName(recent).select("day", "batch_id", "reason", "body")

    def merge_rejects(self, fan_out: int = FAN_OUT, keep_from: str | None = None) -> int:
        """Fold the folders of finished batches into folders per day, level by level; the last batch they hold.

        Rows keep the number of their batch, and batches up to the last one are no longer read, so a
        replayed batch counts once. Days before `keep_from` are left out, if it is given.
        """
        base, pending = self._refused()
        if not pending:
            return base.version
        first, last = min(pending), max(pending)
        parts = [p for p in base.parts if keep_from is None or p.span >= keep_from]
        parts += self._write_refused(self._pending_rejects(pending), 1, first, last, last)
        top = full_levels(parts, fan_out)
        if top:
            parts, rewrite, covered = split_for_merge(parts, top)
            if rewrite:
                parts += self._write_refused(self._refused_rows(rewrite), top + 1, *covered, last)
        told = self._sum_told([base.told, *map(self._told, pending.values())], "refused", "received")
        self._write_version("refused", last, as_text(parts, told, {}))
        return last

    def _refused(self) -> tuple[Base, dict[int, str]]:
        """The newest version of merged rejects, and the folders of the batches behind it."""
        batches, versions = self._finished("rejects"), self._finished("refused")
        version = max(versions, default=-1)
        return self._base(version, versions.get(version)), {b: path for b, path in batches.items() if b > version}

    def _pending_rejects(self, pending: dict[int, str]) -> DataFrame:
        if not pending:
            return _empty(self.spark, _REFUSED_SCHEMA)
        days = F.create_map(*[F.lit(x) for b, path in pending.items() for x in (b, self._told(path).get("day", ""))])
        schema = StructType([*_REJECT_SCHEMA, StructField("batch_id", LongType())])
        reader = self.spark.read.schema(schema).option("basePath", f"{self.root}/rejects")
        return reader.parquet(*pending.values()).withColumn("span", days[F.col("batch_id").cast("int")])

    def _refused_rows(self, parts: list[Part]) -> DataFrame:
        if not parts:
            return _empty(self.spark, _REFUSED_SCHEMA)
        folders = [f"{self.root}/refused_runs/{part.folder}" for part in parts]
        reader = self.spark.read.schema(_REFUSED_SCHEMA).option("basePath", f"{self.root}/refused_runs")
        return reader.parquet(*folders).select(*_REFUSED_SCHEMA.names)

    def _write_refused(self, rows: DataFrame, level: int, first: int, last: int, number: int) -> list[Part]:
        run = f"{number}-{uuid.uuid4().hex}"
        folder = f"{self.root}/refused_runs/run={run}"
        dated = rows.select("reason", "body", "batch_id", F.lit("refused").alias("tier"), "span")
        # Small days become one file, a day of many refused requests several.
        dated.hint("rebalance", "span").write.partitionBy("tier", "span").parquet(folder)
        return self._parts_in(folder, level, first, last, run)

    # What was observed in flight

    def observed(self) -> dict[str, int | None]:
        """`received`, `valid` and `refused` requests, from what batches observed when they were written.

        Reads no row: numbers lie beside deltas and rejects and are summed up when those are folded. `received` is
        null where a batch came as views, which nothing refuses.
        """
        base, batches = self._listing()
        refused, pending = self._refused()
        valid = self._sum_told([base.told, *(self._told(self._delta(b)) for b in batches)], "views")
        asked = self._sum_told([refused.told, *map(self._told, pending.values())], "refused", "received")
        return {"received": asked["received"], "valid": valid["views"], "refused": asked["refused"]}

    @staticmethod
    def _sum_told(told: list[dict], *names: str) -> dict:
        """Sums of what was told; null where any of the told numbers is."""
        out = {}
        for name in names:
            values = [one[name] for one in told if name in one]
            out[name] = None if None in values else sum(values)
        return out

    def batches(self) -> list[int]:
        """Finished micro-batches, ascending."""
        return list(self._finished("deltas"))

    def pending(self, base: int) -> list[int]:
        """Finished micro-batches that base version `base` does not hold."""
        return [b for b in self.batches() if b > base]

    def _delta_rows(self, batches: list[int]) -> DataFrame:
        schema = TIER_SCHEMA["hour"]
        if not batches:
            return _empty(self.spark, schema)
        return self.spark.read.schema(schema).parquet(*[self._delta(b) for b in batches])

    def _delta(self, batch_id: int) -> str:
        return f"{self.root}/deltas/batch_id={batch_id}"

    # Base versions

    def base_version(self) -> int:
        """Last micro-batch folded into the newest complete base, -1 before the first one."""
        return max(self._finished("base"), default=-1)

    def _base(self, version: int, path: str | None) -> Base:
        if path is None:
            return Base(version, [], {}, {})
        return Base(version, *from_text(self._read_text(f"{path}/{_PARTS}")))

    def _part_rows(self, parts: list[Part]) -> DataFrame:
        """Rows of the named folders: `bucket, video_id, run, tier, span, count`."""
        if not parts:
            return _empty(self.spark, _RUN_SCHEMA)
        folders = [f"{self.root}/runs/{part.folder}" for part in parts]
        return self.spark.read.schema(_RUN_SCHEMA).option("basePath", f"{self.root}/runs").parquet(*folders)

    def _tier_rows(self, base: Base, tier: str, low: str = "", high: str | None = None) -> DataFrame:
        """One tier of a base, of the folders that can hold buckets from `low` up to `high`."""
        parts = within(base.parts, tier, low, high)
        rows = self._part_rows(parts)
        if tier in base.keeps_from and any(part.span == LATER for part in parts):
            rows = rows.filter(F.col("bucket") >= base.keeps_from[tier])
        return _tier_form(rows, tier)

    def state(self) -> tuple[int, Tiers]:
        """The last micro-batch that counts (-1: none yet) and the tiers up to it.

        Base and pending deltas lie side by side: keys may repeat, readers sum them.
        """
        base, batches = self._listing()
        return max([base.version, *batches]), self._tiers(base, batches)

    def _listing(self) -> tuple[Base, list[int]]:
        """Newest base and the deltas behind it, each listed once.

        Deltas come first: what a compaction folds in between is then in the base that is seen.
        """
        deltas, bases = self._finished("deltas"), self._finished("base")
        version = max(bases, default=-1)
        return self._base(version, bases.get(version)), [b for b in deltas if b > version]

    def tiers(self) -> Tiers:
        return self.state()[1]

    def _tiers(self, base: Base, batches: list[int]) -> Tiers:
        deltas = self._delta_rows(batches)
        return Tiers(
            **{tier: self._tier_rows(base, tier).unionByName(as_tier(deltas, tier)) for tier in TIER_KEYS}
        )

    def recent(self, clock: Clock) -> Recent:
        """Of hours and days, only the folders that a timeframe can reach are listed and read."""
        base, batches = self._listing()
        deltas = self._delta_rows(batches)
        hours = self._tier_rows(base, "hour", hour_text(clock.last_day_start))
        days = self._tier_rows(base, "day", day_text(clock.last_month_start), day_text(clock.today_start))
        return Recent(
            max([base.version, *batches]),
            hours.unionByName(as_tier(deltas, "hour")),
            days.unionByName(as_tier(deltas, "day")),
            self._all_time_runs(base, batches),
        )

    def _all_time_runs(self, base: Base, batches: list[int]) -> CountedRuns:
        schema = TIER_SCHEMA["all_time"]
        parts = within(base.parts, "all_time")
        runs = [_tier_form(self._part_rows([part]), "all_time") for part in parts]
        tops = [f"{self.root}/tops/run={part.run}" for part in parts]
        known = self.spark.read.schema(schema).parquet(*tops) if tops else _empty(self.spark, schema)
        pending = as_tier(self._delta_rows(batches), "all_time") if batches else None
        summaries = self._finished("summaries")
        paths = [summaries[b] for b in batches if b in summaries]
        told = self.spark.read.parquet(*paths) if paths and len(paths) == len(batches) else None
        return CountedRuns(runs, known, pending, told)

    def tier(self, name: str) -> DataFrame:
        """One tier with one row per key."""
        return fold([getattr(self.tiers(), name)], name)

    def compact(self, clock: Clock, through: int | None = None, fan_out: int = FAN_OUT) -> int:
        """Fold pending deltas into a new base version, apply retention, and return its number.

        Each delta is folded into every tier once, so a late view reaches all of them and a
        repeated run has nothing left to add. The new version becomes visible with its list of folders,
        after all of them. Runs of a level that is not full are neither read nor written.
        """
        base, pending = self._listing()
        batches = [b for b in pending if through is None or b <= through]
        if not batches:
            return base.version
        last = batches[-1]
        deltas = _every_tier(self._delta_rows(batches), clock)
        parts = retained(base.parts, clock) + self._write_run(deltas, 1, batches[0], last, last)
        top = full_levels(parts, fan_out)
        if top:
            parts, rewrite, covered = split_for_merge(parts, top)
            if rewrite:
                rows = self._part_rows(rewrite).filter(~_too_old(clock))
                parts += self._write_run(rows, top + 1, *covered, last)
        told = self._sum_told([base.told, *(self._told(self._delta(b)) for b in batches)], "views")
        self._write_version("base", last, as_text(parts, told, keeps_from(clock)))
        return last

    def _write_version(self, folder: str, last: int, text: str) -> None:
        path = self._new_version(folder, str(last))
        self._write_text(f"{path}/{_PARTS}", text)
        self._complete(folder, path)

    def _parts_in(self, folder: str, level: int, first: int, last: int, run: str) -> list[Part]:
        found = [path.rsplit("/", 2)[1:] for path in self._folders(f"{folder}/tier=*/span=*")]
        return [Part(level, first, last, tier[len("tier=") :], span[len("span=") :], run) for tier, span in found]

    def _write_run(self, rows: DataFrame, level: int, first: int, last: int, number: int) -> list[Part]:
        """Fold rows (`tier, span, bucket, video_id, count`) into a run of its own; its parts."""
        run = f"{number}-{uuid.uuid4().hex}"
        folder = f"{self.root}/runs/run={run}"
        keys = ["tier", "span", "bucket", "video_id"]
        folded = rows.groupBy(*keys).agg(F.sum("count").alias("count"))
        # Without dealing by folder, every task would leave a file in every folder. Adaptive execution merges small
        # folders into a task and gives a large one several.
        dealt = folded.hint("rebalance", "tier", "span")
        # Sorted files let Parquet skip to a bucket, and within the all-time counts to an id.
        dealt.sortWithinPartitions(*keys).write.partitionBy("tier", "span").parquet(folder)
        parts = self._parts_in(folder, level, first, last, run)
        totals = within(parts, "all_time")
        if totals:
            best = _tier_form(self._part_rows(totals), "all_time").orderBy(*best_first()).limit(TOP_ROWS)
            best.write.parquet(f"{self.root}/tops/run={run}")
        return parts

    def clean_up(self, keep_snapshots: int = 10, grace: timedelta = timedelta(0)) -> None:
        """Drop deltas, bases, folders of runs and answers that were replaced at least `grace` ago.

        A reader that started before then must have ended.
        """
        self._drop_replaced("base", ("deltas", "summaries"), "runs", grace)
        self._drop_replaced("refused", ("rejects",), "refused_runs", grace)
        for path in self._answers()[:-keep_snapshots]:
            self._delete(path)

    def _drop_replaced(self, versions: str, batches: tuple[str, ...], runs: str, grace: timedelta) -> None:
        """Delete what the newest version that is at least `grace` old has replaced.

        A run numbered as that version or above may be in the making, so it stays.
        """
        found = self._finished(versions)
        settled = [v for v, path in found.items() if self._age(path) >= grace.total_seconds()]
        version = max(settled, default=-1)
        kept = {part for v, path in found.items() if v >= version for part in self._base(v, path).parts}
        used = {part.folder for part in kept}
        still = {runs: {part.run for part in kept}, "tops": {part.run for part in kept if part.tier == "all_time"}}

        def number(path: str, key: str) -> int:
            return int(path.rsplit(f"{key}=", 1)[1].split("-")[0])

        for folder in batches:
            for batch_id, path in self._finished(folder).items():
                if batch_id <= version:
                    self._delete(path)
        for path in self._complete_paths(versions):
            if number(path, "v") < version:
                self._delete(path)
        for path in self._folders(f"{self.root}/{runs}/run=*/tier=*/span=*"):
            if number(path, "run") < version and path.split(f"/{runs}/")[-1] not in used:
                self._delete(path)
        for folder in (runs, "tops") if runs == "runs" else (runs,):
            for path in self._folders(f"{self.root}/{folder}/run=*"):
                if number(path, "run") < version and path.rsplit("run=", 1)[1] not in still[folder]:
                    self._delete(path)

    # Published answers

    def publish(self, snapshot: DataFrame, clock: Clock, batch_id: int | None = None) -> int:
        """Write all timeframes as a new version: a list that became empty replaces the old one.

        The state an answer reflects decides which one is served, not the order of publishing. An
        answer without a batch counts as older than one with.
        """
        version = max(self._finished("snapshot"), default=-1) + 1
        rows = snapshot.withColumns(
            {
                "as_of": wall_clock(clock.as_of),
                "batch_id": F.lit(batch_id).cast("bigint"),
            }
        )
        rows = rows.select(*SNAPSHOT.names).coalesce(1)  # 4 x MAX_K rows at most
        state = f"b{0 if batch_id is None else batch_id + 1}-t{clock.as_of:%Y%m%dT%H%M%S%f}"
        path = self._new_version("snapshot", f"{version}-{state}")
        rows.write.parquet(path)
        self._complete("snapshot", path)
        return version

    def snapshot(self) -> DataFrame:
        """The answers of the newest state; no rows before anything was published."""
        answers = self._answers()
        if not answers:
            return _empty(self.spark, SNAPSHOT)
        return self.spark.read.schema(SNAPSHOT).parquet(answers[-1])

    def _answers(self) -> list[str]:
        """Complete answers by the state they reflect, then by the order of publishing."""

        def state(path: str) -> tuple:
            number, batch, moment, own = path.rsplit("v=", 1)[1].split("-", 3)
            return int(batch[1:]), moment, int(number), own

        return sorted(self._complete_paths("snapshot"), key=state)

    # Directories, through Hadoop so that any file system Spark can use works

    def _new_version(self, folder: str, number: str) -> str:
        return f"{self.root}/{folder}/v={number}-{uuid.uuid4().hex}"

    def _path(self, path: str):
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return path, path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _delete(self, path: str) -> None:
        path, fs = self._path(path)
        fs.delete(path, True)

    def _complete(self, folder: str, path: str, told: dict | None = None) -> None:
        """Make a written directory visible, and make sure that it is. The marker holds what was observed."""
        marker, fs = self._path(f"{path}/{_COMPLETE}")
        stream = fs.create(marker, True)
        stream.write(bytearray(json.dumps(told or {}).encode()))
        stream.close()
        listed = {p.rsplit("/", 1)[1] for p in self._complete_paths(folder)}
        if path.rsplit("/", 1)[1] not in listed:
            raise RuntimeError(f"{path} was written but cannot be listed")

    def _told(self, path: str) -> dict:
        return json.loads(self._read_text(f"{path}/{_COMPLETE}"))

    def _folders(self, pattern: str) -> list[str]:
        path, fs = self._path(pattern)
        return sorted(status.getPath().toString() for status in fs.globStatus(path) or [])

    def _write_text(self, path: str, text: str) -> None:
        path, fs = self._path(path)
        stream = fs.create(path, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def _read_text(self, path: str) -> str:
        path, fs = self._path(path)
        stream = fs.open(path)
        try:
            return self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _age(self, path: str) -> float:
        """Seconds since a directory became visible."""
        marker, fs = self._path(f"{path}/{_COMPLETE}")
        return time.time() - fs.getFileStatus(marker).getModificationTime() / 1000

    def _complete_paths(self, folder: str) -> list[str]:
        path, fs = self._path(f"{self.root}/{folder}/*=*/{_COMPLETE}")
        return [status.getPath().getParent().toString() for status in fs.globStatus(path)]

    def _finished(self, folder: str) -> dict[int, str]:
        """Number -> path of the complete directories in a folder, ascending."""
        return _numbered(self._complete_paths(folder))
