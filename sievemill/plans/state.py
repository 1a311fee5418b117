"""Run folders and resumable state: completed stages and keys, counts, failures and outputs."""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievemill.sources.shared_tables import exists, make_folder, read_saved, remove, write_text

#: Failures that the state lists; all of them are in the table beside the answers.
LISTED = 100


class Paused(RuntimeError):
    """A stage has not done all of its rows; the same run goes on when it is resumed."""


class NotEnabled(ValueError):
    """A stage is needed that the run may not do and has not done."""

    def __init__(self, stage: str):
        super().__init__(f"stage {stage} is needed but neither enabled nor complete")
        self.stage = stage


def now() -> str:
    return time.strftime("%Y-%m-%dT%H:%M:%S")


def new_run_id() -> str:
    return time.strftime("run_%Y%m%d_%H%M%S")


def _session() -> SparkSession:
    return SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()


@dataclass
class RunState:
    """Small state of a run, kept by the driver in whatever file system the run's folder is; keys of rows live in tables beside it.
    Saved by writing a new file and putting it in the old one's place."""

    path: str
    completed_stages: list[str] = field(default_factory=list)
    counts: dict[str, int] = field(default_factory=dict)
    failures: list[dict] = field(default_factory=list)
    output_paths: dict[str, str] = field(default_factory=dict)
    config: dict = field(default_factory=dict)
    current_stage: str = ""
    updated_at: str = ""

    @classmethod
    def open(cls, folder: str, resume: bool, config: dict | None = None) -> RunState:
        """A new run folder, or an earlier one to go on with. An existing folder is an error unless resumed, and so is another policy
        version than the run began with."""
        path = f"{folder.rstrip('/')}/state.json"
        saved = read_saved(_session(), path)
        if saved is not None:
            if not resume:
                raise FileExistsError(f"run exists: {folder}")
            state = cls(path=path, **json.loads(saved))
            for key in ("policy_version",):
                if config and key in config and state.config.get(key) not in (None, config[key]):
                    raise ValueError(f"{key} is {state.config[key]} in this run, not {config[key]}")
            return state
        make_folder(_session(), folder)
        state = cls(path=path, config=config or {})
        state.save()
        return state

    def save(self) -> None:
        self.updated_at = now()
        rest = {k: v for k, v in self.__dict__.items() if k != "path"}
        write_text(_session(), self.path, json.dumps(rest, indent=1, ensure_ascii=False))

    def record_failures(self, stage: str, failed: DataFrame) -> int:
        """Note the first failed ``key, error`` rows of a stage in place of what was noted of it before; how many failed. They are not
        complete, so the next run tries them again."""
        listed = failed.orderBy("key").limit(LISTED).collect()
        self.failures = [f for f in self.failures if f["stage"] != stage] + [{"stage": stage, "key": r.key, "error": r.error, "at": now()} for r in listed]
        n = failed.count() if len(listed) == LISTED else len(listed)
        self.counts[f"{stage}_failed"] = n
        self.save()
        return n

    def failed(self, stage: str) -> bool:
        return any(f["stage"] == stage for f in self.failures)

    def complete(self, stage: str, count: int, path: str) -> None:
        if stage not in self.completed_stages:
            self.completed_stages.append(stage)
        self.counts[stage], self.output_paths[stage] = count, path
        self.save()


class Stages:
    """Memoized stages: each is computed, written and counted once for a run."""

    def __init__(self, spark: SparkSession, folder: str, resume: bool = False, config: dict | None = None, enabled: list[str] | None = None):
        self.spark, self.folder, self.enabled = spark, folder.rstrip("/"), enabled
        self.state = RunState.open(folder, resume, config)
        self.anew = False

    def _begin(self, name: str) -> DataFrame | None:
        """The stage's table if it stands and nothing before it was done anew."""
        state = self.state
        path = state.output_paths.get(name)
        if not self.anew and name in state.completed_stages and not state.failed(name) and path and exists(self.spark, path):
            return self.spark.read.parquet(path)
        if self.enabled is not None and name not in self.enabled:
            raise NotEnabled(name)
        state.current_stage = name
        return None

    def run(self, name: str, compute: Callable[[], DataFrame]) -> DataFrame:
        done = self._begin(name)
        if done is not None:
            return done
        path = f"{self.folder}/{name}"
        compute().write.mode("overwrite").parquet(path)
        out = self.spark.read.parquet(path)
        self.state.complete(name, out.count(), path)
        return out

    def answer(self, name: str, rows: DataFrame, key: str, work: Callable[[DataFrame], DataFrame], most: int | None = None, order: str | None = None) -> DataFrame:
        """A stage of ``resume_map``: keys that fail are noted and come again when the run is resumed; while keys are left that were
        not tried yet, the run pauses here."""
        done = self._begin(name)
        if done is not None:
            return in_order(done, rows, key, order)
        path = f"{self.folder}/{name}"
        before = self.state.counts.get(name)
        out = resume_map(rows, key, path, work, most, order)
        n, targets = out.count(), rows.select(key).distinct().count()
        n_failed = self.state.record_failures(name, failures(self.spark, path))
        self.state.counts[name], self.state.counts[f"{name}_targets"] = n, targets
        self.anew = self.anew or before not in (None, n)
        if n + n_failed < targets:
            self.state.save()
            raise Paused(f"{name}: {n} of {targets} rows are done; resume the same run to go on")
        self.state.complete(name, n, path)
        return out


def failures(spark: SparkSession, done_path: str) -> DataFrame:
    """``key, error`` of the rows that failed when ``resume_map`` last ran."""
    return spark.read.schema("key string, error string").parquet(f"{done_path}.failed")


def in_order(done: DataFrame, rows: DataFrame, key: str, order: str | None) -> DataFrame:
    return done.join(rows.select(key, order), key).orderBy(order) if order else done


def resume_map(rows: DataFrame, key: str, done_path: str, work: Callable[[DataFrame], DataFrame], most: int | None = None, order: str | None = None) -> DataFrame:
    """Do what is not done yet, at most ``most`` rows this time, append it to the checkpoint table and give all that is done in the order
    of ``rows``. Rows with an ``error`` are not kept and come again; they are listed beside the table."""
    spark = rows.sparkSession
    done = spark.read.parquet(done_path) if exists(spark, done_path) else None
    todo = rows if done is None else rows.join(done.select(key).distinct(), key, "left_anti")
    if most is not None:
        todo = (todo.orderBy(order) if order else todo).limit(most)
    made = work(todo)
    failed_path, made_path = f"{done_path}.failed", f"{done_path}.made"
    if "error" in made.columns:
        # services are asked once: what they said is written before it is parted
        made.write.mode("overwrite").parquet(made_path)
        made = spark.read.schema(made.schema).parquet(made_path)
        bad = F.coalesce("error", F.lit("")) != ""
        made.filter(bad).select(F.col(key).cast("string").alias("key"), "error").write.mode("overwrite").parquet(failed_path)
        made = made.filter(~bad).drop("error")
    else:
        spark.createDataFrame([], "key string, error string").write.mode("overwrite").parquet(failed_path)
    made.write.mode("append").parquet(done_path)
    remove(spark, made_path)
    return in_order(spark.read.parquet(done_path), rows, key, order)
