"""Stage outputs kept as Parquet, so that a later run can start from them."""

from __future__ import annotations

import time
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from tablemend.sources.files import write_quarantine, write_tables


@dataclass(frozen=True)
class Stage:
    name: str
    mandatory: bool = False


STAGES = (
    Stage("EXTRACT", mandatory=True),
    Stage("NORMALIZE", mandatory=True),
    Stage("DEDUP"),
    Stage("INTEGRITY"),
    Stage("REDUCE"),
    Stage("JOIN"),
)


class MissingStageError(RuntimeError):
    """Tables were asked for that no earlier stage has kept."""


def shared_folder(spark: SparkSession) -> str:
    """A folder that driver and executors share: ``spark.checkpoint.dir``, or one in the warehouse where that is not set."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    return folder.rstrip("/")


_LOG_SCHEMA = "seq long, stage string, name string, path string"


class StageStore:
    """Tables by stage under one root.

    Every save writes to a new folder, ``{root}/{stage}/run-.../{table}``, and then
    adds a line per table to a log, a Parquet table in ``{root}/_log``. A table
    counts as kept once its line is there. So a failed save leaves the last good
    output in place, and results that were read earlier stay readable. What a
    later stage kept counts only if it is newer than what the stages before it
    kept of the table. Reading a table back also cuts its lineage. Folders that
    are no longer needed are the owner's to remove.
    """

    def __init__(self, spark: SparkSession, root: str, stages: Sequence[Stage] = STAGES):
        self.spark = spark
        self.root = root.rstrip("/")
        self.stages = tuple(stages)

    def _kept(self) -> dict[tuple[str, str], str]:
        """(stage, table) -> folder, for all that is kept and not outdated."""
        try:
            log = self.spark.read.schema(_LOG_SCHEMA).parquet(f"{self.root}/_log").collect()
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return {}
        latest = {(r["stage"], r["name"]): r for r in sorted(log, key=lambda r: r["seq"])}
        kept: dict[tuple[str, str], str] = {}
        newest: dict[str, int] = {}
        for stage in self.stages:
            for (_, name), r in latest.items():
                if r["stage"] == stage.name and r["seq"] > newest.get(name, -1):
                    newest[name] = r["seq"]
                    kept[stage.name, name] = r["path"]
        return kept

    def has(self, stage: str, table: str) -> bool:
        return (stage, table) in self._kept()

    def read(self, stage: str, table: str) -> DataFrame:
        kept = self._kept()
        if (stage, table) not in kept:
            raise MissingStageError(f"{stage} has not kept {table}")
        return self.spark.read.parquet(kept[stage, table])

    def save(self, stage: str, tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
        """Write the tables of a stage and return them as read back."""
        self._position(stage)
        seq = time.time_ns()
        folder = f"{self.root}/{stage}/run-{seq}-{uuid4().hex}"
        write_tables(tables, folder)
        lines = [(seq, stage, name, f"{folder}/{name}") for name in tables]
        if lines:
            log = self.spark.createDataFrame(lines, _LOG_SCHEMA)
            log.coalesce(1).write.mode("append").parquet(f"{self.root}/_log")
        # The schemas are known; giving them saves a look at the files' footers.
        return {name: self.spark.read.schema(df.schema).parquet(f"{folder}/{name}") for name, df in tables.items()}

    def save_quarantine(self, quarantine: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
        """Write the rows set aside, a folder per foreign key, and return them as read back."""
        root = f"{self.root}/quarantine/run-{time.time_ns()}-{uuid4().hex}"
        write_quarantine(quarantine, root)
        return {name: self.spark.read.schema(q.schema).parquet(f"{root}/{name}") for name, q in quarantine.items()}

    def restore(self, before: str, tables: Iterable[str]) -> dict[str, DataFrame]:
        """Each table from the latest stage before ``before`` that has it.

        The search goes back to the nearest mandatory stage and includes it.
        """
        wanted, kept = list(tables), self._kept()
        found: dict[str, DataFrame] = {}
        for stage in reversed(self.stages[: self._position(before)]):
            for name in wanted:
                if name not in found and (stage.name, name) in kept:
                    found[name] = self.spark.read.parquet(kept[stage.name, name])
            if stage.mandatory or len(found) == len(wanted):
                break
        missing = [n for n in wanted if n not in found]
        if missing:
            raise MissingStageError(f"no stage before {before} has kept: {', '.join(missing)}")
        return found

    def _position(self, stage: str) -> int:
        names = [s.name for s in self.stages]
        if stage not in names:
            raise ValueError(f"unknown stage {stage!r}; stages are {names}")
        return names.index(stage)
