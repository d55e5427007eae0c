"""Tables that grow by runs: each run writes its own part of every table, and one commit makes all of them count at once."""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class RunConflict(RuntimeError):
    """Another run was committed since this one began."""


@dataclass(frozen=True)
class Run:
    """A run that has begun: its number among the committed ones, and the name of its parts."""

    number: int
    name: str


class Runs:
    """Parts of tables at ``folder/table/run=name``; a run counts once ``folder/commits/number.json`` is there.

    The commit file is written aside and renamed, which fails if the number is taken: of runs that overlap one is
    committed, the other gets RunConflict. Parts without a commit, of a run that was killed, are never read.
    """

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")
        self.jvm = spark.sparkContext._jvm

    def _path(self, name: str) -> object:
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")

    def _system(self) -> object:
        return self._path("commits").getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def commits(self) -> list[dict]:
        """The commits in order, one for each run since the last compaction: number, name, source, tables, replaces."""
        if not self._system().exists(self._path("commits")):
            return []
        schema = "number long, name string, source string, tables array<string>, replaces array<string>"
        rows = self.spark.read.schema(schema).option("pathGlobFilter", "*.json").json(f"{self.folder}/commits").collect()
        rows = sorted((r.asDict() for r in rows if r.name is not None), key=lambda r: r["number"])
        gone = {name for r in rows for name in r["replaces"] or []}
        return [r for r in rows if r["name"] not in gone]

    def has(self, source: str) -> bool:
        """Whether a committed run came from ``source``, such as a stream's batch."""
        if not self._system().exists(self._path("commits")):
            return False
        return not self.spark.read.schema("source string").option("pathGlobFilter", "*.json").json(f"{self.folder}/commits").where(F.col("source") == source).isEmpty()

    def begin(self) -> Run:
        number = max((r["number"] for r in self.commits()), default=0) + 1
        return Run(number, f"{number:010d}-{uuid.uuid4().hex[:12]}")

    def part(self, run: Run, table: str) -> str:
        """Where the run's part of a table goes."""
        return f"{self.folder}/{table}/run={run.name}"

    def commit(self, run: Run, tables: list[str], source: str | None = None, replaces: list[str] | None = None) -> None:
        """Make the run's parts of ``tables`` count, and those of the runs it ``replaces`` no more."""
        body = json.dumps({"number": run.number, "name": run.name, "source": source, "tables": tables, "replaces": replaces or []})
        system, aside, final = self._system(), self._path(f"commits/.{run.name}"), self._path(f"commits/{run.number:010d}.json")
        out = system.create(aside, True)
        out.write(bytearray(body.encode()))
        out.close()
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(aside.toUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        kind = getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename")
        never_over = self.spark.sparkContext._gateway.new_array(kind, 1)
        never_over[0] = kind.NONE
        try:
            context.rename(aside, final, never_over)
        except Py4JJavaError as problem:
            system.delete(aside, False)
            if "FileAlreadyExistsException" in str(problem.java_exception):
                raise RunConflict(f"run {run.number} of {self.folder} was committed by another") from problem
            raise

    def table(self, table: str, schema: str | None = None) -> DataFrame | None:
        """All committed parts of a table with the column ``run``; None where no run has one."""
        parts = [f"{self.folder}/{table}/run={r['name']}" for r in self.commits() if table in r["tables"]]
        if not parts:
            return None
        reader = self.spark.read.option("basePath", f"{self.folder}/{table}")
        df = (reader.schema(f"{schema}, run string") if schema else reader).parquet(*parts)
        return df.withColumn("run", F.col("run").cast("string"))

    def latest(self, table: str, key: list[str], schema: str | None = None) -> DataFrame | None:
        """Of the rows with one key that of the latest run: a maximum with map-side combine, whatever a key's rows.

        A run has one row for each key; the row's columns come without ``run``.
        """
        rows = self.table(table, schema)
        if rows is None:
            return None
        columns = [c for c in rows.columns if c != "run"]
        return rows.groupBy(*key).agg(F.max_by(F.struct(*columns), "run").alias("_row")).select("_row.*")

    def compact(self, keys: dict[str, list[str]]) -> Run | None:
        """One run with the latest rows of each table (name: key) instead of all runs so far; None where there is none.

        Parts that were replaced stay for readers that have begun, until ``sweep``.
        """
        before = self.commits()
        if not before:
            return None
        run, made = self.begin(), []
        for table, key in keys.items():
            rows = self.latest(table, key)
            if rows is not None:
                rows.write.parquet(self.part(run, table))
                made.append(table)
        self.commit(run, made, replaces=[r["name"] for r in before])
        return run

    def sweep(self) -> list[str]:
        """Delete parts that no commit in force has, as of killed and replaced runs; call it while none is under way."""
        system = self._system()
        keep = {f"run={r['name']}" for r in self.commits()}
        gone = []
        for found in system.globStatus(self._path("*/run=*")) or []:
            path = found.getPath()
            if path.getName() not in keep:
                system.delete(path, True)
                gone.append(f"{path.getParent().getName()}/{path.getName()}")
        return sorted(gone)
