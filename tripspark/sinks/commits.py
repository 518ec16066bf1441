"""Tables of files that belong together: what a run writes becomes visible as a whole, or not at all.

A run writes each of its tables to a folder of its own and then commits: one small file that names the folders that count from
now on. Readers go by the newest such file, so what a stopped run has left is not seen, and a run that is done again after its
commit changes nothing. A commit may also take folders out, for compaction; they stay on disk until `clear`, so readers that
have begun can end.

One writer at a time: commits are numbered, and a number that exists already is an error.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


@dataclass(frozen=True)
class Folder:
    """Rows of one table: where they are, which run wrote them, and what part of the table they are."""

    table: str
    path: str
    run: int
    part: str = ""
    base: bool = False  # made from earlier folders of its part


@dataclass
class State:
    number: int = 0
    runs: dict[str, int] = field(default_factory=dict)  # job -> its last run
    folders: list[Folder] = field(default_factory=list)
    notes: dict[str, list] = field(default_factory=dict)  # what a job has to remember, a few values a run


class CommitLog:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._jvm = spark.sparkContext._jvm

    def _file(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    def _system(self):
        return self._file("").getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _numbers(self) -> list[int]:
        system, folder = self._system(), self._file("commits")
        names = [s.getPath().getName() for s in system.listStatus(folder)] if system.exists(folder) else []
        return sorted(int(n) for n in names if n.isdigit())

    def state(self) -> State:
        numbers = self._numbers()
        if not numbers:
            return State()
        stream = self._system().open(self._file(f"commits/{numbers[-1]:010d}"))
        try:
            told = json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()
        return State(told["number"], told["runs"], [Folder(**f) for f in told["folders"]], told["notes"])

    def done(self, job: str, run: int) -> bool:
        return self.state().runs.get(job, -1) >= run

    def write(self, rows: DataFrame, table: str, run: int, part: str = "", base: bool = False, form: str = "parquet") -> Folder:
        """Write rows to a new folder, which counts once it is committed."""
        folder = Folder(table, f"{table}/run={run}-{uuid.uuid4().hex}", run, part, base)
        rows.write.format(form).save(f"{self.path}/{folder.path}")
        return folder

    def commit(
        self,
        job: str,
        run: int,
        added: Iterable[Folder],
        removed: Iterable[Folder] = (),
        notes: dict[str, list] | None = None,
    ) -> None:
        state, gone = self.state(), set(removed)
        runs = {**state.runs, job: max(run, state.runs.get(job, -1))}
        kept = [f for f in state.folders if f not in gone] + list(added)
        told = {"number": state.number + 1, "runs": runs, "folders": [vars(f) for f in kept], "notes": {**state.notes, **(notes or {})}}
        system, name = self._system(), f"{told['number']:010d}"
        draft, final = self._file(f"drafts/{name}-{uuid.uuid4().hex}"), self._file(f"commits/{name}")
        system.mkdirs(self._file("commits"))
        out = system.create(draft, False)
        out.write(bytearray(json.dumps(told).encode()))
        out.close()
        if system.exists(final) or not system.rename(draft, final):
            raise RuntimeError(f"another writer has made commit {name} of {self.path}")

    def folders(self, table: str) -> list[Folder]:
        return [f for f in self.state().folders if f.table == table]

    def read(self, table: str, schema: StructType | str, where: Callable[[Folder], bool] | None = None) -> DataFrame:
        """Committed rows, or those of some folders."""
        paths = [f"{self.path}/{f.path}" for f in self.folders(table) if where is None or where(f)]
        return self.read_paths(paths, schema)

    def read_paths(self, paths: list[str], schema: StructType | str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def read_text(self, table: str) -> DataFrame:
        paths = [f"{self.path}/{f.path}" for f in self.folders(table)]
        return self.spark.read.text(paths) if paths else self.spark.createDataFrame([], "value string")

    def clear(self, table: str) -> int:
        """Delete folders of a table that don't count: those that were taken out, and what stopped runs have left."""
        system, folder = self._system(), self._file(table)
        if not system.exists(folder):
            return 0
        live = {f.path.rsplit("/", 1)[-1] for f in self.folders(table)}
        dead = [s.getPath() for s in system.listStatus(folder) if s.getPath().getName() not in live]
        for path in dead:
            system.delete(path, True)
        return len(dead)
