"""Small files in a shared folder: written once under a name that nobody else can take.

Tables keep their rows in Parquet, written by Spark. What these helpers write is control
information of a few lines: which batch has which number, which files belong to a table, how
far a config has come. The order of such entries is the order of their numbers, and a number
belongs to whoever created its file, so no clock takes part in it.
"""

from __future__ import annotations

import json
import os
import uuid
from dataclasses import dataclass
from typing import Any

from pyspark.sql import SparkSession

_WIDTH = 12
# outcomes of an entry
DONE, ABANDONED = "done", "abandoned"


class Shared:
    """A folder on any file system that Spark's readers can open."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark.sparkContext._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.path)
        self._fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._path = jvm.org.apache.hadoop.fs.Path

    def create(self, name: str, text: str) -> bool:
        """Write ``name`` unless it is there. False means that another writer has it; of any number of
        writers exactly one gets True, and no reader ever sees half a file.

        The text is written aside and then takes its name. A file system whose rename refuses a name
        that is taken, as HDFS does, makes that one step; on a local disk a hard link does.
        """
        self._fs.mkdirs(self._path(self.path))
        if self._fs.exists(self._path(f"{self.path}/{name}")):
            return False
        aside = self._path(f"{self.path}/.{name}.{uuid.uuid4().hex}")
        out = self._fs.create(aside, False)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        target = self._path(f"{self.path}/{name}")
        if self._fs.getUri().getScheme() != "file":
            taken = not self._fs.exists(target) and self._fs.rename(aside, target)
        else:
            try:
                os.link(aside.toUri().getPath(), target.toUri().getPath())
                taken = True
            except FileExistsError:
                taken = False
        if self._fs.exists(aside):
            self._fs.delete(aside, False)
        return taken

    def read(self, name: str) -> str:
        source = self._fs.open(self._path(f"{self.path}/{name}"))
        try:
            return bytes(source.readAllBytes()).decode()
        finally:
            source.close()

    def names(self) -> list[str]:
        """Names of finished files, in order; none where the folder is missing."""
        return [name for name, _ in self.sizes()]

    def sizes(self) -> list[tuple[str, int]]:
        """Names of finished files with their bytes."""
        if not self._fs.exists(self._path(self.path)):
            return []
        found = [(s.getPath().getName(), s.getLen()) for s in self._fs.listStatus(self._path(self.path)) if s.isFile()]
        return sorted((n, size) for n, size in found if not n.startswith((".", "_")))

    def remove(self, name: str) -> None:
        self._fs.delete(self._path(f"{self.path}/{name}"), True)


@dataclass(frozen=True)
class Entry:
    number: int
    what: dict[str, Any]


class CommitLog:
    """Numbered entries 1, 2, 3, ... of one table. A writer claims the next number by creating its file.

    Entries are never changed. ``settle`` adds the outcome of an entry beside it, also once only.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.entries_at, self.outcomes_at = Shared(spark, f"{path}/entries"), Shared(spark, f"{path}/outcomes")

    def numbers(self) -> list[int]:
        return [int(n.split(".")[0]) for n in self.entries_at.names()]

    def last(self) -> int:
        """The greatest number taken, 0 before the first."""
        return max(self.numbers(), default=0)

    def claim_at(self, number: int, **what: Any) -> bool:
        """Take this very number; False where another writer has it."""
        return self.entries_at.create(f"{number:0{_WIDTH}d}.json", json.dumps(what, sort_keys=True))

    def entry(self, number: int) -> Entry:
        return Entry(number, json.loads(self.entries_at.read(f"{number:0{_WIDTH}d}.json")))

    def settle(self, number: int, outcome: str) -> bool:
        """Note how an entry ended; False where it has an outcome already.

        Only the outcome ``done`` is left out of the file, so that a listing tells it.
        """
        return self.outcomes_at.create(f"{number:0{_WIDTH}d}.json", "" if outcome == DONE else outcome)

    def settled(self) -> dict[int, str]:
        """Outcomes by number. Only files that hold something are opened."""
        names = self.outcomes_at.sizes()
        return {int(n.split(".")[0]): self.outcomes_at.read(n) if size else DONE for n, size in names}

    def drop(self, number: int) -> None:
        self.entries_at.remove(f"{number:0{_WIDTH}d}.json")
        self.outcomes_at.remove(f"{number:0{_WIDTH}d}.json")

    def forget(self, before: int) -> None:
        """Drop entries below a number that are done; those that were given up stay known."""
        for number, outcome in self.settled().items():
            if number < before and outcome == DONE:
                self.drop(number)
