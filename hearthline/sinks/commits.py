"""Which folders of a table are live: a small JSON state, replaced in one step.

Writers put their rows into folders of their own and then commit a new state that names
them, so readers find either the state before or the one after, and what a failed writer
left behind is never read.  A commit is a file named by its number, made by a rename that
fails where the number is taken; the writer then looks at the new state and tries again.
"""

from __future__ import annotations

import json
import threading
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

KEPT = 20  # commits that stay for readers that are under way and for a look back
_ONE_AT_A_TIME = threading.Lock()  # local file systems rename without looking, within one process


class Taken(Exception):
    """Another writer has committed since the state was read."""


class CommitLog:
    """The states of the table below ``path``."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self._jvm = spark._jvm
        self._folder = self._path(f"{self.path}/_commits")
        self._files = self._folder.getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, path: str) -> object:
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def _numbers(self) -> list[int]:
        if not self._files.exists(self._folder):
            return []
        names = [f.getPath().getName() for f in self._files.listStatus(self._folder)]
        return sorted(int(n.removesuffix(".json")) for n in names if n[:1].isdigit())

    def _file(self, number: int) -> object:
        return self._path(f"{self.path}/_commits/{number:012d}.json")

    def read(self, back: int = 0) -> tuple[int, dict]:
        """Number and state of the last commit, or of one further back; (0, {}) where there is none."""
        numbers = self._numbers()
        if len(numbers) <= back:
            return 0, {}
        number = numbers[-1 - back]
        stream = self._files.open(self._file(number))
        try:
            return number, json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def commit(self, after: int, state: dict) -> int:
        """Make ``state`` the one after commit number ``after``; raises ``Taken`` if that isn't the last any more."""
        draft = self._path(f"{self.path}/_commits/_{uuid.uuid4().hex}")
        out = self._files.create(draft, False)
        out.write(bytearray(json.dumps(state).encode()))
        out.close()
        rename = self._jvm.org.apache.hadoop.fs.Options.Rename
        ways = self.spark._sc._gateway.new_array(rename, 1)
        ways[0] = rename.NONE
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._folder.toUri(), self.spark._jsc.hadoopConfiguration())
        with _ONE_AT_A_TIME:
            if self._files.exists(self._file(after + 1)):
                self._files.delete(draft, False)
                raise Taken(f"commit {after + 1} of {self.path}")
            context.rename(self._files.makeQualified(draft), self._files.makeQualified(self._file(after + 1)), ways)
        for old in [n for n in self._numbers() if n <= after + 1 - KEPT]:
            self._files.delete(self._file(old), False)
        return after + 1

    def change(self, step: Callable[[dict], dict | None]) -> dict:
        """Commit what ``step`` makes of the last state, again if another writer was faster; None leaves it as it is."""
        while True:
            number, state = self.read()
            made = step(json.loads(json.dumps(state)))
            if made is None:
                return state
            try:
                self.commit(number, made)
                return made
            except Taken:
                continue

    def new_folder(self, kind: str) -> str:
        """The name of a folder that no other writer uses, relative to the table."""
        return f"{kind}/{uuid.uuid4().hex}"

    def exists(self, folder: str) -> bool:
        return self._files.exists(self._path(f"{self.path}/{folder}"))

    def rows(self, folders: list[str], schema: object) -> DataFrame:
        """The rows of the folders, without looking for others."""
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{f}" for f in folders])

    def drop_others(self, live: set[str]) -> int:
        """Delete the folders two levels below the table that aren't live; returns how many."""
        root, gone = self._path(self.path), 0
        for outer in self._files.listStatus(root) if self._files.exists(root) else []:
            name = outer.getPath().getName()
            if not outer.isDirectory() or name == "_commits":
                continue
            for inner in self._files.listStatus(outer.getPath()):
                if inner.isDirectory() and f"{name}/{inner.getPath().getName()}" not in live:
                    gone += self._files.delete(inner.getPath(), True)
        return gone
