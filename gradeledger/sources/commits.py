"""A numbered log of small commits beside a report.

Each commit is one file ``_log/<number>.json``, written aside and then given its number only if
no other commit has it, so an entry is there whole or not at all, and of two writers one gets
the number. An entry says which run a date shows, what the audit log is told, or which view
follows the report; what belongs together is in one entry and can't disagree.

Every ``COMPACT_EVERY`` entries are gathered in ``<number>.all``: a first line with the state,
then all entries. Readers take the newest one and the entries behind it.

On HDFS and its like numbers are given by a rename without overwriting, on a local or mounted
folder by a hard link; both are atomic there.
"""

from __future__ import annotations

import json
import logging
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import date
from urllib.parse import urlparse

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

log = logging.getLogger(__name__)

#: Loose entries from which they are gathered.
COMPACT_EVERY = 50
#: Attempts at reading a log that is being gathered meanwhile.
ATTEMPTS = 20


class PublishConflict(RuntimeError):
    """Another run published the same date since this one began."""


class Files:
    """Small files of one folder, through Hadoop's file systems."""

    def __init__(self, spark: SparkSession, folder: str):
        self.jvm, self.gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.folder = folder
        self.root = self._path("")
        self.fs = self.root.getFileSystem(self.conf)
        self.local = self.fs.getUri().getScheme() == "file"

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}" if name else self.folder)

    def _file(self, name: str):
        return self.jvm.java.io.File(f"{urlparse(self.folder).path}/{name}")

    def names(self) -> list[str]:
        if not self.fs.exists(self.root):
            return []
        return sorted(s.getPath().getName() for s in self.fs.listStatus(self.root))

    def text(self, name: str) -> str:
        stream = self.fs.open(self._path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def first_line(self, name: str) -> str:
        stream = self.fs.open(self._path(name))
        try:
            reader = self.jvm.java.io.InputStreamReader(stream, "UTF-8")
            return self.jvm.java.io.BufferedReader(reader).readLine()
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        """Writes a file of its own name."""
        if self.local:
            self._file("").mkdirs()
            out = self.jvm.java.io.FileOutputStream(self._file(name))
        else:
            out = self.fs.create(self._path(name), False)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def give(self, name: str, to: str) -> bool:
        """Gives a written file the name ``to``; False if another file has it."""
        try:
            if self.local:
                self.jvm.java.nio.file.Files.createLink(self._file(to).toPath(), self._file(name).toPath())
            else:
                kind = getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename")
                none = self.gateway.new_array(kind, 1)
                none[0] = kind.NONE
                context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.root.toUri(), self.conf)
                context.rename(self._path(name), self._path(to), none)
        except Py4JJavaError as failure:
            if failure.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
                return False
            raise
        return True

    def delete(self, name: str) -> None:
        self.fs.delete(self._path(name), False)

    def put_new(self, name: str, text: str) -> bool:
        """A new file, whole or not at all; False if there is one of that name."""
        aside = f".{uuid.uuid4().hex}"
        self.write(aside, text)
        try:
            return self.give(aside, name)
        finally:
            self.delete(aside)


@dataclass(frozen=True)
class State:
    """What the log says by its last entry."""

    last: int = 0
    gathered: int = 0
    #: ISO date to (number of the entry, run).
    dates: dict[str, tuple[int, str]] = field(default_factory=dict)
    #: View name to the ISO date that it shows, None for the latest.
    views: dict[str, str | None] = field(default_factory=dict)

    def number(self, day: date) -> int:
        """The entry that published a date, 0 if none did."""
        return self.dates.get(day.isoformat(), (0, ""))[0]

    def run(self, day: date | str | None = None) -> str | None:
        """The run that a date shows, by default the latest date's."""
        key = day.isoformat() if isinstance(day, date) else day
        if key is None:
            key = max(self.dates, default="")
        return self.dates.get(key, (0, None))[1]

    def after(self, entry: dict) -> State:
        dates, views = self.dates, self.views
        if entry.get("run"):
            dates = dates | {entry["date"]: (entry["n"], entry["run"])}
        if entry.get("view"):
            views = views | {entry["view"]: entry.get("view_date")}
        return State(entry["n"], self.gathered, dates, views)


def _number(name: str) -> int:
    return int(name.split(".")[0])


def _loose(n: int) -> str:
    return f"{n:012d}.json"


class CommitLog:
    """The log below the folder of a report."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.files = Files(spark, f"{path}/_log")

    def _names(self) -> tuple[str | None, list[str]]:
        """The newest gathering, and the loose entries behind it."""
        names = [n for n in self.files.names() if not n.startswith(".")]
        gathered = max((n for n in names if n.endswith(".all")), default=None)
        least = _number(gathered) if gathered else 0
        return gathered, [n for n in names if n.endswith(".json") and _number(n) > least]

    def _steadily(self, read: Callable):
        """Reads again when a file went away meanwhile, because entries were gathered."""
        for attempt in range(ATTEMPTS):
            try:
                return read()
            except Py4JJavaError as failure:
                gone = "FileNotFoundException" in failure.java_exception.getClass().getName()
                if not gone or attempt == ATTEMPTS - 1:
                    raise
        raise AssertionError

    def state(self) -> State:
        def read() -> State:
            gathered, loose = self._names()
            state = State()
            if gathered:
                kept = json.loads(self.files.first_line(gathered))["state"]
                dates = {k: tuple(v) for k, v in kept["dates"].items()}
                state = State(kept["last"], _number(gathered), dates, kept["views"])
            for name in loose:
                state = state.after(json.loads(self.files.text(name)))
            return state

        return self._steadily(read)

    def _lines(self) -> list[str]:
        gathered, loose = self._names()
        lines = self.files.text(gathered).splitlines()[1:] if gathered else []
        return [*lines, *(self.files.text(n).strip() for n in loose)]

    def entries(self) -> list[dict]:
        return [json.loads(line) for line in self._steadily(self._lines)]

    def commit(self, entry: dict, check: Callable[[State], None] | None = None) -> int:
        """Adds an entry and returns its number. ``check`` sees the state right before and may
        raise; it sees it again when another writer was faster."""
        own = uuid.uuid4().hex
        while True:
            state = self.state()
            if check is not None:
                check(state)
            n = state.last + 1
            line = json.dumps(entry | {"n": n, "id": own}) + "\n"
            if not self.files.put_new(_loose(n), line):
                continue
            if self._counts(n, own):
                break
            self.files.delete(_loose(n))  # the number was gathered and free again
        if n - state.gathered >= COMPACT_EVERY:
            try:
                self.compact()
            except Exception as failure:  # the entry is there already; a later one gathers
                log.warning("entries can't be gathered: %s", failure)
        return n

    def _counts(self, n: int, own: str) -> bool:
        """Whether an entry put at ``n`` is seen: not if ``n`` was gathered without it before."""
        gathered, _ = self._names()
        return gathered is None or _number(gathered) < n or any(e["id"] == own for e in self.entries())

    def compact(self) -> None:
        """Gathers all entries in one file. Readers see the same state at every moment."""
        lines = self._steadily(self._lines)
        if not lines:
            return
        state = State()
        for line in lines:
            state = state.after(json.loads(line))
        first = {"state": {"last": state.last, "dates": state.dates, "views": state.views}}
        if self.files.put_new(f"{state.last:012d}.all", "\n".join([json.dumps(first), *lines]) + "\n"):
            for name in self.files.names():
                old = name.endswith(".all") and _number(name) < state.last
                if not name.startswith(".") and (old or (name.endswith(".json") and _number(name) <= state.last)):
                    self.files.delete(name)

    def read(self) -> DataFrame:
        """The entries' lines as Spark reads them (column ``value``)."""
        gathered, loose = self._names()
        paths = [f"{self.files.folder}/{n}" for n in ([gathered] if gathered else []) + loose]
        if not paths:
            return self.spark.createDataFrame([], "value string")
        return self.spark.read.text(paths)
