"""The record of what a warehouse publishes: numbered JSON files, of which the greatest is what readers see.

A record names, per table, the parts (folders of files that never change) that make it up. A run writes its parts first
and then publishes one new record, by a create that fails if the number is taken: readers see all of a run or nothing,
and of two runs that began from one record only one is published.
"""

from __future__ import annotations

import json
import os
import uuid
from dataclasses import asdict, dataclass, field

from pyspark.sql import SparkSession

# Records that are kept besides the newest; parts that only older ones name are deleted.
RETAIN = 8


class ConcurrentRunError(Exception):
    """Another run has published since this one began; nothing of this one is visible. Run it again."""


@dataclass
class Part:
    """One folder of a table: its id, where it lies (below the location), its rows if counted, and its partition values."""

    part: str
    path: str
    rows: int | None = None
    values: dict[str, str] = field(default_factory=dict)
    rolled: bool = False  # a part of the facts whose counts are in the nodes
    counted: bool = False  # a part of the facts whose days are in the summary


@dataclass
class Record:
    number: int = 0
    buckets: int = 0
    tables: dict[str, list[Part]] = field(default_factory=dict)
    frontier: dict[str, str] = field(default_factory=dict)
    nodes: dict[str, str] = field(default_factory=dict)  # level/node of the roll-ups -> the write that holds it
    node_rows: dict[str, int] = field(default_factory=dict)  # rows of titles of each write
    unknown_books: bool = False  # whether a node holds loans of books that were not known
    trash: list[tuple[int, str]] = field(default_factory=list)  # (record that dropped it, folder)

    def to_json(self) -> str:
        return json.dumps(asdict(self), sort_keys=True)

    @classmethod
    def from_json(cls, text: str) -> Record:
        raw = json.loads(text)
        raw["tables"] = {t: [Part(**p) for p in parts] for t, parts in raw["tables"].items()}
        raw["trash"] = [tuple(x) for x in raw["trash"]]
        return cls(**raw)

    def copy(self) -> Record:
        return Record.from_json(self.to_json())


class RecordStore:
    """Records under ``<location>/_published`` of any file system that Spark reaches."""

    def __init__(self, spark: SparkSession, location: str):
        self.spark, self.location = spark, location
        self.folder = f"{location}/_published"

    def _fs(self, path: str):
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()), at

    def names(self, path: str) -> list[str]:
        """The names in a folder; none if it is not there."""
        fs, at = self._fs(path)
        return [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []

    def delete(self, path: str) -> None:
        fs, at = self._fs(path)
        fs.delete(at, True)

    def latest(self) -> Record | None:
        numbers = [int(n[:-5]) for n in self.names(self.folder) if n.endswith(".json")]
        if not numbers:
            return None
        fs, at = self._fs(f"{self.folder}/{max(numbers):012d}.json")
        stream = fs.open(at)
        try:
            return Record.from_json(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def publish(self, record: Record) -> None:
        """Make ``record`` the newest, whole or not at all. Fails if its number is taken."""
        fs, final = self._fs(f"{self.folder}/{record.number:012d}.json")
        _, draft = self._fs(f"{self.folder}/.{uuid.uuid4().hex}.draft")
        out = fs.create(draft, False)
        out.write(bytearray(record.to_json().encode()))
        out.close()
        try:
            if fs.getUri().getScheme() == "file":
                # A local rename replaces what is there; a link does not.
                os.link(draft.toUri().getPath(), final.toUri().getPath())
            elif fs.exists(final) or not fs.rename(draft, final):
                raise FileExistsError(final.toString())
        except FileExistsError as taken:
            raise ConcurrentRunError(f"record {record.number} of {self.location} was published by another run") from taken
        finally:
            fs.delete(draft, False)
        old = f"{self.folder}/{record.number - 1 - RETAIN:012d}.json"
        self.delete(old)
