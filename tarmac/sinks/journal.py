"""Intents of loads that need several steps, so that a load that dies between two of them is finished by the next one."""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import SparkSession


class Journal:
    """A folder with one small file for each load, ``NNNNNNNN.json``, and an empty ``NNNNNNNN.done`` once it is through.

    One writer at a time. A file is written under another name and renamed, so it is there whole or not at all.
    """

    def __init__(self, spark: SparkSession, place: str):
        self.spark, self.place = spark, place.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._files = self._path(self.place).getFileSystem(spark._jsc.hadoopConfiguration())

    def _numbers(self, ending: str) -> list[int]:
        if not self._files.exists(self._path(self.place)):
            return []
        names = [s.getPath().getName() for s in self._files.listStatus(self._path(self.place))]
        return sorted(int(n.split(".")[0]) for n in names if n.endswith(ending) and n[0] != ".")

    def _write(self, name: str, text: str) -> None:
        hidden, path = self._path(f"{self.place}/.{name}"), self._path(f"{self.place}/{name}")
        out = self._files.create(hidden, True)
        out.write(bytearray(text.encode()))
        out.close()
        if not self._files.rename(hidden, path):
            raise OSError(f"{path} exists: another load writes to this table")

    def last(self) -> dict[str, Any] | None:
        """The last intent, with its number and whether it is done."""
        numbers = self._numbers(".json")
        if not numbers:
            return None
        source = self._files.open(self._path(f"{self.place}/{numbers[-1]:08d}.json"))
        text = bytes(source.readAllBytes()).decode()
        source.close()
        return json.loads(text) | {"number": numbers[-1], "done": numbers[-1] in self._numbers(".done")}

    def begin(self, intent: dict[str, Any]) -> int:
        """Write down what is about to be done; from here on it will be, by this load or the next."""
        number = (self._numbers(".json") or [0])[-1] + 1
        self._write(f"{number:08d}.json", json.dumps(intent))
        return number

    def finish(self, number: int) -> None:
        """Everything of this intent is done; earlier ones are not needed any more."""
        self._write(f"{number:08d}.done", "")
        for ending in (".json", ".done"):
            for old in self._numbers(ending):
                if old < number:
                    self._files.delete(self._path(f"{self.place}/{old:08d}{ending}"), False)
