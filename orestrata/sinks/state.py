"""A small JSON document beside a table that says which of its folders count.

It is replaced by writing the next number, so a reader finds the old document or the new one, never half of one, and a
writer that fails leaves the old one. One writer at a time.
"""

from __future__ import annotations

import json

from pyspark.sql import SparkSession

FOLDER = "_state"
KEPT = 3


class State:
    def __init__(self, spark: SparkSession, path: str) -> None:
        self.path = path.rstrip("/")
        self._jvm = spark._jvm
        self._files = self._at("").getFileSystem(spark._jsc.hadoopConfiguration())

    def read(self) -> dict | None:
        """The current document; None before the first one."""
        numbers = self._numbers()
        return json.loads(self._text(numbers[-1])) if numbers else None

    def write(self, document: dict) -> None:
        numbers = self._numbers()
        number = numbers[-1] + 1 if numbers else 0
        draft = self._at(f"{FOLDER}/.draft-{number}")
        out = self._files.create(draft, True)
        out.write(bytearray(json.dumps(document).encode()))
        out.close()
        if not self._files.rename(draft, self._file(number)):
            raise OSError(f"{self.path}: number {number} can't be written")
        for old in numbers[: 1 - KEPT]:
            self._files.delete(self._file(old), False)

    def names(self, folder: str) -> list[str]:
        """What lies directly below a folder of the table."""
        place = self._at(folder)
        return [f.getPath().getName() for f in self._files.listStatus(place)] if self._files.exists(place) else []

    def delete(self, folder: str) -> None:
        if not folder:
            raise ValueError("name a folder below the table")
        self._files.delete(self._at(folder), True)

    def replace(self, folder: str, by: str) -> None:
        """Put a folder of the table in place of another; if lost in between, `by` is still there."""
        self.delete(folder)
        if not self._files.rename(self._at(by), self._at(folder)):
            raise OSError(f"{self.path}: {by} can't be moved")

    def _numbers(self) -> list[int]:
        return sorted(int(name[:-5]) for name in self.names(FOLDER) if name.endswith(".json"))

    def _file(self, number: int):
        return self._at(f"{FOLDER}/{number:012d}.json")

    def _text(self, number: int) -> str:
        stream = self._files.open(self._file(number))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _at(self, folder: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{folder}" if folder else self.path)
