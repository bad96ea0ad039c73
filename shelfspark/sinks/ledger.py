"""Numbered records in a shared folder, each number given once.

A record is a small JSON file named by its number.  It is written aside and
renamed into place, which a distributed file system does at once and only if the
name is free; then it is read back.  Of several writers that claim a number
one gets it and the others go on to the next.  (An object store whose rename
copies gives no such promise: put the ledger on a file system there.)"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

DIGITS = 12


class Ledger:
    def __init__(self, spark: SparkSession, folder: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._spark, self.folder = spark, folder
        self._fs = self._path(folder).getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)

    def move_files(self, folder: str, target: str) -> None:
        """Move the data files of a finished job into a table, one rename each (what the
        commit of an append does), and remove the folder."""
        self._fs.mkdirs(self._path(target))
        for f in self._fs.listStatus(self._path(folder)):
            name = f.getPath().getName()
            if name[0] not in "_." and not self._fs.rename(f.getPath(), self._path(f"{target}/{name}")):
                raise OSError(f"cannot move {name} to {target}")
        self.delete(folder)

    def numbers(self) -> list[int]:
        """Numbers given so far, in order."""
        if not self.exists(self.folder):
            return []
        names = [f.getPath().getName() for f in self._fs.listStatus(self._path(self.folder))]
        return sorted(int(name) for name in names if name.isdigit())

    def name(self, number: int) -> str:
        return f"{self.folder}/{number:0{DIGITS}d}"

    def read(self, number: int) -> dict:
        stream = self._fs.open(self._path(self.name(number)))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def last(self) -> dict | None:
        given = self.numbers()
        return self.read(given[-1]) if given else None

    def claim(self, record: Callable[[dict | None], dict]) -> tuple[int, dict]:
        """Add ``record(last record)`` under the next number; made anew if another writer was faster."""
        token = uuid.uuid4().hex
        while True:
            given = self.numbers()
            number = given[-1] + 1 if given else 1
            value = record(self.read(given[-1]) if given else None) | {"token": token}
            aside = f"{self.folder}/_{token}"
            stream = self._fs.create(self._path(aside), True)
            stream.write(bytearray(json.dumps(value).encode()))
            stream.close()
            free = not self.exists(self.name(number))
            if free and self._fs.rename(self._path(aside), self._path(self.name(number))) and self.read(number)["token"] == token:
                return number, value
            self.delete(aside)
