"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from shelfspark.session import shared_dir

CHUNK_BYTES = 2 << 20


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared checkpoint folder and read it back.

    Used where a result is read more than once or a lineage must end: the files
    survive lost executors and are the same for every reader."""
    spark = df.sparkSession
    path = shared_dir(spark, "llm", name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have yet."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the offsets of its rows; null: empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def text_chunks(batches: Iterator[pa.RecordBatch], column: str = "text",
                limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches into runs of rows of about ``limit`` bytes of text
    (a longer text is a run of its own)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).cumsum()
        at = 0
        while at < batch.num_rows:
            base = size[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(size, base + limit, "right")))
            yield batch.slice(at, to - at)
            at = to
    pa.default_memory_pool().release_unused()  # Python workers live on after their task


class Best:
    """The first ``k`` rows of each of ``groups`` groups by (value descending, id
    ascending, null ids last), kept in bounded memory while rows stream by."""

    LIMIT = 1 << 17

    def __init__(self, groups: int, k: int):
        self.k, self.limit = k, max(self.LIMIT, 2 * groups * k)
        self.least = np.full(groups, np.iinfo(np.int64).min)  # a row below it cannot be among the first k
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.waiting = 0

    def add(self, group: np.ndarray, value: np.ndarray, ids: np.ndarray | int | None, row: np.ndarray | int = 0) -> None:
        """Rows of several groups; ``ids`` and ``row`` (a number carried along) may be one for all."""
        none = np.full(len(group), ids is None)
        self.parts.append((group, value, none, np.broadcast_to(np.int64(0) if ids is None else ids, len(group)),
                           np.broadcast_to(np.int64(row), len(group)) if np.isscalar(row) else row))
        self.waiting += len(group)
        if self.waiting > self.limit:
            self._compact()

    def _compact(self) -> tuple[np.ndarray, ...]:
        if not self.parts:
            return (np.empty(0, np.int64),) * 2 + (np.empty(0, bool),) + (np.empty(0, np.int64),) * 2
        group, value, none, ids, row = (np.concatenate(x) for x in zip(*self.parts))
        order = np.lexsort((ids, none, ~value, group))  # ~value = -value-1: descending, without overflow
        group = group[order]
        place = np.arange(len(group)) - np.searchsorted(group, group)
        order, group, place = order[place < self.k], group[place < self.k], place[place < self.k]
        kept = (group, value[order], none[order], ids[order], row[order])
        last = place == self.k - 1
        self.least[group[last]] = kept[1][last]
        self.parts, self.waiting = [kept], len(group)
        return kept

    def rows(self) -> tuple[np.ndarray, np.ndarray, pa.Array]:
        """(group, value, id) of the rows kept."""
        group, value, none, ids, _ = self._compact()
        return group, value, pa.array(ids, pa.int64(), mask=none)

    def numbered(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(group, value, id, row) of the rows kept, for ids without nulls."""
        group, value, _, ids, row = self._compact()
        return group, value, ids, row
