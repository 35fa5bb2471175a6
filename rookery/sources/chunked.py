"""A Spark data source that writes rows to an outside store in chunks, with commit and abort.

A task stages its chunks in the store; rows that the store refuses are sent again. Only when
every task is done does the driver commit what they staged; a failed job is aborted and
leaves nothing behind. A retried or speculative task stages anew, and just the staging of
the attempt that Spark accepted is committed.
"""

import time
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from typing import Protocol

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, Row
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from rookery.sources.sinks import latest_by_key


class Store(Protocol):
    """Where chunks go. It is sent to every task, so it must be picklable."""

    def stage(self, attempt: str, number: int, rows: list[Row]) -> tuple[list[str], list[Row]]:
        """Take a chunk; returns the names of what was staged and the rows that were refused."""

    def commit(self, staged: Sequence[str]) -> None: ...

    def abort(self, attempts: Sequence[str]) -> None: ...


@dataclass
class Staged(WriterCommitMessage):
    """What one task attempt left in the store."""

    attempt: str
    names: list[str]


class _Writer(DataSourceWriter):
    def __init__(self, store: Store, chunk: int, retries: int):
        self.store, self.chunk, self.retries = store, chunk, retries

    def write(self, iterator: Iterator[Row]) -> Staged:
        attempt, names, rows = uuid.uuid4().hex, [], []
        for row in iterator:
            rows.append(row)
            if len(rows) == self.chunk:
                self._send(attempt, rows, names)
                rows = []
        if rows:
            self._send(attempt, rows, names)
        return Staged(attempt, names)

    def _send(self, attempt: str, rows: list[Row], names: list[str]) -> None:
        for turn in range(self.retries + 1):
            staged, rows = self.store.stage(attempt, len(names), rows)
            names += staged
            if not rows:
                return
            time.sleep(min(0.01 * 2**turn, 5.0))
        self.store.abort([attempt])
        raise RuntimeError(f"{len(rows)} rows were still refused after {self.retries} retries")

    def commit(self, messages: list[Staged | None]) -> None:
        self.store.commit([name for m in messages if m is not None for name in m.names])

    def abort(self, messages: list[Staged | None]) -> None:
        self.store.abort([m.attempt for m in messages if m is not None])


def write_chunked(
    df: DataFrame, keys: Sequence[str], store: Store, chunk: int = 25, retries: int = 10
) -> None:
    """Write the last row of every key to ``store``, all rows or none."""

    class Chunked(DataSource):
        @classmethod
        def name(cls) -> str:
            return "rookery_chunked"

        def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
            return _Writer(store, chunk, retries)

    df.sparkSession.dataSource.register(Chunked)
    latest_by_key(df, keys).write.format("rookery_chunked").mode("append").save()


@dataclass
class FolderStore:
    """Chunks as Parquet files below a folder of any file system that pyarrow opens by URI.

    ``capacity`` is how many rows a call accepts; the rest is refused, as a throttled store does.
    """

    uri: str
    capacity: int | None = None

    def _open(self, *parts: str) -> tuple[fs.FileSystem, str]:
        system, path = fs.FileSystem.from_uri("/".join((self.uri.rstrip("/"), *parts)))
        return system, path

    def stage(self, attempt: str, number: int, rows: list[Row]) -> tuple[list[str], list[Row]]:
        accepted, refused = rows[: self.capacity], rows[len(rows[: self.capacity]) :]
        system, folder = self._open("staged", attempt)
        system.create_dir(folder)
        name = f"{number:06}.parquet"
        pq.write_table(pa.Table.from_pylist([r.asDict() for r in accepted]), f"{folder}/{name}", filesystem=system)
        return [f"{attempt}/{name}"], refused

    def commit(self, staged: Sequence[str]) -> None:
        system, folder = self._open("rows")
        system.create_dir(folder)
        _, source = self._open("staged")
        for name in staged:
            system.move(f"{source}/{name}", f"{folder}/{name.replace('/', '-')}")

    def abort(self, attempts: Sequence[str]) -> None:
        for attempt in attempts:
            system, folder = self._open("staged", attempt)
            if system.get_file_info(folder).type == fs.FileType.Directory:
                system.delete_dir(folder)
