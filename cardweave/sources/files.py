"""A folder of messages as a data source of its own: every regular file, in batch and as a stream.

Spark's file readers leave out empty files and names that start with . or _, and their stream
emits a path once. This source lists the folder itself, when a batch is planned: once, into a listing on the
shared folder, whose parts (ranges of names of bounded size) are the partitions. Tasks read their part of the
listing and the files in it; nothing is listed a second time.

The stream keeps the listing it has seen. A poll compares it with what is there, by name, modification time
and size, so a file comes again whenever it was written again, also with an older time, and
writes down what changed before the poll counts: a batch that is replayed reads the same files. Offsets are
the numbers of the polls.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from cardweave.storage import folder_in_task

SCHEMA = "name STRING, content BINARY, modified BIGINT"
#: Files and bytes in one partition; a larger file is one of its own.
PART_FILES, PART_BYTES = 5_000, 32 << 20
#: What a task hands on at once.
_CHUNK_BYTES = 8 << 20
#: Polls after which what was seen is written as one listing.
_COMPACT_AFTER = 20

_LISTING = pa.schema([("name", pa.string()), ("modified", pa.int64()), ("size", pa.int64())])


def listing(folder: str) -> pa.Table:
    """name, modified (microseconds) and size of every regular file directly in ``folder``, by name."""
    filesystem, path = folder_in_task(folder)
    files = [f for f in filesystem.get_file_info(fs.FileSelector(path)) if f.type == fs.FileType.File]
    columns = [[f.base_name for f in files], [f.mtime_ns // 1000 for f in files], [f.size for f in files]]
    return pa.table(columns, schema=_LISTING).sort_by("name")


def _parts(files: pa.Table) -> Iterator[pa.RecordBatch]:
    """Consecutive rows with at most ``PART_FILES`` files and about ``PART_BYTES`` bytes."""
    first, size = 0, 0
    sizes = files.column("size").to_pylist()
    for i, n in enumerate(sizes):
        if i > first and (size + n > PART_BYTES or i - first >= PART_FILES):
            yield files.slice(first, i - first).combine_chunks().to_batches()[0]
            first, size = i, 0
        size += n
    if first < len(sizes):
        yield files.slice(first).combine_chunks().to_batches()[0]


def _put(path: str, content: bytes) -> None:
    """Write a file whole or not at all."""
    folder, name = path.rsplit("/", 1)
    filesystem, root = folder_in_task(folder)
    filesystem.create_dir(root, recursive=True)
    draft = f"{root}/.{name}-{uuid.uuid4().hex}"
    with filesystem.open_output_stream(draft) as out:
        out.write(content)
    filesystem.move(draft, f"{root}/{name}")


def _open(path: str):
    folder, name = path.rsplit("/", 1)
    filesystem, root = folder_in_task(folder)
    return filesystem.open_input_file(f"{root}/{name}")


def _write_listing(path: str, files: pa.Table) -> int:
    """Write a listing in parts; how many there are."""
    sink, parts = pa.BufferOutputStream(), 0
    with pa.ipc.new_file(sink, _LISTING) as writer:
        for part in _parts(files):
            writer.write_batch(part)
            parts += 1
    _put(path, sink.getvalue().to_pybytes())
    return parts


def _read_listing(path: str) -> pa.Table:
    with _open(path) as source:
        return pa.ipc.open_file(source).read_all()


class FilesPartition(InputPartition):
    """One part of a listing."""

    def __init__(self, path: str, part: int):
        self.path, self.part = path, part


def _contents(folder: str, partition: FilesPartition, gone_is_error: bool) -> Iterator[pa.RecordBatch]:
    with _open(partition.path) as source:
        files = pa.ipc.open_file(source).get_batch(partition.part)
    filesystem, root = folder_in_task(folder)
    rows, size = [], 0

    def batch() -> pa.RecordBatch:
        names, contents, times = zip(*rows)
        columns = [pa.array(names, pa.string()), pa.array(contents, pa.binary()), pa.array(times, pa.int64())]
        return pa.record_batch(columns, ["name", "content", "modified"])

    for row in files.to_pylist():
        try:
            with filesystem.open_input_stream(f"{root}/{row['name']}") as file:
                content = file.read()
        except FileNotFoundError:
            if gone_is_error:
                raise
            continue
        rows.append((row["name"], content, row["modified"]))
        size += len(content)
        if size > _CHUNK_BYTES:
            yield batch()
            rows, size = [], 0
    if rows:
        yield batch()


class _FolderReader(DataSourceReader):
    def __init__(self, options: dict):
        self.folder, self.work = options["path"], options["work"]
        self.names_only = options.get("namesonly", "false") == "true"

    def partitions(self) -> list[FilesPartition]:
        path = f"{self.work.rstrip('/')}/listing-{uuid.uuid4().hex}.arrow"
        return [FilesPartition(path, i) for i in range(_write_listing(path, listing(self.folder)))]

    def read(self, partition: FilesPartition | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # an empty folder
            return
        if not self.names_only:
            yield from _contents(self.folder, partition, gone_is_error=True)
            return
        with _open(partition.path) as source:
            files = pa.ipc.open_file(source).get_batch(partition.part)
        nothing = pa.nulls(files.num_rows, pa.binary())
        yield pa.record_batch([files["name"], nothing, files["modified"]], ["name", "content", "modified"])


class _FolderStream(DataSourceStreamReader):
    """Polls, numbered from 1; ``state`` holds what each of them found and belongs to the query's checkpoint."""

    def __init__(self, options: dict):
        self.folder, self.state = options["path"], options["state"].rstrip("/")
        self.settle = int(float(options.get("settleseconds", "0")) * 1_000_000)
        self.most = int(options.get("filesperbatch", "0"))
        self.poll, self.seen = -1, _LISTING.empty_table()

    def _file(self, kind: str, poll: int) -> str:
        return f"{self.state}/{kind}-{poll:09d}.arrow"

    def _numbers(self, kind: str) -> list[int]:
        filesystem, root = folder_in_task(self.state)
        found = filesystem.get_file_info(fs.FileSelector(root, allow_not_found=True))
        return sorted(int(f.base_name[len(kind) + 1 :].split(".")[0]) for f in found if f.base_name.startswith(f"{kind}-"))

    def _load(self) -> None:
        """What the last finished poll had seen: the last whole listing, and what changed since."""
        done, whole = self._numbers("poll"), self._numbers("whole")
        self.poll = done[-1] if done else 0
        base = max((n for n in whole if n <= self.poll), default=0)
        self.seen = _read_listing(self._file("whole", base)) if base else _LISTING.empty_table()
        for poll in range(base + 1, self.poll + 1):
            self.seen = self._after(_read_listing(self._file("changed", poll)), _read_listing(self._file("gone", poll)))

    def _after(self, changed: pa.Table, gone: pa.Table) -> pa.Table:
        names = pa.concat_tables([changed, gone]).select(["name"])
        kept = self.seen.join(names, "name", join_type="left anti")
        return pa.concat_tables([kept.select(_LISTING.names), changed])

    def initialOffset(self) -> dict:
        return {"poll": 0}

    def latestOffset(self) -> dict:
        if self.poll < 0:
            self._load()
        before = int(time.time() * 1_000_000) - self.settle
        there = listing(self.folder)
        settled = there.filter(pc.less_equal(there["modified"], before)) if self.settle else there
        changed = settled.join(self.seen, _LISTING.names, join_type="left anti").select(_LISTING.names)
        gone = self.seen.join(there.select(["name"]), "name", join_type="left anti").select(_LISTING.names)
        if self.most and changed.num_rows > self.most:  # the oldest first; the others are found by the next poll
            changed = changed.sort_by([("modified", "ascending"), ("name", "ascending")]).slice(0, self.most)
        if changed.num_rows or gone.num_rows:
            poll = self.poll + 1
            parts = _write_listing(self._file("changed", poll), changed.sort_by("name"))
            _write_listing(self._file("gone", poll), gone)
            _put(f"{self.state}/poll-{poll:09d}.json", json.dumps({"parts": parts}).encode())
            self.poll, self.seen = poll, self._after(changed, gone)
        return {"poll": self.poll}

    def partitions(self, start: dict, end: dict) -> list[FilesPartition]:
        found = []
        for poll in range(start["poll"] + 1, end["poll"] + 1):
            with _open(f"{self.state}/poll-{poll:09d}.json") as source:
                parts = json.loads(source.read())["parts"]
            found += [FilesPartition(self._file("changed", poll), i) for i in range(parts)]
        return found

    def read(self, partition: FilesPartition | None) -> Iterator[pa.RecordBatch]:
        # A file deleted since it was listed has nothing left to publish.
        if partition is not None:
            yield from _contents(self.folder, partition, gone_is_error=False)

    def commit(self, end: dict) -> None:
        """Batches up to ``end`` are not replayed any more; from time to time their listings become one."""
        whole = self._numbers("whole")
        if self.poll - (whole[-1] if whole else 0) < _COMPACT_AFTER:
            return
        _write_listing(self._file("whole", self.poll), self.seen.sort_by("name"))
        filesystem, root = folder_in_task(self.state)
        for kind, ending, numbers in [
            ("changed", "arrow", self._numbers("changed")),
            ("gone", "arrow", self._numbers("gone")),
            ("poll", "json", self._numbers("poll")),
            ("whole", "arrow", whole),
        ]:
            for n in numbers:
                if n <= end["poll"] and n < self.poll:
                    filesystem.delete_file(f"{root}/{kind}-{n:09d}.{ending}")


class FolderFiles(DataSource):
    """Format ``folder_files``; options path, and work (batch) or state (stream) on the shared folder."""

    @classmethod
    def name(cls) -> str:
        return "folder_files"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _FolderReader(self.options)

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _FolderStream(self.options)
