"""Record files as a Python data source: files that a filter excludes are never opened.

    spark.dataSource.register(RecordFiles)
    df = spark.read.format("record_files").option("kind", "meeting").load(folder)
    df.where("date = DATE '2025-02-01' AND record_id = '3'")

Rows are (file_name, record_id, date, year, value, corrupt): one per record of a file, as JSON text.  Id and date come
from the file name, so filters on record_id, date and year choose files while the scan is planned.  A file that is not
JSON is one row with its text in `corrupt` and no value; `quarantine` keeps these apart.  Chosen files are read in
bundles of bounded bytes, and each file's rows are given out as it is read.

The stream reader remembers the time and name of the last file of each batch, and takes files after it in that order.

Folders are opened by pyarrow, so a store must be one that it knows (local or shared disks, object stores, HDFS).
"""

from __future__ import annotations

import datetime
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceStreamReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    LessThan,
    LessThanOrEqual,
)

SCHEMA = "file_name string, record_id string, date date, year int, value string, corrupt string"
BUNDLE_BYTES = 32 << 20
BUNDLE_FILES = 1000
#: Files of one micro-batch of a stream.
BATCH_FILES = 10_000

_DATED = r"_(\d{4}-\d{2}-\d{2})"
#: How the files of a kind are named.
KINDS = {
    "meeting": rf"meeting_(\d+){_DATED}\.json",
    "processed_transcript": rf"processed_transcript_(\d+){_DATED}\.json",
    "transcript": rf"transcript_(\d+){_DATED}\.json",
    "video_mapping": r"video_mapping_(\d+)\.json",
}


@dataclass(frozen=True)
class RecordFile:
    path: str
    name: str
    size: int
    changed: int
    record_id: str
    date: datetime.date | None

    def value(self, column: str):
        if column == "year":
            return self.date.year if self.date else None
        return self.name if column == "file_name" else getattr(self, column)


class Bundle(InputPartition):
    def __init__(self, files: tuple[RecordFile, ...] = ()) -> None:
        super().__init__(None)
        self.files = files


def listed(folder: str, kind: str) -> list[RecordFile]:
    """The files of a kind in a folder, by name."""
    system, root = fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder.removeprefix("file:"))
    pattern, out = re.compile(KINDS[kind]), []
    for info in system.get_file_info(fs.FileSelector(root, allow_not_found=True)):
        found = pattern.fullmatch(info.base_name) if info.is_file else None
        if found:
            date = None
            if found.re.groups > 1:
                try:
                    date = datetime.date.fromisoformat(found.group(2))
                except ValueError:  # no such day: a file without a date
                    pass
            out.append(RecordFile(info.path, info.base_name, info.size, info.mtime_ns or 0, found.group(1), date))
    return sorted(out, key=lambda f: f.name)


def bundled(files: list[RecordFile]) -> list[Bundle]:
    out, size = [], BUNDLE_BYTES
    for f in files:
        if size + f.size > BUNDLE_BYTES or len(out[-1].files) >= BUNDLE_FILES:
            out.append(Bundle())
            size = 0
        out[-1].files += (f,)
        size += f.size
    return out


_ARROW = pa.schema([("file_name", pa.string()), ("record_id", pa.string()), ("date", pa.date32()), ("year", pa.int32()), ("value", pa.string()), ("corrupt", pa.string())])


def read_files(folder: str, files: tuple[RecordFile, ...]) -> Iterator[pa.RecordBatch]:
    system = fs.FileSystem.from_uri(folder)[0] if "://" in folder else fs.LocalFileSystem()
    for f in files:
        with system.open_input_stream(f.path) as stream:
            raw = stream.read()
        values, corrupt = [None], [None]
        try:
            parsed = json.loads(raw.decode("utf-8-sig"))
            records = parsed if isinstance(parsed, list) else [parsed]
            values = [json.dumps(r, ensure_ascii=False) for r in records]
            corrupt = [None] * len(values)
        except ValueError:  # neither UTF-8 nor JSON
            corrupt = [raw.decode("utf-8", "replace")]
        n = len(values)
        columns = [[f.name] * n, [f.record_id] * n, [f.date] * n, [f.value("year")] * n, values, corrupt]
        yield pa.RecordBatch.from_arrays([pa.array(c, field.type) for c, field in zip(columns, _ARROW, strict=True)], schema=_ARROW)


_COMPARE = {
    EqualTo: lambda a, b: a == b,
    GreaterThan: lambda a, b: a > b,
    GreaterThanOrEqual: lambda a, b: a >= b,
    LessThan: lambda a, b: a < b,
    LessThanOrEqual: lambda a, b: a <= b,
    In: lambda a, b: a in b,
}


class RecordReader(DataSourceReader):
    def __init__(self, folder: str, kind: str) -> None:
        self.folder, self.kind = folder, kind
        self.tests: list[Filter] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802
        for f in filters:
            known = type(f) in _COMPARE and f.attribute in {("record_id",), ("date",), ("year",), ("file_name",)}
            if known:
                self.tests.append(f)
            else:
                yield f

    def chosen(self) -> list[RecordFile]:
        def passes(f: RecordFile) -> bool:
            for t in self.tests:
                value = f.value(t.attribute[0])
                if value is None or not _COMPARE[type(t)](value, t.value):
                    return False
            return True

        return [f for f in listed(self.folder, self.kind) if passes(f)]

    def partitions(self) -> list[Bundle]:
        return bundled(self.chosen()) or [Bundle()]

    def read(self, partition: Bundle) -> Iterator[pa.RecordBatch]:
        return read_files(self.folder, partition.files)


class RecordStream(DataSourceStreamReader):
    def __init__(self, folder: str, kind: str, most: int) -> None:
        self.folder, self.kind, self.most = folder, kind, most
        self.last: tuple[int, str] | None = None

    def initialOffset(self) -> dict:  # noqa: N802
        return {"changed": -1, "name": ""}

    def _between(self, start: dict, end: dict | None = None) -> list[RecordFile]:
        low = (start["changed"], start["name"])
        files = sorted(listed(self.folder, self.kind), key=lambda f: (f.changed, f.name))
        return [f for f in files if (f.changed, f.name) > low and (end is None or (f.changed, f.name) <= (end["changed"], end["name"]))]

    def latestOffset(self) -> dict:  # noqa: N802
        """The newest file, or the last of the next `most` files after the batch before."""
        at = self.last or (-1, "")
        fresh = self._between({"changed": at[0], "name": at[1]})[: self.most]
        if fresh:
            at = (fresh[-1].changed, fresh[-1].name)
        self.last = at
        return {"changed": at[0], "name": at[1]}

    def partitions(self, start: dict, end: dict) -> list[Bundle]:
        self.last = max(self.last or (-1, ""), (end["changed"], end["name"]))
        return bundled(self._between(start, end)) or [Bundle()]

    def read(self, partition: Bundle) -> Iterator[pa.RecordBatch]:
        return read_files(self.folder, partition.files)

    def commit(self, end: dict) -> None:
        pass


class RecordFiles(DataSource):
    """Options: path, kind (a name of `KINDS`), and files_per_batch for streams."""

    @classmethod
    def name(cls) -> str:
        return "record_files"

    def schema(self) -> str:
        return SCHEMA

    def _where(self) -> tuple[str, str]:
        return self.options["path"], self.options.get("kind", "meeting")

    def reader(self, schema) -> RecordReader:
        return RecordReader(*self._where())

    def streamReader(self, schema) -> RecordStream:  # noqa: N802
        return RecordStream(*self._where(), int(self.options.get("files_per_batch", BATCH_FILES)))


def record_files(spark: SparkSession, folder: str, kind: str) -> DataFrame:
    """The records of a kind of files; filters on file name, id, date and year choose the files.

    Load once for each filter: scans of one load that stand in one plan under different filters share the files of the last
    (Spark 4.1 keeps the chosen files with the loaded table, not with the scan).
    Turns filter pushdown for Python sources on in the session: a source that takes filters cannot be read without."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(RecordFiles)
    return spark.read.format("record_files").option("kind", kind).load(folder)


def record_stream(spark: SparkSession, folder: str, kind: str, files_per_batch: int = BATCH_FILES) -> DataFrame:
    spark.dataSource.register(RecordFiles)
    return spark.readStream.format("record_files").option("kind", kind).option("files_per_batch", files_per_batch).load(folder)


def typed(records: DataFrame, schema: str) -> DataFrame:
    """Records with their fields as columns; `file_name`, `record_id` and `date` of the file stay beside them."""
    good = records.where(F.col("value").isNotNull())
    return good.select("file_name", "record_id", F.col("date").alias("file_date"), F.from_json("value", schema).alias("r")).select("file_name", "record_id", "file_date", "r.*")


def quarantine(records: DataFrame) -> DataFrame:
    return records.where(F.col("corrupt").isNotNull()).select("file_name", "corrupt")
