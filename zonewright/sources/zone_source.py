"""Zone files as a Spark data source: `spark.read.format("zonefiles").load(folder)`, and the same as a stream.

One partition per file, that is per (tld, date). The options `tlds` (names with commas between), `first` and `last` (days) say which
files to list; the others are not opened. Rows are lines (tld, date, value); `zone.parse_zone_lines` makes records of them.

As `zonefiles_filtered` the source takes filters on tld and date for the same. In Spark 4.1 the files chosen by a filter stay with the
loaded frame, and a later query of that frame without any filter gets no others; so each query must load it anew.
"""

from __future__ import annotations

import gzip
import re
from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass
from datetime import date

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

from zonewright.sources.zone import FILE_NAME

SCHEMA = "tld string, date date, value string"
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"
BATCH_LINES = 10_000
_ROWS = pa.schema([("tld", pa.string()), ("date", pa.date32()), ("value", pa.string())])
_TESTS = {EqualTo: lambda x, v: x == v, GreaterThan: lambda x, v: x > v, GreaterThanOrEqual: lambda x, v: x >= v,
          LessThan: lambda x, v: x < v, LessThanOrEqual: lambda x, v: x <= v, In: lambda x, v: x in v}


@dataclass
class ZoneFile(InputPartition):
    tld: str
    day: date
    path: str
    changed: int


def _files(path: str) -> list[ZoneFile]:
    """Zone files of a folder, by time of change and name; names that do not fit the pattern are left out."""
    system, root = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
    found = []
    for info in system.get_file_info(fs.FileSelector(root)):
        if info.is_file and (m := re.fullmatch(FILE_NAME, info.base_name)):
            try:
                found.append(ZoneFile(m[1], date.fromisoformat(m[2]), info.path, info.mtime_ns or 0))
            except ValueError:
                continue  # the digits are no date
    return sorted(found, key=lambda f: (f.changed, f.path))


def _lines(file: ZoneFile, path: str) -> Iterator[pa.RecordBatch]:
    system = fs.FileSystem.from_uri(path)[0] if "://" in path or path.startswith("file:") else fs.LocalFileSystem()
    with system.open_input_stream(file.path, compression=None) as raw, gzip.open(raw, "rt", encoding="utf-8", errors="replace", newline="\n") as text:
        held: list[str] = []
        for line in text:
            held.append(line.rstrip("\r\n"))
            if len(held) == BATCH_LINES:
                yield _batch(file, held)
                held = []
        if held:
            yield _batch(file, held)


def _batch(file: ZoneFile, lines: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([file.tld] * len(lines)), pa.array([file.day] * len(lines)), pa.array(lines)], schema=_ROWS)


def _chosen(options: Mapping[str, str]) -> list[ZoneFile]:
    tlds = {t.strip() for t in options["tlds"].split(",")} if "tlds" in options else None
    first, last = (date.fromisoformat(options.get(k, d)) for k, d in (("first", "0001-01-01"), ("last", "9999-12-31")))
    return [f for f in _files(options["path"]) if (tlds is None or f.tld in tlds) and first <= f.day <= last]


class ZoneReader(DataSourceReader):
    def __init__(self, options: Mapping[str, str]) -> None:
        self.options = dict(options)

    def partitions(self) -> list[ZoneFile]:
        return _chosen(self.options)

    def read(self, partition: ZoneFile) -> Iterator[pa.RecordBatch]:
        return _lines(partition, self.options["path"])


class FilteredZoneReader(ZoneReader):
    def __init__(self, options: Mapping[str, str]) -> None:
        super().__init__(options)
        self.tests: list[tuple] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            test = _TESTS.get(type(f))
            column = f.attribute[0] if test is not None and len(f.attribute) == 1 else None
            if column in ("tld", "date"):
                self.tests.append((column, type(f), f.value))
            else:
                yield f  # left to Spark

    def partitions(self) -> list[ZoneFile]:
        def fits(file: ZoneFile) -> bool:
            return all(_TESTS[kind](file.tld if column == "tld" else file.day, value) for column, kind, value in self.tests)

        return [f for f in super().partitions() if fits(f)]


class ZoneStreamReader(DataSourceStreamReader):
    """Files in order of change; the offset is the last file taken, so each file is read in one batch once."""

    def __init__(self, options: Mapping[str, str]) -> None:
        self.options = dict(options)

    def initialOffset(self) -> dict:
        return {"changed": -1, "path": ""}

    def latestOffset(self) -> dict:
        files = _chosen(self.options)
        return {"changed": files[-1].changed, "path": files[-1].path} if files else self.initialOffset()

    def partitions(self, start: dict, end: dict) -> list[ZoneFile]:
        after, upto = ((o["changed"], o["path"]) for o in (start, end))
        return [f for f in _chosen(self.options) if after < (f.changed, f.path) <= upto]

    def read(self, partition: ZoneFile) -> Iterator[pa.RecordBatch]:
        return _lines(partition, self.options["path"])


class ZoneSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "zonefiles"

    def schema(self) -> str:
        return SCHEMA

    def _given(self) -> dict[str, str]:
        return {k: self.options[k] for k in ("path", "tlds", "first", "last") if k in self.options}

    def reader(self, schema) -> ZoneReader:
        return ZoneReader(self._given())

    def streamReader(self, schema) -> ZoneStreamReader:
        return ZoneStreamReader(self._given())


class FilteredZoneSource(ZoneSource):
    @classmethod
    def name(cls) -> str:
        return "zonefiles_filtered"

    def reader(self, schema) -> FilteredZoneReader:
        return FilteredZoneReader(self._given())


def register(spark: SparkSession) -> SparkSession:
    """A session of the same application that knows `zonefiles` and `zonefiles_filtered`; the caller's settings stay as they are."""
    own = spark.newSession()
    own.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    own.conf.set(PUSHDOWN, "true")
    for source in (ZoneSource, FilteredZoneSource):
        own.dataSource.register(source)
    return own
