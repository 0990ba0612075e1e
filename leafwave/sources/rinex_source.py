"""RINEX 3 files as a Spark data source, in batch and as a stream.

``spark.read.format("rinex").load(path)`` gives (path, epoch, record): the text
of each epoch block and its time. With the options ``start`` and ``end`` a file
whose name tells a period outside the wanted time is left unread, other files
are cut into byte ranges, and blocks outside the wanted time are not handed to
Spark. These are options and no pushed filters, since Spark 4.1 keeps what one
query pushes into a Python source for all later queries on that DataFrame.
With the option ``content`` = ``headers`` only the head of each file is read.

As a stream, offsets are places in the order of arrival: (modification time,
path). A batch holds the files between two offsets, so a batch that is run
again reads the same files, and a file is read once. Files changed less than
``settleSeconds`` ago wait for the next batch.

What a block holds is parsed by ``rinex3`` as Columns.
"""

from __future__ import annotations

import json
import re
import time
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime, timedelta

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from leafwave.session import broadcast_checked, cut_lineage
from leafwave.sources import rinex3
from leafwave.sources.filenames import LONG_FAMILIES, SHORT_FAMILIES, UNITS
from leafwave.sources.sbf_source import list_files, open_store

RANGE_BYTES = 32 << 20
TAIL = 1 << 16
DDL = "path string, epoch timestamp_ntz, record string"
SCHEMA = pa.schema([("path", pa.string()), ("epoch", pa.timestamp("us")), ("record", pa.string())])
ROWS = 2_000


# -- names and times ---------------------------------------------------------------


def name_span(path: str) -> tuple[datetime, datetime] | None:
    """First instant of a file and the first after it, by its name; None for other names."""
    name = re.split(r"[/\\]", path)[-1]
    for pattern in LONG_FAMILIES.values():
        if m := re.match(pattern, name):
            year, doy, hour, minute, period = m.groups()[:5]
            start = datetime(int(year), 1, 1) + timedelta(days=int(doy) - 1, hours=int(hour), minutes=int(minute))
            return start, start + timedelta(seconds=int(period[:2]) * UNITS[period[2]])
    for pattern in SHORT_FAMILIES.values():
        if m := re.match(pattern, name):
            doy, letter, minute, yy = m.groups()
            start = datetime(int(yy) + (1900 if int(yy) >= 80 else 2000), 1, 1) + timedelta(days=int(doy) - 1, minutes=int(minute or 0))
            if letter == "0":
                return start, start + timedelta(days=1)
            start += timedelta(hours=ord(letter.lower()) - 97)
            return start, start + timedelta(minutes=15 if minute else 60)
    return None


def epoch_of(record: str) -> datetime | None:
    """Time of an epoch block, as ``rinex3.parse_epochs`` reads it; None where it reads none."""
    m = re.match(rinex3.EPOCH_PATTERN, record)
    if not m:
        return None
    try:
        whole, _, part = m[6].partition(".")
        return datetime(*(int(m[i]) for i in range(1, 6)), int(whole), int(f"{part:0<6}"[:6]))
    except ValueError:
        return None


@dataclass
class Wanted:
    """Bounds of the wanted epochs, both included."""

    start: datetime | None = None
    end: datetime | None = None

    def file(self, path: str) -> bool:
        span = name_span(path)
        return span is None or ((self.end is None or span[0] <= self.end) and (self.start is None or span[1] > self.start))

    def epoch(self, at: datetime | None) -> bool:
        return (self.start is None and self.end is None) or (at is not None and (self.start is None or at >= self.start) and (self.end is None or at <= self.end))


# -- records -------------------------------------------------------------------------


@dataclass
class TextRange(InputPartition):
    path: str
    size: int
    start: int
    end: int


def ranges_of(path: str, size: int, step: int) -> Iterator[TextRange]:
    """A compressed file is one range."""
    step = max(size, 1) if path.endswith(".gz") else step
    return (TextRange(path, size, at, min(at + step, size)) for at in range(0, size, step))


def read_head(path: str) -> str | None:
    """The header of a file; None where it has no end."""
    store, inside = open_store(path)
    with store.open_input_stream(inside) as f:
        head = b""
        while more := f.read(TAIL):
            head += more
            found = head.find(rinex3.HEADER_END.encode())
            if found >= 0 or b"\n>" in head:
                return head[: head.find(b"\n", found)].decode("utf-8", "replace") if found >= 0 else None
    return None


def read_records(part: TextRange) -> Iterator[str]:
    """Epoch blocks whose mark lies in the range, without the mark."""
    store, inside = open_store(part.path)
    if part.path.endswith(".gz"):
        with store.open_input_stream(inside) as f:  # pyarrow unpacks by the name's ending
            data = f.read()
        base, end = 0, len(data)
    else:
        with store.open_input_file(inside) as f:
            base = max(0, part.start - 1)  # the line break before a mark at the start
            stop, end = part.end, part.end - base
            data = f.read_at(stop - base, base)
            while stop < part.size:  # the last block ends before the first mark beyond the range
                more = f.read_at(min(TAIL, part.size - stop), stop)
                joint = len(data) - 1
                data += more
                stop += len(more)
                if data.find(b"\n>", max(joint, end - 1)) >= 0:
                    break
    at = data.find(b"\n>")
    while 0 <= at and at + 1 < end:
        after = data.find(b"\n>", at + 1)
        yield data[at + 2 : after if after >= 0 else len(data)].decode("utf-8", "replace")
        at = after


def batches(part: TextRange, content: str, wanted: Wanted) -> Iterator[pa.RecordBatch]:
    if content == "headers":
        head = read_head(part.path)
        rows = iter([(None, head)] if head is not None else [])
    else:
        found = ((epoch_of(r), r) for r in read_records(part))
        rows = (r for r in found if wanted.epoch(r[0]))
    held: list[tuple[datetime | None, str]] = []
    for row in rows:
        held.append(row)
        if len(held) == ROWS:
            yield _batch(part.path, held)
            held = []
    if held:
        yield _batch(part.path, held)


def _batch(path: str, rows: list[tuple[datetime | None, str]]) -> pa.RecordBatch:
    epochs, records = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array([path] * len(rows)), pa.array(epochs, SCHEMA.field("epoch").type), pa.array(records, pa.string())], schema=SCHEMA)


# -- data source -----------------------------------------------------------------------


class _Options:
    def __init__(self, options: dict[str, str]):
        path = options["path"]
        self.paths = json.loads(path) if path.startswith("[") else [path]
        self.step = int(options.get("rangeBytes", RANGE_BYTES))
        self.content = options.get("content", "epochs")
        self.settle = float(options.get("settleSeconds", 2.0))
        bound = lambda name: datetime.fromisoformat(options[name]) if name in options else None
        self.wanted = Wanted(bound("start"), bound("end"))

    def cut(self, files: Iterator[tuple[str, int]]) -> list[TextRange]:
        if self.content == "headers":
            return [TextRange(path, size, 0, size) for path, size in files]
        return [r for path, size in files for r in ranges_of(path, size, self.step)]


class RinexReader(DataSourceReader):
    def __init__(self, options: _Options):
        self.options = options

    def partitions(self) -> list[TextRange]:
        files = (f for given in self.options.paths for f in list_files(given))
        return self.options.cut((path, size) for path, size in files if self.options.content == "headers" or self.options.wanted.file(path))

    def read(self, partition: TextRange) -> Iterator[pa.RecordBatch]:
        yield from batches(partition, self.options.content, self.options.wanted)


class RinexStreamReader(DataSourceStreamReader):
    def __init__(self, options: _Options):
        self.options = options

    def arrivals(self) -> list[tuple[int, str, int]]:
        """(modification time in ns, path, size) of all files, in order."""
        out = []
        for given in self.options.paths:
            for path, size in list_files(given):
                store, inside = open_store(path)
                out.append((store.get_file_info([inside])[0].mtime_ns, path, size))
        return sorted(out)

    def initialOffset(self) -> dict:
        return {"at": -1, "path": ""}

    def latestOffset(self) -> dict:
        until = time.time_ns() - int(self.options.settle * 1e9)
        settled = [(at, path) for at, path, _ in self.arrivals() if at <= until]
        return dict(zip(("at", "path"), settled[-1])) if settled else self.initialOffset()

    def partitions(self, start: dict, end: dict) -> list[TextRange]:
        lo, hi = ((o["at"], o["path"]) for o in (start, end))
        return self.options.cut((path, size) for at, path, size in self.arrivals() if lo < (at, path) <= hi)

    def read(self, partition: TextRange) -> Iterator[pa.RecordBatch]:
        yield from batches(partition, self.options.content, self.options.wanted)

    def commit(self, end: dict) -> None:
        """Offsets are all there is to keep."""


class RinexSource(DataSource):
    """Options ``path`` (or a JSON list), ``rangeBytes``, ``content`` (epochs or headers), ``start`` and ``end``
    (ISO, both included), and ``settleSeconds`` (streams)."""

    @classmethod
    def name(cls) -> str:
        return "rinex"

    def schema(self) -> str:
        return DDL

    def reader(self, schema) -> RinexReader:
        return RinexReader(_Options(self.options))

    def streamReader(self, schema) -> RinexStreamReader:
        return RinexStreamReader(_Options(self.options))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(RinexSource)


def _path(path: str | list[str]) -> str:
    return path if isinstance(path, str) else json.dumps(list(path))


def headers(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per file, from its first bytes."""
    register(spark)
    return rinex3.parse_header(spark.read.format("rinex").option("content", "headers").load(_path(path)))


def read_between(
    spark: SparkSession, path: str | list[str], start: datetime | None = None, end: datetime | None = None, range_bytes: int = RANGE_BYTES
) -> DataFrame:
    """Observations of RINEX 3 files with ``start`` <= epoch <= ``end``; files named for another time stay unread."""
    register(spark)
    bounds = {name: t.isoformat() for name, t in (("start", start), ("end", end)) if t is not None}
    blocks = spark.read.format("rinex").options(rangeBytes=range_bytes, **bounds).load(_path(path))
    heads = broadcast_checked(cut_lineage(headers(spark, path)), rinex3.MAX_BROADCAST_FILES)
    return rinex3.parse_epochs(blocks.select("path", "record"), heads)


def stream(spark: SparkSession, path: str, settle_seconds: float = 2.0) -> DataFrame:
    """Epoch blocks (path, epoch, record) of files in the order they arrive."""
    register(spark)
    return spark.readStream.format("rinex").option("settleSeconds", settle_seconds).load(path)


def file_summary(obs: DataFrame) -> DataFrame:
    """Per file: first and last epoch, numbers of epochs and satellites, and the systems seen."""
    sv = F.split_part("sid", F.lit("|"), F.lit(1))
    return obs.groupBy("path").agg(
        F.min("epoch").alias("start_time"), F.max("epoch").alias("end_time"), F.count_distinct("epoch").alias("num_epochs"),
        F.count_distinct(sv).alias("num_satellites"), F.sort_array(F.collect_set(F.substring("sid", 1, 1))).alias("systems"),
    )
