"""Septentrio binary files as a Spark data source that reads byte ranges.

``spark.read.format("sbf").option("rangeBytes", n).load(path)`` cuts every file
into ranges; a task reads one, or several small neighbouring ones. It finds block
marks, checks lengths and CRC-16, and keeps the blocks that start in its ranges.
It begins two block lengths early, so by the time it reaches its first range it
walks the same chain of blocks as a reader of the whole file. Fields are taken
from all blocks of a range at once with numpy structured types.

A range knows nothing of what came before it. Rows whose leap seconds or whose
measurement epoch lie in another range leave them NULL, and each range adds one
``range`` row with what its neighbours need (see ``sbf.read_raw``).

The option ``kinds`` names the rows that are wanted; other blocks are not
decoded. It is an option and no pushed filter, since Spark 4.1 keeps what one
query pushes into a Python source for all later queries on that DataFrame.
Paths may be files, folders or patterns on any store pyarrow can open.
"""

from __future__ import annotations

import binascii
import fnmatch
import json
import posixpath
import struct
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

# Block numbers.
MEAS_EPOCH, RECEIVER_TIME, CHANNEL_STATUS, SAT_VISIBILITY = 4027, 5914, 4013, 4012
PVT_GEODETIC, DOP, RECEIVER_STATUS, MEAS_EXTRA = 4007, 4001, 4014, 4000
LARGEST_BLOCK = 1 << 16
RANGE_BYTES = 16 << 20
#: Small ranges share a task while there are at least about this many tasks.
MIN_TASKS = 96
SLICE = 65_536

# Layouts of sub-blocks and of blocks after their time.
MASTER = np.dtype(
    [("channel", "u1"), ("type", "u1"), ("svid", "u1"), ("misc", "u1"), ("code_lsb", "<u4"), ("doppler", "<i4"), ("carrier_lsb", "<u2"),
     ("carrier_msb", "i1"), ("cn0", "u1"), ("lock_time", "<u2"), ("obs_info", "u1"), ("n2", "u1")]
)
SLAVE = np.dtype(
    [("type2", "u1"), ("lock_time", "u1"), ("cn0", "u1"), ("offset_msb", "u1"), ("carrier_msb", "i1"), ("obs_info2", "u1"),
     ("code_offset_lsb", "<u2"), ("carrier_lsb", "<u2"), ("doppler_offset_lsb", "<u2")]
)
SKY = np.dtype([("svid", "u1"), ("freq", "u1"), ("azimuth", "<u2"), ("elevation", "<i2"), ("rise_set", "u1")])
EXTRA = np.dtype(
    [("channel", "u1"), ("type", "u1"), ("mp", "<i2"), ("smoothing", "<i2"), ("code_var", "<u2"), ("carrier_var", "<u2"),
     ("lock_time", "<u2"), ("cum_loss", "u1"), ("car_mp", "i1"), ("obs_info", "u1"), ("misc", "u1")]
)
PVT = np.dtype(
    {"names": ["mode", "a", "b", "c", "n_sv", "corr_age", "h_acc", "v_acc"], "formats": ["u1", "<f8", "<f8", "<f8", "u1", "<u2", "<u2", "<u2"],
     "offsets": [0, 2, 10, 18, 60, 64, 76, 78], "itemsize": 80}
)
DILUTION = np.dtype({"names": ["a", "b", "c"], "formats": ["<u2"] * 3, "offsets": [2, 6, 8], "itemsize": 10})
STATUS = np.dtype({"names": ["cpu", "error", "temperature"], "formats": ["u1", "<u4", "u1"], "offsets": [0, 10, 17], "itemsize": 18})

SCHEMA = pa.schema(
    [
        ("path", pa.string()), ("part", pa.int64()), ("at", pa.int64()), ("kind", pa.string()), ("tow", pa.int64()), ("week", pa.int32()), ("leap", pa.int32()),
        ("epoch_at", pa.int64()), ("epoch_tow", pa.int64()), ("epoch_week", pa.int32()), ("epoch_leap", pa.int32()),
        ("svid", pa.int32()), ("freq_nr", pa.int32()), ("channel", pa.int32()), ("type", pa.int32()), ("obs_info", pa.int32()), ("misc", pa.int32()),
        ("code_lsb", pa.int64()), ("doppler", pa.int64()), ("carrier_msb", pa.int32()), ("carrier_lsb", pa.int32()), ("cn0", pa.int32()),
        ("type2", pa.int32()), ("obs_info2", pa.int32()), ("offset_msb", pa.int32()), ("code_offset_lsb", pa.int32()), ("doppler_offset_lsb", pa.int32()),
        ("a", pa.float64()), ("b", pa.float64()), ("c", pa.float64()), ("fields", pa.list_(pa.float64())),
    ]
)
_SQL = {pa.string(): "string", pa.int64(): "bigint", pa.int32(): "int", pa.float64(): "double", pa.list_(pa.float64()): "array<double>"}
DDL = ", ".join(f"{f.name} {_SQL[f.type]}" for f in SCHEMA)
KINDS = ("obs", "sky", "pvt", "dop", "status", "extra", "channel", "range")


# -- walking blocks ---------------------------------------------------------------


def walk(data: bytes, base: int, start: int, end: int) -> Iterator[tuple[int, int, int, int, int]]:
    """(place in ``data``, number, TOW, week, length) of the sound blocks that start in [start, end) of the file; ``data`` begins at ``base``."""
    at = data.find(b"$@")
    while 0 <= at and at + base < end and at + 14 <= len(data):
        crc, ident, length = struct.unpack_from("<HHH", data, at + 2)
        stop = at + length
        if length < 14 or length % 4 or stop > len(data) or binascii.crc_hqx(memoryview(data)[at + 4 : stop], 0) != crc:
            at = data.find(b"$@", at + 2)
            continue
        if at + base >= start:
            tow, week = struct.unpack_from("<IH", data, at + 8)
            yield at, ident & 0x1FFF, tow, week, length
        at = data.find(b"$@", stop)


def sub_blocks(data: bytes, blocks: list[tuple[int, int]], head: int, inner: bool) -> tuple[np.ndarray, ...]:
    """Places of all sub-blocks of blocks given as (body, end): owner, place, size, and for ``inner`` ones owner, master and place."""
    owner, place, size, owner2, master2, place2 = [], [], [], [], [], []
    for i, (body, end) in enumerate(blocks):
        n, size1 = data[body], data[body + 1]
        size2 = data[body + 2] if inner else 0
        at = body + head
        for _ in range(n):
            if at + size1 > end or not size1:
                break
            owner.append(i)
            place.append(at)
            size.append(size1)
            n2 = data[at + MASTER.itemsize - 1] if inner else 0
            at += size1
            for _ in range(n2):
                if at + size2 > end:
                    break
                owner2.append(i)
                master2.append(len(place) - 1)
                place2.append(at)
                at += size2
    return tuple(np.array(x, np.int64) for x in (owner, place, size, owner2, master2, place2))


def fields_at(buffer: np.ndarray, places: np.ndarray, kind: np.dtype) -> np.ndarray:
    """Structures of type ``kind`` at ``places``; what lies beyond the buffer reads as zero."""
    spots = places[:, None] + np.arange(kind.itemsize)
    raw = np.where(spots < len(buffer), buffer[np.minimum(spots, len(buffer) - 1)], 0).astype("u1")
    return np.ascontiguousarray(raw).view(kind).ravel()


# -- rows of a range ----------------------------------------------------------------


class RangeRows:
    """The wanted rows of one range of a file."""

    def __init__(self, path: str, data: bytes, base: int, start: int, blocks: Iterable[tuple[int, int, int, int, int]]):
        self.path, self.part, self.base, self.data = path, start, base, data
        self.buffer = np.frombuffer(data, "u1")
        self.found: dict[int, list[tuple[int, int, int, int]]] = {}
        for at, number, tow, week, length in blocks:
            self.found.setdefault(number, []).append((at, tow, week, length))
        self.epochs = np.array([(at + base, tow, week) for at, tow, week, _ in self.found.get(MEAS_EPOCH, [])], np.int64).reshape(-1, 3)
        times = [(at + base, struct.unpack_from("<b", data, at + 20)[0]) for at, _, _, n in self.found.get(RECEIVER_TIME, []) if n >= 24]
        self.times = np.array(times, np.int64).reshape(-1, 2)

    def leap(self, at: np.ndarray, unknown: np.ndarray | bool = False) -> pa.Array:
        """Leap seconds told at or before each place, NULL where the range tells none or the place is ``unknown``."""
        k = np.searchsorted(self.times[:, 0], at, side="right") - 1
        value = self.times[np.maximum(k, 0), 1] if len(self.times) else np.zeros(len(at), np.int64)
        return pa.array(value.astype(np.int32), mask=(k < 0) | unknown)

    def batch(self, kind: str, heads: np.ndarray, owner: np.ndarray, **columns) -> Iterator[pa.RecordBatch]:
        """Rows of one kind: ``heads`` are (place, TOW, week) of blocks, ``owner`` says whose each row is."""
        for lo in range(0, len(owner), SLICE):
            cut = slice(lo, lo + SLICE)
            own = heads[owner[cut]]
            n = len(own)
            following = np.searchsorted(self.epochs[:, 0], own[:, 0])
            none = following >= len(self.epochs)
            epoch = self.epochs[np.minimum(following, len(self.epochs) - 1)] if len(self.epochs) else np.zeros((n, 3), np.int64)
            known = {
                "path": pa.array([self.path] * n), "part": np.full(n, self.part), "at": own[:, 0], "kind": pa.array([kind] * n),
                "tow": own[:, 1], "week": own[:, 2], "leap": self.leap(own[:, 0]),
                "epoch_at": pa.array(epoch[:, 0], mask=none), "epoch_tow": pa.array(epoch[:, 1], mask=none),
                "epoch_week": pa.array(epoch[:, 2], mask=none), "epoch_leap": self.leap(epoch[:, 0], none),
            }
            known |= {c: v[cut] if isinstance(v, np.ndarray) else v.slice(lo, n) for c, v in columns.items()}
            yield pa.RecordBatch.from_arrays([pa.nulls(n, f.type) if f.name not in known else pa.array(known[f.name]).cast(f.type) for f in SCHEMA], schema=SCHEMA)

    def blocks(self, number: int) -> tuple[list[tuple[int, int]], np.ndarray]:
        """(body, end) of the blocks of one number, and their (place in the file, TOW, week)."""
        rows = self.found.get(number, [])
        return [(at + 14, at + n) for at, _, _, n in rows], np.array([(at + self.base, tow, week) for at, tow, week, _ in rows], np.int64).reshape(-1, 3)

    def whole(self, number: int, kind: np.dtype, complete: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Structures at the bodies of blocks, the blocks, and how long each body is."""
        bodies, heads = self.blocks(number)
        long = np.array([end - body for body, end in bodies], np.int64)
        at = np.array([body for body, _ in bodies], np.int64)
        keep = long >= kind.itemsize if complete else long > 0
        return fields_at(self.buffer, at[keep], kind), heads[keep], long[keep]

    def obs(self) -> Iterator[pa.RecordBatch]:
        bodies, heads = self.blocks(MEAS_EPOCH)
        owner, place, _, owner2, master2, place2 = sub_blocks(self.data, bodies, 6, inner=True)
        masters = fields_at(self.buffer, place, MASTER)
        shared = ("channel", "svid", "type", "obs_info", "misc", "code_lsb", "doppler")
        own = {c: masters[c].astype(np.int64) for c in (*shared, "carrier_lsb", "carrier_msb", "cn0")}
        yield from self.batch("obs", heads, owner, **own)
        slaves = fields_at(self.buffer, place2, SLAVE)
        both = {c: own[c][master2] for c in shared} | {c: slaves[c].astype(np.int64) for c in SLAVE.names if c != "lock_time"}
        yield from self.batch("obs", heads, owner2, **both)

    def sky(self) -> Iterator[pa.RecordBatch]:
        bodies, heads = self.blocks(SAT_VISIBILITY)
        owner, place, *_ = sub_blocks(self.data, bodies, 2, inner=False)
        x = fields_at(self.buffer, place, SKY)
        yield from self.batch(
            "sky", heads, owner, svid=x["svid"].astype(np.int64), a=90.0 - x["elevation"] * 0.01, b=x["azimuth"] * 0.01, c=x["rise_set"].astype(float)
        )

    def pvt(self) -> Iterator[pa.RecordBatch]:
        x, heads, long = self.whole(PVT_GEODETIC, PVT, complete=False)
        ends = {"n_sv": 61, "corr_age": 66, "h_acc": 78, "v_acc": 80}
        rows = [[float(v) if n >= ends[c] else None for c, v in zip(ends, r)] for n, r in zip(long, x[list(ends)].tolist())]
        columns = {c: x[c] for c in "abc"}
        yield from self.batch("pvt", heads, np.arange(len(x)), type=x["mode"].astype(np.int64), fields=pa.array(rows, pa.list_(pa.float64())), **columns)

    def dop(self) -> Iterator[pa.RecordBatch]:
        x, heads, _ = self.whole(DOP, DILUTION, complete=True)
        yield from self.batch("dop", heads, np.arange(len(x)), **{c: x[c] * 0.01 for c in "abc"})

    def status(self) -> Iterator[pa.RecordBatch]:
        x, heads, _ = self.whole(RECEIVER_STATUS, STATUS, complete=True)
        yield from self.batch(
            "status", heads, np.arange(len(x)), a=x["cpu"].astype(float), b=x["temperature"].astype(float), c=x["error"].astype(float)
        )

    def extra(self) -> Iterator[pa.RecordBatch]:
        bodies, heads = self.blocks(MEAS_EXTRA)
        owner, place, size, *_ = sub_blocks(self.data, bodies, 6, inner=False)
        x = fields_at(self.buffer, place, EXTRA)
        values = np.stack([x[c].astype(float) for c in ("mp", "smoothing", "code_var", "carrier_var", "lock_time", "cum_loss", "car_mp")], axis=1) if len(x) else np.zeros((0, 7))
        yield from self.batch(
            "extra", heads, owner, channel=x["channel"].astype(np.int64), type=x["type"].astype(np.int64),
            obs_info=np.where(size >= 15, x["obs_info"], 0).astype(np.int64), misc=pa.array(x["misc"].astype(np.int64), mask=size < 16),
            fields=pa.array(list(values), pa.list_(pa.float64())),
        )

    def channel(self) -> Iterator[pa.RecordBatch]:
        """Frequency numbers where they change within the range."""
        bodies, heads = self.blocks(CHANNEL_STATUS)
        last: dict[int, int] = {}
        rows = []
        for i, (body, end) in enumerate(bodies):
            n, size1, size2 = self.data[body : body + 3]
            at = body + 6
            for _ in range(n):
                if at + size1 > end or size1 < 10:
                    break
                svid, freq = self.data[at], self.data[at + 1]
                if svid and last.get(svid) != freq:
                    last[svid] = freq
                    rows.append((i, svid, freq))
                at += size1 + self.data[at + 9] * size2
        owner, svid, freq = (np.array(x, np.int64) for x in (zip(*rows) if rows else ([], [], [])))
        yield from self.batch("channel", heads, owner, svid=svid, freq_nr=freq)

    def range(self) -> Iterator[pa.RecordBatch]:
        """What neighbours need: the last leap seconds told, the first epoch and the leap seconds told before it."""
        row = dict.fromkeys(SCHEMA.names) | {"path": self.path, "part": self.part, "kind": "range"}
        if len(self.times):
            row["leap"] = int(self.times[-1, 1])
        if len(self.epochs):
            at, tow, week = self.epochs[0].tolist()
            row |= {"epoch_at": at, "epoch_tow": tow, "epoch_week": week, "epoch_leap": self.leap(self.epochs[:1, 0]).to_pylist()[0]}
        yield pa.RecordBatch.from_pylist([row], schema=SCHEMA)


def range_rows(
    path: str, read: Callable[[int, int], bytes], size: int, start: int, end: int, kinds: tuple[str, ...] = KINDS, step: int | None = None,
) -> Iterator[pa.RecordBatch]:
    """Rows of the blocks that start in [start, end) of a file, by ranges of ``step`` bytes; ``read(at, n)`` gives its bytes."""
    base = max(0, start - 2 * LARGEST_BLOCK)
    data = read(base, min(size, end + LARGEST_BLOCK) - base)
    step = step or end - start
    blocks: dict[int, list] = {at: [] for at in range(start, end, step)}
    for block in walk(data, base, start, end):
        at = block[0] + base
        blocks[at - (at - start) % step].append(block)
    for at, inside in blocks.items():
        rows = RangeRows(path, data, base, at, inside)
        for kind in KINDS:
            if kind in kinds:
                yield from getattr(rows, kind)()


# -- data source ----------------------------------------------------------------------


def open_store(path: str) -> tuple[pafs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), posixpath.abspath(path)


def list_files(path: str) -> Iterator[tuple[str, int]]:
    """(URI, size) of a file, of a folder's files or of those a pattern names; hidden ones left out."""
    store, inside = open_store(path)
    prefix = path[: len(path) - len(inside)] if path.endswith(inside) else ""
    folder, pattern = posixpath.split(inside)
    if any(c in pattern for c in "*?["):
        found = [f for f in store.get_file_info(pafs.FileSelector(folder)) if fnmatch.fnmatchcase(posixpath.basename(f.path), pattern)]
    else:
        (found,) = [store.get_file_info([inside])]
        if found[0].type == pafs.FileType.Directory:
            found = store.get_file_info(pafs.FileSelector(inside, recursive=True))
        elif found[0].type == pafs.FileType.NotFound:
            raise FileNotFoundError(path)
    for f in sorted(found, key=lambda f: f.path):
        if f.type == pafs.FileType.File and not posixpath.basename(f.path).startswith((".", "_")):
            yield prefix + f.path, f.size


@dataclass
class ByteRanges(InputPartition):
    """Stretches of files, (path, size, start, end) each, that one task reads range by range."""

    stretches: list[tuple[str, int, int, int]]


class SbfReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        path = options["path"]
        self.paths = json.loads(path) if path.startswith("[") else [path]
        self.step = int(options.get("rangeBytes", RANGE_BYTES))
        self.kinds = tuple(options["kinds"].split(",")) if "kinds" in options else KINDS

    def partitions(self) -> list[ByteRanges]:
        files = [f for given in self.paths for f in list_files(given)]
        share = max(self.step, min(RANGE_BYTES, sum(size for _, size in files) // MIN_TASKS))
        share -= share % self.step
        tasks, room = [], 0
        for path, size in files:
            for at in range(0, size, share):
                stretch = (path, size, at, min(at + share, size))
                n = stretch[3] - at
                if n > room:
                    tasks.append(ByteRanges([]))
                    room = share
                tasks[-1].stretches.append(stretch)
                room -= n
        return tasks

    def read(self, partition: ByteRanges) -> Iterator[pa.RecordBatch]:
        for path, size, start, end in partition.stretches:
            store, inside = open_store(path)
            with store.open_input_file(inside) as f:
                yield from range_rows(path, lambda at, n, f=f: f.read_at(n, at), size, start, end, self.kinds, self.step)


class SbfSource(DataSource):
    """``spark.read.format("sbf")``; options ``path`` (or a JSON list of paths), ``rangeBytes`` and ``kinds`` (by commas)."""

    @classmethod
    def name(cls) -> str:
        return "sbf"

    def schema(self) -> str:
        return DDL

    def reader(self, schema) -> SbfReader:
        return SbfReader(self.options)
