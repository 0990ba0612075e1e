"""RINEX files through the data source: pruned by name and time, cut anywhere, in batch and as a stream."""

import gzip
import os
from datetime import datetime, timedelta

import pytest

from leafwave.sources import rinex3, rinex_source
from leafwave.sources.rinex_source import Wanted, name_span

HEADER = "".join(
    f"{text:<60}{label}\n"
    for text, label in ((f"{'3.04':>9}{'':11}OBSERVATION DATA    M", "RINEX VERSION / TYPE"), ("G    2 C1C S1C", "SYS / # / OBS TYPES"), ("", "END OF HEADER"))
)
START = datetime(2025, 1, 1)


def text_of(first: datetime, epochs: int, step: int = 30) -> str:
    out = HEADER
    for i in range(epochs):
        t = first + timedelta(seconds=step * i)
        out += t.strftime("> %Y %m %d %H %M ") + f"{t.second:2d}.0000000  0  2\n".replace("  0.", " 00.") if t.second < 10 else t.strftime("> %Y %m %d %H %M %S.0000000  0  2\n")
        out += "".join(f"G{s:02d}{2e7 + s + i:14.3f}  {40 + s / 10:14.3f}  \n" for s in (3, 17))
    return out


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    d = tmp_path_factory.mktemp("rinex")
    for h in range(4):
        (d / f"LEAA01TUW_R_20250010{h}00_01H_30S_AA.rnx").write_text(text_of(START + timedelta(hours=h), 120))
    (d / "notes.rnx").write_text(text_of(START + timedelta(days=9), 5))
    with gzip.open(d / "LEAA01TUW_R_20250020000_15M_30S_AA.rnx.gz", "wt") as f:
        f.write(text_of(START + timedelta(days=1), 30))
    return str(d)


def rows(df):
    return sorted(map(tuple, df.select("epoch", "sid", "SNR", "Pseudorange").collect()))


def test_names_tell_periods():
    day = timedelta(days=1)
    assert name_span("/x/LEAA01TUW_R_20250010100_01H_30S_AA.rnx.gz") == (START + timedelta(hours=1), START + timedelta(hours=2))
    assert name_span("ROSX00TUW_R_20250010000_01D_05S_MO.rnx") == (START, START + day)
    assert name_span("ract001b15.25o") == (START + timedelta(minutes=75), START + timedelta(minutes=90))
    assert name_span("rosl0010.25o") == (START, START + day) and name_span("rosl001c.25o")[1] == START + timedelta(hours=3)
    assert name_span("notes.txt") is None


def test_wanted_files_and_epochs():
    w = Wanted(START + timedelta(hours=1), START + timedelta(hours=2))
    names = [f"LEAA01TUW_R_20250010{h}00_01H_30S_AA.rnx" for h in range(4)]
    assert [w.file(n) for n in names] == [False, True, True, False] and w.file("notes.rnx")
    assert w.epoch(START + timedelta(hours=1)) and not w.epoch(START) and not w.epoch(None)


def test_files_outside_the_bounds_stay_unread(spark, folder):
    assert len(rinex_source.RinexReader(rinex_source._Options({"path": folder})).partitions()) == 6
    bounds = {"start": "2025-01-01T02:10:30", "end": "2025-01-01T02:19:30"}
    reader = rinex_source.RinexReader(rinex_source._Options({"path": folder, **bounds}))
    assert {os.path.basename(p.path) for p in reader.partitions()} == {"LEAA01TUW_R_20250010200_01H_30S_AA.rnx", "notes.rnx"}
    rinex_source.register(spark)
    wanted = spark.read.format("rinex").options(**bounds).load(folder)
    assert wanted.rdd.getNumPartitions() == 2 and wanted.count() == 19
    everything = spark.read.format("rinex").load(folder)
    counts = [everything.where(f"hour(epoch) = {h}").count() for h in (1, 2, 1)]
    assert counts == [120, 120, 120]  # filters of one frame do not meet


@pytest.mark.parametrize("step", [1 << 25, 4_000, 301, 64])
def test_rows_do_not_depend_on_the_cut(spark, folder, step):
    got = rinex_source.read_between(spark, folder, range_bytes=step)
    assert rows(got) == rows(rinex3.read_rinex3(spark, folder))
    part = rinex_source.read_between(spark, folder, START + timedelta(minutes=59), START + timedelta(minutes=61), step)
    assert {r[0] for r in rows(part)} == {START + timedelta(minutes=59, seconds=30 * i) for i in range(5)}


def test_headers_and_odd_files(spark, folder, tmp_path):
    heads = rinex_source.headers(spark, folder).collect()
    assert len(heads) == 6 and all(h["codes"] == ["GC1C", "GS1C"] for h in heads)
    (tmp_path / "empty.rnx").write_text("")
    (tmp_path / "cut.rnx").write_text(HEADER[:100])
    (tmp_path / "late.rnx").write_text(HEADER + "> 2025 13 01 00 00  0.0000000  0  1\nG01\n> nothing\n>")
    assert rinex_source.headers(spark, str(tmp_path)).count() == 1
    assert rinex_source.read_between(spark, str(tmp_path)).count() == 0
    rinex_source.register(spark)
    assert spark.read.format("rinex").load(str(tmp_path)).where("epoch IS NULL").count() == 3


def test_stream_reads_each_file_once_and_equals_batch(spark, tmp_path):
    landing, out, state = (str(tmp_path / n) for n in ("landing", "out", "state"))
    os.mkdir(landing)
    rinex_source.register(spark)

    def land(h, at):
        path = f"{landing}/LEAA01TUW_R_20250010{h}00_01H_30S_AA.rnx"
        with open(path, "w") as f:
            f.write(text_of(START + timedelta(hours=h), 20))
        os.utime(path, (at, at))

    def run():
        q = rinex_source.stream(spark, landing, 0).writeStream.format("parquet").option("checkpointLocation", state).trigger(availableNow=True).start(out)
        q.awaitTermination(120)
        assert q.exception() is None

    land(2, 1000)
    land(1, 1000)
    run()
    assert spark.read.parquet(out).count() == 40
    run()
    assert spark.read.parquet(out).count() == 40
    land(0, 1001)
    land(3, 1002)
    run()
    streamed, batch = (df.select("path", "epoch", "record") for df in (spark.read.parquet(out), spark.read.format("rinex").load(landing)))
    assert sorted(map(tuple, streamed.collect())) == sorted(map(tuple, batch.collect()))
    assert streamed.count() == 80


def test_arrivals_that_have_not_settled_wait(tmp_path):
    (tmp_path / "a.rnx").write_text(HEADER)
    reader = rinex_source.RinexStreamReader(rinex_source._Options({"path": str(tmp_path), "settleSeconds": "60"}))
    assert reader.latestOffset() == reader.initialOffset() and reader.partitions(reader.initialOffset(), reader.latestOffset()) == []
