import binascii
import struct
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from leafwave.api.registry import detect_format, read_any
from leafwave.sources import filenames as fn
from leafwave.sources.lines import file_registry
from leafwave.sources.nmea import read_nmea
from leafwave.sources.products import read_clk, read_sp3
from leafwave.sources.rinex2 import read_rinex2
from leafwave.sources.rinex3 import is_stripped, parse_header, read_rinex3
from leafwave.sources.lines import read_records
from leafwave.sources.sbf import observations_and_geometry, positions, read_raw, read_sbf
from leafwave.sources.sinex import read_catalogue


def label(text, name):
    return f"{text:<60}{name}"


def field(value, tail="  "):
    return f"{value:14.3f}{tail}" if value is not None else " " * 16


def rinex3_text(newline="\n"):
    codes = ["C1C", "L1C", "D1C", "S1C", "C1W", "L1W", "S1W", "C2W", "L2W", "S2W", "C5Q", "L5Q", "S5Q", "D5Q"]
    lines = [
        label(f"{'3.04':>9}{'':11}OBSERVATION DATA    M", "RINEX VERSION / TYPE"),
        label("STATION", "MARKER NAME"),
        label("  4075539.8000   931735.3000  4801629.6000", "APPROX POSITION XYZ"),
        label("G   14 " + " ".join(codes[:13]), "SYS / # / OBS TYPES"),
        label("       " + codes[13], "SYS / # / OBS TYPES"),
        label("R    2 C1C S1C", "SYS / # / OBS TYPES"),
        label("", "END OF HEADER"),
        "> 2025 01 01 00 00  0.0000000  0  3",
        "G01" + field(2.1e7, " 7") + field(1.1e8, "16") + field(-512.125) + field(44.5)
        + field(None) * 9 + field(33.25),
        "R05" + field(1.9e7) + field(0.0, " 4"),
        "G99" + field(1.0),
        "> 2025 01 01 00 00 05.5000000  0  1",
        "G01" + field(2.2e7) + field(None) * 2 + "        oops  ",
        "> broken epoch line",
        "G01" + field(9.9e7),
    ]
    return newline.join(lines) + newline


@pytest.mark.parametrize("newline", ["\n", "\r\n"])
def test_rinex3(spark, tmp_path, newline):
    for name in ("a.rnx", "b.rnx"):
        (tmp_path / name).write_bytes(rinex3_text(newline).encode())
    rows = read_rinex3(spark, str(tmp_path)).orderBy("path", "epoch", "sid").collect()
    one = [r for r in rows if r["path"].endswith("a.rnx")]
    assert len(rows) == 2 * len(one)
    got = {(r["epoch"], r["sid"]): r for r in one}
    t0, t1 = datetime(2025, 1, 1), datetime(2025, 1, 1, 0, 0, 5, 500000)
    assert set(got) == {
        (t0, "G01|L1|C"), (t0, "G01|L5|Q"), (t0, "R05|G1|C"), (t1, "G01|L1|C"),
    }
    first = got[(t0, "G01|L1|C")]
    assert (first["SNR"], first["Pseudorange"], first["Phase"], first["Doppler"]) == (44.5, 2.1e7, 1.1e8, -512.125)
    assert (first["LLI"], first["SSI"]) == (1, 6)
    assert got[(t0, "G01|L5|Q")]["Doppler"] == 33.25
    # Zero signal strength is missing, its indicator is not.
    assert got[(t0, "R05|G1|C")]["SNR"] is None and got[(t0, "R05|G1|C")]["SSI"] == 4
    assert got[(t1, "G01|L1|C")]["SNR"] is None
    header = parse_header(read_records(spark, str(tmp_path), "\n>")).first()
    assert (header["approx_x"], header["marker_name"]) == (4075539.8, "STATION")


def test_rinex3_is_independent_of_split_size(spark, tmp_path):
    blocks = "".join(
        f"> 2025 01 01 {i // 3600:02d} {i % 3600 // 60:02d} {i % 60:2d}.0000000  0  1\n".replace("  0  1", "  0  1")
        + "R05" + field(1e7 + i) + field(30 + i % 20) + "\n"
        for i in range(2000)
    ).replace("> 2025 01 01", "> 2025 01 01")
    head = "\n".join(
        [label(f"{'3.04':>9}", "RINEX VERSION / TYPE"), label("R    2 C1C S1C", "SYS / # / OBS TYPES"), label("", "END OF HEADER")]
    )
    (tmp_path / "x.rnx").write_text(head + "\n" + blocks)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
        df = read_rinex3(spark, str(tmp_path))
        assert df.count() == 2000
        assert df.agg(F.sum("Pseudorange")).first()[0] == pytest.approx(sum(1e7 + i for i in range(2000)))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_stripped_files(spark, tmp_path):
    text = "\n".join(
        [label(f"{'3.05':>9}", "RINEX VERSION / TYPE"), label("G    1 S1C", "SYS / # / OBS TYPES"), label("", "END OF HEADER"),
         "> 2025 01 01 00 00  0.0000000  0  1", "G01" + field(40.0)]
    )
    (tmp_path / "s.rnx").write_text(text + "\n")
    assert read_rinex3(spark, str(tmp_path), stripped=True).first()["SNR"] == 40.0
    assert is_stripped(parse_header(read_records(spark, str(tmp_path), "\n>"))).first()["stripped"]
    (tmp_path / "full.rnx").write_text(rinex3_text())
    with pytest.raises(ValueError):
        read_rinex3(spark, str(tmp_path), stripped=True)


def rinex2_text(n_epochs=1):
    sats = [f"G{i:02d}" for i in range(1, 14)] + [" 20"]
    out = [
        label(f"{'2.11':>9}", "RINEX VERSION / TYPE"),
        label("    10    C1    L1    S1    P2    L2    S2    C5    L5    S5", "# / TYPES OF OBSERV"),
        label("          D1", "# / TYPES OF OBSERV"),
        label("", "END OF HEADER"),
    ]
    for k in range(n_epochs):
        out += [
            f" 25  1  1  0 {k:2d} 30.0000000  0 14" + "".join(sats[:12]),
            " " * 32 + "".join(sats[12:]),
        ]
        for i in range(14):
            out.append(field(2e7 + i) + field(1e8, "1 ") + field(40.0 + i) + field(0.0) + field(None))
            out.append(field(None) * 4 + field(-100.0 - i))
        out += [f" 25  1  1  0 {k:2d} 45.0000000  4  1", label("A COMMENT", "COMMENT")]
    return "\n".join(out) + "\n"


@pytest.mark.parametrize("split", [None, 4096])
def test_rinex2(spark, tmp_path, split):
    (tmp_path / "a.25o").write_text(rinex2_text(12))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    if split:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    try:
        rows = read_rinex2(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert len(rows) == 12 * 14 * 2
    at = {(r["epoch"], r["sid"]): r for r in rows}
    t = datetime(2025, 1, 1, 0, 3, 30)
    assert at[(t, "G20|L1|C")]["Pseudorange"] == 2e7 + 13
    x = at[(t, "G13|L1|X")]
    assert (x["SNR"], x["Phase"], x["Doppler"], x["LLI"]) == (52.0, 1e8, -112.0, 1)
    # P2 is zero and L2 blank: no L2 rows.
    assert not [s for _, s in at if "|L2|" in s]


def sentence(body):
    c = 0
    for ch in body:
        c ^= ord(ch)
    return f"${body}*{c:02X}"


def test_nmea(spark, tmp_path):
    lines = [
        sentence("GPGSV,1,1,01,09,10,100,33"),  # before any epoch
        sentence("GPRMC,235959.00,A,1,N,1,E,0,0,311224,,"),
        sentence("GPGSV,1,1,03,01,40,083,46,02,17,308,,33,07,344,39"),
        sentence("GLGSV,1,1,01,65,40,083,30"),
        sentence("GPGSV,1,1,01,01,40,083,48"),  # the larger value of an epoch counts
        "$GPGSV,1,1,01,05,40,083,50*00",  # wrong checksum
        sentence("GNGGA,000000.50,1,N,1,E,1,08,0.9,5,M,4,M,,"),  # time on the last known date
        sentence("GPGSV,1,1,01,01,40,083,41,8"),
        sentence("GAGSV,1,1,01,11,40,083,35,7"),
    ]
    (tmp_path / "l.nmea").write_text("\r\n".join(lines) + "\r\n")
    got = {(r["epoch"], r["sid"]): r["SNR"] for r in read_nmea(spark, str(tmp_path)).collect()}
    t0, t1 = datetime(2024, 12, 31, 23, 59, 59), datetime(2024, 12, 31, 0, 0, 0, 500000)
    assert got == {
        (t0, "G01|L1|C"): 48.0, (t0, "G02|L1|C"): None, (t0, "S01|L1|C"): 39.0, (t0, "R01|G1|C"): 30.0,
        (t1, "G01|L5|Q"): 41.0, (t1, "E11|E1|X"): 35.0,
    }
    assert detect_format(spark, str(tmp_path / "l.nmea")) == "nmea"
    assert read_any(spark, str(tmp_path / "l.nmea")).count() == 6
    (tmp_path / "a.rnx").write_text(rinex3_text())
    alone = read_rinex3(spark, str(tmp_path / "a.rnx")).count()
    assert alone > 0 and read_any(spark, str(tmp_path)).count() == 6 + alone
    (tmp_path / "x.txt").write_text("nothing known\n")
    with pytest.raises(ValueError, match="x.txt"):
        read_any(spark, str(tmp_path))


def test_products(spark, tmp_path):
    (tmp_path / "o.sp3").write_text(
        "#dP2024  1  1  0  0  0.00000000\n+    2 G01G02\n"
        "*  2024  1  1  0  0  0.00000000\nPG01  15000.123456 -20000.000001   1234.500000 999999.999999\n"
        "PG02 999999.999999  1.000000      2.000000 0\n"
        "*  2024  1  1  0 15  0.00000000\nPG01  15001.000000 -20000.000000   1234.000000 1.0\nEOF\n"
    )
    rows = read_sp3(spark, str(tmp_path / "o.sp3")).orderBy("epoch", "sv").collect()
    assert len(rows) == 3 and rows[0]["X"] == pytest.approx(15000123.456) and rows[1]["X"] is None
    assert rows[2]["epoch"] == datetime(2024, 1, 1, 0, 15)
    (tmp_path / "c.clk").write_text(
        "     3.00           C                   RINEX VERSION / TYPE\n"
        "AS G01  2024 01 01 00 00 30.900000  2   1.5e-04 1e-11\nAR ABCD 2024 01 01 00 00  0.0 1 0.0\n"
    )
    (row,) = read_clk(spark, str(tmp_path / "c.clk")).collect()
    assert (row["epoch"], row["sv"], row["clock_offset"]) == (datetime(2024, 1, 1, 0, 0, 30), "G01", 1.5e-4)


def test_catalogue(spark, tmp_path):
    (tmp_path / "m.snx").write_text(
        "%=SNX 2.00\n+SATELLITE/IDENTIFIER\n*SVN_ COSPAR ID SatCat Block__________ Comment\n"
        " G063 2011-036A 37753  GPS-IIF         Launched 2011\n-SATELLITE/IDENTIFIER\n"
        "+SATELLITE/PRN\n G063 2011:197:00000 2019:001:00000 G01\n G080 2019:002:00000 0000:000:00000 G01\n-SATELLITE/PRN\n"
        "+SATELLITE/MASS\n G063 2011:197:00000 0000:000:00000  1633.000 note\n-SATELLITE/MASS\n"
    )
    tables = read_catalogue(spark, str(tmp_path / "m.snx"))
    prn = {r["svn"]: r for r in tables["prn"].collect()}
    assert prn["G063"]["prn"] == "G01" and prn["G063"]["block"] == "GPS-IIF" and prn["G080"]["end"] is None
    assert tables["mass"].first()["mass_kg"] == 1633.0


def sbf_block(number, tow, week, body):
    payload = struct.pack("<HHIH", number, 0, tow, week) + body
    payload += b"\0" * (-(len(payload) + 4) % 4)
    length = len(payload) + 4
    payload = payload[:2] + struct.pack("<H", length) + payload[4:]
    return b"$@" + struct.pack("<H", binascii.crc_hqx(payload, 0)) + payload


def test_sbf(spark, tmp_path):
    status = struct.pack("<BBB3x", 1, 12, 8) + struct.pack("<BB2xHHbBBx", 40, 10, 0, 0, 0, 0, 1)
    time = struct.pack("<bbbbbbbB", 25, 1, 1, 0, 0, 0, 18, 7)
    t1 = struct.pack("<BBBBIiHbBHBB", 3, 0, 7, 5, 1000, 12345, 500, 2, 140, 9, 0, 1)
    t2 = struct.pack("<BBBBbBHHH", 3, 9, 120, 0b11110111, 1, 0, 2000, 300, 100)
    r = struct.pack("<BBBBIiHbBHBB", 4, 8, 40, 5, 2000, -(1 << 31), 0, -128, 255, 9, 0, 0)
    meas = struct.pack("<BBBBBB", 2, 20, 12, 0, 0, 0) + t1 + t2 + r
    sky = struct.pack("<BB", 1, 8) + struct.pack("<BBHhBB", 7, 0, 9000, 4500, 1, 0)
    pvt = struct.pack("<BBddd", 4, 0, 0.8, 0.3, 250.0)
    dop = struct.pack("<BBHHHH", 9, 0, 150, 0, 90, 120)
    good = [
        sbf_block(5914, 0, 2347, time), sbf_block(4013, 0, 2347, status), sbf_block(4007, 1000, 2347, pvt),
        sbf_block(4001, 1000, 2347, dop), sbf_block(4012, 1000, 2347, sky), sbf_block(4027, 1000, 2347, meas),
    ]
    corrupt = bytearray(sbf_block(4027, 2000, 2347, meas))
    corrupt[20] ^= 1
    (tmp_path / "r.sbf").write_bytes(b"junk" + b"".join(good) + bytes(corrupt))
    got = {row["sid"]: row for row in read_sbf(spark, str(tmp_path / "r.sbf")).collect()}
    assert set(got) == {"G07|L1|C", "G07|L2|L", "R03|G1|C"}
    g = got["G07|L1|C"]
    pr = (5 * 2**32 + 1000) * 1e-3
    assert g["SNR"] == 45.0 and g["Pseudorange"] == pytest.approx(pr) and g["Doppler"] == pytest.approx(1.2345)
    assert g["Phase"] == pytest.approx(pr * 1575.42e6 / 299792458 + (2 * 65536 + 500) * 1e-3)
    s = got["G07|L2|L"]
    assert s["SNR"] == 40.0 and s["Pseudorange"] == pytest.approx(pr + (-65536 + 2000) * 1e-3)
    assert s["Doppler"] == pytest.approx(1.2345 * 1227.6 / 1575.42 + (-2 * 65536 + 100) * 1e-4, rel=1e-5)
    n = got["R03|G1|C"]
    assert n["SNR"] is None and n["Doppler"] is None and n["Phase"] is None and n["Pseudorange"] is not None
    raw = read_raw(spark, str(tmp_path / "r.sbf"))
    p = positions(raw).first()
    assert (p["latitude"], p["height"], p["pdop"], p["vdop"]) == (0.8, 250.0, 1.5, 1.2)
    _, geometry = observations_and_geometry(raw)
    angles = {row["sid"]: (row["theta"], row["phi"]) for row in geometry.collect()}
    assert set(angles) == {"G07|L1|C", "G07|L2|L"}
    assert angles["G07|L1|C"] == pytest.approx((0.785398163, 1.570796327))


def test_names_and_hashes(spark, tmp_path):
    df = spark.createDataFrame(
        [("/d/LEAA01TUW_R_20250011530_15M_05S_AA.rnx.gz",), ("ract001b15.25o",), ("rosl001a.25o",), ("rref001a00.25_",),
         ("ROSX00TUW_R_20250010000_01D_05S_MO.rnx",), ("notes.txt",)],
        "path string",
    )
    fam = [r["family"] for r in fn.match_families(df).collect()]
    assert fam == ["canonical", "septentrio_rinex_v2", "rinex_v2_short", "septentrio_sbf", "rinex_v3_long", None]
    p = fn.parse_canonical(df).first()
    assert (p["site"], p["hour"], p["minute"], p["compression"]) == ("LEA", 15, 30, "gz")
    assert fn.parse_canonical(df).select(fn.canonical_name().alias("n")).first()["n"] == p["path"].split("/")[-1]
    (tmp_path / "x").write_bytes(b"abc")
    assert file_registry(spark, str(tmp_path / "x")).first()["file_hash"] == "ba7816bf8f01cfea"


def test_nmea_log_in_the_order_of_its_events(spark, tmp_path):
    """Events whose times start over with each copy: a line's epoch comes from the line before it, not from its day."""
    import duckdb
    from leafwave.plans import ORACLES, QUERIES

    events = f"SELECT event_id + i * 1000000 AS event_id, ts, user_id, event_type, value, props FROM '/root/testdata/sf0.001/events.parquet', range(5) r(i)"
    con = duckdb.connect()
    con.execute(f"COPY ({events}) TO '{tmp_path}/events.parquet' (FORMAT parquet)")
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet'")
    got = sorted(tuple(r) for r in QUERIES["nmea_parse"](spark, str(tmp_path)).select("epoch", "sid", "SNR").collect())
    assert got == sorted(con.sql(f"SELECT epoch, sid, SNR FROM ({ORACLES['nmea_parse']})").fetchall())


def test_nmea_state_crosses_splits(spark):
    from leafwave.sources.nmea import parse_sentences

    rows = [
        (0, 1, sentence("GPRMC,235959.00,A,1,N,1,E,0,0,311224,,")),
        (1, 2, sentence("GPGSV,1,1,01,01,40,083,41")),  # a split that tells no epoch
        (2, 3, sentence("GPGSV,1,1,01,02,40,083,42")),
        (2, 4, sentence("GNGGA,000000.50,1,N,1,E,1,08,0.9,5,M,4,M,,")),  # its date comes from another split
        (2, 5, sentence("GNGGA,99,1,N,1,E,1,08,0.9,5,M,4,M,,")),  # no time
        (3, 6, sentence("GPGSV,1,1,01,03,40,083,43")),
        (3, 7, sentence("GPRMC,120000.00,A,1,N,1,E,0,0,,,")),  # no date
        (3, 8, sentence("GPGSV,1,1,01,04,40,083,44")),
    ]
    lines = spark.createDataFrame([("f", *r) for r in rows], "path string, block long, pos long, line string")
    t0, t1 = datetime(2024, 12, 31, 23, 59, 59), datetime(2024, 12, 31, 0, 0, 0, 500000)
    got = {r["sid"][:3]: (r["epoch"], r["SNR"]) for r in parse_sentences(lines).collect()}
    assert got == {"G01": (t0, 41.0), "G02": (t0, 42.0), "G03": (t1, 43.0), "G04": (t1, 44.0)}
