"""Binary files in byte ranges: the same rows however a file is cut, and every field against how it was packed."""

import binascii
import math
import random
import struct

import pytest

from leafwave.functions import sbf as sc
from leafwave.sources import sbf, sbf_source

WEEK = 2347


def block(number, tow, body, week=WEEK):
    payload = struct.pack("<HHIH", number, 0, tow, week) + body
    payload += b"\0" * (-(len(payload) + 4) % 4)
    payload = payload[:2] + struct.pack("<H", len(payload) + 4) + payload[4:]
    return b"$@" + struct.pack("<H", binascii.crc_hqx(payload, 0)) + payload


def recording(seed=1, epochs=60, junk=True):
    """A file, and what its blocks say."""
    rng = random.Random(seed)
    out, told = [], []
    leap, freq = 18, {}
    for e in range(epochs):
        tow = 1000 * (e + 1)
        if e in (5, 40):
            leap = 18 - (e == 40)
            out.append(block(5914, tow, struct.pack("<bbbbbbbB", 25, 1, 1, 0, 0, 0, leap, 7)))
        if e in (3, 30):
            freq = {40: 10 + (e == 30), 41: 5}
            body = struct.pack("<BBB3x", 2, 12, 8) + b"".join(struct.pack("<BB2xHHbBBx", s, f, 0, 0, 0, 0, 1) + b"\1" * 8 for s, f in freq.items())
            out.append(block(4013, tow, body))
        x = {"tow": tow, "leap": leap, "freq": dict(freq)}
        if e % 3:
            x["dop"] = [rng.randrange(1, 900) for _ in range(3)]
            out.append(block(4001, tow, struct.pack("<BBHHHH", 9, 0, x["dop"][0], 0, *x["dop"][1:])))
        if e % 4 == 1:
            for _ in range(1 + (e % 8 == 1)):  # the later of two counts
                x["pvt"] = dict(mode=rng.randrange(11), n_sv=rng.randrange(40), age=rng.randrange(1000), h=rng.choice([65535, 130]), v=250)
                p = x["pvt"]
                body = struct.pack("<BBddd", p["mode"], 0, 0.8, 0.3, 250.0) + b"\0" * 34 + struct.pack("<BBHHIBBHHHHH", p["n_sv"], 0, 0, p["age"], 0, 0, 0, 0, 0, p["h"], p["v"], 0)
                out.append(block(4007, tow, body))
        if e % 5 == 2:
            x["status"] = (rng.randrange(100), rng.choice([0, 121]), rng.choice([0, 48]))
            out.append(block(4014, tow, struct.pack("<BBIIIBBBB", x["status"][0], 0, 9, 0, x["status"][2], 0, 0, 0, x["status"][1])))
        if e % 2:
            x["sky"] = [(s, rng.randrange(36000), rng.randrange(9000), rng.choice([0, 1, 255])) for s in (7, 40)]
            out.append(block(4012, tow, struct.pack("<BB", 2, 8) + b"".join(struct.pack("<BBHhBB", s, 0, a, el, r, 0) for s, a, el, r in x["sky"])))
        if e % 3 == 1:
            x["extra"] = {(c, s): (rng.randrange(-900, 900), rng.randrange(-900, 900), rng.choice([65535, 77]), rng.choice([65535, 5]), rng.choice([65535, 300]), 4, rng.randrange(-128, 128), rng.randrange(8)) for c, s in ((3, 0), (3, 3), (4, 8))}
            body = b"".join(struct.pack("<BBhhHHHBbBB", c, s, *v[:5], v[5], v[6], 0, v[7]) for (c, s), v in x["extra"].items())
            out.append(block(4000, tow, struct.pack("<BBf", 3, 16, 1.0) + body))
        x["g"] = (rng.randrange(2**32), rng.randrange(-10**6, 10**6), rng.randrange(65536), rng.randrange(100), rng.randrange(200))
        x["s"] = (rng.randrange(60000), rng.randrange(60000), rng.randrange(65536), rng.randrange(200))
        code, doppler, lsb, msb, level = x["g"]
        t1 = struct.pack("<BBBBIiHbBHBB", 3, 0, 7, 5, code, doppler, lsb, msb, level, 9, 0, 1)
        t2 = struct.pack("<BBBBbBHHH", 3, 9, x["s"][3], 0b11110111, 1, 0, x["s"][0], x["s"][2], x["s"][1])
        r = struct.pack("<BBBBIiHbBHBB", 4, 8, 40, 5, code, doppler, lsb, msb, level, 9, 0, 0)
        meas = block(4027, tow, struct.pack("<BBBBBB", 2, 20, 12, 0, 0, 0) + t1 + t2 + r)
        if junk and e % 7 == 3:
            bad = bytearray(meas)
            bad[25] ^= 4
            out += [bytes(bad), b"$@ $@$@", bytes(rng.randrange(256) for _ in range(rng.randrange(50)))]
        out.append(meas)
        told.append(x)
    return b"".join(out), told


def as_set(df, *columns):
    return sorted(tuple(None if v is None else round(v, 9) if isinstance(v, float) else v for v in r) for r in df.select(*columns).collect())


RAW = [c.split()[0] for c in sbf_source.DDL.split(", ") if c.split()[0] not in ("part", "fields", "leap")] + ["epoch", "of_epoch"]


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("sbf")
    told = {}
    for name, seed in (("a.sbf", 1), ("b.sbf", 2)):
        data, told[name] = recording(seed)
        (folder / name).write_bytes(data)
    (folder / "_hidden").write_bytes(b"x")
    return str(folder), told, len(data)


def test_rows_do_not_depend_on_the_cut(spark, landed):
    folder, _, size = landed
    want = as_set(sbf.read_raw(spark, folder), *RAW)
    assert len({r[0] for r in want}) == 2 and {r[2] for r in want} == {"obs", "sky", "pvt", "dop", "status", "extra"}
    for parts in (3, 50):
        step = size // parts
        blocks = sbf.read_blocks(spark, folder, step)
        assert blocks.rdd.getNumPartitions() > 1.5 * parts
        got = as_set(sbf.read_raw(spark, folder, step), *RAW)
        assert got == want, parts
    strip = lambda rows: sorted((r[0].rsplit("/", 1)[1], *r[1:]) for r in rows)
    assert strip(as_set(sbf.read_raw(spark, folder, size // 9, whole_files=True), *RAW)) == strip(want)


@pytest.mark.parametrize("step", [1 << 24, 301])
def test_every_field(spark, landed, step):
    folder, told, _ = landed
    raw = sbf.read_raw(spark, f"{folder}/a.sbf", step)
    first = {tow: min(r["epoch"] for r in raw.where(f"kind = 'obs' AND tow = {tow}").collect()) for tow in (1000, 41000)}
    assert (first[41000] - first[1000]).total_seconds() == 41  # one leap second less
    epochs = {x["tow"]: x for x in told["a.sbf"]}
    quality = sbf.epoch_quality(raw).collect()
    assert len(quality) == len(epochs)
    by_time = dict(zip(sorted(r["epoch"] for r in quality), sorted(epochs)))
    near = lambda a, b: (a is None) == (b is None) and (a is None or math.isclose(a, b, abs_tol=1e-9))
    for r in quality:
        x = epochs[by_time[r["epoch"]]]
        for c, v in zip(("pdop", "hdop", "vdop"), x.get("dop", [None] * 3)):
            assert near(r[c], None if v is None else v / 100)
        p = x.get("pvt")
        assert (r["n_sv"], r["pvt_mode"]) == ((p["n_sv"], p["mode"]) if p else (None, None))
        assert near(r["mean_corr_age_s"], p and p["age"] / 100) and near(r["h_accuracy_m"], p and (None if p["h"] == 65535 else 1.3)) and near(r["v_accuracy_m"], p and 2.5)
        s = x.get("status")
        assert (r["cpu_load"], r["rx_error"]) == ((s[0], s[2]) if s else (None, None)) and near(r["temperature_c"], s and (None if s[1] == 0 else 21.0))
    names = {"G07|L1|C": (3, 0, 7), "G07|L2|L": (3, 3, 7), "R03|G1|C": (4, 8, 40)}
    signals = sbf.signal_quality(raw).collect()
    assert len(signals) == 3 * len(epochs)
    for r in signals:
        x = epochs[by_time[r["epoch"]]]
        channel, number, svid = names[r["sid"]]
        v = x.get("extra", {}).get((channel, number))
        want = [None] * 8 if v is None else [v[0] / 1000, v[1] / 1000, None if v[2] == 65535 else v[2] * 1e-4, *[None if k == 65535 else k for k in v[3:5]], v[5], v[6] / 512, v[7] / 32]
        have = [r[c] for c in ("mp_correction_m", "smoothing_corr_m", "code_var", "carrier_var", "lock_time_s", "cum_loss_cont", "car_mp_corr_cycles", "cn0_highres_correction")]
        assert all(map(near, have, want)), (r, want)
        s = next((y for y in x.get("sky", []) if y[0] == svid), None)
        assert near(r["broadcast_theta"], s and math.radians(90 - s[2] / 100)) and near(r["broadcast_phi"], s and math.radians(s[1] / 100))
        assert r["rise_set"] == (None if s is None or s[3] == 255 else s[3])
    last = {40: 11, 41: 5}
    for r in sbf.corrected_observations(raw).collect():
        x = epochs[by_time[r["epoch"]]]
        channel, number, svid = names[r["sid"]]
        code, doppler, lsb, msb, level = x["g"]
        pr = (5 * 2**32 + code) * 1e-3
        f = {0: 1575.42, 3: 1227.60}.get(number) or 1602 + (x["freq"].get(40, last[40]) - 8) * 9 / 16
        if number == 3:
            level, pr, msb, lsb = x["s"][3], pr + (-65536 + x["s"][0]) * 1e-3, 1, x["s"][2]
        phase = pr * f * 1e6 / sc.SPEED_OF_LIGHT + (msb * 65536 + lsb) * 1e-3
        v = x.get("extra", {}).get((channel, number))
        assert near(r["SNR_raw"], level * 0.25 + 10) and near(r["SNR"], level * 0.25 + 10 + (v[7] / 32 if v else 0))
        assert r["Pseudorange"] == pytest.approx(pr) and r["Phase"] == pytest.approx(phase, rel=1e-12)
        assert near(r["Pseudorange_raw"], None if v is None else r["Pseudorange"] + (v[0] + v[1]) / 1000)
        assert near(r["Pseudorange_unsmoothed"], None if v is None else r["Pseudorange"] + v[1] / 1000)
        assert near(r["Phase_raw"], None if v is None else r["Phase"] + v[6] / 512)


def test_only_wanted_kinds_are_decoded(spark, landed):
    folder, _, size = landed
    for kinds in (("dop",), ("dop", "range")):
        reader = sbf_source.SbfReader({"path": folder, "rangeBytes": str(size // 4), "kinds": ",".join(kinds)})
        parts = reader.partitions()
        assert {k for p in parts for b in reader.read(p) for k in b.column("kind").to_pylist()} == set(kinds) and len(parts) >= 8
    assert sbf.read_blocks(spark, folder, kinds=("dop",)).count() == 80
    rows = sbf.read_blocks(spark, folder)  # filters of one frame do not meet
    assert [rows.where(f"kind = '{k}'").count() for k in ("dop", "status", "dop")] == [80, 24, 80]
    both = rows.where("kind = 'dop'").unionByName(rows.where("kind = 'status'"))
    assert {r["kind"]: r["count"] for r in both.groupBy("kind").count().collect()} == {"dop": 80, "status": 24}


def test_patterns_lists_and_odd_files(spark, landed, tmp_path):
    folder, _, _ = landed
    one = sbf.read_sbf(spark, f"{folder}/a*.sbf").count()
    assert one == 180 and sbf.read_sbf(spark, [f"{folder}/a.sbf", f"file://{folder}/b.sbf"]).count() == 2 * one
    (tmp_path / "empty.sbf").write_bytes(b"")
    (tmp_path / "noise.sbf").write_bytes(b"$@" * 999)
    (tmp_path / "cut.sbf").write_bytes(recording(3, 2, junk=False)[0][:-3])
    assert sbf.read_sbf(spark, str(tmp_path), 64).count() == 3  # the last epoch is cut off
    assert sbf.epoch_quality(sbf.read_raw(spark, str(tmp_path))).count() == 1
    with pytest.raises(Exception, match="missing"):
        sbf.read_sbf(spark, f"{folder}/missing.sbf").count()


def test_small_ranges_share_tasks(landed, monkeypatch):
    folder, _, size = landed
    read = lambda reader: [b.to_pylist() for p in reader.partitions() for b in reader.read(p)]
    want = read(sbf_source.SbfReader({"path": folder, "rangeBytes": "200"}))
    monkeypatch.setattr(sbf_source, "MIN_TASKS", 4)
    reader = sbf_source.SbfReader({"path": folder, "rangeBytes": "200"})
    assert 4 <= len(reader.partitions()) <= 8 < size // 200
    assert read(reader) == want


def test_files_are_decoded_once(spark, landed):
    folder, _, _ = landed
    state = sbf.read_blocks(spark, folder, kinds=sbf.STATE).localCheckpoint()
    raw = sbf.with_state(sbf.read_blocks(spark, folder), state)
    for query in (sbf.epoch_quality, sbf.signal_quality, sbf.corrected_observations):
        plan = query(raw)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("RelationV2") == 1, query


def test_constant_frequency_is_one_span(spark, landed):
    folder, _, _ = landed
    spans = sbf.frequency_spans(sbf.read_blocks(spark, f"{folder}/a.sbf", 301)).collect()
    by = {svid: sorted((r["lo"], -1 if r["hi"] is None else r["hi"], r["freq_nr"]) for r in spans if r["svid"] == svid) for svid in {r["svid"] for r in spans}}
    assert [len(v) for _, v in sorted(by.items())] == [1, 3]
    (_, first, late), (start, change, early), (then, end, again) = by.pop(40)
    assert (late, early, again, end) == (11, 10, 11, -1) and first == start < change == then
    assert [x[:2] for x in next(iter(by.values()))] == [(-1, -1)]
