"""Scaling of raw receiver measurement fields, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from leafwave.functions.signals import BANDS

SPEED_OF_LIGHT = 299_792_458.0
DOPPLER_MISSING = -(1 << 31)

# First and last svid, system, svid of slot 0.
SVID_RANGES = (
    (1, 37, "G", 0),
    (38, 61, "R", 37),
    (62, 62, "R", 62),
    (63, 68, "R", 38),
    (71, 106, "E", 70),
    (107, 119, "L", 0),
    (120, 140, "S", 0),
    (141, 180, "C", 140),
    (181, 187, "J", 180),
    (191, 197, "I", 190),
    (198, 215, "S", 57),
    (216, 222, "I", 208),
    (223, 245, "C", 182),
)

# Signal number -> (system, band, tracking code).
SIGNALS = {
    0: ("G", "L1", "C"),
    1: ("G", "L1", "W"),
    2: ("G", "L2", "W"),
    3: ("G", "L2", "L"),
    4: ("G", "L5", "Q"),
    5: ("G", "L1", "L"),
    6: ("J", "L1", "C"),
    7: ("J", "L2", "L"),
    8: ("R", "G1", "C"),
    9: ("R", "G1", "P"),
    10: ("R", "G2", "P"),
    11: ("R", "G2", "C"),
    12: ("R", "G3", "Q"),
    13: ("C", "B1C", "P"),
    14: ("C", "B2a", "P"),
    15: ("I", "L5", "A"),
    17: ("E", "E1", "C"),
    19: ("E", "E6", "C"),
    20: ("E", "E5a", "Q"),
    21: ("E", "E5b", "Q"),
    22: ("E", "E5", "Q"),
    23: ("L", "LBd", "?"),
    24: ("S", "L1", "C"),
    25: ("S", "L5", "I"),
    26: ("J", "L5", "Q"),
    27: ("J", "L6", "E"),
    28: ("C", "B1I", "I"),
    29: ("C", "B2I", "I"),
    30: ("C", "B3I", "I"),
    32: ("J", "L1", "L"),
    33: ("J", "L1", "Z"),
    34: ("C", "B2b", "D"),
    38: ("J", "L1", "E"),
    39: ("J", "L5", "P"),
}
# Signals whose C/N0 has no 10 dB offset, and the FDMA signals.
NO_OFFSET = (1, 2)
FDMA = (8, 9, 10, 11)


def _svid_parts(svid: int) -> tuple[str, int]:
    for lo, hi, system, base in SVID_RANGES:
        if lo <= svid <= hi:
            return system, svid - base
    return "?", svid


def _lookup(values: list, key: Column) -> Column:
    """Constant array indexed by a small integer; NULL outside it."""
    return F.get(F.array(*[F.lit(v) for v in values]), key)


def decode_svid(svid: Column) -> Column:
    """struct(system, prn); unknown ids give system '?'."""
    known = [_svid_parts(i) for i in range(256)]
    return F.struct(
        F.coalesce(_lookup([k[0] for k in known], svid), F.lit("?")).alias("system"),
        F.coalesce(_lookup([k[1] for k in known], svid), svid).alias("prn"),
    )


def sv_of(svid: Column) -> Column:
    """Satellite name such as G01."""
    names = ["%s%02d" % _svid_parts(i) for i in range(256)]
    return F.coalesce(_lookup(names, svid), F.concat(F.lit("?"), svid.cast("string")))


def signal_number(type_byte: Column, obs_info: Column) -> Column:
    """Low five bits of the type; 31 points to the extended number in ObsInfo."""
    low = type_byte.bitwiseAND(31)
    extended = F.shiftright(obs_info, 3).bitwiseAND(31) + 32
    return F.when(low == 31, extended).otherwise(low)


def cn0(raw: Column, signal: Column) -> Column:
    scaled = raw * F.lit(0.25)
    return F.when(raw != 255, F.when(signal.isin(*NO_OFFSET), scaled).otherwise(scaled + F.lit(10.0)))


def pseudorange(misc: Column, code_lsb: Column) -> Column:
    msb = misc.bitwiseAND(15)
    value = (msb * F.lit(4_294_967_296) + code_lsb) * F.lit(1e-3)
    return F.when((msb != 0) | (code_lsb != 0), value)


def doppler(raw: Column) -> Column:
    return F.when(raw != DOPPLER_MISSING, raw * F.lit(1e-4))


def phase(pr_m: Column, carrier_msb: Column, carrier_lsb: Column, freq_mhz: Column) -> Column:
    cycles = pr_m / (F.lit(SPEED_OF_LIGHT) / (freq_mhz * F.lit(1e6)))
    value = cycles + (carrier_msb * 65_536 + carrier_lsb) * F.lit(1e-3)
    return F.when(~((carrier_msb == -128) & (carrier_lsb == 0)), value)


def signed_bits(value: Column, bits: int) -> Column:
    sign = 1 << (bits - 1)
    return value.bitwiseAND(sign - 1) - value.bitwiseAND(sign)


def offset_msbs(raw: Column) -> tuple[Column, Column]:
    """Code (3 bits) and Doppler (5 bits) offsets packed in one byte."""
    return signed_bits(raw.bitwiseAND(7), 3), signed_bits(F.shiftright(raw, 3).bitwiseAND(31), 5)


def pseudorange2(pr1: Column, msb: Column, lsb: Column) -> Column:
    value = pr1 + (msb * 65_536 + lsb) * F.lit(1e-3)
    return F.when(~((msb == -4) & (lsb == 0)), value)


def doppler2(d1: Column, msb: Column, lsb: Column, freq2: Column, freq1: Column) -> Column:
    value = d1 * (freq2 / freq1) + (msb * 65_536 + lsb) * F.lit(1e-4)
    return F.when(~((msb == -16) & (lsb == 0)), value)


def _fixed_frequency(n: int) -> float | None:
    if n not in SIGNALS or n in FDMA:
        return None
    system, band, _ = SIGNALS[n]
    band = "B2b" if band == "B2I" else band
    return BANDS[system][band][1] if band in BANDS.get(system, {}) else None


def carrier_frequency(signal: Column, freq_nr: Column) -> Column:
    """MHz; FDMA carriers need the channel number, the L-band beam has none."""
    slot = freq_nr - 8
    return (
        F.when(signal.isin(8, 9), F.lit(1602.0) + slot * F.lit(9 / 16))
        .when(signal.isin(10, 11), F.lit(1246.0) + slot * F.lit(7 / 16))
        .otherwise(_lookup([_fixed_frequency(n) for n in range(40)], signal))
    )


def sid_of(svid: Column, signal: Column) -> Column:
    """``SV|band|code``; NULL for an unknown signal."""
    suffix = [f"|{SIGNALS[n][1]}|{SIGNALS[n][2]}" if n in SIGNALS else None for n in range(40)]
    return F.concat(sv_of(svid), _lookup(suffix, signal))
