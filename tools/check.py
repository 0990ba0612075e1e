"""Run registered queries against their SQL in DuckDB and report differences.

    python tools/check.py [--sf 0.01] [name-prefix ...]
"""

from __future__ import annotations

import argparse
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from leafwave.plans import ORACLES, QUERIES  # noqa: E402
from leafwave.session import local_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def family(type_name: str) -> str:
    t = type_name.lower()
    if t in ("bigint", "int", "integer", "smallint", "tinyint", "hugeint"):
        return "int"
    if t in ("double", "float"):
        return "float"
    if t in ("string", "varchar"):
        return "string"
    if t.startswith("timestamp"):
        return "timestamp"
    return t


def rows_of(pdf) -> list[tuple]:
    pdf = pdf[sorted(pdf.columns)]
    out = []
    for row in pdf.itertuples(index=False):
        vals = []
        for v in row:
            if v is None or v != v:
                vals.append(None)
            elif hasattr(v, "tolist"):
                vals.append(str(v.tolist()))
            elif hasattr(v, "isoformat"):
                vals.append((v.isoformat() + "T00:00:00")[:19] if len(v.isoformat()) == 10 else v.isoformat()[:26])
            elif isinstance(v, float):
                vals.append(v)
            else:
                vals.append(str(v) if not isinstance(v, (int, bool)) else int(v))
        out.append(tuple(vals))
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), x) for x in r))


def close(a: tuple, b: tuple) -> bool:
    if len(a) != len(b):
        return False
    for x, y in zip(a, b):
        if isinstance(x, (int, float)) and isinstance(y, (int, float)):
            if x != y:
                return False
        elif x != y:
            return False
    return True


def main() -> None:
    p = argparse.ArgumentParser()
    p.add_argument("--sf", default="0.01")
    p.add_argument("names", nargs="*")
    a = p.parse_args()
    sf_dir = f"/root/testdata/sf{a.sf}"
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    spark = local_session(8)
    names = [n for n in QUERIES if not a.names or any(n.startswith(x) for x in a.names)]
    failed = []
    for n in names:
        t0 = time.time()
        try:
            df = QUERIES[n](spark, sf_dir)
            got = df.toPandas()
        except Exception as e:  # noqa: BLE001
            print(f"ERROR {n}: {str(e)[:900]}", flush=True)
            failed.append(n)
            continue
        t1 = time.time()
        if n not in ORACLES:
            print(f"ROWS  {n}: {len(got)} rows {t1 - t0:.1f}s", flush=True)
            continue
        try:
            rel = con.sql(ORACLES[n])
            want = rel.df()
        except Exception as e:  # noqa: BLE001
            print(f"SQLERR {n}: {str(e)[:900]}", flush=True)
            failed.append(n)
            continue
        t2 = time.time()
        ts = {f.name: family(f.dataType.simpleString()) for f in df.schema.fields}
        td = {c: family(str(t)) for c, t in zip(rel.columns, rel.types)}
        problem = ""
        if ts != td:
            problem = f"schema {sorted(set(ts.items()) ^ set(td.items()))}"
        elif len(got) != len(want):
            problem = f"rows {len(got)} vs {len(want)}"
        else:
            g, w = rows_of(got), rows_of(want)
            bad = [(x, y) for x, y in zip(g, w) if not close(x, y)]
            if bad:
                problem = f"{len(bad)} differing of {len(g)}, first {bad[0]}"
        status = "FAIL " if problem else "ok   "
        if problem:
            failed.append(n)
        print(f"{status} {n}: {len(got)} rows spark {t1 - t0:.1f}s duckdb {t2 - t1:.1f}s {problem}", flush=True)
    print(f"{len(names) - len(failed)} of {len(names)} pass; failed: {failed}")


if __name__ == "__main__":
    main()
