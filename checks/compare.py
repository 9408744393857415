"""Run the checks against DuckDB: ``python -m checks.compare [sf_dir] [name ...]``."""

from __future__ import annotations

import sys
import time

import duckdb

from checks import ORACLES, QUERIES
from tremorloom import build_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _key(row: tuple) -> tuple:
    return tuple((v is None, str(v)) for v in row)


def compare(spark, con, sf_dir: str, name: str) -> tuple[bool, str]:
    started = time.time()
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    got = [tuple(r) for r in df.select(*[f"`{c}`" for c in columns]).collect()]
    spent = time.time() - started
    if name not in ORACLES:
        return bool(got), f"rows only: {len(got)} rows, {spent:.1f}s"
    picked = ", ".join(f'"{c}"' for c in columns)
    want = con.execute(f"SELECT {picked} FROM ({ORACLES[name]}) AS o").fetchall()
    got.sort(key=_key), want.sort(key=_key)
    if len(got) != len(want):
        return False, f"{len(got)} rows, DuckDB {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        parts = [f"{c}: {a!r} / {b!r}" for c, a, b in zip(columns, *bad[0]) if a != b]
        return False, f"{len(bad)} of {len(got)} rows differ, first: " + "; ".join(parts[:6]) + f" in {bad[0][0][:4]}"
    return bool(got), f"{len(got)} rows equal, {spent:.1f}s" + ("" if got else " (EMPTY)")


def main(argv: list[str]) -> int:
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(QUERIES)
    spark = build_session(
        "checks", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__driver__memory="12g", spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    for name in names:
        try:
            good, text = compare(spark, con, sf_dir, name)
        except Exception as error:  # report and go on with the next check
            good, text = False, f"{type(error).__name__}: {str(error)[:600]}"
        failed += not good
        print(f"{'ok  ' if good else 'FAIL'} {name}: {text}", flush=True)
    print(f"{len(names) - failed} of {len(names)} checks hold")
    return 1 if failed else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
