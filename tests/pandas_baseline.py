"""Single-process pandas timings of the headline formulas, to compare ``bench.py`` with.

``python -m tests.pandas_baseline [sf_dir]`` prints one JSON line. Written from the definitions in the README;
not collected by pytest.
"""

from __future__ import annotations

import json
import sys
import time

import numpy as np
import pandas as pd

PERIODS = [("P1", "2024-01-01", "2024-01-08"), ("P2", "2024-01-08", "2024-01-15"), ("P3", "2024-01-15", "2024-01-22"), ("P4", "2024-01-22", "2024-02-01")]
BASE = ["amplitude_mean", "amplitude_std", "amplitude_max", "amplitude_min", "amplitude_range", "amplitude_abs_mean", "amplitude_count"]


def cells(samples: pd.DataFrame, unit: str) -> pd.DataFrame:
    s = samples.assign(time_min=samples.ts.dt.floor(unit), low2=samples.low**2, high2=samples.high**2)
    g = s.groupby(["period_id", "sensor", "time_min"])
    out = g.amplitude.agg(amplitude_mean="mean", amplitude_std="std", amplitude_max="max", amplitude_min="min", amplitude_count="count")
    out["energy_low"], out["energy_high"] = g.low2.mean(), g.high2.mean()
    out["frequency_index"] = np.log10((out.energy_high + 1e-12) / (out.energy_low + 1e-12))
    return out.reset_index()


def entropy(v: np.ndarray) -> float:
    v = v[np.isfinite(v)]
    share = np.histogram(v, bins=20)[0] / len(v)
    share = share[share > 0]
    return float(-(share * np.log2(share)).sum())


def kurtosis(v: np.ndarray) -> float:
    v = v[np.isfinite(v)]
    n, d = len(v), v - v.mean()
    m2 = (d**2).mean()
    return 0.0 if m2 == 0 else (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * ((d**4).mean() / m2**2 - 3) + 6)


def slope(v: np.ndarray) -> float:
    ok = np.isfinite(v)
    x = np.arange(len(v))[ok]
    dx = x - x.mean()
    return float((dx * v[ok]).sum() / (dx * dx).sum())


def features(table: pd.DataFrame) -> pd.DataFrame:
    table = table.assign(amplitude_range=table.amplitude_max - table.amplitude_min, amplitude_abs_mean=table.amplitude_mean.abs())
    parts = []
    for _, g in table.groupby(["period_id", "sensor"], sort=False):
        g = g.sort_values("time_min")
        r = g[BASE].rolling(10, min_periods=5)
        new = {}
        for stat in ("mean", "std", "min", "max", "median"):
            for c, col in getattr(r, stat)().items():
                new[f"{c}_roll_{stat}"] = col
        m = g.amplitude_mean.rolling(10, min_periods=5)
        new["shannon_entropy"], new["kurtosis"], new["slope"] = (m.apply(f, raw=True) for f in (entropy, kurtosis, slope))
        for c in ("shannon_entropy", "kurtosis", "amplitude_mean_roll_mean"):
            new[f"{c}_env"] = new[c].rolling(10, min_periods=3).median()
        parts.append(pd.concat([g, pd.DataFrame(new)], axis=1))
    return pd.concat(parts, ignore_index=True)


def event_samples(sf: str) -> pd.DataFrame:
    e = pd.read_parquet(f"{sf}/events.parquet")
    s = pd.DataFrame({"ts": e.ts, "station": e.event_type, "sensor": e.event_type + "__C" + (e.user_id % 3).astype(str), "amplitude": e.value, "low": e.value})
    s["high"] = [float(json.loads(p)["k"]) for p in e.props]
    parts = []
    for name, start, end in PERIODS:
        p = s[(s.ts >= start) & (s.ts < end)]
        if name == "P3":
            p = p[p.station.isin(["view", "click", "error"])]
        parts.append(p.assign(period_id=name))
    return pd.concat(parts)


def line_samples(sf: str) -> pd.DataFrame:
    li = pd.read_parquet(f"{sf}/lineitem.parquet")
    return pd.DataFrame(
        {"period_id": "P", "sensor": li.l_suppkey.astype(str) + "__" + li.l_returnflag, "ts": li.l_shipdate, "amplitude": li.l_quantity, "low": li.l_extendedprice, "high": li.l_discount}
    )


LINE_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def distribution_drift(sf: str):
    li = pd.read_parquet(f"{sf}/lineitem.parquet", columns=[*LINE_FEATURES, "l_linestatus"])
    ref, cand = li[li.l_linestatus == "F"], li[li.l_linestatus != "F"]
    out = {}
    for c in LINE_FEATURES:
        a, b = np.sort(ref[c].to_numpy(np.float32)), np.sort(cand[c].to_numpy(np.float32))
        grid = np.unique(np.concatenate([a, b]))
        ks = np.abs(np.searchsorted(a, grid, "right") / len(a) - np.searchsorted(b, grid, "right") / len(b)).max()
        cuts = np.quantile(a.astype(float), np.arange(1, 10) / 10)
        share = lambda v: np.maximum(np.bincount(np.searchsorted(cuts, v, "left"), minlength=10) / len(v), 1e-4)
        p, q = share(a), share(b)
        out[c] = (ks, ((q - p) * np.log(q / p)).sum())
    return out


def feature_drift(sf: str):
    li = pd.read_parquet(f"{sf}/lineitem.parquet", columns=[*LINE_FEATURES, "l_linestatus"])
    ref, cand = li[li.l_linestatus == "F"], li[li.l_linestatus != "F"]
    return {c: abs(cand[c].mean() - ref[c].mean()) / ref[c].std(ddof=0) for c in LINE_FEATURES}


def threshold_sweep(sf: str):
    li = pd.read_parquet(f"{sf}/lineitem.parquet", columns=["l_tax", "l_discount", "l_returnflag"])
    p, actual = li.l_tax + li.l_discount, li.l_returnflag == "R"
    return [((p >= t) & actual).sum() for t in np.arange(1, 8) * 0.02], [((p >= t) & ~actual).sum() for t in np.arange(1, 8) * 0.02]


def quantiles(sf: str):
    li = pd.read_parquet(f"{sf}/lineitem.parquet", columns=["l_extendedprice", "l_returnflag"])
    return li.groupby("l_returnflag").l_extendedprice.quantile([0.1, 0.25, 0.5, 0.9])


def summary(sf: str):
    x = np.stack(pd.read_parquet(f"{sf}/embeddings.parquet").embedding.to_numpy()).reshape(-1, 8, 8)
    return x.mean((1, 2)), x.std((1, 2)), x.min((1, 2)), x.max((1, 2)), np.abs(x).mean((1, 2)), x.std(1).mean(1), x.std(2).mean(1)


def main(sf: str) -> None:
    work = {
        "minute_aggregate": lambda: cells(event_samples(sf), "h"),
        "sensor_features": lambda: features(cells(event_samples(sf), "h")),
        "sequence_summary": lambda: summary(sf),
        "feature_drift": lambda: feature_drift(sf),
        "distribution_drift": lambda: distribution_drift(sf),
        "threshold_sweep": lambda: threshold_sweep(sf),
        "exact_quantiles": lambda: quantiles(sf),
        "supplier_features": lambda: features(cells(line_samples(sf), "D")),
    }
    timings = {}
    for name, run in work.items():
        started = time.perf_counter()
        run()
        timings[name] = round(time.perf_counter() - started, 3)
    print(json.dumps({"metric": "pandas_single_process", "unit": "sec", "queries": timings, "sf": sf.rsplit("sf", 1)[-1]}))


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1")
