"""Rolling features against a pandas / numpy restatement, on rows with gaps, NULLs and flat stretches."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tremorloom.operators import contract, features, minutes
from tremorloom.schemas import MINUTE_COLUMNS, ROLLING_BASE, SENSOR_FEATURES

WINDOW, BINS = 10, 20


def minute_frame(seed: int = 7, n: int = 230) -> pd.DataFrame:
    rng = np.random.default_rng(seed)
    parts = []
    for sensor, skip in (("AAA", 0), ("BBB", 37)):
        t = pd.date_range("2020-01-01", periods=n, freq="min").delete(rng.choice(n, 20 + skip, replace=False))
        mean = rng.normal(0, 3, len(t)).round(1)
        mean[40:70] = 2.5
        p = pd.DataFrame({"eruption_id": "p", "network": "N", "station": sensor, "channel": "HHZ", "time_min": t})
        p["amplitude_mean"] = mean
        p["amplitude_std"] = rng.random(len(t))
        p["amplitude_max"] = mean + rng.random(len(t))
        p["amplitude_min"] = mean - rng.random(len(t))
        p["amplitude_count"] = rng.integers(1, 9, len(t)).astype(float)
        p.loc[[5, 6, 7, 8, 9, 90, 91], "amplitude_mean"] = [np.nan, np.inf, np.nan, np.nan, -np.inf, np.nan, np.nan]
        for c in MINUTE_COLUMNS[10:]:
            p[c] = rng.random(len(t))
        parts.append(p)
    return pd.concat(parts, ignore_index=True)


def restated(p: pd.DataFrame) -> pd.DataFrame:
    """The definitions, one frame at a time."""
    out = []
    for _, g in p.groupby("station"):
        g = g.sort_values("time_min").reset_index(drop=True)
        g = g.replace([np.inf, -np.inf], np.nan)
        g["amplitude_range"] = g.amplitude_max - g.amplitude_min
        g["amplitude_abs_mean"] = g.amplitude_mean.abs()
        rows: dict[str, list] = {}
        put = lambda name, v: rows.setdefault(name, []).append(v)
        for i in range(len(g)):
            part = g.iloc[max(0, i - WINDOW + 1) : i + 1]
            for c in ROLLING_BASE:
                v = part[c].dropna().to_numpy()
                ok = len(v) >= 5
                put(f"{c}_roll_mean", v.mean() if ok else np.nan)
                put(f"{c}_roll_std", v.std(ddof=1) if ok else np.nan)
                put(f"{c}_roll_min", v.min() if ok else np.nan)
                put(f"{c}_roll_max", v.max() if ok else np.nan)
                put(f"{c}_roll_median", np.median(v) if ok else np.nan)
            m = part.amplitude_mean
            v = m.dropna().to_numpy()
            if len(v) < 5:
                put("shannon_entropy", np.nan), put("kurtosis", np.nan), put("amplitude_mean_slope", np.nan)
                continue
            share = np.histogram(v, bins=BINS)[0] / len(v)
            share = share[share > 0]
            put("shannon_entropy", -(share * np.log2(share)).sum())
            k, d = len(v), v - v.mean()
            if np.ptp(v) == 0:
                put("kurtosis", 0.0)
            else:
                g2 = (d**4).mean() / (d**2).mean() ** 2 - 3
                put("kurtosis", (k - 1) / ((k - 2) * (k - 3)) * ((k + 1) * g2 + 6))
            keep = m.notna().to_numpy()
            put("amplitude_mean_slope", np.polyfit(np.arange(len(m))[keep], v, 1)[0])
        for name, values in rows.items():
            g[name] = values
        for env, source in (
            ("shannon_entropy_env", "shannon_entropy"),
            ("kurtosis_env", "kurtosis"),
            ("amplitude_mean_env", "amplitude_mean_roll_mean"),
        ):
            g[env] = [
                np.median(w) if len(w := g[source].iloc[max(0, i - WINDOW + 1) : i + 1].dropna()) >= 3 else np.nan
                for i in range(len(g))
            ]
        out.append(g)
    return pd.concat(out, ignore_index=True)


@pytest.fixture(scope="module")
def raw():
    return minute_frame()


@pytest.mark.parametrize("chunk_rows", [7, 64, 8192])
def test_features_equal_restatement_for_any_chunk_size(spark, raw, chunk_rows):
    df = features.prepare_minutes(spark.createDataFrame(raw))
    got = features.sensor_features(df, WINDOW, BINS, chunk_rows=chunk_rows, bucket="hour").toPandas()
    want = restated(raw)
    assert len(got) == len(want)
    got = got.sort_values(["station", "time_min"]).reset_index(drop=True)
    for c in SENSOR_FEATURES[15:]:
        np.testing.assert_allclose(got[c].astype(float), want[c].astype(float), rtol=1e-9, atol=1e-9, err_msg=c)


def test_feature_names_and_992_contract(spark, raw):
    assert len(SENSOR_FEATURES) == 58
    base = raw[raw.station == "AAA"].head(40)
    many = pd.concat([base.assign(station=f"S{i:02d}") for i in range(17)], ignore_index=True)
    rows = features.sensor_features(features.prepare_minutes(spark.createDataFrame(many)), WINDOW, BINS)
    names = contract.derive_contract(rows)
    assert len(names) == 992 and names == sorted(names)
    vectors = contract.contract_vectors(rows, names)
    x = {r["time_min"]: r["x"] for r in vectors.collect()}
    assert {len(v) for v in x.values()} == {992}
    wide = rows.toPandas()
    at = max(x)
    one = wide[(wide.sensor == "S03__HHZ") & (wide.time_min == at)].iloc[0]
    for c in ("amplitude_mean_roll_std", "kurtosis_env", "filter_full_low_hz"):
        assert x[at][names.index(f"{c}__S03__HHZ")] == pytest.approx(np.float32(one[c]), rel=1e-6)
    everyone = wide[wide.time_min == at]
    assert x[at][names.index("network_entropy_mean")] == pytest.approx(everyone.shannon_entropy.mean(), rel=1e-5)
    assert x[at][names.index("network_amplitude_std")] == pytest.approx(0.0, abs=1e-6)


def test_unknown_names_are_null_and_repeats_are_averaged(spark):
    rows = spark.createDataFrame(
        [("p", 1, "a", 1.0), ("p", 1, "a", 3.0), ("p", 1, "b", 5.0)], "eruption_id string, time_min int, sensor string, f double"
    )
    got = contract.contract_vectors(rows, ["f__b", "f__missing", "f__a", "other"], ["f"]).first()["x"]
    assert got == [5.0, None, 2.0, None]


def test_all_missing_feature_is_not_in_a_derived_contract(spark):
    rows = spark.createDataFrame([("a", 1.0, None), ("b", None, None)], "sensor string, f double, g double")
    assert contract.derive_contract(rows, ["f", "g"]) == ["f__a"]


def test_network_std_is_null_for_one_sensor(spark):
    rows = spark.createDataFrame(
        [("p", 1, "a", 1.0, 2.0, 3.0)],
        "eruption_id string, time_min int, sensor string, shannon_entropy double, kurtosis double, amplitude_mean_roll_mean double",
    )
    r = features.network_stats(rows).first()
    assert r["network_entropy_mean"] == 1.0 and r["network_entropy_std"] is None


def test_bad_time_fails_the_job(spark):
    rows = spark.createDataFrame([("p", "A", "Z", "never", "1.5")], "eruption_id string, station string, channel string, time_min string, amplitude_mean string")
    with pytest.raises(Exception, match="bad time_min"):
        features.prepare_minutes(rows).collect()
    assert features.prepare_minutes(rows, strict_time=False).count() == 0


def test_quality_of_an_empty_and_of_a_broken_table(spark, raw):
    empty = spark.createDataFrame(raw).limit(0)
    found = {r["rule"]: r["n_bad"] for r in minutes.minute_quality(empty).collect()}
    assert found["empty_table"] == 1 and found["bad_time"] == 0
    twice = spark.createDataFrame(raw).unionByName(spark.createDataFrame(raw.head(3))).withColumn(
        "frequency_index", F.when(F.col("station") == "AAA", F.lit(float("inf"))).otherwise(F.col("frequency_index"))
    )
    found = {r["rule"]: r["n_bad"] for r in minutes.minute_quality(twice).collect()}
    assert found["duplicate_sensor_time"] == 3 and found["missing_columns"] == 0
    assert found["frequency_index_infinite"] == (raw.station == "AAA").sum() + 3


def test_core_selection_needs_some_core_feature(spark):
    with pytest.raises(ValueError):
        features.select_core(spark.createDataFrame([("p", 1, "a")], "eruption_id string, time_min int, sensor string"))
