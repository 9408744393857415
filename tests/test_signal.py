"""Conditioning of traces: gaps, trend and the band-pass against a time-domain filter."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tremorloom.operators import signal

RATE = 100.0


def trace(values: np.ndarray, rate: float = RATE, station: str = "CSS", start="2020-01-01") -> pd.DataFrame:
    ts = pd.Timestamp(start) + pd.to_timedelta(np.round(np.arange(len(values)) * 1e6 / rate), unit="us")
    return pd.DataFrame(
        {"period_id": "p", "network": "N", "station": station, "channel": "HHZ", "ts": ts, "amplitude": values, "sampling_rate": rate}
    )


def butterworth(low: float, high: float, rate: float, order: int = 4):
    """Digital band-pass polynomials: analogue prototype, band transform, bilinear transform."""
    prototype = np.exp(1j * np.pi * (2 * np.arange(order) + order + 1) / (2 * order))
    w = 2 * rate * np.tan(np.pi * np.array([low, high]) / rate)
    centre, width = w[0] * w[1], w[1] - w[0]
    half = prototype * width / 2
    poles = np.concatenate([half + np.sqrt(half**2 - centre), half - np.sqrt(half**2 - centre)])
    z_poles = (2 * rate + poles) / (2 * rate - poles)
    z_zeros = np.concatenate([np.ones(order), -np.ones(order)])
    gain = np.real(width**order * (2 * rate) ** order / np.prod(2 * rate - poles))
    return np.real(np.poly(z_zeros)) * gain, z_poles


def both_ways(x: np.ndarray, low: float, high: float, rate: float) -> np.ndarray:
    """Forward then backward filtering by cascaded second-order sections."""
    _, poles = butterworth(low, high, rate)
    num, _ = butterworth(low, high, rate)
    scale = num[0]
    upper = poles[np.imag(poles) > 0]

    def once(signal_in):
        y = signal_in * scale
        for p in upper:
            a1, a2 = -2 * np.real(p), abs(p) ** 2
            out = np.zeros_like(y)
            x1 = x2 = y1 = y2 = 0.0
            for i, v in enumerate(y):
                out[i] = v - x2 - a1 * y1 - a2 * y2
                x2, x1, y2, y1 = x1, v, y1, out[i]
            y = out
        return y

    return once(once(x)[::-1])[::-1]


def test_bandpass_equals_a_forward_backward_filter(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=18_000)
    out = signal.bandpass(spark.createDataFrame(trace(x)), chunk_seconds=60, pad_seconds=30).orderBy("ts").toPandas()
    assert len(out) == len(x)
    inside = slice(3000, -3000)
    for name, (low, high) in {"amplitude": (1, 16), "low": (1, 5.5), "high": (6, 16)}.items():
        want = both_ways(x, low, high, RATE)
        np.testing.assert_allclose(out[name].to_numpy()[inside], want[inside], atol=1e-6, err_msg=name)


def test_bandpass_keeps_in_band_and_removes_out_of_band(spark):
    t = np.arange(12_000) / RATE
    df = spark.createDataFrame(trace(np.sin(2 * np.pi * 3 * t) + np.sin(2 * np.pi * 30 * t)))
    out = signal.bandpass(df, chunk_seconds=40, pad_seconds=20).orderBy("ts").toPandas()
    inside = slice(2000, -2000)
    np.testing.assert_allclose(out["low"].to_numpy()[inside], np.sin(2 * np.pi * 3 * t)[inside], atol=1e-3)
    assert np.abs(out["high"].to_numpy()[inside]).max() < 1e-2


def test_gap_is_a_straight_line_and_crosses_buckets(spark):
    full = trace(np.arange(500, dtype=float) ** 2, rate=1.0)
    holed = full.drop(index=range(100, 341)).reset_index(drop=True)
    holed.loc[10, "amplitude"] = np.nan
    out = signal.interpolate_gaps(spark.createDataFrame(holed), bucket_seconds=30).orderBy("ts").toPandas()
    assert len(out) == 500 and out["filled"].sum() == 242
    line = np.interp(np.arange(500), np.delete(np.arange(500), [10, *range(100, 341)]), np.delete(np.arange(500.0) ** 2, [10, *range(100, 341)]))
    np.testing.assert_allclose(out["amplitude"], line)
    assert (out["ts"].diff().dropna() == pd.Timedelta(seconds=1)).all()


def test_detrend_removes_line_and_mean(spark):
    x = 5 + 0.25 * np.arange(300) + np.sin(np.arange(300))
    df = spark.createDataFrame(trace(x, rate=10.0))
    both = signal.detrend_linear(signal.demean(df)).orderBy("ts").toPandas()["amplitude"]
    once = signal.detrend_linear(df).orderBy("ts").toPandas()["amplitude"]
    a, b = np.polyfit(np.arange(300), x, 1)
    np.testing.assert_allclose(once, x - (a * np.arange(300) + b), atol=1e-9)
    np.testing.assert_allclose(both, once, atol=1e-9)


def test_single_sample_trace_becomes_zero(spark):
    assert signal.detrend_linear(spark.createDataFrame(trace(np.array([4.0])))).first()["amplitude"] == 0.0


def test_trace_checks(spark):
    good, silent = trace(np.ones(5)), trace(np.full(5, np.nan), station="NAN")
    slow = trace(np.ones(5), rate=30.0, station="SLOW")
    df = spark.createDataFrame(pd.concat([good, silent, slow], ignore_index=True))
    flags = {r["station"]: r["failed"] for r in signal.trace_quality(df).collect()}
    assert flags == {"CSS": False, "NAN": True, "SLOW": False}
    assert {r["station"] for r in signal.usable_traces(df).select("station").distinct().collect()} == {"CSS", "NAN"}
    wanted = spark.createDataFrame([("p", "N", "CSS,SLOW,GONE")], "period_id string, network string, stations string")
    assert [r["station"] for r in signal.missing_stations(df, wanted).collect()] == ["GONE"]
    assert signal.station_coverage(df, wanted).first()["coverage"] == pytest.approx(2 / 3)


def test_overlap_takes_the_later_segment(spark):
    a = trace(np.array([1.0, 1.0, 1.0])).assign(segment=1)
    b = trace(np.array([2.0, 2.0]), start="2020-01-01T00:00:00.010").assign(segment=2)
    merged = signal.merge_segments(spark.createDataFrame(pd.concat([a, b], ignore_index=True)), "segment")
    assert [r["amplitude"] for r in merged.orderBy("ts").collect()] == [1.0, 2.0, 2.0]
    assert merged.where(F.col("amplitude") == 2).count() == 2


def pieces_both_ways(df: pd.DataFrame, low: float, high: float) -> np.ndarray:
    """Runs cut by hand, each filtered in one go; NaN where a value is missing."""
    us = df["ts"].to_numpy().astype("datetime64[us]").astype(np.int64)
    x, rate = df["amplitude"].to_numpy(float), df["sampling_rate"].to_numpy(float)
    out, start = np.full(len(x), np.nan), 0
    for i in range(1, len(x) + 1):
        joined = i < len(x) and rate[i] == rate[i - 1] and abs((us[i] - us[i - 1]) * rate[i] / 1e6 - 1) < 0.5 and np.isfinite(x[i]) and np.isfinite(x[i - 1])
        if not joined:
            if np.isfinite(x[start]):
                out[start:i] = both_ways(x[start:i], low, high, rate[start])
            start = i
    return out


@pytest.mark.parametrize("chunk_seconds", [1, 7, 1000])
def test_bandpass_is_exact_for_any_chunk_with_gap_null_and_rate_change(spark, monkeypatch, chunk_seconds):
    monkeypatch.setattr(signal, "_FAN", 4)  # several levels of composition
    rng = np.random.default_rng(3)
    first = trace(rng.normal(size=3000) + 4)
    first.loc[[0, 700, 1203, 1204, 2999], "amplitude"] = [np.nan, np.nan, np.inf, np.nan, np.nan]
    first = first.drop(index=range(1500, 1740))
    second = trace(rng.normal(size=1500), rate=50.0, start="2020-01-01T00:00:30")
    alone = trace(np.array([3.0]), start="2020-01-01T00:02:00")
    slow = trace(np.ones(40), rate=20.0, start="2020-01-01T00:03:00")
    whole = pd.concat([first, second, alone, slow], ignore_index=True)
    other = whole.assign(station=None, amplitude=-2 * whole["amplitude"])
    df = spark.createDataFrame(pd.concat([whole, other], ignore_index=True)).repartition(5)
    out = signal.bandpass(df, chunk_seconds=chunk_seconds).toPandas().sort_values("ts")
    assert len(out) == 2 * len(whole)
    assert out.loc[out["sampling_rate"] == 20, ["amplitude", "low", "high"]].isna().all().all()
    for name, (low, high) in {"amplitude": (1, 16), "low": (1, 5.5), "high": (6, 16)}.items():
        want = np.where(whole["sampling_rate"] == 20, np.nan, pieces_both_ways(whole, low, high))
        np.testing.assert_allclose(out.loc[out["station"] == "CSS", name].to_numpy(), want, atol=1e-9, err_msg=name)
        np.testing.assert_allclose(out.loc[out["station"].isna(), name].to_numpy(), -2 * want, atol=2e-9, err_msg=name)


def test_bandpass_filters_stored_chunks_in_one_pass(spark):
    plan = signal.bandpass(spark.createDataFrame(trace(np.ones(3000))))._jdf.queryExecution().executedPlan().toString()
    assert "PythonRDD" not in plan and plan.count("MapInArrow") == 1


def test_bandpass_of_nothing(spark):
    empty = spark.createDataFrame(trace(np.ones(3))).where("false")
    assert signal.bandpass(empty).count() == 0
