"""The three jobs, composed from the operators: extraction, training dataset, inference."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tremorloom.operators import contract, features, gates, minutes, periods, scaling, scoring, sequences, signal
from tremorloom.operators.ranking import measured_broadcast
from tremorloom.schemas import ALERT_MIN_CLASS, ALERT_THRESHOLD, MINUTES, N_CLASSES
from tremorloom.session import cut_lineage, stored, told
from tremorloom.sources import tables
from tremorloom.sources.snapshots import Snapshots


def extraction_report(samples: DataFrame, period_table: DataFrame) -> DataFrame:
    """What is wrong with the input of ``extract_minutes``: rows ``(severity, period_id, rule, detail)``.

    Errors are broken period rows, periods without any sample, and traces without a sound rate or a finite value;
    warnings are requested stations without a sample. The samples are read once, into one row per trace.
    """
    typed = periods.typed_periods(period_table)
    traces = cut_lineage(signal.trace_quality(periods.assign_periods(samples, typed)))
    name = F.concat_ws(".", "network", "station", "channel")
    found = lambda df, severity, rule, detail: df.select(
        F.lit(severity).alias("severity"), "period_id", rule.alias("rule"), detail.alias("detail")
    )
    broken = found(periods.validate_periods(period_table), "error", F.col("rule"), F.col("detail"))
    empty = typed.select("period_id").distinct().join(traces.select("period_id").distinct(), "period_id", "left_anti")
    silent = found(empty, "error", F.lit("no_samples"), F.lit(""))
    bad_rate = found(traces.where("bad_rate"), "error", F.lit("bad_rate"), name)
    no_value = found(traces.where("no_finite_value"), "error", F.lit("no_finite_value"), name)
    report = broken.unionByName(silent).unionByName(bad_rate).unionByName(no_value)
    if "stations" in typed.columns:
        missing = signal.missing_stations(traces, typed)
        report = report.unionByName(found(missing, "warning", F.lit("missing_station"), F.col("station")))
    return report


def extract_minutes(
    samples: DataFrame, period_table: DataFrame, step_seconds: int = 60, segment: str | None = None, gate: bool = True
) -> DataFrame:
    """Raw samples to minute aggregates, all periods and traces at once.

    ``samples`` is a table of ``network, station, channel, ts, amplitude, sampling_rate``; ``period_table`` is
    tidy or typed period metadata. Raw samples are shuffled twice: by time bucket to find gaps, by chunk to
    filter. They are stored once in between, with a description of each gap, for the line fit and the filter; the samples
    that fill gaps are made on the way to the filter and never stored.

    The gate: a period without a sample, a trace without a sound rate or without a finite value stop the job with the
    errors of ``extraction_report``. It is taken while the samples are read to fill gaps; only a failure reads them again,
    to name the culprits.
    """
    broken = periods.validate_periods(period_table)
    periods.require_none(broken, "period table not usable")
    typed = periods.typed_periods(period_table)
    assigned, seen = periods.assign_periods(samples, typed), Observation()
    if gate:
        assigned = signal.observe_traces(assigned, seen)
    linked = stored(signal.link_gaps(signal.usable_traces(assigned), segment=segment), "linked")
    if gate:
        found = told(seen)
        sound = found and found["least_rate"] > 0 and found["traces"] == found["sound_traces"]
        if not sound or found["periods"] < typed.select("period_id").distinct().count():
            periods.require_none(extraction_report(samples, period_table).where("severity = 'error'"), "samples not usable")
    # the least-squares line absorbs the mean, one detrend covers both steps
    lines = measured_broadcast(signal.linked_trace_lines(linked))
    flat = signal.detrend_linear(signal.fill_gaps(linked).drop("filled"), lines=lines)
    return minutes.minute_aggregate(signal.bandpass(flat), step_seconds)


def publish_minutes(
    samples: DataFrame,
    period_table: DataFrame,
    root: str,
    batch: str,
    step_seconds: int = 60,
    segment: str | None = None,
    files_per_period: int | None = None,
) -> bool:
    """Extract, write, audit, publish: minutes become visible only after they passed both gates.

    The rules of the minute table are observed while it is written, without a second scan; when one is broken, the written
    table is read once more to name periods and rules, and nothing is published. False: the batch was published before.
    """
    return publish_audited(
        lambda: extract_minutes(samples, period_table, step_seconds, segment), samples.sparkSession, root, batch, files_per_period
    )


def publish_audited(make: Callable[[], DataFrame], spark: SparkSession, root: str, batch: str, files_per_period: int | None = None) -> bool:
    """Write-audit-publish of a minute table in contract form."""
    store = Snapshots(spark, root)

    def write(commit: str) -> None:
        audit, folder = Observation(), store.folder("minutes", commit)
        tables.write_minutes(minutes.observed(make(), audit), folder, files_per_period=files_per_period)
        metrics = told(audit)
        broken = [rule for rule, found in metrics.items() if found]
        if not metrics or broken == ["empty_table"]:
            raise periods.ContractViolation("minutes not fit for publication: no trace gave a minute")
        if broken:
            findings = minutes.minute_quality(tables.read_minutes(spark, folder, "parquet"), by=["eruption_id"])
            periods.require_none(findings.where("severity = 'error' AND n_bad > 0"), "minutes not fit for publication")

    return store.publish(batch, write)


def published_minutes(spark: SparkSession, root: str) -> DataFrame:
    """Minutes of the last publication."""
    return Snapshots(spark, root).latest("minutes", MINUTES)


def feature_vectors(
    minute_table: DataFrame, names: Sequence[str] | None = None, window_rows: int = 10, bins: int = 20
) -> tuple[DataFrame, list[str]]:
    """Contract-ordered vectors per (period, minute), deriving the contract when none is given."""
    sensor = features.sensor_features(features.prepare_minutes(minute_table), window_rows, bins)
    chosen = list(names) if names else contract.derive_contract(sensor)
    vectors = contract.contract_vectors(sensor, chosen).withColumnRenamed("eruption_id", "period_id")
    return vectors, chosen


def of_periods(minute_table: DataFrame, usable: DataFrame) -> DataFrame:
    """Minutes of the usable periods; with a table partitioned by period only their folders are read."""
    return minute_table.join(usable.select(F.col("period_id").alias("eruption_id")).distinct(), "eruption_id", "left_semi")


def training_dataset(
    minute_table: DataFrame,
    period_table: DataFrame,
    names: Sequence[str] | None = None,
    length: int = 120,
    stride: int = 5,
    window_rows: int = 10,
    bins: int = 20,
    max_horizon_hours: float = 48.0,
    clamp_after_event: bool = False,
    split: str = "chronological",
    train_ratio: float = 0.70,
    val_ratio: float = 0.15,
    task: str = "classification",
    drop_inference: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """``(sequences, params)``: labelled, split, imputed and standardised sequences and the fit parameters.

    Checkpointed once each: the indexed vectors (read by ends, weights and assembly), the kept ends (read by
    the split and the weights) and the weighted train rows (read by the passes of the fit).
    """
    manual = split == "manual"
    usable = periods.select_periods(period_table, "training", manual, drop_inference)
    vectors, chosen = feature_vectors(of_periods(minute_table, usable), names, window_rows, bins)
    indexed = cut_lineage(sequences.index_rows(vectors))
    ends = sequences.sequence_ends(indexed, length, stride)
    kept = cut_lineage(sequences.label_sequences(ends, usable, max_horizon_hours, clamp_after_event, task))
    if manual:
        placed = sequences.split_manual(kept, usable)
    elif split == "chronological":
        placed = sequences.split_chronological(kept, train_ratio, val_ratio)
    else:
        raise ValueError("split must be 'manual' or 'chronological'")
    train = cut_lineage(sequences.sequence_weights(indexed, placed.where(F.col("split") == "train"), length))
    params = cut_lineage(scaling.fit_params(train, chosen))
    scaled = scaling.apply_params(indexed, params, len(chosen))
    return sequences.build_sequences(scaled, placed, length).drop("end_rn"), params


def inference_sequences(
    minute_table: DataFrame,
    period_table: DataFrame,
    names: Sequence[str],
    params: DataFrame,
    length: int = 120,
    stride: int = 1,
    window_rows: int = 10,
    bins: int = 20,
) -> DataFrame:
    """Sequences with a saved contract and saved parameters; nothing is fitted."""
    usable = periods.select_periods(period_table, "inference")
    vectors, _ = feature_vectors(of_periods(minute_table, usable), names, window_rows, bins)
    indexed = sequences.index_rows(scaling.apply_params(vectors, params, len(names)))
    wanted = [c for c in ("period_id", "period_ord") if c in usable.columns]
    ends = sequences.sequence_ends(indexed, length, stride).join(usable.select(*wanted), "period_id")
    return sequences.build_sequences(indexed, ends, length).drop("end_rn")


def predict_alerts(
    batch: DataFrame,
    predict: Callable,
    is_logits: bool = False,
    n_classes: int = N_CLASSES,
    min_class: int = ALERT_MIN_CLASS,
    threshold: float = ALERT_THRESHOLD,
    seq_len: int | None = None,
    n_features: int | None = None,
) -> DataFrame:
    """Scores, probabilities, predicted class and alert of each sequence (without the matrices).

    The batch must first pass ``batch_contract``; else nothing is scored. Without ``seq_len`` and ``n_features`` all
    rows must have the sizes of the first one.
    """
    if (seq_len is None) != (n_features is None):
        raise ValueError("give both seq_len and n_features, or neither")
    if seq_len is None:
        sizes = batch.select(F.size("x").alias("rows"), F.size(F.element_at("x", 1)).alias("features")).first()
        seq_len, n_features = (sizes["rows"], sizes["features"]) if sizes else (0, 0)
    findings = gates.expect(batch, gates.batch_contract(seq_len, n_features))
    periods.require_none(findings.where(~F.col("success")), "batch not fit for scoring")
    scored = scoring.score(batch, predict, n_classes).drop("x")
    probable = scoring.to_probabilities(scored, is_logits, n_classes)
    return scoring.alert(scoring.predicted_class(probable), n_classes, min_class, threshold)
