"""Published predictions: payloads, latest and history tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tremorloom.functions.times import format_utc, format_utc_compact
from tremorloom.operators.scoring import class_key_map
from tremorloom.session import cut_lineage
from tremorloom.sources.snapshots import Snapshots


def history_key(created: Column, prefix: str = "predictions/history/", filename: str = "prediction.json") -> Column:
    """``<prefix>/<yyyyMMddTHHmmssZ>/<filename>``."""
    stem = prefix.strip("/")
    return F.concat(F.lit(stem + "/" if stem else ""), format_utc_compact(created), F.lit("/" + filename))


def _optional(df: DataFrame, c: str, kind: str = "string") -> Column:
    return F.col(c) if c in df.columns else F.lit(None).cast(kind).alias(c)


def prediction_payload(predictions: DataFrame, generated_at: Column) -> DataFrame:
    """Adds ``payload``: one struct with the alert, classification and model groups and the flat prediction.

    Input columns: ``created_at, probabilities, predicted_class, predicted_probability, p_alert_24h,
    alert_24h, min_class_alert, alert_threshold_24h, n_classes`` and optional ids.
    """
    optional = {c: _optional(predictions, c) for c in ("eruption_id", "model_name", "model_version", "run_id")}
    metadata = _optional(predictions, "metadata", "map<string,string>")
    by_class = class_key_map("probabilities")
    created = format_utc("created_at")
    flat = F.struct(
        created.alias("created_at_utc"),
        "predicted_class",
        "predicted_probability",
        "probabilities",
        by_class.alias("probabilities_by_class"),
        "p_alert_24h",
        "alert_24h",
        "min_class_alert",
        "alert_threshold_24h",
        "n_classes",
        *[c.alias(n) for n, c in optional.items()],
        metadata.alias("metadata"),
    )
    payload = F.struct(
        format_utc(generated_at).alias("generated_at_utc"),
        F.lit("success").alias("status"),
        F.struct(
            F.col("alert_24h").alias("active"),
            "p_alert_24h",
            F.col("alert_threshold_24h").alias("threshold_24h"),
            "min_class_alert",
        ).alias("alert"),
        F.struct(
            "predicted_class", "predicted_probability", "n_classes", by_class.alias("probabilities_by_class")
        ).alias("classification"),
        F.struct(
            optional["model_name"].alias("model_name"),
            optional["model_version"].alias("model_version"),
            optional["run_id"].alias("run_id"),
        ).alias("model"),
        optional["eruption_id"].alias("eruption_id"),
        flat.alias("prediction"),
        metadata.alias("metadata"),
    )
    return predictions.withColumn("payload", payload)


def inference_report(predictions: DataFrame, generated_at: Column) -> DataFrame:
    """Adds ``report``: where the outputs went and a summary of the prediction."""
    optional = {c: _optional(predictions, c) for c in ("eruption_id", "model_name", "model_version", "run_id")}
    report = F.struct(
        format_utc(generated_at).alias("generated_at_utc"),
        F.lit("success").alias("status"),
        F.struct(
            history_key(F.col("created_at")).alias("history_prediction"),
            history_key(F.col("created_at"), "reports/inference", "report.json").alias("inference_report"),
        ).alias("outputs"),
        F.struct(
            format_utc("created_at").alias("created_at_utc"),
            optional["eruption_id"].alias("eruption_id"),
            "alert_24h",
            "p_alert_24h",
            "alert_threshold_24h",
            "predicted_class",
            "predicted_probability",
        ).alias("prediction_summary"),
        F.struct(*[optional[c].alias(c) for c in ("model_name", "model_version", "run_id")]).alias("model"),
    )
    return predictions.withColumn("report", report)


def latest_predictions(predictions: DataFrame, keys: Sequence[str], tie: str) -> DataFrame:
    """Newest row per key: a grouped maximum, so a key with very many rows is reduced before the shuffle."""
    newest = F.max_by(F.struct(*predictions.columns), F.struct("created_at", tie))
    grouped = predictions.groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys]).agg(newest.alias("_row"))
    return grouped.select("_row.*")


def publish_predictions(
    predictions: DataFrame, history_path: str, latest_path: str, keys: Sequence[str], tie: str, generated_at: Column
) -> None:
    """Append to the immutable history (a folder per instant) and update the latest table, same payload.

    The latest table is merged from its previous state and the new rows; the growing history is read only when
    there is no latest table yet (first run, or one lost between delete and write). The two folders are written one
    after the other and a second call appends again; ``publish_batch`` is repeatable and shows both at once.
    """
    spark = predictions.sparkSession
    ready = cut_lineage(
        prediction_payload(predictions, generated_at).select(
            *dict.fromkeys([*keys, "created_at", tie]), F.to_json("payload").alias("payload")
        )
    )
    stamped = ready.withColumn("at", format_utc_compact("created_at"))
    stamped.write.mode("append").partitionBy("at").parquet(history_path)
    try:
        before = spark.read.schema(ready.schema).parquet(latest_path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        before = spark.read.schema(ready.schema).parquet(history_path).select(*ready.columns)
    newest = cut_lineage(latest_predictions(before.unionByName(ready), keys, tie))
    newest.write.mode("overwrite").parquet(latest_path)


def publish_batch(
    predictions: DataFrame, root: str, batch: str, keys: Sequence[str], tie: str, generated_at: Column
) -> bool:
    """Publish a batch once: its rows join the immutable history and the latest table, which readers see at the same time.

    False, with nothing changed, when the batch was published before. A run that died before its marker leaves no trace
    for readers and is simply repeated. The latest table is merged from its last version and the new rows; the history
    isn't read. Predictions are read once, into the history.
    """
    spark = predictions.sparkSession
    store = Snapshots(spark, root)
    ready = prediction_payload(predictions, generated_at).select(
        *dict.fromkeys([*keys, "created_at", tie]), F.to_json("payload").alias("payload")
    )

    def write(commit: str) -> None:
        ready.write.parquet(store.folder("history", commit))
        written = spark.read.schema(ready.schema).parquet(store.folder("history", commit))
        before = store.latest("latest", ready.schema)
        latest_predictions(before.unionByName(written), keys, tie).write.parquet(store.folder("latest", commit))

    return store.publish(batch, write)


def read_latest(spark: SparkSession, root: str, schema: T.StructType | str) -> DataFrame:
    """Newest prediction per key, as of the last publication."""
    return Snapshots(spark, root).latest("latest", _struct(schema))


def read_history(spark: SparkSession, root: str, schema: T.StructType | str) -> DataFrame:
    """All published predictions, with the ``commit`` they came with."""
    return Snapshots(spark, root).all_rows("history", _struct(schema))


def _struct(schema: T.StructType | str) -> T.StructType:
    return schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
