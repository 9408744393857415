"""Feature contract (ordered names) and contract-ordered vectors.

A minute has hundreds of features. They stay in one ``array<float>`` per row: sensors contribute a block of
58 values each, blocks are put side by side in sensor order, and one constant permutation brings the result
into contract order. There are never hundreds of columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tremorloom.functions.arrays import bind, constant_array
from tremorloom.functions.numeric import finite
from tremorloom.schemas import NETWORK_FULL, SENSOR_FEATURES

NETWORK_COLUMNS = [f"{prefix}_{stat}" for prefix in NETWORK_FULL for stat in ("mean", "std")]


def feature_names(features: DataFrame, columns: Sequence[str] = SENSOR_FEATURES) -> DataFrame:
    """Names ``feature__sensor`` (and network names) that have at least one value anywhere."""
    counted = features.groupBy("sensor").agg(*[F.count(finite(c)).alias(c) for c in columns])
    named = counted.select(
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(c).alias("feature"), F.concat_ws("__", F.lit(c), "sensor").alias("name"), F.col(c).alias("n"))
                    for c in columns
                ]
            )
        ).alias("_e")
    ).select("_e.*")
    present = named.where(F.col("n") > 0)
    network = None
    for prefix, c in NETWORK_FULL.items():
        if c in columns:
            found = present.where(F.col("feature") == c).select("feature").distinct()
            rows = found.select(F.explode(F.array(F.lit(f"{prefix}_mean"), F.lit(f"{prefix}_std"))).alias("name"))
            network = rows if network is None else network.unionByName(rows)
    names = present.select("name")
    return names if network is None else names.unionByName(network)


def derive_contract(features: DataFrame, columns: Sequence[str] = SENSOR_FEATURES, most: int | None = None) -> list[str]:
    """Sorted union of the names over all periods: configuration, one name per feature and sensor, hence returned to the driver.

    ``most``: raise if there are more names than the caller expects.
    """
    names = feature_names(features, columns).distinct().collect()
    if most is not None and len(names) > most:
        raise ValueError(f"{len(names)} feature names, more than {most}")
    if not names:
        raise ValueError("no feature has a value")
    return sorted(row["name"] for row in names)


def contract_table(spark: SparkSession, names: Sequence[str]) -> DataFrame:
    return spark.createDataFrame(list(enumerate(names)), "idx int, name string")


def align_to_contract(wide: DataFrame, names: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Wide table in contract order: unknown columns dropped, absent ones NULL."""
    present = set(wide.columns)
    return wide.select(
        *keys, *[F.col(f"`{n}`") if n in present else F.lit(None).cast("double").alias(n) for n in names]
    )


def contract_vectors(
    features: DataFrame,
    names: Sequence[str],
    columns: Sequence[str] = SENSOR_FEATURES,
    period: str = "eruption_id",
) -> DataFrame:
    """One row per minute: ``(period, time_min, x array<float>)`` in contract order.

    One shuffle on (period, minute) serves averaging of repeated rows, network statistics and assembly; a group
    holds one row per sensor. Names the data do not have stay NULL; sensors outside the contract are left out
    of the blocks but still count in the network statistics, as all sensors of the minute do.
    """
    columns = list(columns)
    position = {c: i for i, c in enumerate(columns)}
    sensors = sorted({n.split("__", 1)[1] for n in names if "__" in n and n.split("__", 1)[0] in position})
    slot = {s: i * len(columns) for i, s in enumerate(sensors)}
    network = [n for n in NETWORK_COLUMNS if NETWORK_FULL[n.rsplit("_", 1)[0]] in position]
    network_slot = {n: len(sensors) * len(columns) + i for i, n in enumerate(network)}

    def place(name: str) -> int:
        if name in network_slot:
            return network_slot[name]
        feature, _, sensor = name.partition("__")
        if feature in position and sensor in slot:
            return slot[sensor] + position[feature]
        return -1

    permutation = constant_array([place(n) for n in names], "int")
    merged = (
        features.repartition(period, "time_min")
        .groupBy(period, "time_min", "sensor")
        .agg(*[F.avg(c).alias(c) for c in columns])
    )
    block = F.array(*[finite(c).cast("float") for c in columns])
    per_minute = merged.groupBy(period, "time_min").agg(
        F.map_from_entries(F.collect_list(F.struct("sensor", block.alias("block")))).alias("_blocks"),
        *[
            stat(source).alias(f"_{prefix}_{label}")
            for prefix, source in NETWORK_FULL.items()
            if source in position
            for label, stat in (("mean", F.avg), ("std", F.stddev_samp))
        ],
    )
    empty = F.array_repeat(F.lit(None).cast("float"), len(columns))
    sensor_list = F.lit(sensors) if sensors else F.array().cast("array<string>")
    side_by_side = bind(
        F.col("_blocks"),
        lambda blocks: F.flatten(F.transform(sensor_list, lambda s: F.coalesce(F.try_element_at(blocks, s), empty))),
    )
    tail = F.array(*[F.col(f"_{n}").cast("float") for n in network]) if network else F.array().cast("array<float>")
    ordered = bind(
        F.concat(side_by_side, tail),
        lambda cells: F.transform(permutation, lambda i: F.when(i >= 0, F.get(cells, i))),
    )
    return per_minute.select(period, "time_min", ordered.alias("x"))
