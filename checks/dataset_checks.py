"""Checks of contract, sequences, labels, splits, weights, fit, profiles and gates."""

from __future__ import annotations


from pyspark.sql import functions as F

from checks import standins as st
from checks.standins import HOURS_SQL, ROLLED_SQL
from checks.support import check, scratch, table
from tremorloom.functions.labels import horizon_label
from tremorloom.operators import contract, gates, minutes, periods, scaling, sequences
from tremorloom.operators.ranking import exact_quantiles, global_rank
from tremorloom.plans import jobs
from tremorloom.session import cut_lineage
from tremorloom.sources import tables

LENGTH, STRIDE = 12, 5

# --- contract -------------------------------------------------------------------------------------

CONTRACT_FEATURES = ["amplitude_mean", "amplitude_std", "amplitude_mean_roll_mean", "shannon_entropy", "kurtosis"]
SENSORS = [f"{s}__C{c}" for s in ("click", "error", "purchase", "signup", "view") for c in range(3)]
NAMES = sorted(
    [f"{f}__{s}" for f in CONTRACT_FEATURES for s in SENSORS] + ["kurtosis__no__sensor"] + contract.NETWORK_COLUMNS
)
NETWORK_EXPR = {
    "network_entropy_mean": "avg(shannon_entropy)",
    "network_entropy_std": "stddev_samp(shannon_entropy)",
    "network_kurtosis_mean": "avg(kurtosis)",
    "network_kurtosis_std": "stddev_samp(kurtosis)",
    "network_amplitude_mean": "avg(amplitude_mean_roll_mean)",
    "network_amplitude_std": "stddev_samp(amplitude_mean_roll_mean)",
}


def _value_sql(name: str) -> str:
    if name in NETWORK_EXPR:
        return f"CAST({NETWORK_EXPR[name]} AS FLOAT)"
    feature, sensor = name.split("__", 1)
    return f"CAST(avg({feature}) FILTER (sensor = '{sensor}') AS FLOAT)"


CONTRACT_SQL = (
    f"WITH {ROLLED_SQL}, named AS ("
    + " UNION ".join(f"SELECT '{f}__' || sensor AS name FROM features WHERE {f} IS NOT NULL" for f in CONTRACT_FEATURES)
    + " UNION "
    + " UNION ".join(
        f"SELECT '{prefix}_{stat}' FROM features WHERE {source} IS NOT NULL"
        for prefix, source in contract.NETWORK_FULL.items()
        for stat in ("mean", "std")
    )
    + ") SELECT row_number() OVER (ORDER BY name) - 1 AS idx, name FROM named"
)


@check("feature_contract", "idx:i name:s", CONTRACT_SQL)
def _(spark, sf):
    names = contract.derive_contract(st.sensor_rows(spark, sf), CONTRACT_FEATURES)
    return contract.contract_table(spark, names)


@check(
    "contract_vectors",
    "eruption_id:s time_min:t idx:i v:d",
    f"WITH {ROLLED_SQL}, wide AS (SELECT eruption_id, time_min, [" + ", ".join(_value_sql(n) for n in NAMES) + "] AS x FROM features GROUP BY 1, 2) "
    f"SELECT eruption_id, time_min, unnest(range({len(NAMES)})) AS idx, unnest(x) AS v FROM wide",
)
def _(spark, sf):
    vectors = contract.contract_vectors(st.sensor_rows(spark, sf), NAMES, CONTRACT_FEATURES)
    return vectors.select("eruption_id", "time_min", F.posexplode("x").alias("idx", "v"))


@check(
    "align_to_contract",
    "eruption_id:s sensor:s time_min:t amplitude_std:d brand_new:d amplitude_mean:d",
    f"WITH {HOURS_SQL} SELECT eruption_id, sensor, time_min, amplitude_std, CAST(NULL AS DOUBLE) AS brand_new, amplitude_mean FROM hours",
)
def _(spark, sf):
    wide = st.hours(spark, sf)
    return contract.align_to_contract(wide, ["amplitude_std", "brand_new", "amplitude_mean"], ["eruption_id", "sensor", "time_min"])


# --- sequences ------------------------------------------------------------------------------------

ENDS_SQL = (
    f"{HOURS_SQL}, vecs AS (SELECT eruption_id AS period_id, time_min, CAST(avg(amplitude_mean) AS FLOAT) AS f0, "
    "CAST(stddev_samp(amplitude_mean) AS FLOAT) AS f1, CAST(sum(amplitude_count) AS FLOAT) AS f2 FROM hours GROUP BY 1, 2), "
    "idx AS (SELECT *, row_number() OVER (PARTITION BY period_id ORDER BY time_min) AS rn FROM vecs), "
    f"ends AS (SELECT period_id, time_min AS t_end, rn AS end_rn FROM idx WHERE rn >= {LENGTH} AND (rn - {LENGTH}) % {STRIDE} = 0)"
)
TIMED_SQL = (
    f"{ENDS_SQL}, timed AS (SELECT e.*, p.period_type, p.split, epoch_us(p.event_start) AS ev, "
    "(epoch_us(p.event_start) - epoch_us(e.t_end)) / 3.6e9 AS h FROM ends e JOIN periods p USING (period_id))"
)
LABEL_CASE = "CASE WHEN h <= 6 THEN 5 WHEN h <= 12 THEN 4 WHEN h <= 24 THEN 3 WHEN h <= 36 THEN 2 WHEN h <= 48 THEN 1 END"
KEPT_SQL = (
    f"{TIMED_SQL}, kept AS (SELECT period_id, t_end, end_rn, split, h AS hours, {LABEL_CASE} AS y FROM timed "
    "WHERE period_type = 'eruption' AND h >= 0 AND h <= 48 UNION ALL "
    "SELECT period_id, t_end, end_rn, split, NULL, 0 FROM timed WHERE period_type = 'quiet')"
)
SPLIT_SQL = (
    f"{KEPT_SQL}, ranked AS (SELECT *, row_number() OVER (ORDER BY t_end, period_id) - 1 AS pos, count(*) OVER () AS n FROM kept), "
    "bounds AS (SELECT *, greatest(1, least(CAST(trunc(n * CAST(0.7 AS DOUBLE)) AS BIGINT), n - 2)) AS b1 FROM ranked), "
    "bounds2 AS (SELECT *, greatest(b1 + 1, least(CAST(trunc(n * CAST(0.85 AS DOUBLE)) AS BIGINT), n - 1)) AS b2 FROM bounds), "
    "placed AS (SELECT period_id, t_end, end_rn, y, CASE WHEN pos < b1 THEN 'train' WHEN pos < b2 THEN 'val' ELSE 'test' END AS split FROM bounds2)"
)
WEIGHT_SQL = (
    f"{SPLIT_SQL}, weights AS (SELECT i.period_id, i.time_min, i.f0, i.f1, i.f2, "
    f"(SELECT count(*) FROM placed k WHERE k.split = 'train' AND k.period_id = i.period_id AND k.end_rn BETWEEN i.rn AND i.rn + {LENGTH - 1}) AS weight FROM idx i)"
)


def vectors(spark, sf):
    x = F.array(
        F.avg("amplitude_mean").cast("float"),
        F.stddev_samp("amplitude_mean").cast("float"),
        F.sum("amplitude_count").cast("float"),
    )
    return (
        st.hours(spark, sf).groupBy(F.col("eruption_id").alias("period_id"), "time_min").agg(x.alias("x"))
    )


def indexed(spark, sf):
    return sequences.index_rows(vectors(spark, sf))


def ends(spark, sf):
    return sequences.sequence_ends(indexed(spark, sf), LENGTH, STRIDE)


def kept(spark, sf):
    return sequences.label_sequences(ends(spark, sf), st.period_table(spark))


def placed(spark, sf):
    # the boundaries are searched with several small actions over the ends
    return sequences.split_chronological(cut_lineage(kept(spark, sf)), 0.7, 0.15)


def weights(spark, sf):
    rows = cut_lineage(indexed(spark, sf))
    kept_ends = sequences.label_sequences(sequences.sequence_ends(rows, LENGTH, STRIDE), st.period_table(spark))
    train = sequences.split_chronological(cut_lineage(kept_ends), 0.7, 0.15).where("split = 'train'")
    return sequences.sequence_weights(rows, train, LENGTH, chunk_rows=50)


@check("sequence_ends", "period_id:s t_end:t end_rn:i", f"WITH {ENDS_SQL} SELECT * FROM ends")
def _(spark, sf):
    return ends(spark, sf)


@check(
    "build_sequences",
    "period_id:s t_end:t step:i f0:d f1:d f2:d",
    f"WITH {ENDS_SQL} SELECT e.period_id, e.t_end, i.rn - e.end_rn + {LENGTH - 1} AS step, f0, f1, f2 FROM ends e "
    f"JOIN idx i ON i.period_id = e.period_id AND i.rn BETWEEN e.end_rn - {LENGTH - 1} AND e.end_rn",
)
def _(spark, sf):
    built = sequences.build_sequences(indexed(spark, sf), ends(spark, sf), LENGTH)
    return built.select("period_id", "t_end", F.posexplode("x").alias("step", "v")).select(
        "period_id", "t_end", "step", *[F.get("v", F.lit(i)).alias(f"f{i}") for i in range(3)]
    )


@check(
    "hours_to_event",
    "period_id:s t_end:t hours:d",
    f"WITH {TIMED_SQL} SELECT period_id, t_end, h AS hours FROM timed WHERE h >= 0 AND h <= 48",
)
def _(spark, sf):
    joined = ends(spark, sf).join(st.period_table(spark).select("period_id", "eruption_start_utc"), "period_id")
    return sequences.hours_to_event(joined)


@check(
    "hours_to_event_clamped",
    "period_id:s t_end:t hours:d y:i",
    f"WITH {TIMED_SQL} SELECT period_id, t_end, h AS hours, {LABEL_CASE} AS y FROM ("
    "SELECT period_id, t_end, greatest(h, 0) AS h FROM timed WHERE ev IS NOT NULL) WHERE h <= 48",
)
def _(spark, sf):
    joined = ends(spark, sf).join(st.period_table(spark).select("period_id", "eruption_start_utc"), "period_id")
    return sequences.hours_to_event(joined, clamp_after_event=True).withColumn("y", horizon_label("hours"))


@check("label_sequences", "period_id:s t_end:t hours:d y:i", f"WITH {KEPT_SQL} SELECT * FROM kept")
def _(spark, sf):
    return kept(spark, sf)


@check(
    "regression_targets",
    "period_id:s t_end:t y:d",
    f"WITH {KEPT_SQL} SELECT period_id, t_end, CAST(hours AS FLOAT) AS y FROM kept WHERE hours IS NOT NULL",
)
def _(spark, sf):
    return sequences.label_sequences(ends(spark, sf), st.period_table(spark), task="regression")


@check(
    "horizon_label",
    "event_id:i y:i",
    f"SELECT event_id, {LABEL_CASE} AS y FROM (SELECT event_id, value / 10.25 AS h FROM events)",
)
def _(spark, sf):
    return table(spark, sf, "events").withColumn("y", horizon_label(F.col("value") / 10.25, strict=False))


@check(
    "ends_per_period",
    "period_id:s n_sequences:i",
    f"WITH {KEPT_SQL} SELECT p.period_id, count(k.period_id) AS n_sequences FROM periods p LEFT JOIN kept k USING (period_id) GROUP BY 1",
)
def _(spark, sf):
    return sequences.ends_per_period(st.period_table(spark), kept(spark, sf))


@check("split_chronological", "period_id:s t_end:t y:i split:s", f"WITH {SPLIT_SQL} SELECT * FROM placed")
def _(spark, sf):
    return placed(spark, sf)


# every shipping line is a sequence end; the boundaries fall inside busy days
@check(
    "split_chronological_lines",
    "period_id:s t_end:t split:s",
    "WITH ranked AS (SELECT CAST(l_orderkey * 10 + l_linenumber AS VARCHAR) || '-' || CAST(l_partkey AS VARCHAR) || '-' || CAST(l_suppkey AS VARCHAR) || '-' || CAST(l_extendedprice AS VARCHAR) AS period_id, l_shipdate AS t_end FROM lineitem), "
    "pos AS (SELECT *, row_number() OVER (ORDER BY t_end, period_id) - 1 AS pos, count(*) OVER () AS n FROM ranked) "
    "SELECT period_id, t_end, CASE WHEN pos < trunc(n * CAST(0.7 AS DOUBLE)) THEN 'train' WHEN pos < trunc(n * CAST(0.85 AS DOUBLE)) THEN 'val' ELSE 'test' END AS split FROM pos",
)
def _(spark, sf):
    li = table(spark, sf, "lineitem")
    key = F.concat_ws(
        "-", (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("string"), F.col("l_partkey").cast("string"),
        F.col("l_suppkey").cast("string"), F.col("l_extendedprice").cast("string"),
    )
    return sequences.split_chronological(li.select(key.alias("period_id"), F.col("l_shipdate").alias("t_end")), 0.7, 0.15)


@check(
    "split_manual",
    "period_id:s t_end:t split:s",
    f"WITH {ENDS_SQL} SELECT e.period_id, e.t_end, p.split FROM ends e JOIN periods p USING (period_id)",
)
def _(spark, sf):
    return sequences.split_manual(ends(spark, sf), st.period_table(spark))


@check("sequence_weights", "period_id:s time_min:t weight:i", f"WITH {WEIGHT_SQL} SELECT * FROM weights")
def _(spark, sf):
    return weights(spark, sf)


LONG_SQL = (
    f"{WEIGHT_SQL}, long AS (SELECT weight AS w, unnest(range(3)) AS idx, unnest([f0, f1, f2]) AS v FROM weights WHERE weight > 0), "
    "medians AS (SELECT idx, CAST(coalesce(median(CAST(v AS DOUBLE)) FILTER (v IS NOT NULL), 0) AS FLOAT) AS median FROM (SELECT idx, v, unnest(range(w)) FROM long) GROUP BY 1), "
    "filled AS (SELECT l.idx, w, m.median, CAST(coalesce(v, m.median) AS DOUBLE) AS v FROM long l JOIN medians m USING (idx)), "
    "means AS (SELECT idx, max(median) AS median, sum(w * v) / sum(w) AS mean FROM filled GROUP BY 1), "
    "params AS (SELECT f.idx, max(m.median) AS median, CAST(max(mean) AS FLOAT) AS mean, "
    "CAST(CASE WHEN sqrt(sum(w * (v - mean) * (v - mean)) / sum(w)) = 0 THEN 1 ELSE sqrt(sum(w * (v - mean) * (v - mean)) / sum(w)) END AS FLOAT) AS scale "
    "FROM filled f JOIN means m USING (idx) GROUP BY 1)"
)


@check("fit_imputer", "idx:i median:d", f"WITH {LONG_SQL} SELECT * FROM medians")
def _(spark, sf):
    return scaling.fit_imputer(scaling.explode_vectors(weights(spark, sf)))


@check(
    "fit_params",
    "idx:i name:s median:d mean:d scale:d",
    f"WITH {LONG_SQL} SELECT idx, 'f' || idx AS name, median, mean, scale FROM params",
)
def _(spark, sf):
    return scaling.fit_params(weights(spark, sf), ["f0", "f1", "f2"])


@check(
    "apply_params",
    "period_id:s time_min:t idx:i v:d",
    f"WITH {LONG_SQL}, cells AS (SELECT period_id, time_min, unnest(range(3)) AS idx, unnest([f0, f1, f2]) AS v FROM weights) "
    "SELECT period_id, time_min, idx, CAST((coalesce(v, median) - mean) / scale AS FLOAT) AS v FROM cells JOIN params USING (idx)",
)
def _(spark, sf):
    rows = weights(spark, sf)
    params = scaling.fit_params(rows, ["f0", "f1", "f2"])
    return scaling.apply_params(rows, params, 3).select("period_id", "time_min", F.posexplode("x").alias("idx", "v"))


@check(
    "exact_quantiles",
    "flag:s probability:d quantile:d",
    "WITH q AS (SELECT l_returnflag AS flag, unnest([CAST(0.1 AS DOUBLE), 0.25, 0.5, 0.9]) AS probability, "
    "unnest(quantile_cont(CAST(l_extendedprice AS DOUBLE), [0.1, 0.25, 0.5, 0.9])) AS quantile FROM lineitem GROUP BY 1) SELECT * FROM q",
)
def _(spark, sf):
    li = table(spark, sf, "lineitem").withColumnRenamed("l_returnflag", "flag")
    return exact_quantiles(li, "flag", "l_extendedprice", [0.1, 0.25, 0.5, 0.9])


@check(
    "weighted_quantiles",
    "flag:s probability:d quantile:d",
    "WITH e AS (SELECT l_returnflag AS flag, l_extendedprice AS v, unnest(range(CAST(l_quantity AS BIGINT))) FROM lineitem) "
    "SELECT flag, 0.5 AS probability, median(v) AS quantile FROM e GROUP BY 1",
)
def _(spark, sf):
    li = table(spark, sf, "lineitem").withColumnRenamed("l_returnflag", "flag")
    return exact_quantiles(li, "flag", "l_extendedprice", [0.5], weight="l_quantity")


@check(
    "global_rank",
    "l_orderkey:i l_linenumber:i l_partkey:i price:d rn:i",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice AS price, row_number() OVER (PARTITION BY l_linestatus "
    "ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_extendedprice) AS rn FROM lineitem",
)
def _(spark, sf):
    li = table(spark, sf, "lineitem")
    order = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"]
    ranked = global_rank(li, ["l_linestatus"], order, F.date_trunc("month", "l_shipdate"), name="rn")
    return ranked.withColumnRenamed("l_extendedprice", "price")


@check(
    "latest_batch",
    "period_id:s t_end:t",
    f"WITH {ENDS_SQL} SELECT period_id, t_end FROM ends ORDER BY period_id DESC, t_end DESC LIMIT 7",
)
def _(spark, sf):
    order = F.regexp_extract("period_id", "[0-9]+", 0).cast("int")
    return sequences.latest_batch(ends(spark, sf).withColumn("period_ord", order), 7)


@check(
    "merge_datasets",
    "split:s source_ord:i n:i n_flag:i",
    f"WITH {ENDS_SQL}, s AS (SELECT e.period_id, e.t_end, p.split FROM ends e JOIN periods p USING (period_id)) "
    "SELECT split, source_ord, count(*) AS n, count(flag) AS n_flag FROM (SELECT split, 0 AS source_ord, 1 AS flag FROM s "
    "UNION ALL SELECT split, 1, NULL FROM s WHERE split <> 'test' UNION ALL SELECT split, 2, NULL FROM s WHERE split = 'test') GROUP BY 1, 2",
)
def _(spark, sf):
    whole = sequences.split_manual(ends(spark, sf), st.period_table(spark))
    reference = whole.withColumn("flag", F.lit(1))
    merged = sequences.merge_datasets(reference, whole.where("split <> 'test'"), whole.where("split = 'test'"))
    return merged.groupBy("split", "source_ord").agg(F.count(F.lit(1)).alias("n"), F.count("flag").alias("n_flag"))


# --- profiles and gates: every embedding is one sequence of 8 steps with 8 features -----------------

MATRIX_SQL = (
    "seqs AS (SELECT vec_id, CASE WHEN label < 6 THEN 'train' WHEN label < 8 THEN 'val' ELSE 'test' END AS split, "
    "label % 6 AS y, embedding FROM embeddings), "
    "cells AS (SELECT vec_id, split, y, i // 8 AS t, i % 8 AS f, CAST(embedding[i + 1] AS DOUBLE) AS v FROM seqs, range(64) r(i))"
)
# large values are damaged so that the counts of the profile are not all zero
DAMAGED_SQL = (
    f"{MATRIX_SQL}, dam AS (SELECT vec_id, split, y, CASE WHEN v <= CAST(0.3 AS FLOAT) AND v >= CAST(-0.3 AS FLOAT) THEN v END AS v, "
    "v > CAST(0.3 AS FLOAT) AS isn, v < CAST(-0.3 AS FLOAT) AS isi FROM cells)"
)


def matrices(spark, sf):
    e = table(spark, sf, "embeddings")
    steps = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda t: F.slice("embedding", t * 8 + 1, 8))
    split = F.when(F.col("label") < 6, "train").when(F.col("label") < 8, "val").otherwise("test")
    return e.select(F.col("vec_id").alias("seq_id"), split.alias("split"), (F.col("label") % 6).alias("y"), "label", steps.alias("x"))


def damaged(spark, sf):
    bad = lambda v: F.when(v > F.lit(0.3).cast("float"), F.lit(float("nan"))).when(
        v < F.lit(-0.3).cast("float"), F.lit(float("-inf"))
    ).otherwise(v).cast("float")
    return matrices(spark, sf).withColumn("x", F.transform("x", lambda step: F.transform(step, bad)))


PROFILE_AGG = (
    "count(*) FILTER (isn) AS nan_count, count(*) FILTER (isi) AS inf_count, count(v) AS finite_count, count(*) AS total_values, "
    "count(v) / count(*) AS finite_ratio, min(v) AS min_value, max(v) AS max_value, avg(v) AS mean_value, stddev_pop(v) AS std_value, "
    "count(*) FILTER (v = 0) / count(*) AS zero_ratio, max(abs(v)) AS abs_max"
)


@check(
    "sequence_profile",
    "sequence_index:i seq_len:i n_features:i dtype:s nan_count:i inf_count:i finite_count:i total_values:i finite_ratio:d "
    "min_value:d max_value:d mean_value:d std_value:d zero_ratio:d abs_max:d",
    f"WITH {DAMAGED_SQL} SELECT vec_id AS sequence_index, 8 AS seq_len, 8 AS n_features, 'float' AS dtype, {PROFILE_AGG} FROM dam GROUP BY 1",
)
def _(spark, sf):
    return gates.sequence_profile(damaged(spark, sf))


@check(
    "split_profile",
    "split_name:s n_sequences:i seq_len:i n_features:i x_nan_count:i x_inf_count:i y_nan_count:i x_finite_count:i x_total_values:i "
    "x_finite_ratio:d y_finite_ratio:d x_min_value:d x_max_value:d x_mean_value:d x_std_value:d x_abs_max:d label_min:i label_max:i n_unique_labels:i",
    f"WITH {DAMAGED_SQL} SELECT split AS split_name, count(DISTINCT vec_id) AS n_sequences, 8 AS seq_len, 8 AS n_features, "
    "count(*) FILTER (isn) AS x_nan_count, count(*) FILTER (isi) AS x_inf_count, 0 AS y_nan_count, count(v) AS x_finite_count, "
    "count(*) AS x_total_values, count(v) / count(*) AS x_finite_ratio, 1.0 AS y_finite_ratio, min(v) AS x_min_value, max(v) AS x_max_value, "
    "avg(v) AS x_mean_value, stddev_pop(v) AS x_std_value, max(abs(v)) AS x_abs_max, min(y) AS label_min, max(y) AS label_max, "
    "count(DISTINCT y) AS n_unique_labels FROM dam GROUP BY 1",
)
def _(spark, sf):
    return gates.split_profile(damaged(spark, sf))


def _expect_sql(profile: str, rules: list[tuple[str, str]]) -> str:
    """``rules``: (name, SQL aggregate that counts bad rows)."""
    counts = ", ".join(f"{expr} AS r{i}" for i, (_, expr) in enumerate(rules))
    rows = " UNION ALL ".join(
        f"SELECT '{name}' AS rule, r{i} AS n_bad, r{i} = 0 AS success FROM counted" for i, (name, _) in enumerate(rules)
    )
    return f"{profile}, counted AS (SELECT {counts} FROM profile) {rows}"


BATCH_SQL = _expect_sql(
    f"WITH {DAMAGED_SQL}, profile AS (SELECT vec_id AS sequence_index, {PROFILE_AGG} FROM dam GROUP BY 1)",
    [
        ("column_list", "0"),
        ("row_count", "CASE WHEN count(*) = 500 THEN 0 ELSE 1 END"),
        ("sequence_index_between", "count(*) FILTER (sequence_index NOT BETWEEN 0 AND 499)"),
        ("seq_len_between", "0"),
        ("n_features_between", "0"),
        ("nan_count_between", "count(*) FILTER (nan_count <> 0)"),
        ("inf_count_between", "count(*) FILTER (inf_count <> 0)"),
        ("finite_ratio_between", "count(*) FILTER (finite_ratio <> 1)"),
        ("zero_ratio_between", "0"),
        ("min_value_not_null", "count(*) FILTER (min_value IS NULL)"),
        ("max_value_not_null", "count(*) FILTER (max_value IS NULL)"),
        ("mean_value_not_null", "count(*) FILTER (mean_value IS NULL)"),
        ("std_value_not_null", "count(*) FILTER (std_value IS NULL)"),
        ("abs_max_not_null", "count(*) FILTER (abs_max IS NULL)"),
        ("std_value_between", "count(*) FILTER (std_value < 0)"),
        ("abs_max_between", "count(*) FILTER (abs_max < 0)"),
    ],
)


@check("batch_expectations", "rule:s n_bad:i success:b", BATCH_SQL)
def _(spark, sf):
    profile = gates.sequence_profile(damaged(spark, sf))
    return gates.expect(profile, gates.batch_rules(profile, 500, 8, 8))


SPLIT_RULES_SQL = _expect_sql(
    f"WITH {DAMAGED_SQL}, profile AS (SELECT split, count(*) FILTER (isn) AS nans, count(*) FILTER (isi) AS infs, max(y) AS hi, count(DISTINCT y) AS u FROM dam GROUP BY 1)",
    [
        ("column_list", "0"),
        ("row_count", "0"),
        ("split_name_in_set", "0"),
        ("n_sequences_between", "0"),
        ("seq_len_between", "0"),
        ("n_features_between", "count(*)"),
        ("x_nan_count_between", "count(*) FILTER (nans > 0)"),
        ("x_inf_count_between", "count(*) FILTER (infs > 0)"),
        ("y_nan_count_between", "0"),
        ("y_inf_count_between", "0"),
        ("x_finite_ratio_between", "count(*) FILTER (nans + infs > 0)"),
        ("y_finite_ratio_between", "0"),
        ("label_min_between", "0"),
        ("label_max_between", "count(*) FILTER (hi > 4)"),
        ("n_unique_labels_between", "count(*) FILTER (u > 5)"),
    ],
)


@check("split_expectations", "rule:s n_bad:i success:b", SPLIT_RULES_SQL)
def _(spark, sf):
    profile = gates.split_profile(damaged(spark, sf))
    return gates.expect(profile, gates.split_rules(profile, 8, 9, n_classes=5))


@check(
    "validate_batch",
    "rule:s n_bad:i success:b",
    f"WITH {DAMAGED_SQL}, bad AS (SELECT vec_id, count(v) < 64 AS broken FROM dam GROUP BY 1), c AS (SELECT count(*) FILTER (broken) AS n, count(*) AS total FROM bad) "
    "SELECT 'row_count' AS rule, CASE WHEN total = 500 THEN 0 ELSE 1 END AS n_bad, total = 500 AS success FROM c "
    "UNION ALL SELECT 'seq_len', 0, true FROM c UNION ALL SELECT 'n_features', 0, true FROM c UNION ALL SELECT 'finite', n, n = 0 FROM c",
)
def _(spark, sf):
    return gates.validate_batch(damaged(spark, sf), 500, 8, 8)


CONTRACT_RULES_SQL = (
    f"WITH {DAMAGED_SQL}, bad AS (SELECT split, vec_id, max(y) AS y, count(v) < 64 AS broken FROM dam GROUP BY 1, 2), "
    "c AS (SELECT split, count(*) FILTER (broken) AS nf, count(*) FILTER (y > 4) AS hi FROM bad GROUP BY 1), "
    "found AS (SELECT split, 'split_present' AS rule, 0 AS n_bad FROM c UNION ALL SELECT split, 'seq_len', 0 FROM c "
    "UNION ALL SELECT split, 'n_features', 0 FROM c UNION ALL SELECT split, 'finite', nf FROM c UNION ALL SELECT split, 'label_finite', 0 FROM c "
    "UNION ALL SELECT split, 'label_integer', 0 FROM c UNION ALL SELECT split, 'label_range', hi FROM c)"
)


@check("dataset_contract", "split:s rule:s n_bad:i", f"{CONTRACT_RULES_SQL} SELECT * FROM found")
def _(spark, sf):
    return gates.dataset_contract(damaged(spark, sf), 8, 8, n_classes=5)


@check(
    "dataset_report",
    "severity:s split:s rule:s n_bad:i",
    f"{CONTRACT_RULES_SQL}, ys AS (SELECT DISTINCT split, y FROM seqs), "
    "absent AS (SELECT s.split, count(*) AS n FROM (SELECT DISTINCT split FROM ys) s, range(5) r(k) WHERE NOT EXISTS (SELECT 1 FROM ys WHERE ys.split = s.split AND ys.y = k) GROUP BY 1) "
    "SELECT 'error' AS severity, split, rule, n_bad FROM found WHERE n_bad > 0 UNION ALL SELECT 'warning', split, 'absent_classes', n FROM absent "
    "UNION ALL SELECT 'error', NULL, 'names_count', 1",
)
def _(spark, sf):
    return gates.dataset_report(damaged(spark, sf), 8, 8, n_names=7, n_classes=5)


@check(
    "class_counts",
    "split:s y:i n:i valid_class:b",
    f"WITH {MATRIX_SQL}, g AS (SELECT DISTINCT split, k AS y FROM seqs, range(5) r(k)), c AS (SELECT split, y, count(*) AS n FROM seqs GROUP BY 1, 2) "
    "SELECT split, y, coalesce(n, 0) AS n, y BETWEEN 0 AND 4 AS valid_class FROM g FULL JOIN c USING (split, y)",
)
def _(spark, sf):
    return gates.class_counts(matrices(spark, sf), n_classes=5)


@check(
    "target_range",
    "split:s y_min:d y_max:d y_mean:d n_negative:i n_beyond_horizon:i",
    "SELECT l_returnflag AS split, min(y) AS y_min, max(y) AS y_max, avg(y) AS y_mean, count(*) FILTER (y < 0) AS n_negative, "
    "count(*) FILTER (y > 40 + 1e-6) AS n_beyond_horizon FROM (SELECT l_returnflag, l_quantity - 3 AS y FROM lineitem) GROUP BY 1",
)
def _(spark, sf):
    li = table(spark, sf, "lineitem").select(F.col("l_returnflag").alias("split"), (F.col("l_quantity") - 3).alias("y"))
    return gates.target_range(li, 40.0)


# --- the jobs, end to end ---------------------------------------------------------------------------

JOB_NAMES = ["amplitude_mean__click__C0", "network_entropy_mean", "network_amplitude_std"]
_JOB_VECS = (
    "vecs AS (SELECT eruption_id AS period_id, time_min, CAST(avg(amplitude_mean) FILTER (sensor = 'click__C0') AS FLOAT) AS f0, "
    "CAST(avg(shannon_entropy) AS FLOAT) AS f1, CAST(stddev_samp(amplitude_mean_roll_mean) AS FLOAT) AS f2 FROM features GROUP BY 1, 2), idx AS ("
)


def _for_job(sql: str) -> str:
    """The dataset statements over contract vectors instead of the narrow stand-in vectors."""
    start, end = sql.index("vecs AS ("), sql.index("idx AS (") + len("idx AS (")
    return (sql[:start] + _JOB_VECS + sql[end:]).replace(HOURS_SQL, ROLLED_SQL)


TRAINING_SQL = _for_job(LONG_SQL)


@check(
    "training_dataset",
    "period_id:s t_end:t split:s y:i step:i idx:i v:d",
    f"WITH {TRAINING_SQL}, cells AS (SELECT period_id, rn, unnest(range(3)) AS idx, unnest([f0, f1, f2]) AS v FROM idx) "
    f"SELECT p.period_id, p.t_end, p.split, p.y, c.rn - p.end_rn + {LENGTH - 1} AS step, c.idx, CAST((coalesce(c.v, m.median) - m.mean) / m.scale AS FLOAT) AS v "
    f"FROM placed p JOIN cells c ON c.period_id = p.period_id AND c.rn BETWEEN p.end_rn - {LENGTH - 1} AND p.end_rn JOIN params m ON m.idx = c.idx",
)
def _(spark, sf):
    """Minutes to labelled, split, imputed and standardised sequences."""
    minute_rows = minutes.minute_aggregate(st.assigned(spark, sf), st.HOUR)
    built, _params = jobs.training_dataset(
        minute_rows, periods.tidy_periods(st.period_rows(spark)), JOB_NAMES, LENGTH, STRIDE, drop_inference=True
    )
    steps = built.select("period_id", "t_end", "split", "y", F.posexplode("x").alias("step", "row"))
    return steps.select("period_id", "t_end", "split", "y", "step", F.posexplode("row").alias("idx", "v"))


@check(
    "inference_sequences",
    "period_id:s t_end:t step:i idx:i v:d",
    f"WITH {_for_job(ENDS_SQL)}, cells AS (SELECT period_id, rn, unnest(range(3)) AS idx, unnest([f0, f1, f2]) AS v FROM idx) "
    f"SELECT e.period_id, e.t_end, c.rn - e.end_rn + {LENGTH - 1} AS step, c.idx, CAST((coalesce(c.v, CAST(c.idx AS FLOAT)) - CAST(2 AS FLOAT)) / CAST(4 AS FLOAT) AS FLOAT) AS v "
    f"FROM ends e JOIN cells c ON c.period_id = e.period_id AND c.rn BETWEEN e.end_rn - {LENGTH - 1} AND e.end_rn",
)
def _(spark, sf):
    """Sequences of all periods with given contract and parameters; nothing is fitted."""
    minute_rows = minutes.minute_aggregate(st.assigned(spark, sf), st.HOUR)
    params = contract.contract_table(spark, JOB_NAMES).select(
        "idx", "name", F.col("idx").cast("float").alias("median"), F.lit(2.0).cast("float").alias("mean"), F.lit(4.0).cast("float").alias("scale")
    )
    built = jobs.inference_sequences(minute_rows, periods.tidy_periods(st.period_rows(spark)), JOB_NAMES, params, LENGTH, STRIDE)
    steps = built.select("period_id", "t_end", F.posexplode("x").alias("step", "row"))
    return steps.select("period_id", "t_end", "step", F.posexplode("row").alias("idx", "v"))


@check(
    "write_sequences",
    "seq_id:i split:s y:i first:d last:d",
    f"WITH {MATRIX_SQL} SELECT vec_id AS seq_id, split, y, embedding[1] AS first, embedding[64] AS last FROM seqs",
)
def _(spark, sf):
    root = scratch(spark)
    tables.write_sequences(matrices(spark, sf), root)
    last = F.get(F.get("x", F.lit(7)), F.lit(7))
    return tables.read_sequences(spark, root).select("seq_id", "split", "y", F.get(F.get("x", F.lit(0)), F.lit(0)).alias("first"), last.alias("last"))


@check("write_params", "idx:i name:s median:d mean:d scale:d", f"WITH {LONG_SQL} SELECT idx, 'f' || idx AS name, median, mean, scale FROM params")
def _(spark, sf):
    root = scratch(spark)
    tables.write_params(scaling.fit_params(weights(spark, sf), ["f0", "f1", "f2"]), root)
    names = tables.read_contract(spark, root)
    return contract.contract_table(spark, names).join(tables.read_params(spark, root).drop("idx"), "name")
