"""Packing (operator 7): optimal length buckets by dynamic programming, token-budget batches inside each bucket.

Texts longer than ``max_len`` tokens are cut into pieces, so the global histogram has at most ``max_len + 1`` rows; that is all
the driver sees. Dynamic programming over it finds the ``n_buckets`` upper bounds with the least padding. Inside a
bucket, pieces are numbered across tasks (slots of bounded size, and sums over slots), and every ``token_budget //
bound`` of them make a batch.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tremorloom.llm.common import stash

SLOT_ROWS = 50_000


def bucket_bounds(histogram: dict[int, int], n_buckets: int) -> list[int]:
    """Upper bounds of at most ``n_buckets`` buckets that minimise the sum of (bound - length) over all pieces."""
    lengths = sorted(k for k, n in histogram.items() if n)
    if not lengths:
        return []
    size = np.array(lengths, np.float64)
    count = np.array([histogram[k] for k in lengths], np.float64)
    rows = np.concatenate([[0], np.cumsum(count)])
    tokens = np.concatenate([[0], np.cumsum(count * size)])
    m = len(lengths)
    best = np.full(m + 1, np.inf)
    best[0] = 0
    cuts = []
    for _ in range(min(n_buckets, m)):
        fresh, cut = np.full(m + 1, np.inf), np.zeros(m + 1, np.int64)
        fresh[0] = 0
        for j in range(1, m + 1):  # the last bucket holds lengths i .. j-1
            cost = best[:j] + size[j - 1] * (rows[j] - rows[:j]) - (tokens[j] - tokens[:j])
            cut[j] = int(np.argmin(cost))
            fresh[j] = cost[cut[j]]
        best = fresh
        cuts.append(cut)
    bounds, j = [], m
    for cut in reversed(cuts):
        if j:
            bounds.append(lengths[j - 1])
            j = int(cut[j])
    return bounds[::-1]


def pack(
    lengths: DataFrame, n_buckets: int = 16, token_budget: int = 65_536, max_len: int = 2048, id_col: str = "doc_id", length_col: str = "n_tokens"
) -> DataFrame:
    """``doc_id, piece, offset, n_tokens, bucket, bucket_len, batch, place, padding``: a row for each piece of each row.

    Piece p holds the tokens from ``offset = p * max_len``. NULL and negative lengths count as 0; a row of length 0 is one piece
    of 0 tokens. Batches count from 0 in each bucket and hold ``max(1, token_budget // bucket_len)`` pieces, the last of a
    bucket what is left. Repeated rows and NULL ids are pieces of their own. An empty table gives no rows.
    """
    n = F.greatest(F.coalesce(F.col(f"`{length_col}`").cast("long"), F.lit(0)), F.lit(0))
    last = F.greatest(F.floor((n - 1) / max_len), F.lit(0))
    pieces = lengths.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), n.alias("n"), F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("piece"))
    pieces = pieces.select(
        "doc_id", "piece", (F.col("piece") * max_len).alias("offset"), F.least(F.col("n") - F.col("piece") * max_len, F.lit(max_len)).alias("n_tokens"),
        F.monotonically_increasing_id().alias("row"),
    )
    pieces = stash(pieces, "pieces")
    histogram = {r["n_tokens"]: r["n"] for r in pieces.groupBy("n_tokens").agg(F.count("*").alias("n")).collect()}
    bounds = bucket_bounds(histogram, n_buckets)
    if not bounds:
        bounds = [0]
    held = [sum(c for k, c in histogram.items() if (bounds[b - 1] if b else -1) < k <= bound) for b, bound in enumerate(bounds)]
    spark = lengths.sparkSession
    table = [
        f"SELECT {b} AS bucket, {(bounds[b - 1] if b else -1)}L AS above, {bound}L AS bucket_len, {max(1, token_budget // max(1, bound))}L AS capacity, "
        f"{max(1, -(-held[b] // SLOT_ROWS))}L AS slots"
        for b, bound in enumerate(bounds)
    ]
    buckets = spark.sql(" UNION ALL ".join(table))
    placed = pieces.join(F.broadcast(buckets), (F.col("n_tokens") > F.col("above")) & (F.col("n_tokens") <= F.col("bucket_len")))
    placed = placed.withColumn("slot", F.pmod(F.xxhash64("row"), "slots"))
    sums = placed.groupBy("bucket", "slot").agg(F.count("*").alias("n"))
    before = Window.partitionBy("bucket").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("bucket", "slot", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    nth = F.row_number().over(Window.partitionBy("bucket", "slot").orderBy("row")) - 1
    numbered = placed.withColumn("nth", nth).join(sums, ["bucket", "slot"]).withColumn("nth", F.col("nth") + F.col("before"))
    return numbered.select(
        "doc_id", "piece", "offset", "n_tokens", "bucket", "bucket_len",
        F.floor(F.col("nth") / F.col("capacity")).cast("long").alias("batch"),
        (F.col("nth") % F.col("capacity")).cast("long").alias("place"),
        (F.col("bucket_len") - F.col("n_tokens")).alias("padding"),
    )
