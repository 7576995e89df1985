"""Filling containers of fixed capacity by sum-of-squares packing.

Each document goes where the sum of the squared numbers of open containers per residual gap becomes smallest: into an
open container of some gap, or into a new one; ties go to the smaller gap. Documents are dealt by a hash of their id
into shards of about `shard_rows`, each packed on its own, so the loss of dealing is a few open containers per
shard. Within a shard the larger come first, which leaves the small ones to close the gaps.

A document longer than the capacity is cut into full containers and a rest; no other is cut. A null or empty text has
size 0 and lies in the shard's first container. Equal sizes are taken in the order of ids, so the result is the same
on every run. A document id that comes several times is packed as often. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sum_of_squares(sizes: list[int], capacity: int) -> tuple[list[int], int]:
    """(container of each item, number of containers); sizes lie between 1 and the capacity."""
    count = np.zeros(capacity + 1, np.int64)  # open containers by gap; those with none left are closed
    bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    out, used = [], 0
    far = np.int64(1) << 60
    for s in sizes:
        # into gap g: the count at g falls by one, that at g - s grows by one unless nothing is left
        now = count[s : capacity + 1]
        after = count[: capacity + 1 - s].copy()
        cost = 2 * (after - now) + 2
        cost[0] -= 2 * after[0] + 1
        cost[now == 0] = far
        k = int(np.argmin(cost))
        fresh = 2 * int(count[capacity - s]) + 1 if s < capacity else 0
        if cost[k] < far and cost[k] <= fresh:
            g = s + k
            b = bins[g].pop()
            count[g] -= 1
        else:
            g, b = capacity, used
            used += 1
        if g > s:
            bins[g - s].append(b)
            count[g - s] += 1
        out.append(b)
    return out, used


def pack(sizes: DataFrame, capacity: int, *, rows: int, shard_rows: int = 1 << 14) -> DataFrame:
    """(doc_id, piece, start_token, tokens, container): where each document, or piece of a longer one, lies.

    sizes: doc_id, n_tokens. rows: about how many there are.
    """
    shards = max(1, -(-rows // shard_rows))
    kind = dict(sizes.dtypes)["doc_id"]
    s = sizes.where("doc_id is not null").select("doc_id", F.coalesce("n_tokens", F.lit(0)).cast("bigint").alias("n"), F.pmod(F.xxhash64("doc_id"), F.lit(shards)).alias("shard"))

    def shard(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["n", "doc_id"], ascending=[False, True], kind="stable")
        ids, n = pdf["doc_id"].to_numpy(), pdf["n"].to_numpy()
        pieces = np.maximum(1, -(-n // capacity))
        at = np.repeat(np.arange(len(n)), pieces)
        piece = np.arange(len(at)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        size = np.minimum(capacity, n[at] - piece * capacity)
        order = np.argsort(-size, kind="stable")
        at, piece, size = at[order], piece[order], size[order]
        real = int((size > 0).sum())
        where, _ = sum_of_squares(size[:real].tolist(), capacity)
        base = int(pdf["shard"].iloc[0]) << 40
        return pd.DataFrame({"doc_id": ids[at], "piece": piece.astype("int32"), "start_token": piece * capacity, "tokens": size, "container": base + np.array(where + [0] * (len(at) - real), dtype=np.int64)})

    # shards are small in bytes and long in work: each is a task of its own, which the engine would else merge by bytes
    return s.repartition(shards, "shard").groupBy("shard").applyInPandas(shard, f"doc_id {kind}, piece int, start_token bigint, tokens bigint, container bigint")


def fill_report(packed: DataFrame, capacity: int) -> DataFrame:
    """One row: containers, tokens, share of the capacity used, containers over the capacity (none), documents cut."""
    by = packed.groupBy("container").agg(F.sum("tokens").alias("t"), F.sum((F.col("piece") > 0).cast("bigint")).alias("rests"))
    return by.agg(
        F.count("*").alias("containers"), F.sum("t").alias("tokens"), F.round(F.sum("t") / (F.count("*") * capacity), 6).alias("filled"),
        F.sum((F.col("t") > capacity).cast("bigint")).alias("over"), F.sum("rests").alias("further_pieces"),
    )
