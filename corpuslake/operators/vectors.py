"""Inner-product search of a query set against all vectors: exact in blocks,
or in the nearest lists of a coarse index."""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..session import write_shared

#: Vectors in a block; a task holds one block of each side.
BLOCK = 4096


def _top(key, left: pa.Table, right: pa.Table, k: int) -> pa.Table:
    data = np.stack([np.asarray(v, np.float64) for v in left.column("v").to_numpy()])
    ids = np.asarray(left.column("id").to_numpy())
    out_q, out_i, out_s = [], [], []
    queries = np.stack([np.asarray(v, np.float64) for v in right.column("q").to_numpy()])
    for at in range(0, len(queries), 512):
        score = queries[at : at + 512] @ data.T
        take = min(k, score.shape[1])
        # All that reach the k-th best, so that ties are settled by id later.
        low = np.partition(score, score.shape[1] - take, axis=1)[:, score.shape[1] - take]
        rows, cols = np.nonzero(score >= low[:, None] - 1e-12)
        out_q.append(right.column("qid").to_numpy()[at + rows])
        out_i.append(ids[cols])
        out_s.append(score[rows, cols])
    return pa.table({"query_id": np.concatenate(out_q), "id": np.concatenate(out_i), "score": np.concatenate(out_s)})


def top_k(vectors: DataFrame, queries: DataFrame, key: str, vector: str, k: int) -> DataFrame:
    """query_id, id, score, rank of the k vectors with the greatest inner
    product for each query, ties by id. Null and empty vectors are left out;
    all others are expected to be of one length.

    Both sides are dealt into blocks of bounded size and each pair of blocks
    is one matrix product; a pair of blocks sends k rows (and ties) a query.
    """
    usable = lambda df: df.where(F.size(F.coalesce(F.col(vector), F.array())) > 0).select(F.col(key).cast("long").alias("id"), F.col(vector).alias("v"))
    data, asked = usable(vectors), usable(queries)
    nd, nq = (max(1, -(-df.count() // BLOCK)) for df in (data, asked))
    data = data.withColumn("d", F.pmod(F.xxhash64("id"), F.lit(nd))).withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(nq - 1))))
    asked = asked.select(F.col("id").alias("qid"), F.col("v").alias("q"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(nq)).cast("int").alias("qb"))
    asked = asked.withColumn("qd", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(nd - 1).cast("long"))))
    near = data.groupBy("d", "b").cogroup(asked.groupBy("qd", "qb")).applyInArrow(_guarded(k), "query_id long, id long, score double")
    w = Window.partitionBy("query_id").orderBy(F.round("score", 9).desc(), "id")
    return near.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _guarded(k: int):
    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table({"query_id": pa.array([], pa.int64()), "id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        return _top(key, left, right, k)

    return run


#: Vectors that the index is fitted on, rounds of fitting, and vectors of the
#: sample whose recall against brute force over the sample sets the probes.
FIT, FIT_ROUNDS, ASKED = 20_000, 12, 400


def fit_index(vectors: DataFrame, key: str, vector: str, lists: int = 64, k: int = 5, recall: float = 0.95) -> tuple[np.ndarray, int]:
    """(centres, probes): k-means centres of about FIT vectors, taken by the
    hash of their key, and the fewest lists to probe with which the k nearest
    within that sample are found at the given recall. The same on every run.
    Null and empty vectors are left out; no vector gives no centre."""
    usable = vectors.where(F.col(key).isNotNull() & (F.size(F.coalesce(F.col(vector), F.array())) > 0)).select(F.col(key).cast("long").alias("id"), F.col(vector).alias("v"))
    share = min(1.0, FIT / max(usable.count(), 1))
    some = usable.where(F.pmod(F.xxhash64("id", F.lit("centres")), F.lit(1_000_003)) < F.lit(int(share * 1_000_003) + 1))
    rows = sorted(some.collect())
    if not rows:
        return np.zeros((0, 0)), 1
    data = np.array([r.v for r in rows], np.float64)
    rng = np.random.default_rng(3)
    centres = data[rng.choice(len(data), min(lists, len(data)), replace=False)]
    for _ in range(FIT_ROUNDS):
        near = _far(data, centres).argmin(1)
        for i in range(len(centres)):
            mine = data[near == i]
            if len(mine):
                centres[i] = mine.mean(0)
    home = _far(data, centres).argmin(1)
    asked = data[rng.choice(len(data), min(ASKED, len(data)), replace=False)]
    best = np.argsort(-(asked @ data.T), axis=1)[:, :k]
    place = np.argsort(np.argsort(_far(asked, centres), axis=1, kind="stable"), axis=1)  # of each list for each query
    found = np.sort(place[np.arange(len(asked))[:, None], home[best]].reshape(-1))
    return centres, int(found[max(0, -int(-recall * len(found) // 1) - 1)]) + 1


def _far(data: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (centres**2).sum(1)[None] - 2 * data @ centres.T


def _lists(batches, probes: int, shared):
    centres = shared.value
    for b in batches:
        data = np.array(b.column(1).to_pylist(), np.float64)
        if not len(data):
            continue
        far = _far(data, centres)
        take = min(probes, far.shape[1])
        near = np.argsort(far, axis=1, kind="stable")[:, :take]
        rows = b.take(pa.array(np.repeat(np.arange(len(data)), take)))
        yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(near.reshape(-1).astype(np.int32))], names=["id", "v", "list"])


def index_top_k(vectors: DataFrame, queries: DataFrame, key: str, vector: str, k: int, lists: int = 64, probes: int | None = None) -> DataFrame:
    """As top_k, but a query meets only the vectors of the `probes` lists whose
    centres are nearest (None: as many as fit_index finds for a recall of
    0.95); every vector lies in one list. With probes = lists the result is
    exact.

    A list is cut into blocks of about BLOCK vectors, so a hot list is spread
    over many tasks; a query is sent to each block of its lists, as are at
    most BLOCK queries at a time. The centres (lists x dimension) are
    broadcast.
    """
    usable = lambda df: df.where(F.col(key).isNotNull() & (F.size(F.coalesce(F.col(vector), F.array())) > 0)).select(F.col(key).cast("long").alias("id"), F.col(vector).alias("v"))
    centres, enough = fit_index(vectors, key, vector, lists, k)
    probes = enough if probes is None else probes
    spark = vectors.sparkSession
    if not len(centres):
        return spark.createDataFrame([], "query_id long, id long, score double, rank int")
    shared = spark.sparkContext.broadcast(centres)
    data, asked = usable(vectors), usable(queries)
    schema = f"id long, v {data.schema['v'].dataType.simpleString()}, list int"
    data = data.mapInArrow(partial(_lists, probes=1, shared=shared), schema)
    asked = asked.mapInArrow(partial(_lists, probes=probes, shared=shared), schema)
    sizes = data.groupBy("list").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))  # a row for each list
    sizes = F.broadcast(write_shared(sizes, "vector-lists"))
    wanted = F.broadcast(write_shared(asked.groupBy("list").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("turns")), "vector-turns"))
    data = data.join(sizes, "list").join(wanted, "list").withColumn("d", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")).withColumn("b", F.explode(F.sequence(F.lit(0), F.col("turns") - 1)))
    asked = asked.join(sizes, "list").join(wanted, "list").select(F.col("id").alias("qid"), F.col("v").alias("q"), F.col("list").alias("ql"), F.pmod(F.xxhash64("id", F.lit(1)), F.col("turns")).cast("int").alias("qb"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("qd"))
    near = data.select("id", "v", "list", "d", "b").groupBy("list", "d", "b").cogroup(asked.groupBy("ql", "qd", "qb")).applyInArrow(_guarded(k), "query_id long, id long, score double")
    w = Window.partitionBy("query_id").orderBy(F.round("score", 9).desc(), "id")
    return near.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
