"""Exact top-k by inner product: a Voronoi join of queries and data with bounds from cell summaries.

1. Components become integers, ``floor(scale * x)``. Pivots are a bounded number of vectors, those with the
   smallest hash; every vector belongs to the cell of its nearest pivot.
2. A cell's summary is its size, the largest distance ``r`` from its pivot ``p``, and the largest norm. For a query
   ``q`` all its scores lie within ``q.p - |q| r`` and ``min(q.p + |q| r, |q| max|x|)``. Cells taken
   by lower bound until they hold more than k rows give a floor for the k-th score.
3. The query's home cell is solved first, which raises the floor to its k-th score there.
4. Queries are grouped in the order of their home cells into blocks, data cells are cut into blocks, and a data block
   is sent to a query block only if some query's upper bound for the cell reaches its floor. Each
   pair of blocks is solved locally as one matrix product, and the lists are merged per query.

Bounds get a little slack for rounding, so they never exclude a tie; scores are exact integers. A score that leaves the
64-bit range counts as the end of that range, and such scores tie.

Defined cases: vectors that are null or hold null or non-finite components, and rows with a null id take no part.
A shorter vector counts as padded with zeros, an empty one as zeros alone. Components of any finite size take part; those
whose integer passes 1e300 count as 1e300. Every row is a candidate of its own, so repeated rows are found by
each other; a query row never finds itself. With fewer candidates than k all are returned. Extra columns
are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored, under_hash

#: The first byte of a packed vector: 32-bit integers, or doubles that hold integers.
NARROW, WIDE = b"\x04", b"\x08"
EDGE, TOP = 2.0**63, 2.0**63 * (1 - 1e-15)


def packed(x: np.ndarray) -> bytes:
    """An array of integer-valued doubles in as few bytes as hold it exactly."""
    if np.abs(x).max(initial=0) < 2**31:
        return NARROW + x.astype("<i4").tobytes()
    return WIDE + x.astype("<f8").tobytes()


def components(v: str) -> Column:
    """The number of components of a packed vector."""
    width = F.when(F.substring(v, 1, 1) == F.lit(bytearray(WIDE)), 8).otherwise(4)
    return F.floor((F.length(v) - 1) / width)


def within_range(x: np.ndarray, unknown: float) -> np.ndarray:
    """Bounds of scores, kept to the range of 64-bit integers like the scores themselves."""
    return np.clip(np.where(np.isnan(x), unknown, x), -EDGE, TOP)


def integer_vectors(vectors: DataFrame, key: str, vector: str, scale: int) -> DataFrame:
    """uid, id and v (the packed integers) of the rows that take part."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, uids = batch["id"].to_pylist(), batch["uid"].to_pylist()
            out = []
            for i, uid, x in zip(ids, uids, batch["x"]):
                if i is None or not x.is_valid:
                    continue
                x = x.values
                if x.null_count:
                    continue
                x = x.to_numpy(zero_copy_only=False).astype(np.float64)
                if np.isfinite(x).all():
                    with np.errstate(over="ignore"):
                        x = np.clip(np.floor(scale * x), -1e300, 1e300)
                    out.append((uid, i, packed(x)))
            if out:
                u, i, v = zip(*out)
                yield pa.RecordBatch.from_pydict({"uid": pa.array(u, pa.int64()), "id": pa.array(i, pa.int64()), "v": pa.array(v, pa.binary())})
    rows = vectors.select(F.monotonically_increasing_id().alias("uid"), F.col(key).cast("bigint").alias("id"),
                          F.col(vector).cast("array<double>").alias("x"))
    return rows.mapInArrow(run, "uid bigint, id bigint, v binary")


def matrix(rows, d: int) -> np.ndarray:
    out = np.zeros((len(rows), d))
    for i, x in enumerate(rows):
        x = np.frombuffer(x, "<f8" if memoryview(x)[:1] == WIDE else "<i4", offset=1)
        out[i, : len(x)] = x
    return out


def top_scores(q: np.ndarray, own: np.ndarray, floor: np.ndarray, x: np.ndarray, uid: np.ndarray, ids: np.ndarray,
               k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, data row, score): for each query the k best rows that reach its floor, ties to smaller ids."""
    # integers below 2**53 in every product and sum are exact in doubles, below 2**63 in 64-bit integers
    most = np.abs(q).max(initial=0) * np.abs(x).max(initial=0) * q.shape[1]
    if most < 2**53:
        scores = q @ x.T
    elif most < 2**62:
        scores = q.astype(np.int64) @ x.astype(np.int64).T
    else:
        scores = None
    qs, xs, ss = [], [], []
    for i in range(len(q)):
        if scores is None:
            s, tried = wide_scores(q[i], x, uid != own[i], floor[i], k)
        else:
            s, tried = scores[i], uid != own[i]
        at = np.flatnonzero((s >= floor[i]) & tried)
        if len(at) > k:
            least = np.partition(s[at], len(at) - k)[len(at) - k]
            at = at[s[at] >= least]
        at = at[np.lexsort((uid[at], ids[at], ~s[at].astype(np.int64)))][:k]  # ~ turns the order round, as - cannot at -2**63
        qs.append(np.full(len(at), i))
        xs.append(at)
        ss.append(s[at])
    return np.concatenate(qs), np.concatenate(xs), np.concatenate(ss).astype(np.int64)


def wide_scores(q: np.ndarray, x: np.ndarray, others: np.ndarray, floor: float, k: int) -> tuple[np.ndarray, np.ndarray]:
    """One query's exact scores by integers of any size, for the rows (marked) that can be among the k best.

    Sums of doubles with their error bounds tell which rows those are.
    """
    with np.errstate(over="ignore", invalid="ignore"):
        about, error = x @ q, 1e-15 * (len(q) + 2) * (np.abs(x) @ np.abs(q))
        low, high = within_range(about - error, -np.inf), within_range(about + error, np.inf)
    rows = np.flatnonzero(others & (high >= floor))
    if len(rows) > k:
        rows = rows[high[rows] >= np.partition(low[rows], len(rows) - k)[len(rows) - k]]
    out, tried = np.zeros(len(x), np.int64), np.zeros(len(x), bool)
    tried[rows] = True
    whole = [int(c) for c in q]
    for j in rows:
        score = sum(a * int(b) for a, b in zip(whole, x[j]) if a)
        out[j] = min(max(score, -2**63), 2**63 - 1)
    return out, tried


def top_k(vectors: DataFrame, every: int = 50, k: int = 5, key: str = "vec_id", vector: str = "embedding",
          scale: int = 256, pivots: int = 128, data_block: int = 4096, query_block: int = 512) -> DataFrame:
    """query_id, rank, vec_id, score for the rows whose id is divisible by ``every``, against all rows."""
    spark = vectors.sparkSession
    rows = stored(integer_vectors(vectors, key, vector, scale), "knn-vectors")
    longest, total = rows.agg(F.max(components("v")), F.count("*")).first()
    d = max(1, longest or 0)
    sample = rows.select("v", F.xxhash64("v").alias("h")).filter(under_hash(F.col("h"), total, pivots)) \
        .distinct().orderBy("h", "v").limit(pivots).collect()
    p = spark.sparkContext.broadcast(matrix([r["v"] for r in sample], d))

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                x = matrix([b.as_buffer() for b in part["v"]], d)
                with np.errstate(over="ignore", invalid="ignore"):
                    far = (x * x).sum(1)[:, None] - 2 * (x @ p.value.T) + (p.value * p.value).sum(1)[None, :]
                    near = np.where(np.isnan(far), np.inf, far).argmin(1)
                    gap = x - p.value[near]  # the distance itself, as the sum above cancels
                    r, norm = np.sqrt((gap * gap).sum(1)), np.sqrt((x * x).sum(1))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(near.astype(np.int32)), pa.array(r), pa.array(norm)],
                    names=[*part.schema.names, "cell", "r", "norm"])
    rows = stored(rows.mapInArrow(cells, "uid bigint, id bigint, v binary, cell int, r double, norm double"), "knn-cells")
    # one summary per pivot: their number is a parameter
    summary = rows.groupBy("cell").agg(F.count("*").alias("n"), F.max("r").alias("r"), F.max("norm").alias("norm")) \
        .orderBy("cell").toPandas()
    cell, size = summary["cell"].to_numpy(np.int64), summary["n"].to_numpy(np.int64)
    facts = spark.sparkContext.broadcast((p.value[cell], cell, size, summary["r"].to_numpy(float), summary["norm"].to_numpy(float)))

    def bounds(q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        centre, _, _, r, norm = facts.value
        with np.errstate(over="ignore", invalid="ignore"):
            at, long = q @ centre.T, np.sqrt((q * q).sum(1))[:, None]
            slack = 1e-9 * (np.abs(at) + long * (r + norm)[None, :]) + 1e-6
            low = at - long * r[None, :] - slack
            high = np.minimum(at + long * r[None, :], long * norm[None, :]) + slack
        return within_range(low, -np.inf), within_range(high, np.inf)

    def homes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            q = matrix([b.as_buffer() for b in batch["v"]], d)
            _, numbers, n, _, _ = facts.value
            low, high = bounds(q)
            order = np.argsort(-low, axis=1, kind="stable")
            enough = np.cumsum(n[order], axis=1) > k  # one row may be the query itself
            last = np.where(enough.any(1), enough.argmax(1), -1)
            best = np.take_along_axis(low, order, 1)[np.arange(len(q)), last]
            floor = np.where(last >= 0, best, -np.inf)
            home = numbers[high.argmax(1)]
            yield pa.RecordBatch.from_pydict({"quid": batch["uid"], "qid": batch["id"], "qv": batch["v"],
                                              "home": pa.array(home.astype(np.int32)), "floor": pa.array(floor)})
    queries = rows.filter(F.col("id") % every == 0).select("uid", "id", "v").mapInArrow(
        homes, "quid bigint, qid bigint, qv binary, home int, floor double")
    queries = stored(_blocks(queries, "home", "quid", query_block, "qb"), "knn-queries")
    data = stored(_blocks(rows.select("uid", "id", "v", "cell"), "cell", "uid", data_block, "db"), "knn-data")
    spans = stored(data.select("cell", "db").distinct(), "knn-spans")

    def solve(key: tuple, qs: pd.DataFrame, xs: pd.DataFrame) -> pd.DataFrame:
        if not len(qs) or not len(xs):
            return pd.DataFrame({c: pd.Series(dtype="int64") for c in ("quid", "qid", "uid", "id", "score")})
        uid, ids = xs["uid"].to_numpy(np.int64), xs["id"].to_numpy(np.int64)
        i, j, s = top_scores(matrix(qs["qv"], d), qs["quid"].to_numpy(np.int64), qs["floor"].to_numpy(float),
                             matrix(xs["v"], d), uid, ids, k)
        return pd.DataFrame({"quid": qs["quid"].to_numpy(np.int64)[i], "qid": qs["qid"].to_numpy(np.int64)[i],
                             "uid": uid[j], "id": ids[j], "score": s})

    def joined(q: DataFrame, need: DataFrame) -> DataFrame:
        """q: queries with cell; need: (qb, cell) pairs. Data blocks go to the query blocks that need them."""
        sent = data.join(stored(need, "knn-need"), "cell").select("qb", "cell", "db", "uid", "id", "v")
        asked = q.join(spans, "cell").select("qb", "cell", "db", "quid", "qid", "qv", "floor")
        on = ("qb", "cell", "db")
        return asked.groupBy(*on).cogroup(sent.groupBy(*on)).applyInPandas(
            solve, "quid bigint, qid bigint, uid bigint, id bigint, score bigint")

    at_home = queries.withColumn("cell", F.col("home"))
    first = stored(joined(at_home, at_home.select("qb", "cell").distinct()), "knn-home")
    best = Window.partitionBy("quid").orderBy(F.desc("score"), "id", "uid")
    score = F.col("score").cast("double")
    reached = F.least(score - F.abs(score) * 4e-16, F.lit(TOP))  # never above the score, whatever the cast rounds, nor a bound
    kth = first.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") == k).select("quid", reached.alias("kth"))
    queries = queries.join(kth, "quid", "left").withColumn("floor", F.greatest("floor", "kth")).drop("kth")

    def reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                _, high = bounds(matrix([b.as_buffer() for b in part["qv"]], d))
                numbers = facts.value[1]
                i, j = np.nonzero((high >= part["floor"].to_numpy()[:, None]) & (numbers[None, :] != part["home"].to_numpy()[:, None]))
                got = part.take(pa.array(i))
                yield pa.RecordBatch.from_arrays([*got.columns, pa.array(numbers[j].astype(np.int32))], names=[*got.schema.names, "cell"])
    wide = stored(queries.select("quid", "qid", "qv", "home", "floor", "qb").mapInArrow(
        reach, "quid bigint, qid bigint, qv binary, home int, floor double, qb bigint, cell int"), "knn-reach")
    rest = joined(wide, wide.select("qb", "cell").distinct())
    return first.unionByName(rest).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select(
        F.col("qid").alias("query_id"), "rank", F.col("id").alias("vec_id"), "score")


def _blocks(rows: DataFrame, cell: str, uid: str, most: int, name: str) -> DataFrame:
    """Number the rows' blocks: each cell's rows are dealt by hash into blocks of about ``most`` rows.

    Small neighbouring cells share a query block; a data block is only ever read with its cell.
    """
    n = rows.groupBy(cell).agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    n = n.withColumn("_from", F.floor(before / most)).withColumn("_of", F.ceil(F.col("_n") / most))
    return rows.join(n, cell).withColumn(name, F.col("_from") + F.pmod(F.xxhash64(uid), F.col("_of"))).drop("_n", "_from", "_of")
