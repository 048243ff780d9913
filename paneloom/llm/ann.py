"""Nearest neighbours by learned partitions.

On a bounded sample a graph of nearest neighbours is built and cut into balanced parts; a small classifier (softmax over
random features) learns which part a vector belongs to. Every row is put in its most probable part. A query goes to its
several most probable parts and is reranked there with exact distances.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .store import save, share

#: Rows of the sample on which partitions and classifier are fitted.
SAMPLE = 4000
#: A part is searched in blocks of about so many rows, and for so many queries at once.
BLOCK, QUERIES = 4096, 512
FEATURES, NEIGHBOURS = 256, 10


def _knn(x: np.ndarray, k: int) -> np.ndarray:
    sq = (x * x).sum(1)
    out = np.empty((len(x), k), np.int64)
    for at in range(0, len(x), 500):
        d = sq[None, :] - 2 * x[at : at + 500] @ x.T
        d[np.arange(d.shape[0]), np.arange(at, at + d.shape[0])] = np.inf
        out[at : at + 500] = np.argpartition(d, k, axis=1)[:, :k]
    return out


def balanced_parts(x: np.ndarray, parts: int, rounds: int = 30, slack: float = 1.1) -> np.ndarray:
    """A balanced cut of the neighbour graph: halved again and again along the first direction, then each row moves to the part of
    most of its neighbours as long as that part has room."""
    label = np.zeros(len(x), np.int64)
    order = [np.arange(len(x))]
    while len(order) < parts:
        group = order.pop(0)
        y = x[group] - x[group].mean(0)
        v = np.ones(x.shape[1])
        for _ in range(10):
            v = y.T @ (y @ v)
            v /= np.linalg.norm(v) + 1e-12
        rank = np.argsort(y @ v, kind="stable")
        order += [group[rank[: len(rank) // 2]], group[rank[len(rank) // 2 :]]]
    for i, group in enumerate(order):
        label[group] = i
    near = _knn(x, min(NEIGHBOURS, len(x) - 1))
    room = int(slack * len(x) / parts) + 1
    size = np.bincount(label, minlength=parts)
    for _ in range(rounds):
        votes = np.zeros((len(x), parts))
        np.add.at(votes, (np.arange(len(x))[:, None], label[near]), 1)
        gain = votes.max(1) - votes[np.arange(len(x)), label]
        moved = 0
        for i in np.argsort(-gain, kind="stable"):
            if gain[i] <= 0:
                break
            to = int(votes[i].argmax())
            if size[to] < room:
                size[label[i]] -= 1
                size[to] += 1
                label[i] = to
                moved += 1
        if not moved:
            break
    return label


class Router:
    """Softmax classifier over rectified random features and the vector itself, trained by gradient descent."""

    def __init__(self, x: np.ndarray, aim: np.ndarray, steps: int = 200):
        rng = np.random.default_rng(7)
        self.mean, self.scale = x.mean(0), x.std() + 1e-12
        self.hidden = rng.normal(size=(x.shape[1], FEATURES)) / np.sqrt(x.shape[1])
        self.shift = rng.normal(size=FEATURES) * 0.5
        self.w = np.zeros((x.shape[1] + FEATURES + 1, aim.shape[1]))
        f = self._features(x)
        pace, speed = np.zeros_like(self.w), np.zeros_like(self.w)
        for t in range(1, steps + 1):
            g = f.T @ (self._soft(f) - aim) / len(x) + 1e-3 * self.w
            pace, speed = 0.9 * pace + 0.1 * g, 0.999 * speed + 0.001 * g * g
            self.w -= 0.05 * (pace / (1 - 0.9**t)) / (np.sqrt(speed / (1 - 0.999**t)) + 1e-8)

    def _features(self, x):
        z = (x - self.mean) / self.scale
        return np.hstack([z, np.maximum(0, z @ self.hidden + self.shift), np.ones((len(x), 1))])

    def _soft(self, f):
        e = f @ self.w
        e = np.exp(e - e.max(1, keepdims=True))
        return e / e.sum(1, keepdims=True)

    def ranked(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Parts by falling probability for each vector, and the probabilities."""
        p = np.round(self._soft(self._features(x)), 9)
        order = np.argsort(-p, axis=1, kind="stable")
        return order, np.take_along_axis(p, order, 1)


def fit(x: np.ndarray, parts: int, want: float) -> tuple[Router, float]:
    """The router, taught for each vector the parts of its neighbours, and the probability that a query's parts must sum to: the
    least at which vectors that were held out find `want` of their neighbours in the sample."""
    if parts == 1:
        return Router(x, np.ones((len(x), 1)), 1), 1.0
    label = balanced_parts(x, parts)
    near = _knn(x, min(NEIGHBOURS, len(x) - 1))
    held = np.arange(len(x)) % 5 == 0
    aim = (np.eye(parts)[label][near].sum(1) + np.eye(parts)[label]) / (near.shape[1] + 1)
    router = Router(x[~held], aim[~held])
    order, p = router.ranked(x)
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.broadcast_to(np.arange(parts), order.shape), 1)
    at = np.take_along_axis(place[held], order[near[held], 0], 1)  # where in a held query's order each neighbour's part stands
    before = np.cumsum(p[held], 1) - p[held]
    need = np.sort(np.take_along_axis(before, at, 1).ravel())
    return router, float(need[min(len(need) - 1, int(want * len(need)))]) + 1e-6


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(len(column), dim)


def _assigned(router, dim: int):
    def run(batches):
        own = router()
        for batch in batches:
            if len(batch):
                order, _ = own.ranked(_matrix(batch.column("vec"), dim))
                yield batch.append_column("part", pa.array(order[:, 0].astype(np.int32)))

    return run


def _routed(router, dim: int, sizes: np.ndarray, probes: int, mass: float, least: int):
    def run(batches):
        own = router()
        for batch in batches:
            if not len(batch):
                continue
            order, p = own.ranked(_matrix(batch.column("vec"), dim))
            rows, parts = [], []
            for i in range(len(batch)):
                held = np.cumsum(sizes[order[i]])
                # several parts, more while the classifier is unsure, and always enough rows to fill the result
                n = max(probes, int(np.searchsorted(np.cumsum(p[i]), mass)) + 1, int(np.searchsorted(held, least)) + 1)
                n = min(n, order.shape[1])
                rows += [i] * n
                parts += order[i, :n].tolist()
            out = batch.take(pa.array(rows, pa.int64()))
            yield out.append_column("part", pa.array(parts, pa.int32()))

    return run


def _nearest(dim: int, k: int):
    def run(key, members, queries):
        out = [[], [], []]
        if len(members) and len(queries):
            x = _matrix(members.column("vec").combine_chunks(), dim)
            ids = members.column("vec_id").to_numpy()
            qx = _matrix(queries.column("vec").combine_chunks(), dim)
            for q, v in zip(queries.column("vec_id").to_numpy(), qx):
                d = np.sqrt(((x - v) ** 2).sum(1))
                d[ids == q] = np.inf
                if len(d) > k:  # all that reach the k-th distance, so that ties go by id
                    pick = np.flatnonzero(d <= np.partition(d, k - 1)[k - 1])
                else:
                    pick = np.arange(len(d))
                pick = pick[np.isfinite(d[pick])]
                pick = pick[np.lexsort((ids[pick], d[pick]))][:k]
                out[0].append(np.full(len(pick), q))
                out[1].append(ids[pick])
                out[2].append(d[pick])
        cols = [np.concatenate(c) if c else np.zeros(0) for c in out]
        return pa.table({"query_id": pa.array(cols[0].astype(np.int64)), "vec_id": pa.array(cols[1].astype(np.int64)), "score": pa.array(cols[2].astype(np.float64))})

    return run


def valid_vectors(rows: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, vec) of the vectors that take part: with an id, as long as most are, all parts finite and not all zero."""
    vec = F.col(vec_col).cast("array<double>")
    big = F.lit(float("inf"))
    good = rows.select(F.col(id_col).cast("long").alias("vec_id"), vec.alias("vec")).where(F.col("vec_id").isNotNull() & F.col("vec").isNotNull())
    good = good.where(F.forall("vec", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < big), F.lit(False))) & F.exists("vec", lambda x: x != 0))
    dim = good.groupBy(F.size("vec").alias("dim")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dim").first()
    return good.where(F.size("vec") == (dim.dim if dim else 0)), (dim.dim if dim else 0), (dim.n if dim else 0)


def search(rows: DataFrame, k: int = 10, every: int = 100, probes: int = 4, want: float = 0.98, id_col: str = "vec_id", vec_col: str = "embedding", sample: int = SAMPLE) -> DataFrame:
    """query_id, rank, vec_id, score. For each row whose id is divisible by `every`, its k nearest found, by Euclidean distance in
    double precision, nearest first, ties to the smaller id. `want`: recall at which the number of parts is set on held-out rows.

    Rows with the query's own id are not its neighbours. Vectors that are null, zero, of another length than most or with null or
    non-finite parts take no part, nor do null ids. Repeated rows are rows: they may both be found. An id asks once: if its rows
    are repeated, or differ, the smallest of its vectors (by their parts in order) asks. A query gets fewer than k only if there
    are fewer candidates. Other columns are ignored; an empty table gives an empty result.
    """
    spark = rows.sparkSession
    good, dim, n = valid_vectors(rows, id_col, vec_col)
    schema = "query_id long, rank int, vec_id long, score double"
    if not n:
        return spark.createDataFrame([], schema)
    good = good.select("vec_id", "vec")
    parts = int(min(256, max(1, 2 ** round(np.log2(max(1.0, (n**0.5) / 8))))))
    # a threshold on the hash leaves each partition little to send: about four samples in all
    some = good if n <= 4 * sample else good.where(F.pmod(F.xxhash64("vec_id"), F.lit(1 << 40)) < int((1 << 40) * 4 * sample / n))
    fitted = some.orderBy(F.xxhash64("vec_id"), "vec_id", "vec").limit(sample).toArrow()
    x = _matrix(fitted.column("vec").combine_chunks(), dim)
    parts = min(parts, max(1, len(x) // 16))
    fitted, mass = fit(x, parts, want)
    router = share(spark, fitted)
    placed = save(good.mapInArrow(_assigned(router, dim), "vec_id long, vec array<double>, part int"), "placed")
    sizes = np.zeros(parts, np.int64)
    for r in placed.groupBy("part").agg(F.count("*").alias("n")).collect():
        sizes[r.part] = r.n
    asked = good.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("vec").alias("vec")).mapInArrow(_routed(router, dim, sizes, probes, mass, 20 * k), "vec_id long, vec array<double>, part int")
    asked = save(asked, "asked")
    n_asked = np.zeros(parts, np.int64)
    for r in asked.groupBy("part").agg(F.count("*").alias("n")).collect():
        n_asked[r.part] = r.n
    # every block of a part meets every batch of its queries
    blocks = spark.createDataFrame([(i, int(1 + s // BLOCK), int(1 + q // QUERIES)) for i, (s, q) in enumerate(zip(sizes, n_asked))], "part int, blocks int, batches int")
    blocks = F.broadcast(blocks)
    left = placed.join(blocks, "part").withColumn("block", F.pmod(F.xxhash64("vec_id", "vec"), F.col("blocks"))).withColumn("batch", F.explode(F.expr("sequence(0, batches - 1)")))
    right = asked.join(blocks, "part").withColumn("batch", F.pmod(F.xxhash64("vec_id", "vec"), F.col("batches")).cast("int")).withColumn("block", F.explode(F.expr("sequence(0L, cast(blocks - 1 as bigint))")))
    keys = ["part", "block", "batch"]
    found = left.select(*keys, "vec_id", "vec").groupBy(*keys).cogroup(right.select(*keys, "vec_id", "vec").groupBy(*keys)).applyInArrow(_nearest(dim, k), "query_id long, vec_id long, score double")
    best = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", best).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
