"""Approximate nearest neighbours by learned partitions.

On a bounded sample of vectors (``SAMPLE``) the graph of nearest neighbours is cut into balanced partitions, and a
small network learns which partitions a vector's neighbours lie in. It deals every vector of the table to its most
probable partition, and sends a query to the most probable ones, where all vectors are ranked by their exact inner
products. How many it takes is measured: ``CALIBRATION`` vectors are searched in the whole table, and as many partitions
are visited as hold ``RECALL`` of their true neighbours. They are visited in rounds, each ``GROWTH`` times as many as all before, the most probable first:
of a later round only candidates count that reach the worst of the best found so far, so that a query gets about as many rows from each round, however
many partitions it visits. Partitions are split into blocks by hash, so that one that holds much of the table is searched by many
tasks; the best of all blocks are merged by query.

Nulls, ties and other cases: vectors that are null or zero, or hold null or non-finite components, take no part, nor
do vectors of another length than most have; rows without ``vec_id`` take no part; of rows with one ``vec_id`` the
smallest vector counts; equal scores go to the smaller ``vec_id``; with fewer candidates than asked for all that the
probed partitions hold are returned; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import table
from tidemark.sources.staging import staged

SAMPLE = 6000
NEAREST = 20
GRAPH = 12
#: Rows a partition should have, and the range of the number of partitions.
ROWS = 800
PARTITIONS = (4, 256)
#: A query visits as many partitions as find this share of the true neighbours of so many calibration queries.
RECALL, CALIBRATION = 0.95, 200
BLOCK = 4000
#: Partitions visited up to the end of a round, as a multiple of those up to its start.
GROWTH = 4
HIDDEN, EPOCHS = 96, 60


def cut_graph(vectors: np.ndarray, parts: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Neighbours of each vector and a balanced partition that keeps neighbours together."""
    n = len(vectors)
    near = np.empty((n, min(GRAPH, max(n - 1, 1))), np.int64)
    for at in range(0, n, 1000):
        scores = vectors[at : at + 1000] @ vectors.T
        scores[np.arange(len(scores)), np.arange(at, at + len(scores))] = -np.inf
        near[at : at + 1000] = np.argpartition(-scores, near.shape[1] - 1, axis=1)[:, : near.shape[1]]
    rng = np.random.default_rng(seed)
    room = int(np.ceil(1.1 * n / parts))
    centres = vectors[rng.permutation(n)[:parts]]
    for _ in range(8):  # balanced: the surest first, each to the best partition with room
        label = _balanced(vectors @ centres.T, room)
        for part in np.unique(label):
            centre = vectors[label == part].mean(axis=0)
            centres[part] = centre / max(np.linalg.norm(centre), 1e-12)
    for _ in range(12):  # towards where most neighbours are
        votes = np.zeros((n, parts))
        np.add.at(votes, (np.repeat(np.arange(n), near.shape[1]), label[near].ravel()), 1.0)
        np.add.at(votes, (near.ravel(), np.repeat(label, near.shape[1])), 1.0)
        votes[np.arange(n), label] += 0.5
        new = _balanced(votes, room)
        if (new == label).all():
            break
        label = new
    return near, label


def _balanced(gain: np.ndarray, room: int) -> np.ndarray:
    order = np.argsort(-gain, axis=1)
    first = np.take_along_axis(gain, order[:, :2], axis=1)
    sure = first[:, 0] - first[:, -1]
    left = np.full(gain.shape[1], room)
    label = np.empty(len(gain), np.int64)
    for row in np.argsort(-sure, kind="stable"):
        for part in order[row]:
            if left[part]:
                label[row] = part
                left[part] -= 1
                break
    return label


class Router:
    """A network of one hidden layer: vector to probabilities of partitions."""

    def __init__(self, vectors: np.ndarray, target: np.ndarray, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.mean, self.scale = vectors.mean(axis=0), vectors.std() + 1e-12
        x = self._scaled(vectors)
        n, d, p = len(x), x.shape[1], target.shape[1]
        self.w = [rng.normal(0, (2 / d) ** 0.5, (d, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, (1 / HIDDEN) ** 0.5, (HIDDEN, p)), np.zeros(p)]
        m, v, step = [np.zeros_like(w) for w in self.w], [np.zeros_like(w) for w in self.w], 0
        for _ in range(EPOCHS):
            order = rng.permutation(n)
            for at in range(0, n, 128):
                rows = order[at : at + 128]
                hidden = np.maximum(x[rows] @ self.w[0] + self.w[1], 0)
                error = (self._soft(hidden @ self.w[2] + self.w[3]) - target[rows]) / len(rows)
                back = (error @ self.w[2].T) * (hidden > 0)
                grads = [x[rows].T @ back, back.sum(axis=0), hidden.T @ error, error.sum(axis=0)]
                step += 1
                for k, g in enumerate(grads):
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.999 * v[k] + 0.001 * g * g
                    self.w[k] = self.w[k] - 0.003 * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)

    def _scaled(self, vectors: np.ndarray) -> np.ndarray:
        return (vectors - self.mean) / self.scale

    @staticmethod
    def _soft(x: np.ndarray) -> np.ndarray:
        e = np.exp(x - x.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)

    def probabilities(self, vectors: np.ndarray) -> np.ndarray:
        return self._soft(np.maximum(self._scaled(vectors) @ self.w[0] + self.w[1], 0) @ self.w[2] + self.w[3])


def usable(embeddings: DataFrame) -> DataFrame:
    """vec_id and vector (doubles) of all rows that take part."""
    vector = F.col("embedding").cast("array<double>")
    rows = embeddings.select(F.col("vec_id").cast("bigint").alias("vec_id"), vector.alias("vector"))
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where("vec_id is not null and vector is not null").where(~bad)
    rows = rows.where(F.exists("vector", lambda x: x != 0))
    rows = rows.groupBy("vec_id").agg(F.min("vector").alias("vector"))
    return staged(rows.withColumn("length", F.size("vector")), "ann-vectors")


def fit(vectors: DataFrame, total: int) -> Router:
    share = F.pmod(F.xxhash64("vec_id", F.lit("ann")), F.lit(1 << 30)) < F.lit(int((SAMPLE << 30) / max(1, total)))
    sample = vectors.where(share).select("vec_id", "vector").toPandas().sort_values("vec_id")  # bounded by SAMPLE
    if len(sample) == 0:
        sample = vectors.select("vec_id", "vector").orderBy("vec_id").limit(1).toPandas()
    known = np.stack(sample["vector"].to_numpy())
    parts = int(min(max(PARTITIONS[0], round(total / ROWS)), PARTITIONS[1], max(1, len(known) // 8)))
    near, label = cut_graph(known, parts)
    target = np.zeros((len(known), parts))
    np.add.at(target, (np.repeat(np.arange(len(known)), near.shape[1]), label[near].ravel()), 1 / near.shape[1])
    target[np.arange(len(known)), label] += 1
    return Router(known, target / target.sum(axis=1, keepdims=True))


def calibrate(index: DataFrame, router, k: int) -> int:
    """Partitions to visit, by the true neighbours of a bounded number of vectors among all rows."""
    asked = index.select("vec_id", "vector").orderBy(F.xxhash64("vec_id", F.lit("calibration")), "vec_id").limit(CALIBRATION)
    asked = asked.toPandas()
    ids, known = asked["vec_id"].to_numpy(), np.stack(asked["vector"].to_numpy())

    def nearest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            scores = known @ np.stack(batch["vector"].to_numpy()).T
            scores[ids[:, None] == batch["vec_id"].to_numpy()[None, :]] = -np.inf
            best = np.argsort(-scores, axis=1, kind="stable")[:, :k]
            query = np.repeat(np.arange(len(ids)), best.shape[1])
            value = np.take_along_axis(scores, best, axis=1).ravel()
            part = batch["part"].to_numpy()[best.ravel()]
            yield pd.DataFrame({"query": query, "score": value, "part": part})[value > -np.inf]

    found = index.mapInPandas(nearest, "query int, score double, part int")
    first = Window.partitionBy("query").orderBy(F.desc("score"), "part")
    found = found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k).toPandas()
    p = router.value.probabilities(known)
    place = np.argsort(np.argsort(-p, axis=1, kind="stable"), axis=1)[found["query"], found["part"]]
    if not len(place):
        return 1
    return int(np.quantile(place, RECALL, method="higher")) + 1


def ranked(candidates: pd.DataFrame, queries: pd.DataFrame, k: int) -> pd.DataFrame:
    """query_id, vec_id and score of the best ``k`` candidates of each query among those that reach its ``bound``."""
    out = []
    if len(candidates) and len(queries):
        ids = candidates["vec_id"].to_numpy()
        order = np.argsort(ids)
        ids, known = ids[order], np.stack(candidates["vector"].to_numpy())[order]
        for at in range(0, len(queries), 256):
            some = queries.iloc[at : at + 256]
            wanted = np.stack(some["vector"].to_numpy())
            scores = wanted @ known.T
            for query, bound, row in zip(some["vec_id"], some["bound"], scores):
                row[ids == query] = -np.inf
                high = np.flatnonzero((row >= bound) & (row > -np.inf))
                best = high[np.argsort(-row[high], kind="stable")[:k]]  # ids ascend, so ties go to the smaller
                out += [(query, ids[i], row[i]) for i in best]
    return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])


def search(embeddings: DataFrame, queries: DataFrame, k: int = NEAREST) -> DataFrame:
    """query_id, rank, vec_id and score: the nearest of ``embeddings`` found for each row of ``queries``."""
    spark = embeddings.sparkSession
    vectors = usable(embeddings)
    lengths = vectors.groupBy("length").agg(F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("first"))
    top = lengths.orderBy(F.desc("n"), "length").first()
    schema = "query_id bigint, rank int, vec_id bigint, score double"
    if top is None:
        return spark.createDataFrame([], schema)
    vectors, total = vectors.where(F.col("length") == top["length"]), top["n"]
    router = spark.sparkContext.broadcast(fit(vectors, total))

    def deal(probes: int):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                if not len(batch):
                    continue
                p = router.value.probabilities(np.stack(batch["vector"].to_numpy()))
                parts = np.argsort(-p, axis=1, kind="stable")[:, :probes]
                out = batch.loc[batch.index.repeat(parts.shape[1])].reset_index(drop=True)
                place = np.tile(np.arange(parts.shape[1], dtype=np.int32), len(batch))
                yield out.assign(part=parts.ravel().astype(np.int32), place=place)

        return run

    form = "vec_id bigint, vector array<double>, part int, place int"
    own = staged(vectors.select("vec_id", "vector").mapInPandas(deal(1), form), "ann-index")
    asked = vectors.join(queries.select(F.col("vec_id").cast("bigint").alias("vec_id")).distinct(), "vec_id", "left_semi")
    probes = calibrate(own, router, k)
    asked = staged(asked.select("vec_id", "vector").mapInPandas(deal(probes), form), "ann-queries")
    # Blocks by partition: at most as many rows as there are partitions.
    blocks = own.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    all_of = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))

    def rank(candidates: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        return ranked(candidates, queries, k)

    keys = ["part", "block", "turn"]
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    found, start, end = spark.createDataFrame([], schema), 0, 1
    while start < probes:
        some = asked.where(F.col("place").between(start, end - 1))
        turns = some.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("turns"))
        plan = F.broadcast(blocks.join(turns, "part"))
        # The worst of a query's best, once it has as many as asked for.
        bounds = found.where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").alias("bound"))
        some = some.join(bounds, "vec_id", "left").withColumn("bound", F.coalesce("bound", F.lit(float("-inf"))))
        left = own.join(plan, "part").select(
            "part", F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int").alias("block"), all_of("turns").alias("turn"), "vec_id", "vector"
        )
        right = some.join(plan, "part").select(
            "part", all_of("blocks").alias("block"), F.pmod(F.xxhash64("vec_id"), F.col("turns")).cast("int").alias("turn"), "vec_id", "vector", "bound"
        )
        new = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(rank, "query_id bigint, vec_id bigint, score double")
        new = new.unionByName(found.select("query_id", "vec_id", "score"))
        found = staged(new.withColumn("rank", F.row_number().over(best).cast("int")).where(F.col("rank") <= k), "ann-found")
        start, end = end, end * GROWTH
    return found.select("query_id", "rank", "vec_id", "score")


def op6_learned_partitions(spark, sf_dir) -> DataFrame:
    embeddings = table(spark, sf_dir, "embeddings")
    return search(embeddings, embeddings.where(F.col("vec_id") % 20 == 0))
