"""Hard negatives by rotated one-bit codes with deterministic intervals.

A vector is turned by one fixed rotation and coded in layers: the signs of what is left of it, the alignment of it with that
code (their inner product), and the length of what then remains. The inner product with another vector is the sum over
layers of alignment times that vector's projection on the code, and the remainder, which Cauchy and Schwarz bound by the
remaining length times the part of the other vector outside the code. The projection comes from popcounts of the code with
the bit planes of the anchor, whose rounding is bounded in the same way. So every row has an interval that holds its
score for certain.

Rows in shards of bounded size meet anchors in blocks, each pair of shard and block in a task. Layer by layer, rows whose
interval ends below the k-th best lower bound, or misses all of an anchor's windows, drop out; survivors are
scored in whole numbers. What remains of a task is ``k`` rows for each search.

Nulls, ties and other cases: rows with a null id, label or vector, an empty vector, or a null or non-finite component take no
part; of rows of one id the one of the smallest label and vector counts, so that repeated rows count once; vectors of
different lengths never meet; ties go to the smaller id; an anchor without positives, a positive with a score below zero and
an empty table give no rows; scores beyond 64 bits raise an error; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import by_value, table
from tidemark.operators import keys as K
from tidemark.sources.staging import staged

by_value(__name__)

LABELS = 10
RELABELLED, ANCHORED = 7, 100
POSITIVES, NEGATIVES = 5, 10
#: Per cent of the positive's score that a negative's lies within.
WINDOW = (30, 90)
SCALE = 256
LAYERS = 4
#: Bits to which a component of an anchor is rounded for the popcounts.
PLANES = 8
#: Bytes of vectors in a shard, and anchors in a block.
SHARD_BYTES, BLOCK = 16 << 20, 128
#: Floating point errors stay far below this part of the lengths' product.
SLACK = 1e-9

_ROWS = "vec_id bigint, label bigint, dim int, vector array<double>, code binary, align array<double>, rest array<double>"
_KEYS = ["dim", "shard", "block"]


def rotation(dim: int) -> np.ndarray:
    """The same orthogonal matrix wherever it is made."""
    q, r = np.linalg.qr(np.random.default_rng(dim).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def _packed(signs: np.ndarray) -> np.ndarray:
    """Rows of booleans as rows of 64-bit words."""
    bits = np.packbits(signs, axis=1, bitorder="little")
    wide = np.zeros((len(bits), -(-bits.shape[1] // 8) * 8), np.uint8)
    wide[:, : bits.shape[1]] = bits
    return wide.view("<u8")


class Codes(NamedTuple):
    """Of many rows, by layer: code words, alignments, remaining lengths."""

    words: np.ndarray
    align: np.ndarray
    rest: np.ndarray


def encode(vectors: np.ndarray) -> Codes:
    n, dim = vectors.shape
    left, words, align, rest = vectors @ rotation(dim).T, [], [], []
    for _ in range(LAYERS):
        up = left >= 0
        along = np.abs(left).sum(axis=1) / math.sqrt(dim)
        left = left - np.where(up, 1.0, -1.0) * (along / math.sqrt(dim))[:, None]
        words.append(_packed(up))
        align.append(along)
        rest.append(np.sqrt((left * left).sum(axis=1)))
    return Codes(np.stack(words, 1), np.stack(align, 1), np.stack(rest, 1))


class Anchor:
    """A vector rounded to bit planes, for projections on codes by popcounts."""

    def __init__(self, vector: np.ndarray, turned: np.ndarray):
        self.vector, self.dim = vector, len(vector)
        self.low, high = turned.min(), turned.max()
        self.step = (high - self.low) / (2**PLANES - 1) or 1.0
        steps = np.rint((turned - self.low) / self.step).astype(np.int64)
        rounded = self.low + self.step * steps
        self.planes = _packed((steps[None, :] >> np.arange(PLANES)[:, None]) & 1 > 0)
        self.total = rounded.sum()
        self.off = math.sqrt(((turned - rounded) ** 2).sum())
        self.square = float((turned * turned).sum())

    def projections(self, words: np.ndarray) -> np.ndarray:
        """About the inner products with codes of unit length, each off by ``self.off`` at most."""
        ones = np.bitwise_count(words).sum(axis=1, dtype=np.int64)
        steps = np.zeros(len(words), np.int64)
        for b, plane in enumerate(self.planes):
            steps += np.bitwise_count(words & plane).sum(axis=1, dtype=np.int64) << b
        return (2 * (self.low * ones + self.step * steps) - self.total) / math.sqrt(self.dim)


class Narrowing:
    """Intervals of the scores of an anchor with rows of a shard that shrink layer by layer."""

    def __init__(self, anchor: Anchor, codes: Codes, rows: np.ndarray):
        self.anchor, self.codes, self.rows = anchor, codes, rows
        self.middle, self.drift = np.zeros(len(rows)), np.zeros(len(rows))
        self.slack = SLACK * math.sqrt(anchor.square) * (codes.align[rows, 0] + codes.rest[rows, 0]) + 1e-6

    def layer(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        a, at = self.anchor, self.rows
        along, align = a.projections(self.codes.words[at, k]), self.codes.align[at, k]
        self.middle = self.middle + align * along
        self.drift = self.drift + align * a.off
        outside = np.sqrt(np.maximum(0, a.square - np.maximum(0, np.abs(along) - a.off) ** 2))
        wide = self.drift + outside * self.codes.rest[at, k] + self.slack
        return self.middle - wide, self.middle + wide

    def keep(self, which: np.ndarray) -> None:
        self.rows, self.middle, self.drift, self.slack = (x[which] for x in (self.rows, self.middle, self.drift, self.slack))


def _kth(values: np.ndarray, k: int) -> float:
    return np.partition(values, len(values) - k)[len(values) - k] if len(values) >= k else -math.inf


def whole_scores(vectors: np.ndarray, vector: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers held in doubles."""
    most = np.abs(vectors).max(initial=0) * np.abs(vector).max(initial=0) * len(vector)
    if most < 2**53:
        return (vectors @ vector).astype(np.int64)
    other = [int(x) for x in vector]
    return np.array([sum(int(x) * y for x, y in zip(row, other)) for row in vectors], np.int64)


class Shard:
    def __init__(self, rows: pd.DataFrame):
        self.ids, self.labels = rows["vec_id"].to_numpy(), rows["label"].to_numpy()
        self.vectors = np.stack(rows["vector"].to_numpy()).astype(np.float64)
        words = np.stack([np.frombuffer(x, "<u8") for x in rows["code"]]).reshape(len(rows), LAYERS, -1)
        self.codes = Codes(words, np.stack(rows["align"].to_numpy()), np.stack(rows["rest"].to_numpy()))

    def nearest(self, anchor: Anchor, own: int, label: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The best ``k`` other rows of the same label and their scores."""
        some = Narrowing(anchor, self.codes, np.flatnonzero((self.labels == label) & (self.ids != own)))
        for layer in range(LAYERS):
            low, high = some.layer(layer)
            some.keep(high >= _kth(low, k))
        scores = whole_scores(self.vectors[some.rows], anchor.vector)
        best = np.lexsort((self.ids[some.rows], -scores))[:k]
        return self.ids[some.rows][best], scores[best]

    def within(self, anchor: Anchor, label: int, windows: list[tuple[int, int]], k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each window of scores (both ends belong to it) its best ``k`` rows of other labels."""
        some = Narrowing(anchor, self.codes, np.flatnonzero(self.labels != label))
        for layer in range(LAYERS):
            low, high = some.layer(layer)
            any_window = np.zeros(len(low), bool)
            for least, most in windows:
                sure = _kth(low[(low >= least) & (high <= most)], k)
                any_window |= (high >= max(least, sure)) & (low <= most)
            some.keep(any_window)
        ids, scores, found = self.ids[some.rows], whole_scores(self.vectors[some.rows], anchor.vector), []
        for least, most in windows:
            inside = np.flatnonzero((scores >= least) & (scores <= most))
            best = inside[np.lexsort((ids[inside], -scores[inside]))[:k]]
            found.append((ids[best], scores[best]))
        return found


def window(score: int) -> tuple[int, int]:
    """The whole numbers ``x`` with ``WINDOW[0] * score <= 100 * x <= WINDOW[1] * score``."""
    return -(-WINDOW[0] * score // 100), WINDOW[1] * score // 100


def whole_vectors(embeddings: DataFrame) -> DataFrame:
    """vec_id, label, vector (whole numbers) of the rows that take part."""
    sound = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = embeddings.where("vec_id is not null and label is not null and embedding is not null").where((F.size("embedding") > 0) & sound)
    one = rows.groupBy(F.col("vec_id").cast("bigint").alias("vec_id")).agg(F.min(F.struct("label", "embedding")).alias("row"))
    label = F.when(F.col("vec_id") % RELABELLED == 0, (F.col("row.label").cast("bigint") + 1) % LABELS).otherwise(F.col("row.label"))
    # Floored below, in doubles, as 64 bits may be too few here.
    scaled = F.transform("row.embedding", lambda x: x.cast("double") * SCALE)
    return one.select("vec_id", label.cast("bigint").alias("label"), scaled.alias("vector"))


def coded(vectors: DataFrame) -> DataFrame:
    """The rows with their codes."""

    def code(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sizes = batch["vector"].map(len).to_numpy()
            for dim in np.unique(sizes):
                part = batch[sizes == dim]
                vectors = np.floor(np.stack(part["vector"].to_numpy()).astype(np.float64))
                codes = encode(vectors)
                yield pd.DataFrame(
                    {
                        "vec_id": part["vec_id"].to_numpy(), "label": part["label"].to_numpy(), "dim": np.int32(dim),
                        "vector": list(vectors), "code": [x.tobytes() for x in codes.words.reshape(len(part), -1)],
                        "align": list(codes.align), "rest": list(codes.rest),
                    }
                )

    return vectors.mapInPandas(code, _ROWS)


def _meet(rows: DataFrame, anchors: DataFrame, shards: int, blocks: int, work, schema: str) -> DataFrame:
    """``work(shard, anchors)`` for every shard of rows and block of anchors."""
    number = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int")).withColumn("block", number(blocks))
    asked = anchors.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")).withColumn("shard", number(shards))

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = list(work(Shard(left), right)) if len(left) and len(right) else []
        return pd.DataFrame(found, columns=[f.split()[0] for f in schema.split(", ")])

    return dealt.groupBy(*_KEYS).cogroup(asked.groupBy(*_KEYS)).applyInPandas(run, schema)


def _anchors(frame: pd.DataFrame) -> Iterator[tuple]:
    turn = rotation(len(frame["vector"].iloc[0]))
    for row in frame.itertuples(index=False):
        vector = np.asarray(row.vector, np.float64)
        yield row, Anchor(vector, turn @ vector)


def hard_negatives(embeddings: DataFrame, anchored: int = ANCHORED, positives: int = POSITIVES, negatives: int = NEGATIVES) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    rows = staged(coded(whole_vectors(embeddings)), "codes")
    n, dim = rows.agg(F.count(F.lit(1)), F.max("dim")).first()
    anchors = staged(rows.where(F.col("vec_id") % anchored == 0).select("vec_id", "label", "dim", "vector"), "anchors")
    shards = max(1, -(-n * (8 * (dim or 0) + 256) // SHARD_BYTES))
    blocks = max(1, -(-anchors.count() // BLOCK))

    def nearest(shard: Shard, asked: pd.DataFrame) -> Iterator[tuple]:
        for row, anchor in _anchors(asked):
            ids, scores = shard.nearest(anchor, row.vec_id, row.label, positives)
            yield from ((row.vec_id, i, s) for i, s in zip(ids.tolist(), scores.tolist()))

    near = _meet(rows, anchors, shards, blocks, nearest, "anchor_id bigint, positive_id bigint, positive_score bigint")
    near = staged(K.first_per_key(near, ["anchor_id"], [F.col("positive_score").desc(), F.col("positive_id")], positives), "positives")
    listed = near.groupBy(F.col("anchor_id").alias("vec_id")).agg(
        F.collect_list("positive_id").alias("positive_ids"), F.collect_list("positive_score").alias("positive_scores")
    )

    def within(shard: Shard, asked: pd.DataFrame) -> Iterator[tuple]:
        for row, anchor in _anchors(asked):
            of = [(int(p), int(s)) for p, s in zip(row.positive_ids, row.positive_scores) if s >= 0]
            for (p, s), (ids, scores) in zip(of, shard.within(anchor, row.label, [window(s) for _, s in of], negatives)):
                yield from ((row.vec_id, p, s, i, x) for i, x in zip(ids.tolist(), scores.tolist()))

    schema = "anchor_id bigint, positive_id bigint, positive_score bigint, negative_id bigint, negative_score bigint"
    asked = staged(anchors.join(listed, "vec_id"), "asked")
    found = _meet(rows, asked, shards, blocks, within, schema)
    rank = F.row_number().over(W.partitionBy("anchor_id", "positive_id").orderBy(F.col("negative_score").desc(), "negative_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= negatives).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )


def op12_hard_negatives(spark, sf_dir) -> DataFrame:
    return hard_negatives(table(spark, sf_dir, "embeddings"))


ORACLE_SQL = """
WITH vectors AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS alike, list_inner_product(a.v, b.v)::BIGINT AS score
  FROM vectors AS a JOIN vectors AS b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), positives AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM scored WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5
)
SELECT anchor_id, positive_id,
  row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other)::INTEGER AS rank,
  other AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT alike AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""
