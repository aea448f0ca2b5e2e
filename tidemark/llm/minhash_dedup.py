"""MinHash near-duplicates with tensored banding.

A document's set is its distinct word n-grams, as 64-bit hashes; equal sets are one node. Two small collections of
``HALVES`` half keys, each of ``WIDTH`` minhashes, are computed for a node. A table's key is one half key of the first collection
and one of the second, so that ``2 * HALVES * WIDTH`` minhashes make ``HALVES ** 2`` tables with keys of ``2 * WIDTH``. Sets
of a Jaccard coefficient of 0.85 miss all 64 tables with a probability of 0.00007, those of 0.9 with 0.000004.

1. *Half keys first.* A half key that one node alone has makes no pair; nodes left without one of either
   collection go before any table key is formed. Most documents have no near copy and go here.
2. *Tables.* The rest form their keys. Each bucket is a star around its smallest node, however many nodes share it.
3. *Verify.* Pairs are verified on whole sets, after sizes and parity maps have ruled out what can't link: first each
   node with the star of its largest bucket, then with the stars of buckets that still hold several classes. Buckets whose nodes are in one
   class are settled.
4. *Rest.* A large bucket of several classes would have as many pairs as the square of its nodes. The nodes of all buckets that are not settled
   are therefore indexed once more, by the prefixes of ``ngram_join``: two sets that link share an entry there, so that pairs without one need no look.
   Of an entry's members those outside the largest class meet some members of other classes, then more, at last all, so that every
   pair of a bucket that can link has been verified or is in one class.

Nulls, ties and other cases: null and empty texts, and texts without a word, have empty sets and no links; a row without
``doc_id`` takes part like any other but gives no name to its class, and a class without any id has null and keeps all its
rows; equal rows have equal results; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import by_value, slices, strings, table
from tidemark.llm.ngram_join import _asked, _connected, _mixed, _node, _parity, _sized, _texts, _verified, indexed, settled, sets, shared_entries
from tidemark.sources.staging import staged

by_value(__name__)
by_value(sets.__module__)

WORDS = 5
PERCENT = 85
HALVES = 8
WIDTH = 2

_RANDOM = np.random.default_rng(11).integers(0, 1 << 63, (2, 2 * HALVES * WIDTH), np.uint64)
_TIMES, _PLUS = _RANDOM[0] | np.uint64(1), _RANDOM[1]
_ODD = np.uint64(0x9E3779B97F4A7C15)


def half_keys(own: list[np.ndarray]) -> np.ndarray:
    """The half keys of sets that are not empty, a row of ``2 * HALVES`` for each; the last half of them belongs to the
    second collection."""
    flat = np.concatenate(own)
    begin = np.cumsum([0, *(len(g) for g in own[:-1])])
    keys = np.empty((len(own), 2 * HALVES), np.uint64)
    for k in range(2 * HALVES):
        key = np.full(len(own), k + 1, np.uint64)
        for j in range(k * WIDTH, (k + 1) * WIDTH):
            mixed = flat * _TIMES[j] + _PLUS[j]
            mixed ^= mixed >> np.uint64(32)
            mixed *= _ODD
            key = _mixed(key * _ODD + np.minimum.reduceat(mixed, begin))
        keys[:, k] = key
    return keys


def sketches(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id, n, node, bits (parity map) and halves of every row; a set without members has no node."""

    def sketch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in slices(batches, 4 << 20):
            own = sets(batch["text"].tolist(), words)
            full = [i for i, g in enumerate(own) if len(g)]
            keys = dict(zip(full, half_keys([own[i] for i in full]).view(np.int64))) if full else {}
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"].astype("Int64"),
                    "n": np.array([len(g) for g in own], np.int64),
                    "node": pd.array([_node(g) if len(g) else None for g in own], "Int64"),
                    "bits": strings([_parity(g) if len(g) else None for g in own]),
                    "halves": strings([keys.get(i) for i in range(len(own))]),
                }
            )

    return docs.mapInPandas(sketch, "doc_id bigint, n bigint, node bigint, bits array<bigint>, halves array<bigint>")


def buckets(named: DataFrame) -> DataFrame:
    """entry, node, n, star, size: members of the tables' buckets of two nodes or more, and of each bucket the smallest node and
    the number of nodes."""
    slots = named.select("node", "n", F.posexplode("halves").alias("slot", "half"))
    shared = slots.groupBy("half").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low < high").select("half")
    first = F.col("slot") < HALVES
    # At most ``HALVES`` of either collection.
    alive = slots.join(shared, "half").groupBy("node").agg(
        F.first("n").alias("n"), F.collect_list(F.when(first, F.col("half"))).alias("left"), F.collect_list(F.when(~first, F.col("half"))).alias("right")
    )
    keys = alive.select("node", "n", F.explode("left").alias("a"), "right").select("node", "n", "a", F.explode("right").alias("b"))
    keys = staged(keys.select(F.xxhash64("a", "b").alias("entry"), "node", "n"), "keys")
    stars = keys.groupBy("entry").agg(F.min("node").alias("star"), F.max("node").alias("last"), F.count(F.lit(1)).alias("size"))
    return keys.join(stars.where("star < last").drop("last"), "entry").select("entry", "node", "n", "star", "size")


def _placed(members: DataFrame, labels: DataFrame) -> DataFrame:
    return members.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))


def _several(placed: DataFrame) -> DataFrame:
    """The buckets that hold several classes."""
    return placed.groupBy("entry").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high").select("entry")


def minhash_classes(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles and component_id for every row of ``docs``."""
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    rows = staged(sketches(docs, words), "sketches")
    named = staged(
        rows.where("node is not null").groupBy("node").agg(
            F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("bits").alias("bits"), F.first("halves").alias("halves")
        ), "nodes",
    )
    left = staged(buckets(named), "buckets")
    # First each node meets the star of its largest bucket, then the stars of buckets that still hold several classes.
    largest = left.groupBy("node").agg(F.max(F.struct("size", "entry", "star"))["star"].alias("star")).where("star < node")
    checked = staged(_sized(largest.select(F.col("star").alias("a"), F.col("node").alias("b")), named, percent), "pairs")
    links = _verified(checked, named, docs, words, percent)
    labels = _connected(links)
    placed = staged(_placed(left, labels), "placed")
    left = staged(placed.join(_several(placed), "entry").select("entry", "node", "n", "star", "label"), "mixed")
    stars = left.where("star = node").select("entry", F.col("label").alias("own"))
    star = left.join(stars, "entry").where("label != own").select(F.col("star").alias("a"), F.col("node").alias("b")).distinct()
    fresh = staged(_sized(star, named, percent).join(checked, ["a", "b"], "left_anti"), "pairs")
    if not fresh.isEmpty():
        found = _verified(fresh, named, docs, words, percent)
        checked, links = checked.unionByName(fresh), links.unionByName(found)
        labels = _connected(links)
    placed = staged(_placed(left.drop("label"), labels), "placed")
    again = staged(_asked(placed.join(_several(placed), "entry").select("node").distinct(), named), "again")
    if not again.isEmpty():
        # A null id and one that stands twice may bring other texts along, whose nodes are left out again.
        texts = _texts(again, docs)
        members = shared_entries(indexed(texts.withColumnRenamed("want", "doc_id"), words, percent).where("doc_id = node"))
        placed = _placed(members, labels).join(_placed(members.select(F.col("star").alias("node")).distinct(), labels).select(F.col("node").alias("star"), F.col("label").alias("own")), "star")
        star = placed.where("label != own").select(F.col("star").alias("a"), F.col("node").alias("b")).distinct()
        fresh = staged(_sized(star, named, percent).join(checked, ["a", "b"], "left_anti"), "pairs")
        if not fresh.isEmpty():
            found = _verified(fresh, named, docs, words, percent)
            checked, links = checked.unionByName(fresh), links.unionByName(found)
            labels = _connected(links)
        labels, links = settled(members, labels, links, checked, named, docs, words, percent)
    placed = named.join(labels, "node", "left").select("node", "doc_id", F.coalesce("label", "node").alias("label"))
    least = placed.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    names = placed.join(least, "label").select("node", "component_id")
    result = rows.select("doc_id", F.col("n").alias("n_shingles"), "node")
    own = result.where("node is not null").join(names, "node").select("doc_id", "n_shingles", "component_id")
    alone = result.where("node is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return own.unionByName(alone)


def op11_minhash_tensor(spark, sf_dir) -> DataFrame:
    found = minhash_classes(table(spark, sf_dir, "documents"))
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


ORACLE_SQL = r"""
WITH RECURSIVE split AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_sort(list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))) END AS g
  FROM split
), nodes AS (
  SELECT g, min(doc_id) AS node, len(g) AS n FROM sets WHERE len(g) > 0 GROUP BY g
), grams AS (
  SELECT node, n, unnest(g) AS gram FROM nodes
), links AS (
  SELECT x.node AS a, y.node AS b FROM grams AS x JOIN grams AS y ON x.gram = y.gram AND x.node < y.node
  GROUP BY x.node, x.n, y.node, y.n HAVING 100 * count(*) >= 85 * (x.n + y.n - count(*))
), both_ways AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach(node, other) AS (
  SELECT node, node FROM nodes UNION SELECT r.node, e.b FROM reach AS r JOIN both_ways AS e ON r.other = e.a
), least AS (
  SELECT node, min(other) AS component_id FROM reach GROUP BY node
), named AS (
  SELECT s.doc_id, len(s.g) AS n_shingles, coalesce(l.component_id, s.doc_id) AS component_id
  FROM sets AS s LEFT JOIN nodes ON nodes.g = s.g LEFT JOIN least AS l ON l.node = nodes.node
)
SELECT doc_id, n_shingles, component_id, doc_id = component_id AS kept FROM named
"""
