"""N-gram Jaccard join with token-combination prefixes.

A document's set is its distinct word n-grams, as 64-bit hashes. Documents link when the Jaccard coefficient of
their sets is at least ``percent`` / 100. Equal sets are one node; links between nodes, and from them the classes of
linked documents, are found without pairing up the members of large groups:

1. *Counts.* All n-grams of all documents are counted in a table of fixed size (``CELLS``). N-grams whose cell is far
   above the mean are of the frequent class. Any assignment of classes gives the same links; good ones give short work.
2. *Prefixes.* Every set is ordered alike, rare n-grams first. Two sets that link share an n-gram in their prefixes
   of ``n - ceil(n * percent / 100) + 1``. Rare ones are indexed singly. Where a prefix reaches into the frequent
   class it is extended by G, so that linking sets share more than G there: either a rare one, or more than G frequent
   ones, of which two fall into one of G groups. So of frequent n-grams pairs within a group are indexed.
3. *Verify.* Of each bucket the pairs with one node (a star) are verified on whole sets. Buckets whose nodes are then
   in one class are settled; of others the members outside the largest class meet some members of other classes, those
   still outside then more, and at last all, so that every pair has been verified or is in one class. Most pairs that don't link are ruled out by sizes
   and parity maps before sets are read. No link between different texts is lost, and a group of copies costs as much
   as its rows.

Nulls, ties and other cases: null and empty texts, and texts without a word, have empty sets and no links; a row
without ``doc_id`` takes part like any other but gives no name to its class, and a class without any id has null;
equal rows have equal results; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import lean, slices, strings, table
from tidemark.sources.staging import drop, staged

WORDS = 4
PERCENT = 85
CELLS = 1 << 22
CHUNK = 1 << 15
SHIFT = np.uint64(64 - 22)
#: Characters of text worked on at once: its words and n-grams take some twenty times as much memory.
SLICE = 1 << 20
#: So many others, about, does a node outside its bucket's largest class meet in each round before the last.
AT_A_TIME = (8, 64)
#: Bits of the parity map that bounds from below how many members two sets don't share.
PARITY = 1024
#: N-grams, about, and sets of a class that are compared with those of another block, or their own, in one go.
BLOCK, BLOCK_SETS = 1 << 17, 1 << 10
#: Of so many n-grams at a time is counted which sets hold them.
COLUMNS = 1 << 12
#: A set of ids is broadcast up to this many rows of 16 bytes, beyond it the join is shuffled.
BROADCAST_ROWS = 500_000

_B = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _B[3]
    return x ^ (x >> np.uint64(29))


def sets(texts: list[str | None], words: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct n-gram hashes (unsigned 64-bit) of each text."""
    split = [t.encode().lower().split() if t else [] for t in texts]
    counts = [len(s) for s in split]
    known: dict[bytes, int] = {}
    flat = np.fromiter(
        (known.get(w) or known.setdefault(w, xxhash.xxh3_64_intdigest(w)) for s in split for w in s), np.uint64
    )
    windows = np.zeros(max(0, len(flat) - words + 1), np.uint64)
    for k in range(words):
        windows = _mixed(windows * _B[0] + flat[k : k + len(windows)] + _B[1])
    out, at = [], 0
    for n in counts:
        if n >= words:
            out.append(np.unique(windows[at : at + n - words + 1]))
        elif n:
            value = np.full(1, n, np.uint64)
            for k in range(n):
                value = _mixed(value * _B[2] + flat[at + k : at + k + 1] + _B[1])
            out.append(value)
        else:
            out.append(np.empty(0, np.uint64))
        at += n
    return out


def needed(n: int, percent: int = PERCENT) -> int:
    """Least number of common members of a set of ``n`` with any set that it links to."""
    return -(-n * percent // 100)


def _groups(size_class: int, percent: int) -> int:
    return max(1, (2**size_class * (100 - percent)) // 300)


def signatures(grams: np.ndarray, classes: np.ndarray, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """The index entries of one set, n-grams of the rare class and pairs of the frequent one, and how many members it
    can share at most with a set whose first common n-gram is the entry's or that shares frequent ones only."""
    n = len(grams)
    prefix = n - needed(n, percent) + 1
    level = classes[(grams >> SHIFT).astype(np.int64)]
    order = np.lexsort((grams, level))
    grams, level = grams[order], level[order]
    if level[prefix - 1] == 0:
        return grams[:prefix], n - np.arange(prefix)
    rare = int((level == 0).sum())
    found, most = [grams[:rare]], [n - np.arange(rare)]
    # Frequent ones alone suffice for a link only if there are enough of them.
    for size_class in range(int(n).bit_length() - 1, int(n * 100 // percent).bit_length()) if n - rare >= needed(n, percent) else ():
        groups = _groups(size_class, percent)
        often = grams[rare : prefix + groups]
        own = (_mixed(often) % np.uint64(groups)).astype(np.int64)
        for group in np.unique(own):
            members = often[own == group]
            a, b = np.triu_indices(len(members), 1)
            low, high = np.minimum(members[a], members[b]), np.maximum(members[a], members[b])
            found.append(np.unique(_mixed(low * _B[0] + _mixed(high + np.uint64(size_class + 1)))))
            most.append(np.full(len(found[-1]), n - rare))
    return np.concatenate(found), np.concatenate(most)


def gram_classes(docs: DataFrame, words: int = WORDS) -> np.ndarray:
    """Class by table cell: 0 rare, else how many doublings above the limit. Counts all n-grams of all texts; the table
    has a fixed size whatever the input's."""

    @lean
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cells = np.zeros(CELLS, "<i4")
        for batch in slices(batches, SLICE):
            for grams in sets(batch["text"].tolist(), words):
                np.add.at(cells, (grams >> SHIFT).astype(np.int64), 1)
        # Row by row: the table in one frame would lie in the worker and the executor several times over.
        for k, chunk in enumerate(cells.reshape(-1, CHUNK)):
            yield pd.DataFrame({"chunk": [k], "cells": [chunk.tobytes()]})

    def add(key: tuple, frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(CHUNK, np.int64)
        for frame in frames:
            for cells in frame["cells"]:
                total += np.frombuffer(cells, "<i4")
        yield pd.DataFrame({"chunk": [key[0]], "cells": [total.astype("<i8").tobytes()]})

    parts = docs.select("text").mapInPandas(count, "chunk int, cells binary")
    sums = parts.groupBy("chunk").applyInPandas(add, "chunk int, cells binary").collect()
    cells = np.zeros((CELLS // CHUNK, CHUNK), np.int64)
    for row in sums:
        cells[row["chunk"]] = np.frombuffer(row["cells"], "<i8")
    cells = cells.ravel()
    limit = 8 + 2 * cells.mean()
    return np.ceil(np.log2(np.maximum(cells / limit, 1))).astype(np.uint8)


def _parity(grams: np.ndarray) -> np.ndarray:
    odd = np.bincount((grams % np.uint64(PARITY)).astype(np.int64), minlength=PARITY) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _node(grams: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(grams.tobytes(), seed=len(grams))).astype(np.int64))


def _connected(links: DataFrame) -> DataFrame:
    """node, label: the smallest node that each node of ``links`` (a, b) reaches."""
    edges = staged(
        links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))), "cc-edges"
    )
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    labels = staged(least.select(F.col("a").alias("node"), F.least("a", "m").alias("label")), "cc")
    while True:
        near = (
            edges.join(labels.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("label").alias("near"))
        )
        step = labels.join(near, "node").select("node", "label", F.least("label", "near").alias("low"))
        # A node that got a smaller label tells the old label's node, and takes what that node knows.
        hooks = step.groupBy(F.col("label").alias("node")).agg(F.min("low").alias("hook"))
        step = step.join(hooks, "node", "left").select(
            "node", "label", F.least("low", F.coalesce("hook", "low")).alias("low")
        )
        jump = step.select(F.col("node").alias("low"), F.col("low").alias("far"))
        new = step.join(jump, "low", "left").select(
            "node", F.coalesce("far", "low").alias("label"), (F.col("label") != F.coalesce("far", "low")).alias("moved")
        )
        new = staged(new, "cc")
        moved = not new.where("moved").isEmpty()
        drop(labels)
        labels = new
        if not moved:
            drop(edges)
            return labels.select("node", "label")


def indexed(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n, node, bits (parity map), entries and most of every row of ``docs`` (doc_id, text)."""
    classes = gram_classes(docs, words)

    @lean
    def index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in slices(batches, SLICE):
            own = sets(batch["text"].tolist(), words)
            nodes = [_node(g) if len(g) else None for g in own]
            entries = [signatures(g, classes, percent) if len(g) else None for g in own]
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"].astype("Int64"),
                    "n": np.array([len(g) for g in own], np.int64),
                    "node": pd.array(nodes, "Int64"),
                    "bits": [_parity(g) for g in own],
                    "entries": strings([e and e[0].view(np.int64) for e in entries]),
                    "most": strings([e and e[1].astype(np.int32) for e in entries]),
                }
            )

    # The entries of a document are as many as a sixth of its words; everything after reads this table.
    return staged(docs.mapInPandas(index, "doc_id bigint, n bigint, node bigint, bits array<bigint>, entries array<bigint>, most array<int>"), "grams")


def shared_entries(rows: DataFrame) -> DataFrame:
    """entry, node, star, n, most: the members of each entry that more than one node has, with the smallest of its nodes."""
    entries = rows.where("node is not null").select("node", "n", F.explode(F.arrays_zip("entries", "most")).alias("e"))
    entries = entries.select("node", F.col("n").cast("int").alias("n"), F.col("e.entries").alias("entry"), "e.most")
    # Entries of one set only, however many copies it has, link nothing. All that is asked of an entry needs one shuffle.
    same = Window.partitionBy("entry")
    entries = entries.withColumn("star", F.min("node").over(same)).withColumn("last", F.max("node").over(same)).where("star < last")
    return staged(
        entries.groupBy("entry", "node").agg(F.first("star").alias("star"), F.first("n").alias("n"), F.max("most").alias("most")), "buckets"
    )


def settled(
    members: DataFrame, labels: DataFrame, links: DataFrame, checked: DataFrame, named: DataFrame, docs: DataFrame, words: int, percent: int
) -> tuple[DataFrame, DataFrame]:
    """Labels and links once every pair of an entry's ``members`` has been verified or is in one class."""
    left = members.select("entry", "node", "n", "most")
    for each in (*AT_A_TIME, None):
        # Buckets with more than one class: members outside the largest one meet more and more, at last all others.
        placed = staged(left.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node")), "placed")
        if each != AT_A_TIME[0]:
            drop(left)  # what the round before left open
        left, pairs = _cross(placed, each, percent)
        drop(placed)
        if left.isEmpty():
            break
        fresh = staged(_sized(pairs, named, percent).join(checked, ["a", "b"], "left_anti"), "pairs")
        if fresh.isEmpty():
            continue
        found = _verified(fresh, named, docs, words, percent)
        checked = checked.unionByName(fresh)
        if not found.isEmpty():
            links = links.unionByName(found)
            labels = _connected(links)
    return labels, links


def ngram_join(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, count_links: bool = True) -> DataFrame:
    """doc_id, n_shingles, component_id and, with ``count_links``, n_verified_links for every row of ``docs``; the last counts
    the other sets that the document's set links to, each verified on whole sets."""
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    rows = indexed(docs, words, percent)
    named = rows.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("bits").alias("bits"))
    named = staged(named, "nodes")
    members = shared_entries(rows)
    # Entries take most of what is staged; after this only the ids of rows are asked for.
    result = staged(rows.select("doc_id", F.col("n").alias("n_shingles"), "node"), "rows")
    drop(rows)
    star = members.where("star < node").select(F.col("star").alias("a"), F.col("node").alias("b"))
    checked = staged(_sized(star.distinct(), named, percent), "pairs")
    links = _verified(checked, named, docs, words, percent)
    labels, links = settled(members, _connected(links), links, checked, named, docs, words, percent)
    drop(members)
    placed = named.join(labels, "node", "left").select("node", "doc_id", F.coalesce("label", "node").alias("label"))
    least = placed.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    names = placed.join(least, "label")
    counted = ["n_verified_links"] * count_links
    if count_links:
        names = names.join(_degrees(labels, links, named, docs, words, percent), "node", "left")
        names = names.withColumn("n_verified_links", F.coalesce("links", F.lit(0)).cast("bigint"))
    names = names.select("node", "component_id", *counted)
    own = result.where("node is not null").join(names, "node")
    alone = result.where("node is null").select(
        "node", "doc_id", "n_shingles", F.col("doc_id").alias("component_id"), *[F.lit(0).cast("bigint").alias(c) for c in counted]
    )
    return own.unionByName(alone).select("doc_id", "n_shingles", "component_id", *counted)


def _degrees(labels: DataFrame, links: DataFrame, named: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """node and links, how many nodes each node of a class links to: of classes whose pairs have not all been found to link,
    every pair is verified."""
    links = links.select("a", "b").distinct()
    ends = links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("links"))
    known = staged(labels.join(named.select("node", "n"), "node").join(ends, "node"), "degrees")
    per = known.groupBy("label").agg(F.count(F.lit(1)).alias("k"), F.sum("links").alias("ends"), F.sum("n").alias("size"))
    # Where all pairs link, each was verified.
    per = per.where(F.col("ends") < F.col("k") * (F.col("k") - 1)).select("label", F.ceil(F.greatest(F.col("size") / BLOCK, F.col("k") / BLOCK_SETS)).cast("int").alias("parts"))
    open_ = staged(known.join(per, "label").select("node", "label", "n", "parts"), "open-classes")
    bins = open_.agg(F.ceil(F.sum(F.col("parts") * F.greatest(F.col("n") / BLOCK, F.lit(1 / BLOCK_SETS))))).first()[0]
    if not bins:
        return known.select("node", "links")
    asked = staged(_asked(open_.select("node"), named), "asked")
    whole = _sets(asked, docs, words)
    part = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    placed = whole.join(open_.withColumn("part", part), "node").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    placed = placed.select("label", "node", "part", F.least("part", "other").alias("x"), F.greatest("part", "other").alias("y"), "low", "high")
    placed = placed.withColumn("bin", F.pmod(F.xxhash64("label", "x", "y"), F.lit(bins)))

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        found = []
        for (_, x, y), block in rows.groupby(["label", "x", "y"]):
            block = block.drop_duplicates("node")
            grams = [_whole(low, high) for low, high in zip(block["low"], block["high"])]
            part = block["part"].to_numpy()
            found.append(pd.DataFrame({"node": block["node"].to_numpy(), "links": block_links(grams, part == x, part == y, percent)}))
        return pd.concat(found, ignore_index=True)

    counts = placed.groupBy("bin").applyInPandas(compare, "node bigint, links bigint")
    counts = staged(counts.groupBy("node").agg(F.sum("links").alias("links")), "links-counted")
    drop(asked, open_)
    return known.join(counts.select("node"), "node", "left_anti").select("node", "links").unionByName(counts)


def block_links(grams: list[np.ndarray], left: np.ndarray, right: np.ndarray, percent: int) -> np.ndarray:
    """How many sets of ``right`` each one of ``left`` links to, and the other way round if these are not the same."""
    value, of = np.unique(np.concatenate(grams), return_inverse=True)
    size = np.array([len(g) for g in grams])
    row = np.repeat(np.arange(len(grams)), size)
    # Those of one set alone are common to none.
    several = np.bincount(of, minlength=len(value)) > 1
    number = np.cumsum(several) - 1
    row, of = row[several[of]], number[of[several[of]]]
    order = np.argsort(of, kind="stable")
    row, of = row[order], of[order]
    edge = np.searchsorted(of, np.arange(0, int(several.sum()) + COLUMNS, COLUMNS))
    a, b = np.flatnonzero(left), np.flatnonzero(right)
    common = np.zeros((len(a), len(b)))
    for k, (start, end) in enumerate(zip(edge[:-1], edge[1:])):
        held = np.zeros((len(grams), COLUMNS), np.float32)
        held[row[start:end], of[start:end] - k * COLUMNS] = 1
        common += held[a] @ held[b].T
    links = 100 * common >= percent * (size[a][:, None] + size[b][None, :] - common)
    links &= a[:, None] != b[None, :]
    found = np.zeros(len(grams), np.int64)
    found[a] = links.sum(axis=1)
    if not np.array_equal(a, b):
        found[b] = links.sum(axis=0)
    return found


def _sized(pairs: DataFrame, named: DataFrame, percent: int) -> DataFrame:
    """Pairs that sizes and parity maps allow to link: sets differ in as many members at least as their maps in bits."""
    side = lambda node, n, bits: named.select(F.col("node").alias(node), F.col("n").alias(n), F.col("bits").alias(bits))
    both = pairs.join(side("a", "x", "p"), "a").join(side("b", "y", "q"), "b")
    apart = F.aggregate(F.zip_with("p", "q", lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda t, k: t + k)
    fits = F.least("x", "y") * 100 >= F.greatest("x", "y") * percent
    return both.where(fits).where(apart * (100 + percent) <= (F.col("x") + F.col("y")) * (100 - percent)).select("a", "b")


def _asked(nodes: DataFrame, named: DataFrame) -> DataFrame:
    """doc_id and want, the node, of a row that has the text of each of ``nodes``."""
    return nodes.join(named, "node").select("doc_id", F.col("node").alias("want"))


def _texts(asked: DataFrame, docs: DataFrame) -> DataFrame:
    """want and text; a row of the same id may have another text."""
    sources = F.broadcast(asked) if asked.count() <= BROADCAST_ROWS else asked
    return docs.join(sources, docs["doc_id"].eqNullSafe(sources["doc_id"])).select("want", "text")


def _sets(asked: DataFrame, docs: DataFrame, words: int) -> DataFrame:
    """node, low and high: the halves of the hashes of each node that is asked for."""

    @lean
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[int] = set()
        for batch in slices(batches, SLICE):
            own = sets(batch["text"].tolist(), words)
            # A row of the same id may have another text, or the same once more.
            keep = [i for i, (g, want) in enumerate(zip(own, batch["want"])) if len(g) and want not in seen and _node(g) == want]
            seen.update(batch["want"].iloc[keep])
            yield pd.DataFrame(
                {
                    "node": batch["want"].iloc[keep].to_numpy(),
                    "low": strings([own[i].astype(np.uint32).view(np.int32) for i in keep]),
                    "high": strings([(own[i] >> np.uint64(32)).astype(np.uint32).view(np.int32) for i in keep]),
                }
            )

    return _texts(asked, docs).mapInPandas(read, "node bigint, low array<int>, high array<int>")


def _verified(pairs: DataFrame, named: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs that link, by the whole sets of their nodes, each read from one text."""
    asked = staged(_asked(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), named), "asked")
    whole = staged(_sets(asked, docs, words), "sets")

    # Half of each hash tells all but pairs close above the limit, which are read whole.
    @lean
    def test(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for x, y in batches:
            yield pd.Series([by_halves(a, b, percent) for a, b in zip(x, y)], dtype="int32")

    @lean
    def test_whole(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for low_x, high_x, low_y, high_y in batches:
            yield pd.Series([alike(_whole(a, b), _whole(c, d), percent) for a, b, c, d in zip(low_x, high_x, low_y, high_y)], dtype=bool)

    left = pairs.join(whole.select(F.col("node").alias("a"), F.col("low").alias("x")), "a")
    both = left.join(whole.select(F.col("node").alias("b"), F.col("low").alias("y")), "b")
    told = staged(both.select("a", "b", F.pandas_udf(test, "int")("x", "y").alias("told")).where("told >= 0").distinct(), "told")
    links, close = told.where("told = 1").select("a", "b"), told.where("told = 0").select("a", "b")
    if not close.isEmpty():
        # Sets of other nodes stay where they are.
        ends = staged(close.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "close")
        some = whole.join(F.broadcast(ends) if ends.count() <= BROADCAST_ROWS else ends, "node", "left_semi")
        side = lambda node: some.select(F.col("node").alias(node), F.col("low").alias(f"low_{node}"), F.col("high").alias(f"high_{node}"))
        sure = close.join(side("a"), "a").join(side("b"), "b").where(F.pandas_udf(test_whole, "boolean")("low_a", "high_a", "low_b", "high_b"))
        links = links.unionByName(sure.select("a", "b").distinct())
    links = staged(links, "links")
    drop(asked, whole, told)
    return links


def _whole(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    return low.view(np.uint32).astype(np.uint64) | high.view(np.uint32).astype(np.uint64) << np.uint64(32)


def alike(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= percent * (len(a) + len(b) - common)


def _spare(couples: int) -> int:
    """So many of ``couples`` of members that differ have equal halves at most: that one more has, about
    ``mean ** (spare + 1) / (spare + 1)!``, is 2 ** 8 times less likely than that one has equal hashes of 64 bits, ``mean / 2 ** 32``."""
    mean = couples / 2**32
    spare, odds = 1, mean / 2
    while odds > 2.0**-40:
        spare += 1
        odds *= mean / (spare + 1)
    return spare


def by_halves(a: np.ndarray, b: np.ndarray, percent: int) -> int:
    """Whether sets link, by the low halves of their hashes: -1 no, 1 yes, 0 if that takes whole ones. Members that differ may have
    equal halves, so that too many are found in common: seldom one, and never more than ``spare`` but for a probability far below that
    of equal hashes of 64 bits."""
    common = len(np.intersect1d(a, b, assume_unique=True))
    spare = _spare((len(a) + len(b)) ** 2 // 2)
    if 100 * common < percent * (len(a) + len(b) - common):
        return -1
    return int(100 * (common - spare) >= percent * (len(a) + len(b) - common + spare))


def _cross(placed: DataFrame, each: int | None, percent: int) -> tuple[DataFrame, DataFrame]:
    """The members (entry, node) of buckets of more than one class, and pairs of those outside the largest class with
    about ``each`` members of other classes, or all."""
    per = placed.groupBy("entry", "label").agg(F.count(F.lit(1)).alias("k"))
    largest = per.groupBy("entry").agg(
        F.max(F.struct("k", "label")).alias("top"), F.count(F.lit(1)).alias("classes"), F.sum("k").alias("size")
    )
    parts = F.ceil(F.col("size") / each) if each else F.lit(1)
    largest = largest.where("classes > 1").select("entry", F.col("top.label").alias("top"), parts.alias("parts"))
    rest = placed.join(largest, "entry").withColumn("part", F.pmod(F.xxhash64("node", "entry"), F.col("parts")))
    rest = staged(rest, "open")
    outside = rest.where("label != top").select(
        "entry", "part", F.col("node").alias("p"), F.col("label").alias("own"), F.col("n").alias("n_p"),
        F.col("most").alias("most_p"),
    )
    # A link has its first common entry among those that leave room for as many common members as it takes.
    room = F.least("most", "most_p") * (100 + percent) >= (F.col("n") + F.col("n_p")) * percent
    room = room & (F.least("n", "n_p") * 100 >= F.greatest("n", "n_p") * percent)
    pairs = outside.alias("o").join(
        rest.alias("r"),
        (F.col("o.entry") == F.col("r.entry")) & (F.col("o.part") == F.col("r.part")) & (F.col("own") != F.col("label")) & room,
    )
    pairs = pairs.select(F.least("p", "node").alias("a"), F.greatest("p", "node").alias("b"))
    return rest.select("entry", "node", "n", "most"), pairs.distinct()


def op7_ngram_join(spark, sf_dir) -> DataFrame:
    return ngram_join(table(spark, sf_dir, "documents"))
