"""Best-fit packing of tokenized documents into sequences, in bulk-synchronous rounds.

A round range-sorts the open sequences (by gap) and the documents (by length), largest first, and sweeps every
partition once: a document takes the smallest gap that holds it, a remaining gap is looked at again when the sweep
comes down to it. What a partition can't match by itself, documents too long for its own gaps and gaps no document
of its own wants, meets across partitions by rank: the driver only sees counts per partition and says which ranks
go together. The largest documents that no gap holds open new sequences, gaps are updated, and the next round
begins. Rows never pass through the driver and no task holds more than its range.

Nulls, ties and other cases: a null text is an empty one and packs as its end token alone; equal lengths are taken
in the order of their row number; equal rows and equal or null ``doc_id`` are documents of their own; an empty
table gives no rows; other columns of the input, whatever their names, are not read.
"""

from __future__ import annotations

import base64
import heapq
import math
import zlib
from array import array
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import lean, slices, table
from tidemark.sources.staging import staged

CAPACITY = 1024
END = 2
VOCABULARY = "byte_bpe_50k.tiktoken"
#: The one added token of the vocabulary, which its own library finds in any text.
ADDED, ADDED_ID = "<|endoftext|>", 50256
#: Entries the memory of encoded words keeps before it starts anew.
KEPT_WORDS = 200_000

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
SWEPT = "kind string, item bigint, seq bigint, length bigint, offset bigint, gap bigint, pid int, rank bigint"


class Irregular(Exception):
    """A space beside other white space: the text is encoded as one."""


class Words(dict):
    """Encoded ids (little-endian unsigned 32-bit) of words with the space before them.

    The vocabulary's pattern always begins a new match at a space that is followed by no white space, so words
    that begin there are encoded alone, and each only once."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, word: str) -> bytes:
        if not word or word[0].isspace():
            raise Irregular
        ids = array("I", self.encode(" " + word)).tobytes()
        if len(self) >= KEPT_WORDS:
            self.clear()
        self[word] = ids
        return ids

    def ids(self, text: str) -> bytes:
        if not text:
            return b""
        first, *words = text.split(" ")
        try:
            rest = b"".join(map(self.__getitem__, words))
            return array("I", self.encode(first)).tobytes() + rest
        except Irregular:
            return array("I", self.encode(text)).tobytes()


def encoder(vocabulary: str = VOCABULARY) -> Words:
    """``byte_bpe_50k.json`` and this file are one vocabulary; tests hold the ids of both libraries together."""
    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path(vocabulary), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return Words(own.encode_ordinary)


def pieces(docs: DataFrame, capacity: int = CAPACITY, end: int = END, vocabulary: str = VOCABULARY) -> DataFrame:
    """Documents as token sequences with an end token, those longer than ``capacity`` in pieces, of which only the
    first is shorter."""

    @lean
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words, ending = encoder(vocabulary), array("I", [end]).tobytes()
        added = array("I", [ADDED_ID]).tobytes()
        for batch in slices(batches):
            out: tuple[list, ...] = ([], [], [], [], [])
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                # The vocabulary's added token, found before anything else, is one id wherever it stands in a text.
                ids = added.join(map(words.ids, (text or "").split(ADDED))) + ending
                n = len(ids) // 4
                start, piece = 0, 0
                while start < n:
                    length = (n - 1) % capacity + 1 if start == 0 else capacity
                    for column, value in zip(
                        out, (doc_id, piece, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)]))
                    ):
                        column.append(value)
                    start, piece = start + length, piece + 1
            yield pd.DataFrame(dict(zip(("doc_id", "piece", "start", "length", "ids_crc32"), out))).astype(
                {"doc_id": "Int64"}
            )

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInPandas(cut, PIECES)


def _sweep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One partition, sorted by value, largest first, gaps before documents of equal value."""
    out: list[tuple] = []
    stack: list[tuple] = []  # (gap, seq, fill), smallest on top
    later: list[tuple] = []  # what is left of gaps that were used, largest first
    unmatched, pid, value = 0, 0, 0

    def reach(down_to: int) -> None:
        while later and -later[0][0] >= down_to:
            gap, seq, fill = heapq.heappop(later)
            stack.append((-gap, seq, fill))

    for batch in batches:
        columns = (batch[c].tolist() for c in ("value", "is_item", "id", "fill", "pid"))
        for value, is_item, key, fill, pid in zip(*columns):
            reach(value)
            if not is_item:
                stack.append((value, key, fill))
            elif stack:
                gap, seq, used = stack.pop()
                out.append(("a", key, seq, value, used, None, None, None))
                if gap > value:
                    heapq.heappush(later, (value - gap, seq, used + value))
            else:
                out.append(("i", key, None, value, None, None, pid, unmatched))
                unmatched += 1
        if len(out) > 100_000:
            yield pd.DataFrame(out, columns=_COLUMNS).astype(_TYPES)
            out = []
    reach(value)
    out += [("g", None, seq, None, fill, gap, pid, rank) for rank, (gap, seq, fill) in enumerate(stack)]
    out += [("r", None, seq, None, fill, -gap, None, None) for gap, seq, fill in later]
    if out:
        yield pd.DataFrame(out, columns=_COLUMNS).astype(_TYPES)


_COLUMNS = ["kind", "item", "seq", "length", "offset", "gap", "pid", "rank"]
_TYPES = {c: "Int64" for c in _COLUMNS[1:]} | {"pid": "Int32"}


def meet(stats: list[dict], capacity: int) -> list[tuple]:
    """Which unmatched ranks of documents go to which ranks of gaps, from counts per partition.

    Partitions come largest values first, so the last gaps seen are the smallest that hold what comes next.
    Rows are (pid, first rank, end rank, pid of the gaps, rank of the first gap, documents per gap); the gaps' pid
    is null for documents that open a sequence."""
    by_pid: dict[int, dict] = {}
    for row in stats:
        by_pid.setdefault(row["pid"], {})[row["kind"]] = row
    open_gaps, rows, alone, waiting = [], [], [], 0.0
    for pid in sorted(by_pid):
        if items := by_pid[pid].get("i"):
            at, n = 0, items["n"]
            while at < n and open_gaps:
                q, left, smallest = open_gaps.pop()
                each = max(1, smallest // items["longest"])
                take = min(left, math.ceil((n - at) / each))
                to = min(n, at + take * each)
                rows.append((pid, at, to, q, left - 1, each))
                at = to
                if left > take:
                    open_gaps.append((q, left - take, smallest))
            if at < n:
                alone.append((pid, at, n))
                waiting += (n - at) * items["total"] / n
        if gaps := by_pid[pid].get("g"):
            open_gaps.append((pid, gaps["n"], gaps["smallest"]))
    new = math.ceil(waiting / capacity)
    for pid, at, n in alone:
        opened = min(n - at, new)
        if opened:
            rows.append((pid, at, at + opened, None, None, 1))
        new -= opened
    return rows


def pack(items: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``items`` (item, length) with ``0 < length <= capacity`` placed: item, seq, offset. A sequence has the number
    of the item that opened it."""
    spark = items.sparkSession
    full = items.where(F.col("length") == capacity).select("item", F.col("item").alias("seq"), F.lit(0).alias("offset"))
    waiting = items.where(F.col("length") < capacity).select("item", "length")
    gaps = None
    placed = [full.select("item", "seq", F.col("offset").cast("bigint"))]
    while True:
        rows = waiting.select(
            F.col("length").alias("value"), F.lit(1).alias("is_item"), F.col("item").alias("id"),
            F.lit(0).cast("bigint").alias("fill"),
        )
        if gaps is not None:
            rows = rows.unionByName(
                gaps.select(
                    F.col("gap").alias("value"), F.lit(0).alias("is_item"), F.col("seq").alias("id"),
                    F.col("offset").alias("fill"),
                )
            )
        order = [F.col("value").desc(), F.col("is_item"), F.col("id")]
        swept = staged(
            rows.repartitionByRange(*order)
            .sortWithinPartitions(*order)
            .withColumn("pid", F.spark_partition_id())
            .mapInPandas(_sweep, SWEPT),
            "pack-swept",
        )
        stats = (
            swept.where("kind in ('i', 'g')")
            .groupBy("pid", "kind")
            .agg(
                F.count(F.lit(1)).alias("n"), F.max("length").alias("longest"), F.min("gap").alias("smallest"),
                F.sum("length").alias("total"),
            )
            .collect()
        )
        placed.append(swept.where("kind = 'a'").select("item", "seq", "offset"))
        if not any(row["kind"] == "i" for row in stats):
            break
        rules = spark.createDataFrame(
            meet([row.asDict() for row in stats], capacity),
            "pid int, first bigint, end bigint, q int, top bigint, each bigint",
        )
        # One row per partition and run: a broadcast bounded by the number of partitions.
        left = swept.where("kind = 'i'").alias("i").join(
            F.broadcast(rules).alias("r"),
            (F.col("i.pid") == F.col("r.pid")) & (F.col("i.rank") >= F.col("r.first")) & (F.col("i.rank") < F.col("r.end")),
            "left",
        )
        left = left.select(
            "i.item", "i.length", "q", F.col("first").isNotNull().alias("settled"),
            (F.col("top") - F.floor((F.col("i.rank") - F.col("first")) / F.col("each"))).alias("want"),
        )
        free = swept.where("kind = 'g'").select(
            F.col("pid").alias("q"), F.col("rank").alias("want"), "seq", "gap", F.col("offset").alias("fill")
        )
        # All documents of one gap meet in its group, at most ``capacity`` of them.
        inside = Window.partitionBy("seq").orderBy("item").rowsBetween(Window.unboundedPreceding, -1)
        met = left.where("q is not null").join(free, ["q", "want"])
        met = met.withColumn("offset", F.col("fill") + F.coalesce(F.sum("length").over(inside), F.lit(0)))
        moved = staged(
            met.select(F.lit("a").alias("kind"), "item", "seq", "length", "offset", "gap", "fill").unionByName(
                left.where("q is null").select(
                    F.when(F.col("settled"), "o").otherwise("i").alias("kind"), "item",
                    F.when(F.col("settled"), F.col("item")).alias("seq"), "length",
                    F.lit(0).cast("bigint").alias("offset"), F.lit(capacity).cast("bigint").alias("gap"),
                    F.lit(0).cast("bigint").alias("fill"),
                )
            ),
            "pack-moved",
        )
        placed.append(moved.where("kind in ('a', 'o')").select("item", "seq", "offset"))
        waiting = moved.where("kind = 'i'").select("item", "length")
        used = moved.where("kind in ('a', 'o')").groupBy("seq").agg(
            F.first("gap").alias("had"), F.first("fill").alias("fill"), F.sum("length").alias("sum")
        )
        used = used.select("seq", (F.col("had") - F.col("sum")).alias("gap"), (F.col("fill") + F.col("sum")).alias("offset"))
        kept = swept.where("kind in ('g', 'r')").select("seq", "gap", "offset")
        gaps = kept.join(used, "seq", "left_anti").unionByName(used).where("gap > 0")
    result = placed[0]
    for more in placed[1:]:
        result = result.unionByName(more)
    return result


def packed(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Every piece of every document with its sequence and its place there."""
    cut = staged(pieces(docs, capacity).withColumn("item", F.monotonically_increasing_id()), "pack-pieces")
    whole = F.col("length") == capacity
    full = cut.where(whole).select("*", F.col("item").alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))
    places = pack(cut.where(~whole).select("item", "length"), capacity).withColumnRenamed("seq", "sequence_id")
    return full.unionByName(cut.where(~whole).join(places, "item")).drop("item")


def op4_best_fit_packing(spark, sf_dir) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))
