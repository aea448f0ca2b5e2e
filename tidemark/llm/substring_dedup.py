"""Substring dedup by sliding sentence spans.

Texts are cut into sentences (at ``. ! ?`` and line ends; a sentence of more than ``LONG`` words also at commas and
the like and, where a clause is still longer, after words picked by their own hash, so that a passage is cut alike
wherever it stands; words that never allow a cut, as one word over and over, are cut by number). From every sentence on, the shortest run of at least ``SEVERAL`` sentences and ``WORDS`` words is
hashed, and so is the shortest such run at the text's end. Runs are joined over all documents; a run that stands somewhere before, in an earlier document or further up,
is a repetition, and every sentence it covers goes. Any passage shared word for word, longer than such a run and the
two cut sentences at its ends (about 40 words), is therefore found.

The first place is the smallest ``doc_id`` and there the first position. Nulls, ties and other cases: null texts stay
null, empty ones empty; rows with one id are one document here and take nothing from each other, rows without id are
together the last document; equal texts of different ids keep the first; white space before removed sentences at the
end goes too; an empty table gives no rows; all columns of the input are kept whatever their names.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import lean, slices, table

WORDS = 16
SEVERAL = 2
LONG = 12

_SENTENCE = re.compile(r"[^.!?\n]*[.!?\n]+\s*|[^.!?\n]+")
_CLAUSE = re.compile(r"[^,;:]*[,;:]+\s*|[^,;:]+")
_WORD = re.compile(r"\s*\S+\s*")
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def sentences(text: str) -> tuple[list[str], list[str]]:
    """The sentences of a text, as they stand (together they are the text) and with single spaces."""
    raw, plain = [], []
    for sentence in _SENTENCE.findall(text):
        words = sentence.split()
        if len(words) <= LONG:
            raw.append(sentence)
            plain.append(" ".join(words))
            continue
        for clause in _CLAUSE.findall(sentence):
            words = clause.split()
            if len(words) <= LONG:
                raw.append(clause)
                plain.append(" ".join(words))
                continue
            part: list[str] = []
            for word in _WORD.findall(clause):
                part.append(word)
                if zlib.crc32(word.strip().encode()) % 4 == 0 or len(part) == 2 * LONG:
                    raw.append("".join(part))
                    plain.append(" ".join("".join(part).split()))
                    part = []
            if part:
                raw.append("".join(part))
                plain.append(" ".join("".join(part).split()))
    return raw, plain


def run_ends(plain: list[str]) -> np.ndarray:
    """For every sentence the end of the shortest run that begins there; -1 where the text ends first."""
    n = len(plain)
    total = np.concatenate([[0], np.cumsum([s.count(" ") + 1 if s else 0 for s in plain])])
    ends = np.maximum(np.searchsorted(total, total[:-1] + WORDS), np.arange(n) + SEVERAL)
    return np.where(ends <= n, ends, -1)


def tail(plain: list[str]) -> int:
    """Where the shortest run begins that ends with the text; -1 if the text is shorter."""
    words, start = 0, len(plain)
    while start and (words < WORDS or len(plain) - start < SEVERAL):
        start -= 1
        words += plain[start].count(" ") + 1 if plain[start] else 0
    return start if words >= WORDS and len(plain) - start >= SEVERAL else -1


def run_hashes(plain: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Starts and 64-bit hashes of the runs of one text; start ``len(plain)`` is the run at its end."""
    ends = run_ends(plain)
    starts = np.flatnonzero(ends >= 0)
    if not len(starts):
        return starts, np.empty(0, np.int64)
    begin, stop = starts, ends[starts]
    last = tail(plain)
    if ends[last] != len(plain):  # else it is one of the others
        starts, begin, stop = np.append(starts, len(plain)), np.append(begin, last), np.append(stop, len(plain))
    own = np.fromiter((xxhash.xxh3_64_intdigest(s) for s in plain), np.uint64, len(plain))
    # Horner over the few sentences of a run, all runs at once.
    size, value = stop - begin, np.zeros(len(starts), np.uint64)
    for step in range(int(size.max())):
        inside = step < size
        at = np.minimum(begin + step, len(plain) - 1)
        value = np.where(inside, (value * _BASE + own[at]) ^ (value >> np.uint64(29)), value)
    value = (value ^ (value >> np.uint64(31))) * _MIX
    return starts, value.view(np.int64)


def covered(plain: list[str], starts: np.ndarray) -> np.ndarray:
    """Which sentences the runs of these starts cover."""
    begin, ends = np.append(np.arange(len(plain)), tail(plain)), np.append(run_ends(plain), len(plain))
    edge = np.zeros(len(plain) + 1, np.int64)
    np.add.at(edge, begin[starts], 1)
    np.add.at(edge, ends[starts], -1)
    return np.cumsum(edge)[:-1] > 0


@lean
def _runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in slices(batches):
        ids, tags, starts, hashes, again = [], [], [], [], []
        for doc_id, tag, text in zip(batch["doc_id"], batch["tag"], batch["text"]):
            at, value = run_hashes(sentences(text)[1])
            ids.append(np.repeat(np.array([doc_id], object), len(at)))
            tags.append(np.full(len(at), tag, np.int64))
            starts.append(at)
            hashes.append(value)
            later = np.ones(len(at), bool)
            later[np.unique(value, return_index=True)[1]] = False
            again.append(later)
        yield pd.DataFrame(
            {
                "run": np.concatenate(hashes),
                "doc_id": pd.array(np.concatenate(ids), "Int64"),
                "tag": np.concatenate(tags),
                "start": np.concatenate(starts).astype(np.int32),
                "again": np.concatenate(again),
            }
        )


def repeated_runs(docs: DataFrame) -> DataFrame:
    """doc_id, tag and the starts of all runs that are not the first of their kind."""
    texts = docs.where(F.length("text") > 0).select("doc_id", F.crc32("text").alias("tag"), "text")
    # Hashed once for the counts and once for the join: a stored table of all runs would be as large as the texts.
    runs = texts.mapInPandas(_runs, "run bigint, doc_id bigint, tag bigint, start int, again boolean")
    known = runs.groupBy("run").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("places"))
    return (
        runs.join(known.where("places > 1").select("run", "first"), "run")
        .where(F.col("again") | ~F.col("doc_id").eqNullSafe(F.col("first")))
        .groupBy("doc_id", "tag")
        .agg(F.collect_set("start").alias("starts"))
    )


@lean
def _without(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    for texts, starts in batches:
        kept, removed = [], []
        for text, at in zip(texts, starts):
            if at is None:
                kept.append(None)
                removed.append(0)
                continue
            raw, plain = sentences(text)
            gone = covered(plain, at)
            kept.append("".join(s for s, c in zip(raw, gone) if not c).rstrip())
            removed.append(int(gone.sum()))
        yield pd.DataFrame({"text": kept, "n_removed": np.array(removed, np.int32)})


def substring_dedup(docs: DataFrame, removed: str = "n_removed") -> DataFrame:
    """All rows of ``docs``, ``text`` without repeated sentences; column ``removed`` counts those."""
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.crc32("text").alias("tag"), "text",
        F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in others]).alias("others"),
    )
    found = repeated_runs(rows.select("doc_id", "text")).select(F.col("doc_id").alias("id"), F.col("tag").alias("t"), "starts")
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("tag") == F.col("t"))
    both = rows.join(found, same, "left")
    # Texts without a repetition don't leave the JVM.
    touched = F.when(F.col("starts").isNotNull(), F.col("text"))
    both = both.withColumn("new", F.pandas_udf(_without, "text string, n_removed int")(touched, "starts"))
    text = F.coalesce("new.text", "text")
    own = {"doc_id": F.col("doc_id"), "text": text}
    return both.select(
        *[own.get(c, F.col(f"others.`{c}`")).alias(c) for c in docs.columns], F.col("new.n_removed").alias(removed)
    )


def op10_substring_dedup(spark, sf_dir) -> DataFrame:
    """doc_id, text without repeated passages, n_removed: the sentences that went."""
    return substring_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
