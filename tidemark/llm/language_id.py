"""Language identification by prediction by partial matching.

Every language has a tree of byte contexts of up to three bytes. A byte that its context has seen costs
``-log2(count / (total + distinct))`` bits, another one the escape ``-log2(distinct / (total + distinct))`` and what it
costs in the context shortened by a byte; below the empty context all bytes are alike. The language whose frozen
statistics give a text the shortest code is predicted; the score is its share if all languages were as likely before.

The trees are counted by Spark jobs on about ``SAMPLE_ROWS`` whole texts of each language, picked by hash (the stated
bound of the classifier's sample); predictions then read every text from end to end, long ones ``CHUNK`` bytes at a time.

``known_language`` filters by the same code lengths: limits come from all labelled rows, each priced by trees of the half
it isn't in. One set of trees after the other is sent to the workers and taken back when its rows are staged.

Nulls, ties and other cases: null texts and texts without a letter are ``und`` with score 0, as all are if nothing
could be learned; rows without language teach nothing, nor do rows without id, which are not held out either; equally
short codes go to the language first in the alphabet; an empty table gives no rows; all columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import lean, slices, small_batches, table
from tidemark.sources.staging import drop, staged

#: Expected number of training texts per language; bounds the trees, whatever the size of the corpus.
SAMPLE_ROWS = 400
ORDER = 3
UNKNOWN = "und"
USUAL, TOLERANCE = 0.99, 2.0
#: So many bits must a text's code be longer than the limit of its language allows before it is rejected.
EVIDENCE = 16
#: Characters of short texts, and bytes of a long one, that are priced at a time.
CHUNK = 1 << 18
_PAD = b" " * ORDER
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def remainder(modulus: int) -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % modulus


def _codes(raw: bytes) -> np.ndarray:
    """Codes of all bytes but the first three, each with the three before it."""
    wide = np.frombuffer(raw, np.uint8).astype(np.uint32)
    return (wide[:-3] << 24) | (wide[1:-2] << 16) | (wide[2:-1] << 8) | wide[3:]


def _grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all bytes with the three before them, text after text, and where the texts begin."""
    parts = [t.encode() for t in texts]
    code = _codes(_PAD + _PAD.join(parts))
    begin = np.cumsum([0] + [len(p) + ORDER for p in parts[:-1]])
    inside = np.ones(len(code), bool)
    for k in range(ORDER):
        inside[begin[1:] - 1 - k] = False
    at = np.cumsum([0] + [len(p) for p in parts[:-1]])
    return code[inside], at


def _blocks(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Places of texts in the list, codes of their bytes and where the texts begin in these: short texts together,
    a long one in pieces of its own."""
    sizes = np.array([len(t) for t in texts])
    short = np.flatnonzero((sizes > 0) & (sizes < CHUNK))
    for rows in np.split(short, np.flatnonzero(np.diff(np.cumsum(sizes[short]) // CHUNK)) + 1):
        if len(rows):
            yield rows, *_grams([texts[i] for i in rows])
    for row in np.flatnonzero(sizes >= CHUNK):
        raw = _PAD + texts[row].encode()
        for begin in range(0, len(raw) - ORDER, CHUNK):
            yield np.array([row]), _codes(raw[begin : begin + CHUNK + ORDER]), np.zeros(1, np.int64)


class Trees:
    """Frozen code lengths of all languages."""

    def __init__(self, languages: list[str], language: np.ndarray, gram: np.ndarray, count: np.ndarray):
        self.languages = languages
        n = len(languages)
        shorter = np.full((1, n), 8.0)  # a byte of 256 below the empty context
        known = np.zeros(1, np.uint64)
        self.tables = []
        for order in range(ORDER + 1):
            width = np.uint64(8 * (order + 1))
            own = gram & ((np.uint64(1) << width) - np.uint64(1))
            keys, at = np.unique(own, return_inverse=True)
            seen = np.zeros((len(keys), n))
            np.add.at(seen, (at, language), count)
            contexts, of = np.unique(keys >> np.uint64(8), return_inverse=True)
            total, distinct = np.zeros((len(contexts), n)), np.zeros((len(contexts), n))
            np.add.at(total, of, seen)
            np.add.at(distinct, of, seen > 0)
            with np.errstate(divide="ignore", invalid="ignore"):
                # A context the language never met costs nothing to leave.
                escape = np.where(total > 0, -np.log2(distinct / (total + distinct)), 0.0)
                direct = -np.log2(seen / (total + distinct)[of])
            below = shorter[np.searchsorted(known, keys & ((np.uint64(1) << (width - np.uint64(8))) - np.uint64(1)))]
            cost = np.where(seen > 0, direct, escape[of] + below)
            # The longest grams have a table of their own.
            below_top = (keys, cost.astype(np.float32)) if order < ORDER else (None, None)
            self.tables.append((*below_top, contexts, escape.astype(np.float32)))
            known, shorter = keys, cost
        self._spread(known.astype(np.uint32), shorter.astype(np.float32))

    def _spread(self, keys: np.ndarray, cost: np.ndarray) -> None:
        """An open table of the longest grams, at most a quarter full."""
        bits = max(8, int(4 * len(keys) - 1).bit_length())
        self.shift = np.uint64(64 - bits)
        self.slots = np.full(1 << bits, -1, np.int32)
        self.keys, self.cost, self.steps = keys, cost, 0
        waiting, place = np.arange(len(keys), dtype=np.int32), self._slot(keys)
        while len(waiting):
            free = self.slots[place] < 0
            self.slots[place[free]] = waiting[free]
            lost = self.slots[place] != waiting
            waiting, place = waiting[lost], (place[lost] + 1) & (len(self.slots) - 1)
            self.steps += 1

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * _SPREAD) >> self.shift).astype(np.int64)

    def costs(self, code: np.ndarray) -> np.ndarray:
        """Bits of every byte (rows) in every language (columns)."""
        place = self._slot(code)
        row = self.slots[place]
        off = np.flatnonzero((row >= 0) & (self.keys[row] != code))
        for _ in range(self.steps):
            if not len(off):
                break
            place[off] = (place[off] + 1) & (len(self.slots) - 1)
            row[off] = self.slots[place[off]]
            off = off[(row[off] >= 0) & (self.keys[row[off]] != code[off])]
        out = self.cost[row]
        new = np.flatnonzero(row < 0)
        if len(new):
            grams, at = np.unique(code[new], return_inverse=True)
            out[new] = self._unseen(grams.astype(np.uint64))[at]
        return out

    def _unseen(self, gram: np.ndarray) -> np.ndarray:
        """Code lengths of grams no language has seen: escapes down to the longest one that any has."""
        out = np.zeros((len(gram), len(self.languages)))
        left = np.arange(len(gram))
        for order in range(ORDER, -1, -1):
            keys, cost, contexts, escape = self.tables[order]
            own = gram[left] & ((np.uint64(1) << np.uint64(8 * (order + 1))) - np.uint64(1))
            if order < ORDER:
                at = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
                hit = keys[at] == own
                out[left[hit]] += cost[at[hit]]
                left, own = left[~hit], own[~hit]
            own = own >> np.uint64(8)
            at = np.minimum(np.searchsorted(contexts, own), len(contexts) - 1)
            hit = contexts[at] == own
            out[left[hit]] += escape[at[hit]]
        out[left] += 8.0
        return out


def train(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Trees | None:
    """Trees of the languages in ``docs`` (doc_id, text, lang)."""
    small_batches(docs.sparkSession)
    labelled = docs.where("lang is not null and text is not null and doc_id is not null")
    sizes = labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("rows"))
    # One row per language.
    drawn = labelled.join(F.broadcast(sizes), "lang").where(
        F.pmod(F.xxhash64("doc_id", F.lit("ppm")), F.lit(1 << 30)) < F.lit(float(sample_rows << 30)) / F.col("rows")
    )

    @lean
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in slices(batches, 2 << 20):
            for lang, texts in batch.groupby("lang")["text"]:
                for _, code, _ in _blocks(texts.tolist()):
                    grams, n = np.unique(code, return_counts=True)
                    yield pd.DataFrame({"lang": lang, "gram": grams.astype(np.int64), "n": n})

    grams = drawn.select("lang", F.lower("text").alias("text")).mapInPandas(count, "lang string, gram bigint, n bigint")
    grams = grams.groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas()  # at most the bytes of the sample
    if not len(grams):
        return None
    languages, language = np.unique(grams["lang"].to_numpy(str), return_inverse=True)
    return Trees(languages.tolist(), language, grams["gram"].to_numpy().astype(np.uint64), grams["n"].to_numpy())


def _identified(docs: DataFrame, shared: Broadcast, pred: str, score: str) -> DataFrame:
    """:func:`identify` by the trees in ``shared``."""

    @lean
    def predict(columns: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        trees = shared.value
        for column in columns:
            names = np.full(len(column), UNKNOWN, object)
            scores, rates = np.zeros(len(column)), np.full(len(column), np.nan)
            rows = np.flatnonzero(column.notna().to_numpy()) if trees else []
            if len(rows):
                bits, size = np.zeros((len(rows), len(trees.languages))), np.zeros(len(rows))
                for some, code, at in _blocks(column.iloc[rows].tolist()):
                    bits[some] += np.add.reduceat(trees.costs(code), at, dtype=np.float64)
                    size[some] += np.diff(np.append(at, len(code)))
                best = bits.argmin(axis=1)
                least = bits[np.arange(len(bits)), best]
                names[rows] = np.array(trees.languages, object)[best]
                scores[rows] = 1 / np.exp2(np.maximum(least[:, None] - bits, -1000)).sum(axis=1)
                rates[rows] = least / size
            yield pd.DataFrame({"p": names, "s": scores, "b": rates})

    udf = F.pandas_udf(predict, "p string, s double, b double")
    letters = F.when(F.col("text").rlike(r"\p{L}"), F.lower("text"))
    found = docs.withColumn("_found", udf(letters))
    return found.select(
        *[F.col(f"`{c}`") for c in docs.columns],
        F.col("_found.p").alias(pred), F.col("_found.s").alias(score), F.col("_found.b").alias("bits_per_byte"),
    )


def identify(docs: DataFrame, training: DataFrame, pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """All rows and columns of ``docs`` with ``lang_pred``, ``score`` and ``bits_per_byte``."""
    return _identified(docs, docs.sparkSession.sparkContext.broadcast(train(training)), pred, score)


def limits(docs: DataFrame) -> DataFrame:
    """lang and the highest ``bits_per_byte`` of texts in it: ``TOLERANCE`` times what ``USUAL`` of all labelled rows
    stay below, each priced by trees of the half of ``docs`` (doc_id, text, lang) it isn't in."""
    labelled = docs.select("doc_id", "text", "lang").where("lang is not null and text is not null and doc_id is not null")
    priced = []
    for k in (0, 1):
        shared = docs.sparkSession.sparkContext.broadcast(train(labelled.where(remainder(2) == 1 - k)))
        rates = _identified(labelled.where(remainder(2) == k), shared, "lang_pred", "score")
        priced.append(staged(rates.select("lang", "bits_per_byte").where("bits_per_byte is not null"), "bits"))
        shared.destroy()
    most = priced[0].unionByName(priced[1]).groupBy("lang")
    most = staged(most.agg((TOLERANCE * F.percentile_approx("bits_per_byte", USUAL)).alias("most")), "limits")
    drop(*priced)
    return most


def known_language(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose text has a letter and a code as short as usual for labelled texts of the language that fits
    best; ``lang`` becomes that language. If no row has one, nothing is learned and all texts with a letter stay."""
    most = F.broadcast(limits(docs).select(F.col("lang").alias("_lang"), "most"))  # one row per language
    found = identify(docs, docs, "_lang", "_score")
    # Bits beyond the limit; a text of few bytes can be odd by chance.
    beyond = (F.col("bits_per_byte") - F.col("most")) * F.octet_length(F.lower("text"))
    kept = found.join(most, "_lang", "left").where(
        F.col("text").rlike(r"\p{L}") & (F.coalesce(beyond, F.lit(0)) <= EVIDENCE)
    )
    lang = F.when(F.col("_lang") != UNKNOWN, F.col("_lang")).otherwise(F.col("lang"))
    return kept.withColumn("lang", lang).select(*[F.col(f"`{c}`") for c in docs.columns])


def op1_language_id(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = identify(docs.select("doc_id", "text"), docs.where(remainder(4) != 2))
    return found.select(
        "doc_id", F.coalesce(remainder(4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score", "bits_per_byte"
    )
