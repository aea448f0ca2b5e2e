"""Byte-level BPE by recursive DuckDB queries inside Spark partitions.

Encoding: the matches of the vocabulary's pattern become rows (word, position, token), one per byte at first. A
recursive query joins neighbouring tokens to the merge table and contracts each word's leftmost pair of least rank until
no pair is left. Words are encoded once per worker while memory of them lasts (``KEPT_BYTES``). Decoding: ids are joined
to the vocabulary and put together by an ordered aggregation, pieces of ``PIECE_TOKENS`` of a long document each by
itself. ``encode`` and ``decode`` are jobs of their own; ``round_trip`` does both in one worker with one database.

A recursion costs a round per merge, so matches of more than ``LONG_BYTES`` (no usual word has as many) are contracted
in the same order with a heap instead.

Nulls, ties and other cases: a null text is an empty one and has no ids; equal ranks are taken from the left; equal
rows have equal results; special tokens' strings are ordinary text; an empty table gives no rows; other columns of the
input are not read. Very long texts are cut at spaces, where the pattern always begins a new match.
"""

from __future__ import annotations

import base64
import functools
import heapq
import re
from collections.abc import Iterator
from itertools import chain

import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import slices, small_batches, table

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
LONG_BYTES = 256
#: Memory of words that were encoded, all told, and the longest part of a text that is remembered.
KEPT_BYTES = 96 << 20
KEPT_CHARS = 64
#: What an entry of that memory takes beside its characters and ids.
_ENTRY_BYTES = 220
#: Bytes of words, and tokens of documents, that one query takes.
BLOCK_BYTES = 200_000
PIECE_TOKENS = 200_000
DATABASE_MB = 160

#: The last space of a run before something else than space.
_LAST_SPACE = re.compile(r" (?=\S)")
_SPACES = re.compile(r" (?:\s|\Z)")

ENCODE = """
WITH RECURSIVE t(w, pos, tok, step) AS (
  SELECT w, pos, tok, 0 FROM start
  UNION ALL
  (WITH pairs AS (
     SELECT w, pos, tok, lead(tok) OVER o AS right_tok, lead(pos) OVER o AS right_pos, lead(w) OVER o AS right_w
     FROM t WINDOW o AS (ORDER BY w, pos)),
   least AS (  -- the rank, then the place, of each word's pair; positions are below 1024
     SELECT w, min(id::BIGINT * 1048576 + pos * 1024 + right_pos) AS pair
     FROM pairs JOIN merges ON left_id = tok AND right_id = right_tok
     WHERE w = right_w GROUP BY w)
   SELECT t.w, t.pos, CASE WHEN t.pos = (pair // 1024) % 1024 THEN (pair // 1048576)::INT ELSE t.tok END, t.step + 1
   FROM t JOIN least ON t.w = least.w
   WHERE t.pos <> pair % 1024)
)
SELECT t.w, t.tok FROM t JOIN (SELECT w, max(step) AS step FROM t GROUP BY w) USING (w, step) ORDER BY t.w, t.pos
"""
DECODE = """
SELECT piece, string_agg(hex, '' ORDER BY pos) AS hex FROM tokens JOIN vocabulary USING (id) GROUP BY piece
"""


def ranks(vocabulary: str) -> dict[bytes, int]:
    import public_tokenizers

    with open(public_tokenizers.path(vocabulary), "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def _database() -> duckdb.DuckDBPyConnection:
    # Blocks are sized for memory; nothing spills to a folder of the machine.
    limits = {"threads": 1, "memory_limit": f"{DATABASE_MB}MB", "temp_directory": "", "preserve_insertion_order": False}
    return duckdb.connect(config=limits)


def _ids32(values) -> pa.Array:
    return pa.array(values, pa.int32())


class Encoder:
    def __init__(self, vocabulary: str):
        from public_tokenizers import PATTERN

        self.findall = regex.compile(PATTERN).findall
        self.rank = ranks(vocabulary)
        left, right, both = [], [], []
        for token, number in self.rank.items():
            for k in range(1, len(token)):
                a, b = self.rank.get(token[:k]), self.rank.get(token[k:])
                if a is not None and b is not None:
                    left.append(a), right.append(b), both.append(number)
        self.db = _database()
        merges = pa.table({"left_id": _ids32(left), "right_id": _ids32(right), "id": _ids32(both)})  # noqa: F841
        self.db.execute("CREATE TABLE merges AS SELECT * FROM merges")
        self.byte = np.array([self.rank[bytes([b])] for b in range(256)], np.int32)
        self.words: dict[str, bytes] = {}
        self.kept = 0

    def _query(self, words: list[bytes]) -> list[bytes]:
        raw = np.frombuffer(b"".join(words), np.uint8)
        size = np.array([len(w) for w in words])
        start = pa.table(  # noqa: F841  read by the query
            {
                "w": np.repeat(np.arange(len(words), dtype=np.int32), size),
                "pos": (np.arange(len(raw)) - np.repeat(np.cumsum(size) - size, size)).astype(np.int32),
                "tok": self.byte[raw],
            }
        )
        found = self.db.sql(ENCODE).to_arrow_table()
        flat = found["tok"].to_numpy().astype("<u4").tobytes()
        ends = np.searchsorted(found["w"].to_numpy(), np.arange(len(words) + 1)).tolist()
        return [flat[4 * a : 4 * b] for a, b in zip(ends[:-1], ends[1:])]

    def _long(self, word: bytes) -> bytes:
        tokens: list[bytes | None] = [word[i : i + 1] for i in range(len(word))]
        after, before = list(range(1, len(word) + 1)), list(range(-1, len(word) - 1))
        heap: list[tuple] = []

        def offer(left: int) -> None:
            right = after[left]
            if left >= 0 and right < len(tokens):
                number = self.rank.get(tokens[left] + tokens[right])
                if number is not None:
                    heapq.heappush(heap, (number, left, right, len(tokens[left]) + len(tokens[right])))

        for k in range(len(word) - 1):
            offer(k)
        while heap:
            _, left, right, size = heapq.heappop(heap)
            if tokens[left] is None or after[left] != right or tokens[right] is None:
                continue
            if len(tokens[left]) + len(tokens[right]) != size:
                continue
            tokens[left], tokens[right] = tokens[left] + tokens[right], None
            after[left] = after[right]
            if after[left] < len(tokens):
                before[after[left]] = left
            offer(left)
            if before[left] >= 0:
                offer(before[left])
        return np.array([self.rank[t] for t in tokens if t is not None], "<u4").tobytes()

    def learn(self, matches: set[str]) -> dict[str, bytes]:
        """Ids of every one of ``matches``."""
        found: dict[str, bytes] = {}
        block: list[str] = []
        raws: list[bytes] = []
        size = 0
        for match in matches:
            raw = match.encode()
            if len(raw) > LONG_BYTES:
                found[match] = self._long(raw)
                continue
            block.append(match), raws.append(raw)
            size += len(raw)
            if size >= BLOCK_BYTES:
                found.update(zip(block, self._query(raws)))
                block, raws, size = [], [], 0
        if block:
            found.update(zip(block, self._query(raws)))
        return found

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text, little-endian unsigned 32-bit."""
        if self.kept > KEPT_BYTES:
            self.words.clear()
            self.kept = 0
        words = self.words
        split = [self._units(t) if t else [] for t in texts]
        units = set().union(*split).difference(words)
        parts = dict(zip(units, map(self.findall, units)))
        found = self.learn(set(chain.from_iterable(parts.values())).difference(words))
        words.update(found)
        for unit, matches in parts.items():
            if len(matches) != 1:
                found[unit] = words[unit] = b"".join(map(words.__getitem__, matches))
        ids = [b"".join(map(words.__getitem__, units)) for units in split]
        for part in found:
            if len(part) > KEPT_CHARS:
                del words[part]
            else:
                self.kept += len(part) + len(found[part]) + _ENTRY_BYTES
        return ids

    @staticmethod
    def _units(text: str) -> list[str]:
        """Parts of a text that are encoded alone: a match begins at each space before something else than space."""
        first, *words = _LAST_SPACE.split(text) if _SPACES.search(text) else text.split(" ")
        return [first, *[" " + w for w in words]] if first else [" " + w for w in words]


class Decoder:
    def __init__(self, rank: dict[bytes, int], db: duckdb.DuckDBPyConnection):
        self.db = db
        known = pa.table({"id": _ids32(rank.values()), "hex": [t.hex() for t in rank]})  # noqa: F841  read by the query
        db.execute("CREATE TABLE vocabulary AS SELECT * FROM known")

    def _query(self, pieces: list[np.ndarray]) -> list[bytes]:
        size = np.array([len(p) for p in pieces])
        tokens = pa.table(  # noqa: F841  read by the query
            {
                "piece": np.repeat(np.arange(len(pieces), dtype=np.int32), size),
                "pos": (np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)).astype(np.int32),
                "id": np.concatenate(pieces).astype(np.int32),
            }
        )
        out = [b""] * len(pieces)
        for piece, text in self.db.execute(DECODE).fetchall():
            out[piece] = bytes.fromhex(text)
        return out

    def decode(self, ids: list[bytes]) -> list[bytes]:
        """The bytes that the ids of each document stand for."""
        out: list[list[bytes]] = [[] for _ in ids]
        owners: list[int] = []
        pieces: list[np.ndarray] = []
        held = 0

        def flush() -> None:
            for owner, raw in zip(owners, self._query(pieces)):
                out[owner].append(raw)

        for doc, packed in enumerate(ids):
            tokens = np.frombuffer(packed, "<u4")
            for begin in range(0, len(tokens), PIECE_TOKENS):
                owners.append(doc), pieces.append(tokens[begin : begin + PIECE_TOKENS])
                held += len(pieces[-1])
                if held >= PIECE_TOKENS:
                    flush()
                    owners, pieces, held = [], [], 0
        if pieces:
            flush()
        return [b"".join(parts) for parts in out]


def encode(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, n_tokens and ``ids`` (little-endian unsigned 32-bit) of every document."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = None
        for batch in slices(batches, 4 << 20):
            encoder = encoder or Encoder(vocabulary)
            ids = encoder.encode(batch["text"].tolist())
            yield pd.DataFrame(
                {"doc_id": batch["doc_id"].astype("Int64"), "n_tokens": [len(i) // 4 for i in ids], "ids": ids}
            )

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInPandas(
        run, "doc_id bigint, n_tokens bigint, ids binary"
    )


def decode(encoded: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """``encoded`` (doc_id, n_tokens, ids) with the bytes the ids stand for in ``decoded``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        decoder = None
        for batch in batches:
            decoder = decoder or Decoder(ranks(vocabulary), _database())
            yield batch.assign(doc_id=batch["doc_id"].astype("Int64"), decoded=decoder.decode(batch["ids"].tolist()))

    return encoded.mapInPandas(run, "doc_id bigint, n_tokens bigint, ids binary, decoded binary")


@functools.lru_cache(maxsize=1)
def _both(vocabulary: str) -> tuple[Encoder, Decoder]:
    """One of each for all tasks of a worker, so that words learned in one are known in the next."""
    encoder = Encoder(vocabulary)
    return encoder, Decoder(encoder.rank, encoder.db)


def round_trip(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """What ``decode(encode(docs))`` gives, by one Python worker a task."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in slices(batches, 2 << 20):
            encoder, decoder = _both(vocabulary)
            ids = encoder.encode(batch["text"].tolist())
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"].astype("Int64"),
                    "n_tokens": [len(i) // 4 for i in ids],
                    "ids": ids,
                    "decoded": decoder.decode(ids),
                }
            )

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInPandas(
        run, "doc_id bigint, n_tokens bigint, ids binary, decoded binary"
    )


def op5_byte_bpe(spark, sf_dir) -> DataFrame:
    both = round_trip(table(spark, sf_dir, "documents"))
    return both.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )
