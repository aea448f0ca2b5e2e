"""The phrase graph's workers get short Arrow batches and give their memory back."""

from __future__ import annotations

import zlib

import numpy as np

from tidemark.llm import collocations, ngram_join


def test_phrase_counts_keep_workers_small(spark, monkeypatch):
    setting, given = "spark.sql.execution.arrow.maxBytesPerBatch", []
    plain, before = collocations.lean, spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    monkeypatch.setattr(collocations, "lean", lambda run: given.append(run.__name__) or plain(run))
    docs = spark.createDataFrame([("a b c. a b", "en"), (None, None)] * 40, "text string, lang string")
    try:
        spark.conf.set(setting, "64m")
        graph = collocations.graph(docs)
        assert int(spark.conf.get(setting).rstrip("b")) <= 4 << 20
    finally:
        spark.conf.set(setting, before)
    assert given == ["count", "send"]
    assert {(r.lang, r.k, r.phrase): r.f for r in graph.counts.collect()}["en", 2, "a b"] == 80


def test_a_tasks_cells_take_few_bytes():
    """A task's table comes back as it was, in far fewer bytes than its plain compression takes."""
    rng = np.random.default_rng(2)
    for share in (0, 0.01, 0.2, 1):
        cells = np.where(rng.random(1 << 16) < share, np.minimum(rng.zipf(2, 1 << 16), 30), 0).astype(np.uint8)
        sent = collocations.packed(cells)
        assert (collocations.unpacked(*sent) == cells).all()
        if share == 0.2:
            assert sum(map(len, sent)) < 0.75 * len(zlib.compress(cells.tobytes(), 1))


def test_count_tables_are_right(spark):
    """The counts of n-grams leave a task chunk by chunk, and are right."""
    docs = spark.createDataFrame([(f"w{i % 7} a b c d e",) for i in range(300)], "text string")
    classes = ngram_join.gram_classes(docs)
    own = np.concatenate(ngram_join.sets([f"w{i % 7} a b c d e" for i in range(300)]))
    cells = np.bincount((own >> ngram_join.SHIFT).astype(np.int64), minlength=ngram_join.CELLS)
    want = np.ceil(np.log2(np.maximum(cells / (8 + 2 * cells.mean()), 1))).astype(np.uint8)
    assert (classes == want).all() and classes.max() > 0
