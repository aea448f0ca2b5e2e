"""What a pass and its landing leave on disk while they run."""

from __future__ import annotations

import threading
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from catalog import queries
from tests.test_collect import SPANISH, feed, landed, post, tweet
from tidemark.plans import collect as C
from tidemark.sources import staging
from tidemark.sources.store import Store


@pytest.mark.parametrize("since", [C.Marks(), C.Marks("2023-01-01", 1, "2023-01-01")])
def test_a_pass_drops_what_was_read(spark, tmp_path, monkeypatch, since):
    store, left = Store(spark, str(tmp_path / "store")), []
    plain = Store.upsert
    before = set(staging._STAGED)
    monkeypatch.setattr(Store, "upsert", lambda *given: left.extend(p.rpartition("/")[2] for p in set(staging._STAGED) - before) or plain(*given))
    for takes in ({"posts": [post(i, f"{SPANISH} {i}") for i in (1, 2, 2)]}, {"tweets": [tweet(i, SPANISH) for i in (4, 5)]}, {"feeds": [feed("f", (1, 3, SPANISH))]}):
        given = landed(spark, **takes)
        chosen = {"from_fb": "posts" in takes, "from_tw": "tweets" in takes, "from_rss": "feeds" in takes}
        C.process_all(store, given, marks=since, at=F.lit("2024-01-02").cast("timestamp"), **chosen)
        assert {name.rpartition("-")[0] for name in left} == {"intake", "enriched"}
        left.clear()
    assert store.read().count() == 5 and set(staging._STAGED) == before


def test_folders_are_noted_by_thread(spark):
    with staging.noted() as outer:
        with staging.noted() as inner:
            kept = staging.staged(spark.range(3), "intake")
        other = threading.Thread(target=lambda: staging.staged(spark.range(2), "other"))
        other.start()
        other.join()
    assert len(inner) == 1 and outer == inner and "/intake-" in inner[0]
    assert kept.inputFiles()[0].endswith(".zstd.parquet")
    staging.remove(outer)
    assert not set(inner) & set(staging._STAGED)
    staging.remove([p for p in staging._STAGED if "/other-" in p])


def test_streams_land_packed(spark, tmp_path, monkeypatch):
    taken = []
    monkeypatch.setattr(queries, "shared_dir", lambda spark: str(tmp_path))
    monkeypatch.setattr(queries, "enriched_columns", lambda rows: rows)

    def passes(files, *others):
        taken.append(files.writeStream.foreachBatch(lambda rows, n: taken.extend(r.payload for r in rows.collect())))
        return taken[0].option("checkpointLocation", str(tmp_path / "done")).trigger(availableNow=True).start()

    monkeypatch.setattr(queries.ingest, "start_passes", passes)
    texts = {kind: [f"{kind} {i}\x1e" if kind == "feeds_xml" else f"{kind} {i}" for i in range(9)] for kind in ("facebook_json", "tweets_json", "feeds_xml")}
    frames = {kind: spark.createDataFrame([(x.rstrip("\x1e"),) for x in lines], "payload string") for kind, lines in texts.items()}
    queries.stream_passes(SimpleNamespace(spark=spark, pages=None, terms=None, sources=None, reactions=None, **frames))
    files = [p.name for p in tmp_path.glob("landing-*/*/part-*")]
    assert files and all(name.endswith(".gz") for name in files)
    assert sorted(taken[1:]) == sorted(x.rstrip("\x1e") for lines in texts.values() for x in lines)
