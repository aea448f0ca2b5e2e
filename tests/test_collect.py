"""Whole passes over landed records, batch and streaming."""

from __future__ import annotations

import json
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.plans import collect as C
from tidemark.plans import hooks
from tidemark.schema import FB_POST, TWEET
from tidemark.sources import landing
from tidemark.sources.store import Store
from tidemark.streaming import ingest

SPANISH, ENGLISH = "el perro de la casa y el gato", "the dog of the house and the cat"


def post(i, text, hour=0, page="p"):
    return {
        **dict.fromkeys(FB_POST.fieldNames()), "id": str(i), "message": text, "permalink_url": f"http://f.com/{i}",
        "created_time": f"2024-01-01T{hour:02}:00:00+0000", "reactions": {"summary": {"total_count": 1}}, "page_id": page,
    }


def tweet(i, text):
    return {
        **dict.fromkeys(TWEET.fieldNames()), "id": i, "id_str": str(i), "full_text": text,
        "created_at": "Mon Jan 01 00:00:00 +0000 2024", "user": {"screen_name": "ana", "name": "Ana"},
    }


def feed(name, *entries):
    items = "".join(
        f"<item><link>http://r.es/{i}</link><pubDate>Mon, 01 Jan 2024 {h:02}:00:00 GMT</pubDate><description>{t}</description></item>"
        for i, h, t in entries
    )
    return (f"<rss><channel><link>http://r.es/</link>{items}</channel></rss>", name)


def landed(spark, posts=(), profile=(), tweets=(), feeds=(), reactions=()):
    xml = spark.createDataFrame(list(feeds), "x string, h string")
    return C.Landing(
        pages=spark.createDataFrame([], "url string, html string"),
        terms=spark.createDataFrame([("gato", "category", "pets", None), ("perro", "category", "pets", None)], "term string, kind string, label string, weight double"),
        facebook_posts=spark.createDataFrame(list(posts), FB_POST),
        facebook_profile=spark.createDataFrame(list(profile), FB_POST),
        sources=spark.createDataFrame([("p", "Page", "http://f.com/p")], "id string, name string, link string"),
        me=("me", "Me", "http://f.com/me"),
        reactions=spark.createDataFrame(list(reactions), "postID string, reaction string"),
        tweets=spark.createDataFrame(list(tweets), TWEET),
        account="ana",
        entries=landing.parse_feeds(xml, "x", "h"),
    )


def counts(result):
    return {(r.collectorID, r.outcome): r.n for r in result.collect()}


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "store"))


def test_first_and_later_pass(spark, store):
    first = landed(
        spark,
        posts=[post(1, SPANISH), post(2, ENGLISH), post(3, ""), post(4, SPANISH, 1), post(4, SPANISH, 1), {**post(5, SPANISH), "reactions": None}],
        profile=[post(6, SPANISH, 2)],
        tweets=[tweet(10, SPANISH), tweet(11, ""), tweet(9, SPANISH)],
        feeds=[feed("f", (1, 3, SPANISH), (2, 2, ENGLISH), (3, 1, ""))],
        reactions=[("1", "LOVE"), ("1", "LOVE"), ("1", "SAD")],
    )
    got = counts(C.process_all(store, first, at=F.lit(datetime(2024, 1, 1, 2))))
    assert got == {
        ("facebook", "stored"): 3, ("facebook", "other language"): 1, ("facebook", "no text"): 1, ("facebook", "rejected"): 1,
        ("facebook", "duplicate"): 1,
        ("twitter", "stored"): 2, ("twitter", "other language"): 1,
        ("rss", "stored"): 1, ("rss", "other language"): 1, ("rss", "no text"): 1,
    }
    docs = {r.documentID: r for r in store.read().collect()}
    assert set(docs) == {"FB_1", "FB_4", "FB_6", "TW_9", "TW_10", "RSS_http://r.es/1"}
    one = docs["FB_1"]
    assert (one.LOVE, one.SAD, one.WOW, one.type, one.categories) == (2, 1, 0, "interest", ["pets"])
    assert one.summary == one.text == SPANISH + " ." and one.textProcessed == "perro casa gato"
    assert one.textOpinion == "0.0" and one.textOpinionStr == "Neutro" and one.places == [] and one.LIKE == 0
    assert docs["FB_6"].type == "profile" and docs["FB_6"].sourceName == "Me" and docs["TW_9"].type == "profile"

    # Posts are read past the last insert (02:00), tweets past number 10, feeds down to the first old entry.
    later = landed(
        spark,
        posts=[post(1, SPANISH), post(7, SPANISH, 3)],
        tweets=[tweet(10, SPANISH), tweet(12, SPANISH)],
        feeds=[feed("f", (4, 5, SPANISH), (1, 1, SPANISH), (5, 6, SPANISH))],
    )
    got = counts(C.process_all(store, later, at=F.lit(datetime(2024, 1, 1, 9))))
    assert got == {
        ("facebook", "stored"): 1, ("facebook", "before mark"): 1, ("twitter", "stored"): 1, ("twitter", "before mark"): 1,
        ("rss", "stored"): 1, ("rss", "before date"): 2,
    }
    assert set(r.documentID for r in store.read().collect()) == {*docs, "FB_7", "TW_12", "RSS_http://r.es/4"}


def test_no_record_is_lost(spark, store, tmp_path):
    """Broken, id-less, unlisted, repeated and capped records: outcomes add up to what landed, rejects are kept."""
    lines = [json.dumps(post(i, SPANISH, i)) for i in (1, 2, 3, 3)]
    lines += ["{oops", '{"id": ', json.dumps({**post(9, SPANISH), "id": None}), json.dumps(post(8, SPANISH, page="q"))]
    for name, text in (
        ("fb/a.json", "\n".join(lines)),
        ("tw/a.json", "\n".join([json.dumps(tweet(5, SPANISH)), json.dumps(tweet(5, SPANISH)), "broken", json.dumps(tweet(6, ENGLISH))])),
        ("rss/a.xml", feed("", (1, 3, SPANISH))[0]), ("rss/b.xml", "<rss><channel><item>"), ("rss/c.xml", "no feed"),
    ):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(text)
    files = landed(spark)
    files = C.with_batch(
        files, facebook_posts=landing.read_facebook_posts(spark, f"{tmp_path}/fb"), tweets=landing.read_tweets(spark, f"{tmp_path}/tw"),
        entries=landing.read_feeds(spark, f"{tmp_path}/rss"),
    )
    for marks in (C.Marks(), C.Marks("1990-01-01", 1, "1990-01-01")):
        got = counts(C.process_all(store, files, marks=marks, caps=C.Caps(2, 5, 5)))
        sums = {c: sum(n for (k, _), n in got.items() if k == c) for c in ("facebook", "twitter", "rss")}
        assert sums == {"facebook": 8, "twitter": 4, "rss": 3}
        assert got["facebook", "rejected"] == 4 and got["facebook", "duplicate"] == 1
        assert got["twitter", "rejected"] == 1 and got["twitter", "duplicate"] == 1 and got["rss", "rejected"] == 2
    kept = store.rejects().collect()
    # Both passes met the same seven.
    assert len(kept) == 7 and {r.rejectReason for r in kept} >= {"unreadable record", "missing id", "unlisted page", "unreadable feed"}
    assert {"{oops", "broken", "no feed"} <= {r.payload for r in kept}


def test_winners_are_fixed(spark, store):
    """Copies of a post in any order give one result; the own profile counts before another feed."""
    copies = [{**post(1, SPANISH), "shares": {"count": k}} for k in (3, 1, 2)]
    seen = set()
    for order in ([0, 1, 2], [2, 1, 0], [1, 0, 2]):
        rows = landed(spark, posts=[copies[k] for k in order], profile=[post(1, SPANISH)])
        got = C.enriched(C.collect(rows).filter("outcome is null").drop("outcome"), rows.terms).collect()
        assert len(got) == 1 and got[0].type == "profile"
        alone = C.collect(landed(spark, posts=[copies[k] for k in order])).collect()
        seen.add((len(alone), alone[0].shares))
    assert len(seen) == 1


def test_a_collector_that_fails_leaves_the_others_stored(spark, store, tmp_path):
    files = landed(spark, posts=[post(1, SPANISH)], feeds=[feed("f", (1, 3, SPANISH))])
    files = C.with_batch(files, tweets=lambda: landing.read_tweets(spark, f"{tmp_path}/nowhere"))
    got = counts(C.process_all(store, files))
    assert got == {("facebook", "stored"): 1, ("rss", "stored"): 1, ("twitter", "collector failed"): 1}
    assert {r.documentID for r in store.read().collect()} == {"FB_1", "RSS_http://r.es/1"}
    told = store.rejects().collect()
    assert [r.collectorID for r in told] == ["twitter"] and "nowhere" in told[0].rejectReason
    with pytest.raises(Exception, match="nowhere"):
        C.process_all(store, files, strict=True)


def test_what_landed_is_read_once(spark, store, tmp_path):
    """Documents and counts come from one read of the posts, caps and marks included."""
    reads = spark.sparkContext.accumulator(0)
    (tmp_path / "tw").mkdir()
    rows = [tweet(i, SPANISH) for i in (1, 2, 3, 3, 4, 5)]
    (tmp_path / "tw/a.json").write_text("\n".join(json.dumps(r) for r in rows))

    def watched(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    tweets = landing.read_tweets(spark, f"{tmp_path}/tw")
    files = C.with_batch(landed(spark), tweets=tweets.mapInArrow(watched, tweets.schema))
    got = counts(C.process_all(store, files, marks=C.Marks(), caps=C.Caps(1, 2, 1), from_fb=False, from_rss=False))
    assert got == {("twitter", "stored"): 2, ("twitter", "over limit"): 3, ("twitter", "duplicate"): 1}
    assert reads.value == 6


def test_caps_apply_to_the_first_pass_only(spark, store):
    many = landed(
        spark,
        posts=[post(i, SPANISH, i) for i in range(6)],
        tweets=[tweet(i, SPANISH) for i in range(6)],
        feeds=[feed("f", *[(i, 5, SPANISH if i else "") for i in range(6)]), feed("g", (9, 5, SPANISH))],
    )
    caps = C.Caps(facebook=2, twitter=3, rss=4)
    got = counts(C.process_all(store, many, caps=caps, at=F.lit(datetime(2000, 1, 1))))
    # The textless entry is one of the four.
    assert got == {
        ("facebook", "stored"): 2, ("twitter", "stored"): 3, ("rss", "stored"): 4, ("rss", "no text"): 1, ("rss", "over limit"): 2,
        ("facebook", "over limit"): 4, ("twitter", "over limit"): 3,
    }
    got = counts(C.process_all(store, many, marks=C.Marks("2000-01-01", -1, "2000-01-01"), caps=caps))
    assert got[("facebook", "stored")] == got[("twitter", "stored")] == 6 and ("rss", "over limit") not in got


def test_chosen_collectors_and_refresh(spark, store):
    both = landed(spark, posts=[post(1, SPANISH)], tweets=[tweet(1, SPANISH)])
    C.process_all(store, both, from_tw=False, from_rss=False)
    assert [r.documentID for r in store.read().collect()] == ["FB_1"]
    C.refresh_all(store, both, from_fb=False)
    assert [r.documentID for r in store.read().collect()] == ["TW_1"]
    with pytest.raises(ValueError):
        C.collect(both, from_fb=False, from_tw=False, from_rss=False)


def tweet_docs(spark, store):
    def documents(batch):
        whole = C.with_batch(landed(spark), tweets=batch)
        intake = C.collect(whole, C.Marks(None, -1, None), from_fb=False, from_rss=False)
        return C.enriched(intake.filter("outcome is null").drop("outcome"), whole.terms)

    return documents


def test_stream_equals_batch(spark, store, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    batches = [[tweet(1, SPANISH), tweet(2, ENGLISH)], [tweet(3, SPANISH), tweet(1, SPANISH + " blanco")], [tweet(4, SPANISH)]]

    def run():
        stream = ingest.landed_stream(spark, str(folder), TWEET, files=1)
        return ingest.start_ingest(stream, tweet_docs(spark, store), store, str(tmp_path / "checkpoint"), ingest.ONCE)

    for i, rows in enumerate(batches):
        (folder / f"{i}.json").write_text("\n".join(json.dumps(r) for r in rows))
        assert ingest.keep_running(run, restarts=0) == 0
    got = {r.documentID: r.text for r in store.read().collect()}
    assert got == {"TW_1": SPANISH + " blanco .", "TW_3": SPANISH + " .", "TW_4": SPANISH + " ."}
    # Nothing new: nothing is done again.
    before = {r.documentID: r.date for r in store.read().collect()}
    ingest.keep_running(run, restarts=0)
    assert {r.documentID: r.date for r in store.read().collect()} == before


def test_a_failed_batch_is_done_again(spark, store, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "0.json").write_text(json.dumps(tweet(1, SPANISH)))
    tries = []

    def documents(batch):
        tries.append(1)
        if len(tries) == 1:
            raise RuntimeError("lost")
        return tweet_docs(spark, store)(batch)

    def run():
        stream = ingest.landed_stream(spark, str(folder), TWEET)
        return ingest.start_ingest(stream, documents, store, str(tmp_path / "checkpoint"), ingest.ONCE)

    assert ingest.keep_running(run, restarts=2) == 1
    assert [r.documentID for r in store.read().collect()] == ["TW_1"]


def write_lines(path, *records):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(r if isinstance(r, str) else json.dumps(r) for r in records))
    # Files are taken in the order they landed in.
    os.utime(path, (1.7e9 + len(os.listdir(path.parent)),) * 2)


def test_passes_over_streams_equal_one_pass(spark, store, tmp_path):
    """Posts, tweets and feeds as three streams of several files; a batch that comes again changes nothing."""
    kinds = ("facebook_posts", "facebook_profile", "tweets", "entries")
    folders = {kind: str(tmp_path / kind) for kind in kinds}
    write_lines(tmp_path / "facebook_posts/0.json", post(1, SPANISH), post(2, ENGLISH), "{oops")
    write_lines(tmp_path / "facebook_posts/1.json", post(1, SPANISH + " blanco"), post(3, SPANISH), "")
    write_lines(tmp_path / "facebook_profile/0.json", post(4, SPANISH))
    write_lines(tmp_path / "tweets/0.json", tweet(1, SPANISH), tweet(2, ""))
    write_lines(tmp_path / "entries/0.xml", feed("", (1, 3, SPANISH))[0])
    write_lines(tmp_path / "entries/1.xml", feed("", (2, 3, SPANISH))[0])
    write_lines(tmp_path / "entries/2.xml", "no feed")
    tables = C.with_batch(landed(spark), facebook_posts=None, facebook_profile=None, tweets=None, entries=None)

    def run(checkpoint):
        stream = ingest.landed_files(spark, folders, files=1)
        return ingest.start_passes(stream, tables, store, str(tmp_path / checkpoint), ingest.ONCE)

    assert ingest.keep_running(lambda: run("c"), restarts=0) == 0
    content = lambda: {r.documentID: r.asDict(True) for r in store.read().collect()}
    got = content()
    assert {k: v["text"] for k, v in got.items()} == {
        "FB_1": SPANISH + " blanco .", "FB_3": SPANISH + " .", "FB_4": SPANISH + " .", "TW_1": SPANISH + " .",
        "RSS_http://r.es/1": SPANISH, "RSS_http://r.es/2": SPANISH,
    }
    assert got["FB_4"]["type"] == "profile" and got["FB_1"]["categories"] == ["pets"]
    rejects = sorted(r.payload for r in store.rejects().collect())
    assert rejects == ["no feed", "{oops"]
    # The checkpoint is lost: all batches come again.
    run("other").awaitTermination()
    assert content() == got and store.rejects().count() == 2
    with pytest.raises(ValueError):
        ingest.landed_files(spark, {"posts": "x"})


def test_restarts_wait_longer_each_time(monkeypatch):
    waited = []
    monkeypatch.setattr(ingest.clock, "sleep", waited.append)

    class Query:
        def awaitTermination(self):
            raise ingest.StreamingQueryException("lost")

    with pytest.raises(ingest.StreamingQueryException):
        ingest.keep_running(Query, restarts=4, pause=2, longest=10)
    assert waited == [2, 4, 8, 10]


def test_first_sight_across_batches(spark, tmp_path):
    folder, out = tmp_path / "in", tmp_path / "out"
    folder.mkdir()
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("at", T.TimestampNTZType())])
    batches = [
        [("a", "01T00"), ("b", "01T00"), ("a", "01T05")],
        [("b", "01T23"), ("c", "03T00")],
        [("e", "02T23")],
        # Rows are late by the watermark that the batch before this one had: the second day.
        [("d", "01T10"), ("f", "01T11"), ("g", "02T23")],
    ]
    for i, rows in enumerate(batches):
        write_lines(folder / f"{i}.json", *[{"id": x, "at": f"2024-01-{at}:00:00"} for x, at in rows])
    stream = ingest.first_sight(ingest.landed_stream(spark, str(folder), schema, files=1), ["id"], "at", "1 day")
    query = stream.writeStream.format("parquet").option("path", str(out)).option("checkpointLocation", str(tmp_path / "c")).trigger(**ingest.ONCE).start()
    query.awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(str(out)).collect()) == ["a", "b", "c", "e", "g"]
    assert ingest.late_rows(query) == 2
    assert ingest.every() == {"processingTime": "60 minutes"}


def test_user_function_isolates_failures(spark):
    def double(batch):
        if (batch["v"] == 7).any():
            raise ValueError("seven")
        return batch.assign(w=batch["v"] * 2)

    schema = T.StructType([T.StructField("w", T.LongType())])
    rows = hooks.map_documents(spark.range(20).withColumnRenamed("id", "v"), double, schema).collect()
    assert sorted(r.w for r in rows if r.w is not None) == [v * 2 for v in range(20) if v != 7]
    assert [r.error for r in rows if r.error] == ["ValueError: seven"]
