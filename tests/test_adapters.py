from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.operators import adapters as A
from tidemark.schema import FB_POST, NORMALIZED, TWEET
from tidemark.sources import landing
from tests.test_sources import ATOM, RDF, RSS2

PAGE = "<p>" + "word " * 30 + "</p>"


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([("http://a.es/1", PAGE)], "url string, html string")


def fb(**fields):
    base = dict(
        id="1", permalink_url="http://f.com/1", created_time="2018-03-01T10:11:12+0100",
        reactions={"summary": {"total_count": 3}}, page_id="p",
    )
    return {**dict.fromkeys(FB_POST.fieldNames()), **base, **fields}


def fb_docs(spark, pages, *posts):
    rows = spark.createDataFrame(list(posts), FB_POST)
    sources = spark.createDataFrame([("p", "Page", "http://f.com/p")], "id string, name string, link string")
    return {r.postID: r for r in A.facebook_documents(A.source_posts(rows, sources), pages).collect()}


def test_facebook(spark, pages):
    got = fb_docs(
        spark, pages,
        fb(id="1", message=" Hola #ñu, mira http://a.es/1 ", link="http://a.es/1", parent_id="x", shares={"count": 7}),
        fb(id="2", message="", description="Fin.", **{"from": {"id": "9", "name": "Eva"}}),
        fb(id="3", message="  ", link="http://a.es/missing"),
        fb(id="4", message="a", reactions=None),
        fb(id="5", message="b", created_time="soon"),
        fb(id="6", message="c", page_id="not followed"),
    )
    assert set(got) == {"1", "2", "3", "4", "5"}
    one = got["1"]
    assert one.textRaw.startswith('Hola <a href="https://www.facebook.com/hashtag/ñu" target="_blank">#ñu</a>, mira <a href=')
    assert one.textRaw.endswith(f' .<br><div class="alert alert-info">{PAGE}</div>')
    assert one.text == "Hola #ñu, mira  ." + "word " * 30 and one.textSentiment == "Hola #ñu, mira  ."
    assert (one.documentID, one.sourceName, one.postUserId, one.shares, one.isShared) == ("FB_1", "Page", "", 7, True)
    assert one.hashtagEntities == ["#ñu"] and one.links == ["http://a.es/1"] and one.popularity == 3
    assert one.createdAt == datetime(2018, 3, 1, 9, 11, 12) and one.type == "interest" and one.rejectReason is None
    assert got["2"].text == "Fin." and got["2"].postUserName == "Eva" and got["2"].isShared is False and got["2"].links is None
    assert got["3"].text == "" and got["3"].textRaw == "<br>"
    assert got["4"].rejectReason == "missing reactions" and got["5"].rejectReason == "unreadable date"


def test_twitter(spark, pages):
    user = {"screen_name": "ana", "name": "Ana"}
    base = dict(id=1, id_str="1", created_at="Wed Aug 27 13:08:45 +0000 2008", user=user)
    base = {**dict.fromkeys(TWEET.fieldNames()), **base}
    entities = {"urls": [{"expanded_url": "http://a.es/0"}, {"expanded_url": "http://a.es/1"}], "hashtags": [{"text": "x"}]}
    rows = spark.createDataFrame(
        [
            {**base, "full_text": "hi @eva a@b.es", "entities": entities, "retweeted_status": {"user": {"screen_name": "eva", "name": "Eva"}}},
            {**base, "id": 2, "id_str": "2", "full_text": "", "user": {"screen_name": "bob", "name": "Bob"}, "favorite_count": 4},
            {**base, "id": 3, "id_str": "3", "full_text": "x", "user": None},
        ],
        TWEET,
    )
    got = {r.postID: r for r in A.twitter_documents(rows, pages, "ana").collect()}
    one, two, three = got["1"], got["2"], got["3"]
    link = '<a href="https://twitter.com/{0}" target="_blank">@{0}</a>'
    assert one.textRaw == f"hi {link.format('eva')} a{link.format('b.es')} . <br> <br>" + f'<div class="alert alert-info">{PAGE}</div>'
    assert (one.type, one.isShared, one.originalUserId, one.postUserId) == ("profile", True, "eva", "ana")
    assert one.hashtagEntities == ["#x"] and one.links == ["http://a.es/0", "http://a.es/1"] and one.shares == 0
    assert one.url == "https://twitter.com/ana/status/1" and one.postIDNum == 1 and one.sourceUrl == "https://twitter.com/ana"
    assert (two.type, two.isShared, two.popularity, two.text, two.rejectReason) == ("interest", False, 4, "", None)
    assert two.links == [] and three.rejectReason == "missing user"
    assert A.drop_textless(A.twitter_documents(rows, pages, "ana")).count() == 3


def test_feeds(spark):
    feeds = spark.createDataFrame([(RSS2, "h1"), (ATOM, "h2"), (RDF, "h3")], "x string, h string")
    now = F.lit("2000-01-01").cast("timestamp")
    docs = A.feed_documents(landing.parse_feeds(feeds, "x", "h"), now)
    assert docs.columns == [*NORMALIZED.fieldNames(), "_feed", "_pos"]
    got = {r.documentID: r for r in docs.collect()}
    one, two, atom, old = got["RSS_n1"], got["RSS_http://www.news.es/2"], got["RSS_urn:1"], got["RSS_http://old.org/i"]
    assert one.text == one.textSentiment == "long & whole" and one.textRaw == "<p>long &amp; whole</p>"
    assert (one.sourceId, one.sourceName, one.sourceUrl) == ("news.es", "news.es", "http://www.news.es/")
    assert one.createdAt == datetime(2018, 3, 5, 8, 7, 6) and two.createdAt == datetime(2000, 1, 1)
    assert one.links == ["http://www.news.es/1"] and atom.links == ["http://b.com/e"] and atom.postUserName == "Eva"
    # The short domain of a single-letter host still needs a label of two or three letters.
    assert atom.sourceId == "b.com" and old.createdAt == datetime(2018, 3, 5, 7, 7, 6)
    assert {r.rejectReason for r in got.values()} == {None}


def test_incomplete_entries_are_rejected_one_by_one(spark):
    item = "<item>{}</item>"
    feed = "<rss><channel><link>{}</link>{}</channel></rss>"
    body = "<description>x</description>"
    items = item.format(body) + item.format("<link>http://a.es/2</link>") + item.format("<link>http://a.es/3</link>" + body)
    untyped = item.format("<link>http://a.es/4</link>" + body + '<enclosure url="u"/>')
    rows = spark.createDataFrame(
        [(feed.format("http://a.es/", items + untyped), "h"), (feed.format("nowhere", item.format("<link>http://a.es/5</link>" + body)), "g")],
        "x string, h string",
    )
    got = {(r._feed, r._pos): r.rejectReason for r in A.feed_documents(landing.parse_feeds(rows, "x", "h")).collect()}
    assert got == {
        ("h", 0): "missing link", ("h", 1): "missing text", ("h", 2): None, ("h", 3): "link without type",
        ("g", 0): "feed without domain",
    }
