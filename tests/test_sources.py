from __future__ import annotations

import json

from pyspark.sql import functions as F

from tidemark.sources import landing

RSS2 = """<?xml version="1.0" encoding="UTF-8"?>
<rss version="2.0" xmlns:dc="http://purl.org/dc/elements/1.1/" xmlns:content="http://purl.org/rss/1.0/modules/content/">
 <channel>
  <title>News</title><link>http://www.news.es/</link><description>d</description>
  <item>
   <title>One</title><link>http://www.news.es/1</link><guid isPermaLink="false">n1</guid>
   <dc:creator>Ana</dc:creator><pubDate>Mon, 05 Mar 2018 08:07:06 GMT</pubDate>
   <description>short</description><content:encoded><![CDATA[<p>long &amp; whole</p>]]></content:encoded>
   <enclosure url="http://www.news.es/1.mp3" type="audio/mpeg" length="1"/>
  </item>
  <item><title>Two</title><link>http://www.news.es/2</link><description>&lt;b&gt;two&lt;/b&gt;</description></item>
 </channel>
</rss>"""
ATOM = """<feed xmlns="http://www.w3.org/2005/Atom">
 <title>Blog</title><link rel="self" href="http://b.com/feed"/><link href="http://b.com/"/>
 <entry><id>urn:1</id><title>E</title><link href="http://b.com/e"/><link rel="related" type="text/plain" href="http://b.com/t"/>
  <author><name>Eva</name></author><published>2018-03-05T08:07:06Z</published><updated>2018-03-06T08:07:06Z</updated>
  <summary>s</summary></entry>
</feed>"""
RDF = """<rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" xmlns="http://purl.org/rss/1.0/" xmlns:dc="http://purl.org/dc/elements/1.1/">
 <channel rdf:about="x"><title>Old</title><link>http://old.org/</link></channel>
 <item rdf:about="y"><title>I</title><link>http://old.org/i</link><description>text</description><dc:date>2018-03-05T08:07:06+01:00</dc:date></item>
</rdf:RDF>"""


def test_feed_files(spark, tmp_path):
    for name, text in (("a.xml", RSS2), ("b.xml", ATOM), ("c.xml", RDF), ("d.xml", "not a feed")):
        (tmp_path / name).write_text(text, encoding="utf-8")
    rows = landing.read_feeds(spark, str(tmp_path)).orderBy("feed.title", "pos").collect()
    broken, blog, one, two, old = rows  # what is no feed is a row of its own
    assert broken.link is None and broken._corrupt == "not a feed" and one._corrupt is None
    assert (one.feed.title, one.feed.link, one.pos, one.id, one.author) == ("News", "http://www.news.es/", 0, "n1", "Ana")
    assert one.published == "Mon, 05 Mar 2018 08:07:06 GMT" and one.updated is None
    assert one.summary == "short" and [c.value for c in one.content] == ["<p>long &amp; whole</p>"]
    assert [(l.type, l.href) for l in one.links] == [("text/html", "http://www.news.es/1"), ("audio/mpeg", "http://www.news.es/1.mp3")]
    assert (two.pos, two.id, two.summary, two.content) == (1, None, "<b>two</b>", None)
    assert (blog.feed.link, blog.id, blog.link, blog.author) == ("http://b.com/", "urn:1", "http://b.com/e", "Eva")
    assert [(l.type, l.href) for l in blog.links] == [("text/html", "http://b.com/e"), ("text/plain", "http://b.com/t")]
    assert (blog.published, blog.updated, blog.content) == ("2018-03-05T08:07:06Z", "2018-03-06T08:07:06Z", None)
    assert (old.feed.link, old.link, old.updated) == ("http://old.org/", "http://old.org/i", "2018-03-05T08:07:06+01:00")
    assert one.feed.href.endswith("/a.xml")


def test_json_files_come_from_all_pages_and_survive_broken_lines(spark, tmp_path):
    for page in range(3):
        (tmp_path / f"{page}.json").write_text(json.dumps({"id": f"p{page}", "from": {"id": "1", "name": "A"}}) + "\n{oops\n")
    rows = landing.read_facebook_posts(spark, str(tmp_path)).collect()
    assert sorted(r.id for r in rows if r.id) == ["p0", "p1", "p2"] and len(rows) == 6
    tweets = tmp_path / "t"
    tweets.mkdir()
    (tweets / "t.json").write_text(json.dumps({"id": 5, "id_str": "5", "entities": {"urls": [{"expanded_url": "u"}]}}))
    assert landing.read_tweets(spark, str(tweets)).first().entities.urls[0].expanded_url == "u"


def test_feed_urls_and_page_lookup(spark):
    assert [r.url for r in landing.feed_urls(spark, ["http://a.es/x ", " http://a.es/x"]).collect()] == ["http://a.es/x"]
    assert landing.feed_urls(spark).filter(F.col("url").rlike(r"\s")).count() == 0
    urls = spark.createDataFrame([("u1",), ("u2",), ("u3",)], "url string")
    pages = spark.createDataFrame([("u1", "<p>"), ("u2", None)], "url string, html string")
    assert {r.url: r.html for r in landing.page_lookup(urls, pages).collect()} == {"u1": "<p>", "u2": "", "u3": ""}
