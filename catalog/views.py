"""Landed records derived from the given tables.

Every document stands for one Facebook post, one tweet and one feed entry. Author, tag and time come from
the event of the same number; the linked pages from ``pages``; documents labelled toxic arrive without text
and those of low quality incomplete, so that the rules for missing data have rows to work on.
:mod:`catalog.views_sql` says the same in SQL.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemark.operators import keys as K
from tidemark.session import prepare
from tidemark.sources import landing

ACCOUNT = "user7"
#: Ids per crawl of the feeds; a feed file holds at most this many entries.
CRAWL = 1000
#: Tags whose feed entries show the body of their page.
WITH_BODY = ("click", "purchase")
REACTION_OF = {"signup": "LOVE", "purchase": "WOW", "error": "ANGRY", "view": "LIKE", "click": "HAHA"}

# Parameter tables of the enrichment queries. Entities come from `benchmark`, see `Views.terms`.
POLARITY = {
    **dict.fromkeys("trash pathetic worthless disgusting".split(), -1.0),
    **dict.fromkeys("idiot stupid clown scum loser moron".split(), -0.5),
    **dict.fromkeys("mente bodo zu with".split(), 0.5),
    **dict.fromkeys("para pour für".split(), 1.0),
}
CATEGORIES = {
    "travel": "por para rr osa".split(),
    "science": "ción ciónes del con".split(),
    "insults": "trash scum moron idiot".split(),
}


class Views:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = prepare(spark)
        self.dir = sf_dir

    def table(self, name: str) -> DataFrame:
        rows = self.spark.read.parquet(f"{self.dir}/{name}.parquet")
        return K.spread(rows) if name in ("documents", "pages") else rows

    @cached_property
    def pages(self) -> DataFrame:
        return self.table("pages").select("url", "html")

    def _raw(self, name: str) -> DataFrame:
        """A table as its files lie, for what is shuffled next anyway."""
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    def _posts(self, *, html: bool = False) -> DataFrame:
        """Posts; with ``html`` also the body of the first page where a feed entry shows it.

        All that a post takes from other tables is put together by document number first, without the text, which then
        travels once.
        """
        documents, pages = self._raw("documents"), self._raw("pages")
        n_pages = pages.agg(F.count(F.lit(1))).scalar()
        events = self._raw("events").select(
            F.col("event_id").alias("doc_id"), "user_id", F.col("event_type").alias("tag"), F.col("ts").alias("created_at")
        )
        first = pages.select(F.col("page_id").alias("_p1"), F.col("url").alias("_url1"))
        second = pages.select(F.col("page_id").alias("_p2"), F.col("url").alias("_url2"))
        facts = (
            events.join(documents.select("doc_id"), "doc_id", "left_semi")
            .join(self._raw("labels"), "doc_id", "left")
            .withColumn("_p1", F.col("doc_id") % n_pages)
            .withColumn("_p2", (F.col("doc_id") + 1) % n_pages)
            .join(second, "_p2")
            .join(first, "_p1")
        )
        if html:
            facts = facts.join(pages.select(F.col("page_id").alias("_p1"), "html"), "_p1").withColumn(
                "html", F.when(F.col("tag").isin(*WITH_BODY), F.col("html"))
            )
        rows = documents.select("doc_id", "text", "source", "lang").join(facts, "doc_id")
        link = F.when(F.col("tag") != "signup", F.col("_url1"))
        shared = F.col("tag") == "purchase"
        said = F.concat(
            "text", F.lit(" "), F.coalesce(link, F.lit("")), F.lit(" #"), "tag", F.lit(" @user"), "user_id"
        )
        return rows.select(
            F.col("doc_id").alias("post_id"),
            F.col("source").alias("source_id"),
            "lang",
            "user_id",
            "tag",
            "created_at",
            link.alias("link"),
            F.when(shared, F.col("_url2")).alias("link2"),
            F.when(F.coalesce("toxic", F.lit(0)) == 1, F.lit("")).otherwise(said).alias("text"),
            shared.alias("is_shared"),
            (F.coalesce("quality", F.lit(1)) == 1).alias("complete"),
            F.col("_p1").alias("page_id"),
            *["html"] * html,
        )

    @cached_property
    def posts(self) -> DataFrame:
        return self._posts()

    @cached_property
    def sources(self) -> DataFrame:
        return self.table("documents").select("source").distinct().select(
            F.col("source").alias("id"),
            F.upper("source").alias("name"),
            F.concat(F.lit("https://www.facebook.com/"), "source").alias("link"),
        )

    @cached_property
    def reactions(self) -> DataFrame:
        n_docs = self.table("documents").agg(F.count(F.lit(1))).scalar()
        kinds = F.create_map(*[F.lit(x) for pair in REACTION_OF.items() for x in pair])
        return self.table("events").select(
            (F.col("event_id") % n_docs).cast("string").alias("postID"),
            F.try_element_at(kinds, F.col("event_type")).alias("reaction"),
        )

    @cached_property
    def facebook_json(self) -> DataFrame:
        post = F.struct(
            F.col("post_id").cast("string").alias("id"),
            F.when(F.col("tag") == "view", F.lit("")).otherwise(F.col("text")).alias("message"),
            F.when(F.col("tag") == "view", F.col("text")).alias("description"),
            "link",
            F.concat(F.lit("https://www.facebook.com/"), "source_id", F.lit("/posts/"), "post_id").alias("permalink_url"),
            F.concat(F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+0000")).alias("created_time"),
            F.when(F.col("is_shared"), F.concat("source_id", F.lit("_"), "post_id")).otherwise(F.lit("")).alias("parent_id"),
            F.when(
                F.col("tag") != "error",
                F.struct(F.col("user_id").cast("string").alias("id"), F.concat(F.lit("User "), "user_id").alias("name")),
            ).alias("from"),
            F.when(F.col("tag") != "error", F.struct(F.col("user_id").alias("count"))).alias("shares"),
            F.when(
                F.col("complete"), F.struct(F.struct((F.col("user_id") * 3).alias("total_count")).alias("summary"))
            ).alias("reactions"),
            F.col("source_id").alias("page_id"),
        )
        return self.posts.select(F.to_json(post).alias("payload"))

    @cached_property
    def facebook_posts(self) -> DataFrame:
        return landing.parse_facebook_posts(self.facebook_json, "payload")

    @cached_property
    def tweets_json(self) -> DataFrame:
        name, shown = F.concat(F.lit("user"), "user_id"), F.concat(F.lit("User "), "user_id")
        urls = F.filter(F.array("link", "link2"), lambda u: u.isNotNull())
        tweet = F.struct(
            F.col("post_id").alias("id"),
            F.col("post_id").cast("string").alias("id_str"),
            F.col("text").alias("full_text"),
            F.date_format("created_at", "EEE MMM dd HH:mm:ss '+0000' yyyy").alias("created_at"),
            F.when(F.col("complete"), F.struct(name.alias("screen_name"), shown.alias("name"))).alias("user"),
            F.struct(
                F.transform(urls, lambda u: F.struct(u.alias("expanded_url"))).alias("urls"),
                F.array(F.struct(F.col("tag").alias("text"))).alias("hashtags"),
            ).alias("entities"),
            F.when(
                F.col("is_shared"),
                F.struct(F.struct(F.col("source_id").alias("screen_name"), F.upper("source_id").alias("name")).alias("user")),
            ).alias("retweeted_status"),
            F.col("user_id").alias("favorite_count"),
            F.when(F.col("tag") != "error", F.col("user_id") * 2).alias("retweet_count"),
        )
        return self.posts.select(F.to_json(tweet).alias("payload"))

    @cached_property
    def tweets(self) -> DataFrame:
        return landing.parse_tweets(self.tweets_json, "payload")

    @cached_property
    def feeds_xml(self) -> DataFrame:
        """One RSS file per source and crawl."""
        posts = self._posts(html=True)
        enclosure = F.when(F.col("tag").isin("click", "purchase"), F.concat(
            F.lit('<enclosure url="'), _escaped(F.col("link")), F.lit('" type="'),
            F.when(F.col("tag") == "click", F.lit("audio/mpeg")).otherwise(F.lit("text/html")), F.lit('"/>'),
        ))
        item = F.concat_ws(
            "",
            F.lit("<item>"),
            _element("title", F.concat(F.lit("Entry "), "post_id")),
            _element("link", F.when(F.col("complete"), _entry_link())),
            _element("guid", F.when(F.col("tag") != "error", F.concat(F.lit("guid-"), "post_id"))),
            _element("author", F.when(F.col("tag") != "view", F.concat(F.lit("user"), "user_id"))),
            _element(
                "pubDate",
                F.when(F.col("tag") != "signup", F.date_format("created_at", "EEE, dd MMM yyyy HH:mm:ss 'GMT'")),
            ),
            _element("dc:date", F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ss'Z'")),
            _element("description", F.col("text")),
            _element("content:encoded", F.col("html")),
            enclosure,
            F.lit("</item>"),
        )
        crawl = F.floor(F.col("post_id") / CRAWL)
        files = posts.groupBy("source_id", crawl.alias("crawl")).agg(
            F.array_sort(F.collect_list(F.struct("post_id", item.alias("item")))).alias("items")
        )
        return files.select(
            F.concat(F.lit("https://feeds.example.org/"), "source_id", F.lit("/"), "crawl").alias("href"),
            F.concat(
                F.lit('<rss version="2.0" xmlns:dc="http://purl.org/dc/elements/1.1/" '),
                F.lit('xmlns:content="http://purl.org/rss/1.0/modules/content/"><channel>'),
                _element("title", F.col("source_id")),
                _element("link", F.concat(F.lit("https://"), "source_id", F.lit(".org/"))),
                F.array_join(F.transform("items", lambda i: i["item"]), ""),
                F.lit("</channel></rss>"),
            ).alias("payload"),
        )

    @cached_property
    def entries(self) -> DataFrame:
        return landing.parse_feeds(self.feeds_xml, "payload", "href")

    @cached_property
    def terms(self) -> DataFrame:
        """Word lists: entities are the openings of the benchmark passages, the rest are parameters."""
        words = F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0))
        openings = self.table("benchmark").select(words.alias("w"))

        def opening(length: int, kind: str) -> DataFrame:
            return openings.filter(F.size("w") >= length).select(
                F.array_join(F.slice("w", 1, length), " ").alias("term"), F.lit(kind).alias("kind")
            ).distinct()

        entities = (
            opening(1, "place").union(opening(2, "person")).union(opening(3, "organization"))
            .select("term", "kind", F.lit(None).cast("string").alias("label"), F.lit(None).cast("double").alias("weight"))
        )
        listed = [(t, "polarity", None, w) for t, w in POLARITY.items()]
        listed += [(t, "category", label, None) for label, terms in CATEGORIES.items() for t in terms]
        return entities.unionByName(
            self.spark.createDataFrame(listed, "term string, kind string, label string, weight double")
        )

    @cached_property
    def in_feed_order(self) -> DataFrame:
        """Posts with their place in the feed file of their source."""
        order = W.partitionBy("source_id", "crawl").orderBy("post_id")
        return self.posts.withColumn("crawl", F.floor(F.col("post_id") / CRAWL)).withColumn(
            "pos", (F.row_number().over(order) - 1).cast("bigint")
        )


def _entry_link():
    return F.concat(F.lit("https://"), "source_id", F.lit(".org/p/"), "post_id")


def _escaped(text):
    for mark, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        text = F.replace(text, F.lit(mark), F.lit(entity))
    return text


def _element(name, value):
    return F.concat(F.lit(f"<{name}>"), _escaped(value), F.lit(f"</{name}>"))
