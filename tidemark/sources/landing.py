"""Readers of the landed posts, tweets, feeds and pages.

Each network has a reader of files and a parser of a text column (for records that arrive inside another
table or stream). Both are permissive: a broken record gives a row of nulls, which the adapters reject
with a reason. A reader takes all files below its path, so results that came in several pages are whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import config
from tidemark.schema import FB_POST, FB_REACTION, FB_SOURCE, FEED_ITEM, FEED_XML, PAGE, TWEET

#: The text of a record that can't be read, and when a record landed; both may be missing in a frame.
CORRUPT, LANDED = "_corrupt", "_landed"
_MODE = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}


def _kept(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])


def _read_records(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    rows = spark.read.schema(_kept(schema)).options(**_MODE).json(path)
    return rows.withColumn(LANDED, F.col("_metadata.file_modification_time"))


def read_facebook_posts(spark: SparkSession, path: str) -> DataFrame:
    return _read_records(spark, path, FB_POST)


def read_tweets(spark: SparkSession, path: str) -> DataFrame:
    return _read_records(spark, path, TWEET)


def read_sources(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(FB_SOURCE).json(path)


def read_reactions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(FB_REACTION).json(path)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PAGE).parquet(path).withColumn(LANDED, F.col("_metadata.file_modification_time"))


def read_feeds(spark: SparkSession, path: str) -> DataFrame:
    """Entries of feed files. A feed is one file of bounded size, so it is read as one value."""
    files = spark.read.text(path, wholetext=True)
    return parse_feeds(files.withColumn("_href", F.col("_metadata.file_path")), "value", "_href").drop("_href")


def parse_facebook_posts(rows: DataFrame, payload: str, *keep: str) -> DataFrame:
    return rows.select(*keep, F.from_json(payload, _kept(FB_POST), _MODE).alias("_r")).select(*keep, "_r.*")


def parse_tweets(rows: DataFrame, payload: str, *keep: str) -> DataFrame:
    return rows.select(*keep, F.from_json(payload, _kept(TWEET), _MODE).alias("_r")).select(*keep, "_r.*")


def parse_feeds(rows: DataFrame, payload: str, href: str, *keep: str) -> DataFrame:
    """Entries of feeds held as XML text; ``href`` names the column with the address of the feed."""
    feeds = rows.select(
        *keep, F.col(href).alias("_h"), F.col(payload).alias("_text"),
        F.from_xml(F.col(payload), FEED_XML, {"mode": "PERMISSIVE"}).alias("_x"),
    )
    read = F.col("_x.entry").isNotNull() | F.col("_x.channel").isNotNull() | F.col("_x.item").isNotNull()
    atom = F.col("_x.entry").isNotNull()
    entries = feeds.select(
        *keep,
        F.struct(
            F.coalesce("_x.channel.title", "_x.title").alias("title"),
            F.when(atom, _page_of(F.col("_x.link"))).otherwise(F.col("_x.channel.link")).alias("link"),
            F.col("_h").alias("href"),
        ).alias("feed"),
        F.when(~read, F.col("_text")).alias(CORRUPT),
        # A feed that can't be read is one row without an entry.
        F.posexplode_outer(
            F.when(~read, F.array(F.lit(None).cast(FEED_ITEM))).when(atom, F.transform("_x.entry", _atom_item)).otherwise(
                F.transform(F.coalesce("_x.channel.item", "_x.item"), _rss_item)
            )
        ).alias("pos", "_item"),
    ).where("pos is not null")  # a feed without entries has nothing to report
    return entries.select(
        *keep,
        "feed",
        F.col("pos").cast("bigint").alias("pos"),
        *[F.col(f"_item.{f.name}").alias(f.name) for f in FEED_ITEM.fields],
        CORRUPT,
    )


def _item(**fields: Column) -> Column:
    return F.struct(*[fields[f.name].cast(f.dataType).alias(f.name) for f in FEED_ITEM.fields])


def _link(href: Column, kind: Column) -> Column:
    return F.struct(href.alias("href"), kind.alias("type"))


def _rss_item(item: Column) -> Column:
    """The page of an RSS item counts as an HTML link; its enclosures follow."""
    page = F.filter(F.array(_link(item["link"], F.lit("text/html"))), lambda l: l["href"].isNotNull())
    enclosed = F.transform(item["enclosure"], lambda e: _link(e["_url"], e["_type"]))
    body = item["content:encoded"]
    return _item(
        id=item["guid"],
        link=item["link"],
        title=item["title"],
        author=F.coalesce(item["author"], item["dc:creator"]),
        published=item["pubDate"],
        updated=item["dc:date"],
        summary=item["description"],
        content=F.when(body.isNotNull(), F.array(F.struct(body.alias("value")))),
        links=F.concat(page, F.coalesce(enclosed, F.array().cast(FEED_ITEM["links"].dataType))),
    )


def _atom_item(entry: Column) -> Column:
    body = entry["content"]
    return _item(
        id=entry["id"],
        link=_page_of(entry["link"]),
        title=entry["title"],
        author=entry["author"]["name"],
        published=entry["published"],
        updated=entry["updated"],
        summary=entry["summary"],
        content=F.when(body.isNotNull(), F.array(F.struct(body.alias("value")))),
        links=F.transform(
            entry["link"], lambda l: _link(l["_href"], F.coalesce(l["_type"], F.lit("text/html")))
        ),
    )


def _page_of(links: Column) -> Column:
    """Address of the first Atom link that stands for the page itself."""
    pages = F.filter(links, lambda l: F.coalesce(l["_rel"], F.lit("alternate")) == "alternate")
    return F.get(pages, F.lit(0))["_href"]


def feed_urls(spark: SparkSession, urls=config.FEED_URLS) -> DataFrame:
    """The followed feeds; surrounding blanks of an address carry no meaning."""
    return spark.createDataFrame([(u,) for u in urls], "url string").select(F.trim("url").alias("url")).distinct()


def page_lookup(urls: DataFrame, pages: DataFrame) -> DataFrame:
    """``url, html`` for every url; the empty text for a page that is missing or has no body."""
    return urls.join(pages, "url", "left").select("url", html_or_empty(F.col("html")).alias("html"))


def html_or_empty(html: Column) -> Column:
    return F.coalesce(html, F.lit(""))
