"""Landed records of each network to unified documents.

Every adapter keeps all its rows. One the network sent incomplete gets a ``rejectReason`` instead of
stopping the collector.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import dates as D
from tidemark.functions import text as X
from tidemark.operators import keys as K
from tidemark.operators.links import quote_links
from tidemark.sources.landing import CORRUPT
from tidemark.schema import FACEBOOK, ID_PREFIX, NORMALIZED, REACTIONS, RSS, TWITTER

PROFILE, INTEREST = "profile", "interest"


def first_reason(**tests: Column) -> Column:
    """Name of the first test that holds (underscores read as spaces), null when none does."""
    return F.coalesce(*[F.when(test, F.lit(name.replace("_", " "))) for name, test in tests.items()])


def clean_texts(rows: DataFrame, **columns: str) -> DataFrame:
    """Add ``target=source`` columns: tags out, references decoded, spaces collapsed, then URLs out."""
    bare = rows.withColumns({f"_bare_{t}": X.remove_tags(F.col(s)) for t, s in columns.items()})
    decoded = bare.withColumns({f"_text_{t}": X.decode_entities(F.col(f"_bare_{t}")) for t in columns})
    cleaned = K.compute_once(
        decoded, **{t: X.remove_urls(X.collapse_spaces(F.col(f"_text_{t}"))) for t in columns}
    )
    return cleaned.drop(*[f"_{step}_{t}" for step in ("bare", "text") for t in columns])


def post_texts(posts: DataFrame, network: str, joiner: str) -> DataFrame:
    """``textRaw``, ``text`` and ``textSentiment`` of posts with ``_said`` (stripped) and ``quotes``."""
    closed = posts.withColumn("_post", X.terminate(F.col("_said")))
    raw = closed.withColumn(
        "textRaw",
        X.remove_scripts(F.concat_ws(joiner, X.linkify(F.col("_post"), network), F.col("quotes"))),
    )
    return clean_texts(raw, text="textRaw", textSentiment="_post")


def conform(rows: DataFrame, *keep: str) -> DataFrame:
    """The columns of the unified schema, in its order, then ``keep``; what a network lacks is null."""
    have = set(rows.columns)
    return rows.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in NORMALIZED.fields
        ],
        *keep,
    )


def source_posts(posts: DataFrame, sources: DataFrame) -> DataFrame:
    """Posts of the followed sources with the attributes of their source."""
    return all_posts(posts, sources).filter("_listed").drop("_listed")


def all_posts(posts: DataFrame, sources: DataFrame) -> DataFrame:
    """All posts, with the attributes of their source where it is followed and ``_listed``, whether it is."""
    named = sources.select(
        F.col("id").alias("page_id"), F.col("name").alias("sourceName"), F.col("link").alias("sourceUrl"),
        F.lit(True).alias("_listed"),
    )
    joined = K.dimension_join(posts, named, "page_id", "left")
    return joined.withColumn("_listed", F.coalesce("_listed", F.lit(False)))


def payload(rows: DataFrame, reason: Column) -> Column:
    """What landed of a rejected record: its text if that can't be read, else its fields."""
    corrupt = F.col(CORRUPT) if CORRUPT in rows.columns else F.lit(None).cast("string")
    own = [F.col(f"`{c}`") for c in rows.columns if not c.startswith("_")]
    return F.when(reason.isNotNull(), F.coalesce(corrupt, F.to_json(F.struct(*own))))


def facebook_documents(
    posts: DataFrame, pages: DataFrame, counts: DataFrame | None = None, kind: str = INTEREST, landed: bool = False
) -> DataFrame:
    """``posts`` carry ``page_id, sourceName, sourceUrl`` (see :func:`source_posts`). With ``landed``, rejected records
    keep what landed of them in ``payload``.

    ``counts`` has one row per post with a column per reaction kind; without it the kinds stay null.
    """
    said = posts.withColumns(
        {
            "_said": X.strip(X.first_nonempty(F.col("message"), F.col("description"))),
            "links": F.when(F.col("link") != "", F.array("link")),
        }
    )
    if counts is not None:
        # Before the texts of a post become several.
        found = counts.select(F.col("postID").alias("_counted"), *REACTIONS)
        said = said.join(found, F.col("id") == F.col("_counted"), "left").drop("_counted").withColumns(
            {r: F.coalesce(F.col(r), F.lit(0)) for r in REACTIONS}
        )
    texts = post_texts(quote_links(said, pages), FACEBOOK, "<br>")
    created = D.facebook_date(F.col("created_time"))
    reason = first_reason(
        unreadable_record=_corrupt(posts),
        missing_id=F.col("id").isNull(),
        unlisted_page=~F.col("_listed") if "_listed" in posts.columns else F.lit(False),
        missing_permalink=F.col("permalink_url").isNull(),
        unreadable_date=created.isNull(),
        missing_reactions=F.col("reactions.summary.total_count").isNull(),
    )
    docs = texts.select(
        F.concat(F.lit(ID_PREFIX[FACEBOOK]), "id").alias("documentID"),
        F.lit(FACEBOOK).alias("collectorID"),
        F.col("page_id").alias("sourceId"),
        "sourceName",
        "sourceUrl",
        "textRaw",
        "text",
        "textSentiment",
        created.alias("createdAt"),
        F.col("permalink_url").alias("url"),
        F.col("id").alias("postID"),
        F.coalesce("from.id", F.lit("")).alias("postUserId"),
        F.coalesce("from.name", F.lit("")).alias("postUserName"),
        "links",
        F.coalesce("shares.count", F.lit(0)).alias("shares"),
        facebook_is_shared(F.col("parent_id")).alias("isShared"),
        X.hashtags(F.col("text")).alias("hashtagEntities"),
        F.col("reactions.summary.total_count").alias("popularity"),
        F.lit(kind).alias("type"),
        reason.alias("rejectReason"),
        payload(posts, reason).alias("payload"),
        *[r for r in REACTIONS if counts is not None],
    )
    return conform(docs, *["payload"] * landed)


def _corrupt(rows: DataFrame) -> Column:
    return F.col(CORRUPT).isNotNull() if CORRUPT in rows.columns else F.lit(False)


def facebook_is_shared(parent_id: Column) -> Column:
    return F.coalesce(parent_id, F.lit("")) != ""


def tweet_type(screen_name: Column, account: str) -> Column:
    return F.when(screen_name == account, F.lit(PROFILE)).otherwise(F.lit(INTEREST))


def twitter_documents(tweets: DataFrame, pages: DataFrame, account: str, landed: bool = False) -> DataFrame:
    """``account`` is the screen name whose own tweets are its profile."""
    said = tweets.withColumns(
        {
            "_said": X.strip(F.coalesce("full_text", F.lit(""))),
            "links": F.coalesce(
                F.transform("entities.urls", lambda u: u["expanded_url"]), F.array().cast("array<string>")
            ),
        }
    )
    texts = post_texts(quote_links(said, pages), TWITTER, " <br>")
    created = D.twitter_date(F.col("created_at"))
    name = F.col("user.screen_name")
    reason = first_reason(
        unreadable_record=_corrupt(tweets),
        missing_id=F.col("id").isNull() | F.col("id_str").isNull(),
        missing_text=F.col("full_text").isNull(),
        missing_user=name.isNull(),
        unreadable_date=created.isNull(),
    )
    return conform(
        texts.select(
            F.concat(F.lit(ID_PREFIX[TWITTER]), "id_str").alias("documentID"),
            F.lit(TWITTER).alias("collectorID"),
            name.alias("sourceId"),
            F.col("user.name").alias("sourceName"),
            F.concat(F.lit(X.PROFILE_BASE), name).alias("sourceUrl"),
            "textRaw",
            "text",
            "textSentiment",
            created.alias("createdAt"),
            F.concat(F.lit(X.PROFILE_BASE), name, F.lit("/status/"), "id_str").alias("url"),
            F.col("id_str").alias("postID"),
            F.col("id").alias("postIDNum"),
            name.alias("postUserId"),
            F.col("user.name").alias("postUserName"),
            F.col("retweeted_status.user.screen_name").alias("originalUserId"),
            "links",
            F.coalesce("retweet_count", F.lit(0)).alias("shares"),
            F.col("retweeted_status").isNotNull().alias("isShared"),
            F.coalesce(
                F.transform("entities.hashtags", lambda h: F.concat(F.lit("#"), h["text"])),
                F.array().cast("array<string>"),
            ).alias("hashtagEntities"),
            F.coalesce("favorite_count", F.lit(0)).alias("popularity"),
            tweet_type(name, account).alias("type"),
            reason.alias("rejectReason"),
            payload(tweets, reason).alias("payload"),
        ),
        *["payload"] * landed,
    )


def html_links(links: Column) -> Column:
    """Addresses of the links of type ``text/html``."""
    return F.coalesce(
        F.transform(F.filter(links, lambda l: l["type"] == "text/html"), lambda l: l["href"]),
        F.array().cast("array<string>"),
    )


def feed_documents(
    entries: DataFrame, now: Column | None = None, landed: bool = False, keep: tuple[str, ...] = ()
) -> DataFrame:
    """``entries`` as :func:`tidemark.sources.landing.parse_feeds` gives them.

    ``now`` dates the entries that carry no readable date. ``_feed`` and ``_pos`` stay in the result, for
    caps and date stops, and so do the columns of ``keep``.
    """
    now = F.current_timestamp() if now is None else now
    body = F.when(F.size("content") > 0, F.get("content", F.lit(0))["value"]).otherwise(F.col("summary"))
    texts = clean_texts(entries.withColumn("textRaw", X.remove_scripts(body)), text="textRaw")
    domain = X.url_domain(F.col("feed.link"))
    post_id = F.coalesce("id", "link")
    reason = first_reason(
        unreadable_feed=_corrupt(entries),
        missing_link=F.col("link").isNull(),
        missing_text=F.col("textRaw").isNull(),
        feed_without_domain=domain.isNull(),
        link_without_type=F.coalesce(F.exists("links", lambda l: l["type"].isNull()), F.lit(False)),
    )
    return conform(
        texts.select(
            F.concat(F.lit(ID_PREFIX[RSS]), post_id).alias("documentID"),
            F.lit(RSS).alias("collectorID"),
            domain.alias("sourceId"),
            domain.alias("sourceName"),
            F.col("feed.link").alias("sourceUrl"),
            "textRaw",
            "text",
            F.col("text").alias("textSentiment"),
            D.feed_created_at(F.col("published"), F.col("updated"), now).alias("createdAt"),
            F.col("link").alias("url"),
            post_id.alias("postID"),
            F.coalesce("author", F.lit("")).alias("postUserId"),
            F.coalesce("author", F.lit("")).alias("postUserName"),
            html_links(F.col("links")).alias("links"),
            reason.alias("rejectReason"),
            payload(entries, reason).alias("payload"),
            F.col("feed.href").alias("_feed"),
            F.col("pos").alias("_pos"),
            *keep,
        ),
        "_feed",
        "_pos",
        *["payload"] * landed,
        *keep,
    )


def union_documents(parts: list[DataFrame]) -> DataFrame:
    """All documents of all parts, duplicates included; columns a part lacks are null."""
    first, *rest = parts
    for part in rest:
        first = first.unionByName(part, allowMissingColumns=True)
    return first


def drop_textless(docs: DataFrame) -> DataFrame:
    """Documents with text; tweets stay even without."""
    return docs.filter(has_text())


def has_text() -> Column:
    return (F.col("collectorID") == TWITTER) | (F.col("text") != "")
