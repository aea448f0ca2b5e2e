"""Schemas of the landed inputs and of the unified document."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _L, _B = T.StringType(), T.LongType(), T.BooleanType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


# `from` is a Python keyword, hence the dict.
FB_POST = _struct(
    id=_S,
    message=_S,
    description=_S,
    link=_S,
    permalink_url=_S,
    created_time=_S,
    parent_id=_S,
    **{"from": _struct(id=_S, name=_S)},
    shares=_struct(count=_L),
    reactions=_struct(summary=_struct(total_count=_L)),
    page_id=_S,
)

FB_SOURCE = _struct(id=_S, name=_S, link=_S)

FB_REACTION = _struct(postID=_S, reaction=_S)

TWEET = _struct(
    id=_L,
    id_str=_S,
    full_text=_S,
    created_at=_S,
    user=_struct(screen_name=_S, name=_S),
    entities=_struct(
        urls=T.ArrayType(_struct(expanded_url=_S)),
        hashtags=T.ArrayType(_struct(text=_S)),
    ),
    retweeted_status=_struct(user=_struct(screen_name=_S, name=_S)),
    favorite_count=_L,
    retweet_count=_L,
)

FEED_ITEM = _struct(
    id=_S,
    link=_S,
    title=_S,
    author=_S,
    published=_S,
    updated=_S,
    summary=_S,
    content=T.ArrayType(_struct(value=_S)),
    links=T.ArrayType(_struct(href=_S, type=_S)),
)

#: A feed file as XML: RSS 2.0 (`rss/channel/item`), RSS 1.0 (items beside the channel) or Atom (`feed/entry`).
_ENCLOSURE = T.ArrayType(_struct(_url=_S, _type=_S))
_RSS_ITEM = _struct(
    **{
        "title": _S,
        "link": _S,
        "guid": _S,
        "author": _S,
        "dc:creator": _S,
        "pubDate": _S,
        "dc:date": _S,
        "description": _S,
        "content:encoded": _S,
        "enclosure": _ENCLOSURE,
    }
)
_ATOM_LINK = T.ArrayType(_struct(_href=_S, _rel=_S, _type=_S))
_ATOM_ENTRY = _struct(
    id=_S,
    title=_S,
    link=_ATOM_LINK,
    author=_struct(name=_S),
    published=_S,
    updated=_S,
    summary=_S,
    content=_S,
)
FEED_XML = _struct(
    channel=_struct(title=_S, link=_S, item=T.ArrayType(_RSS_ITEM)),
    item=T.ArrayType(_RSS_ITEM),
    title=_S,
    link=_ATOM_LINK,
    entry=T.ArrayType(_ATOM_ENTRY),
)

PAGE = _struct(url=_S, html=_S)

#: The reaction types, in the order of the output columns.
REACTIONS = ("LOVE", "HAHA", "LIKE", "SAD", "ANGRY", "WOW")

#: The collectors and the prefixes of their document ids.
FACEBOOK, TWITTER, RSS = "facebook", "twitter", "rss"
ID_PREFIX = {FACEBOOK: "FB_", TWITTER: "TW_", RSS: "RSS_"}

_NORMALIZED = dict(
    documentID=_S,
    collectorID=_S,
    sourceId=_S,
    sourceName=_S,
    sourceUrl=_S,
    textRaw=_S,
    text=_S,
    textSentiment=_S,
    createdAt=T.TimestampType(),
    url=_S,
    postID=_S,
    postIDNum=_L,
    postUserId=_S,
    postUserName=_S,
    originalUserId=_S,
    links=T.ArrayType(_S),
    shares=_L,
    isShared=_B,
    hashtagEntities=T.ArrayType(_S),
    popularity=_L,
    **{name: _L for name in REACTIONS},
    type=_S,
    rejectReason=_S,
)

#: What the adapters emit: a document plus the reason it cannot be used, if any.
NORMALIZED = _struct(**_NORMALIZED)

_ENRICHMENT = dict(
    places=T.ArrayType(_S),
    organizations=T.ArrayType(_S),
    people=T.ArrayType(_S),
    textOpinion=_S,
    textOpinionStr=_S,
    summary=_S,
    textProcessed=_S,
    categories=T.ArrayType(_S),
)

#: What the store holds; ``date`` is the insert time.
DOCUMENT = _struct(
    **{name: kind for name, kind in _NORMALIZED.items() if name != "rejectReason"},
    **_ENRICHMENT,
    date=T.TimestampType(),
)
