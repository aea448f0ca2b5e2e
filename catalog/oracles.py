"""SQL twins of the registered queries, for DuckDB over the same tables."""

from __future__ import annotations

from catalog import views_sql as V
from catalog.queries import CAP, SINCE, SINCE_ID
from tidemark import config
from tidemark.schema import REACTIONS

ORACLES: dict[str, str] = {}


def oracle(name: str, select: str, *ctes: str) -> None:
    ORACLES[name] = (f"WITH {', '.join(c.strip() for c in ctes)}\n" if ctes else "") + select


POSTS = V.POSTS

# --- sources ---------------------------------------------------------------------------------------

oracle(
    "src_fb_json",
    """SELECT CAST(post_id AS VARCHAR) AS id, CASE WHEN tag = 'view' THEN '' ELSE text END AS message,
      CASE WHEN tag = 'view' THEN text END AS description, link,
      'https://www.facebook.com/' || source_id || '/posts/' || post_id AS permalink_url,
      strftime(created_at, '%Y-%m-%dT%H:%M:%S+0000') AS created_time,
      CASE WHEN is_shared THEN source_id || '_' || post_id ELSE '' END AS parent_id,
      CASE WHEN tag <> 'error' THEN CAST(user_id AS VARCHAR) END AS from_id,
      CASE WHEN tag <> 'error' THEN 'User ' || user_id END AS from_name,
      CASE WHEN tag <> 'error' THEN user_id END AS shares,
      CASE WHEN complete THEN user_id * 3 END AS reactions, source_id AS page_id
    FROM posts""",
    POSTS,
)
oracle(
    "src_tweet_json",
    """SELECT post_id AS id, CAST(post_id AS VARCHAR) AS id_str, text AS full_text,
      strftime(created_at, '%a %b %d %H:%M:%S +0000 %Y') AS created_at,
      CASE WHEN complete THEN 'user' || user_id END AS screen_name,
      CASE WHEN complete THEN 'User ' || user_id END AS name,
      concat_ws('|', link, link2) AS urls, tag AS hashtags,
      CASE WHEN is_shared THEN source_id END AS retweeted, user_id AS favorite_count,
      CASE WHEN tag <> 'error' THEN user_id * 2 END AS retweet_count
    FROM posts""",
    POSTS,
)
_LINKS = """concat_ws('|', 'text/html ' || entry_link, enclosed_type || ' ' || link)"""
oracle(
    "src_feed_xml",
    f"""SELECT feed_href, source_id AS feed_title, feed_link, pos, guid AS id, entry_link AS link,
      'Entry ' || post_id AS title, author, published, updated, trim(text) AS summary, content, {_LINKS} AS links
    FROM entries""",
    POSTS,
    V.ENTRIES,
)
oracle(
    "source_post_join",
    """SELECT CAST(post_id AS VARCHAR) AS id, source_id AS page_id, upper(source_id) AS "sourceName",
      'https://www.facebook.com/' || source_id AS "sourceUrl"
    FROM posts""",
    POSTS,
)
oracle(
    "scan_all_capped",
    f'SELECT "documentID", "collectorID", "sourceId", "date" FROM stored LIMIT {config.SCAN_CAP}',
    POSTS,
    V.STORED,
)

# --- projections and filters -----------------------------------------------------------------------

_FB_COLUMNS = """'FB_' || post_id AS "documentID", 'facebook' AS "collectorID", source_id AS "sourceId",
  upper(source_id) AS "sourceName", 'https://www.facebook.com/' || source_id AS "sourceUrl",
  text_out AS text, sentiment AS "textSentiment", date_trunc('second', created_at) AS "createdAt",
  'https://www.facebook.com/' || source_id || '/posts/' || post_id AS url, CAST(post_id AS VARCHAR) AS "postID",
  CASE WHEN tag = 'error' THEN '' ELSE CAST(user_id AS VARCHAR) END AS "postUserId",
  CASE WHEN tag = 'error' THEN '' ELSE 'User ' || user_id END AS "postUserName",
  coalesce(link, '') AS links, reason AS "rejectReason" """
_TW_COLUMNS = """'TW_' || post_id AS "documentID", 'twitter' AS "collectorID",
  CASE WHEN complete THEN 'user' || user_id END AS "sourceId", CASE WHEN complete THEN 'User ' || user_id END AS "sourceName",
  CASE WHEN complete THEN 'https://twitter.com/user' || user_id END AS "sourceUrl",
  text_out AS text, sentiment AS "textSentiment", date_trunc('second', created_at) AS "createdAt",
  CASE WHEN complete THEN 'https://twitter.com/user' || user_id || '/status/' || post_id END AS url,
  CAST(post_id AS VARCHAR) AS "postID", CASE WHEN complete THEN 'user' || user_id END AS "postUserId",
  CASE WHEN complete THEN 'User ' || user_id END AS "postUserName",
  concat_ws('|', link, link2) AS links, reason AS "rejectReason" """
_RSS_COLUMNS = """'RSS_' || coalesce(guid, entry_link) AS "documentID", 'rss' AS "collectorID", source_id || '.org' AS "sourceId",
  source_id || '.org' AS "sourceName", feed_link AS "sourceUrl",
  text_out AS text, text_out AS "textSentiment", date_trunc('second', created_at) AS "createdAt",
  entry_link AS url, coalesce(guid, entry_link) AS "postID", coalesce(author, '') AS "postUserId",
  coalesce(author, '') AS "postUserName",
  concat_ws('|', entry_link, CASE WHEN enclosed_type = 'text/html' THEN link END) AS links, reason AS "rejectReason" """
_TYPE = f"CASE WHEN complete AND 'user' || user_id = {V.ACCOUNT_SQL} THEN 'profile' ELSE 'interest' END"
_COUNTS = ", ".join(f"""coalesce(r."{k}", 0) AS "{k}" """ for k in REACTIONS)
_PIVOT = "pivoted AS (SELECT \"postID\", " + ", ".join(
    f"""count(*) FILTER (reaction = '{k}') AS "{k}" """ for k in REACTIONS
) + ' FROM reactions GROUP BY "postID")'
_TAGS = rf"array_to_string(regexp_extract_all(text_out, '#{V.TAG_WORD}'), '|')"

oracle(
    "normalize_fb",
    f"""SELECT {_FB_COLUMNS}, CASE WHEN tag = 'error' THEN 0 ELSE user_id END AS shares, is_shared AS "isShared",
      {_TAGS} AS "hashtagEntities", CASE WHEN complete THEN user_id * 3 END AS popularity, {_COUNTS}, 'interest' AS type
    FROM fb_docs LEFT JOIN pivoted r ON r."postID" = CAST(post_id AS VARCHAR)""",
    POSTS, V.REACTIONS, _PIVOT, V.PARAGRAPHS, V.FACEBOOK_DOCS,
)
oracle(
    "normalize_tweet",
    f"""SELECT {_TW_COLUMNS}, post_id AS "postIDNum", CASE WHEN is_shared THEN source_id END AS "originalUserId",
      CASE WHEN tag = 'error' THEN 0 ELSE user_id * 2 END AS shares, is_shared AS "isShared",
      '#' || tag AS "hashtagEntities", user_id AS popularity, {_TYPE} AS type
    FROM tw_docs""",
    POSTS, V.PARAGRAPHS, V.TWITTER_DOCS,
)
oracle("normalize_feed", f"SELECT {_RSS_COLUMNS} FROM rss_docs", POSTS, V.ENTRIES, V.FEED_DOCS)

_EVERY_DOC = (POSTS, V.ENTRIES, V.PARAGRAPHS, V.FACEBOOK_DOCS, V.TWITTER_DOCS, V.FEED_DOCS)
oracle(
    "filter_nonempty",
    """SELECT 'FB_' || post_id AS "documentID", 'facebook' AS "collectorID", text_out AS text FROM fb_docs WHERE text_out <> ''
    UNION ALL SELECT 'TW_' || post_id, 'twitter', text_out FROM tw_docs
    UNION ALL SELECT 'RSS_' || coalesce(guid, entry_link), 'rss', text_out FROM rss_docs WHERE text_out <> ''""",
    *_EVERY_DOC,
)
oracle(
    "union_collectors",
    f"""SELECT 'facebook' AS "collectorID", 'interest' AS type, count(*) AS n, count(*) AS with_shares, count(DISTINCT post_id) AS ids FROM fb_docs
    UNION ALL SELECT 'twitter', {_TYPE}, count(*), count(*), count(DISTINCT post_id) FROM tw_docs GROUP BY {_TYPE}
    UNION ALL SELECT 'rss', NULL, count(*), 0, count(DISTINCT coalesce(guid, entry_link)) FROM rss_docs""",
    *_EVERY_DOC,
)
oracle("text_pick", "SELECT CAST(post_id AS VARCHAR) AS id, text FROM posts", POSTS)
oracle(
    "is_shared",
    "SELECT CAST(post_id AS VARCHAR) AS id, is_shared AS fb_shared, is_shared AS tw_shared FROM posts",
    POSTS,
)
oracle("post_type", f"SELECT CAST(post_id AS VARCHAR) AS id_str, {_TYPE} AS type FROM posts", POSTS)
oracle(
    "html_links",
    """SELECT 'Entry ' || post_id AS title,
      concat_ws('|', entry_link, CASE WHEN enclosed_type = 'text/html' THEN link END) AS links FROM entries""",
    POSTS, V.ENTRIES,
)
_LANGUAGES = V.languages("documents", "doc_id", "text")
oracle("lang_gate", "SELECT doc_id, language FROM languages WHERE language = 'Spanish'", _LANGUAGES)
oracle("lang_detect", "SELECT doc_id, language FROM languages", _LANGUAGES)
oracle(
    "collector_subset",
    f"""SELECT 'TW_' || post_id AS "documentID", 'twitter' AS "collectorID",
      CASE WHEN NOT complete THEN 'rejected' END AS outcome
    FROM posts WHERE post_id > {SINCE_ID}""",
    POSTS,
)

# --- joins -----------------------------------------------------------------------------------------

oracle(
    "link_expand",
    f"""SELECT post_id, count(url) AS n_links, count(said) AS n_quoted,
      CAST(sum(CASE WHEN url IS NULL THEN NULL ELSE coalesce(length({V.collapse("body")}), 0) END) AS BIGINT) AS n_chars,
      bool_or(CASE WHEN url IS NOT NULL THEN said IS NOT NULL END) AS closed
    FROM (
      SELECT post_id, l.url, c.said, c.body
      FROM (SELECT post_id, unnest([link, link2]) AS url FROM posts) l LEFT JOIN content c ON c.url = l.url
    ) GROUP BY post_id""",
    POSTS, V.PARAGRAPHS,
)
oracle(
    "opinion_label",
    f"""SELECT doc_id, code, {V.LABEL.format(code="code")} AS label FROM (
      SELECT doc_id, CAST(CAST((quality * 2 - toxic * 3 - 1) / 2.0 AS DOUBLE) AS VARCHAR) AS code FROM labels)""",
)

# --- aggregations, windows, limits, unions ---------------------------------------------------------

oracle(
    "reaction_pivot",
    f"""SELECT CAST(post_id AS VARCHAR) AS "postID", {_COUNTS}
    FROM posts LEFT JOIN pivoted r ON r."postID" = CAST(post_id AS VARCHAR)""",
    POSTS, V.REACTIONS, _PIVOT,
)
oracle("popularity_total", 'SELECT "postID", count(*) AS popularity FROM reactions GROUP BY "postID"', V.REACTIONS)
oracle(
    "high_water_mark",
    """SELECT "collectorID", max("date") AS "lastDate", max("postIDNum") AS "lastPostID", max("createdAt") AS "lastCreatedAt"
    FROM stored GROUP BY "collectorID" """,
    POSTS, V.STORED,
)
oracle(
    "limit_per_source",
    f"""SELECT source_id, post_id FROM posts
    QUALIFY row_number() OVER (PARTITION BY source_id ORDER BY created_at DESC, post_id DESC) <= {CAP}""",
    POSTS,
)
oracle(
    "limit_by_position",
    f"SELECT feed_href, pos, 'Entry ' || post_id AS title FROM entries WHERE pos < {CAP}",
    POSTS, V.ENTRIES,
)
oracle(
    "limit_global",
    f"SELECT post_id AS id, CAST(post_id AS VARCHAR) AS id_str FROM posts ORDER BY post_id DESC LIMIT {config.TWITTER_CAP}",
    POSTS,
)
oracle(
    "initial_or_incremental",
    f"""SELECT 'initial' AS run, source_id, post_id FROM posts
    QUALIFY row_number() OVER (PARTITION BY source_id ORDER BY post_id DESC) <= {CAP}
    UNION ALL SELECT 'incremental', source_id, post_id FROM posts WHERE post_id > {SINCE_ID}""",
    POSTS,
)
oracle(
    "incremental_since",
    f"""SELECT "documentID", s."collectorID", "createdAt" FROM stored s LEFT JOIN (
      SELECT "collectorID", max("createdAt") AS mark FROM stored WHERE "createdAt" < TIMESTAMP '{SINCE}' GROUP BY ALL
    ) m ON m."collectorID" = s."collectorID" WHERE mark IS NULL OR "createdAt" > mark""",
    POSTS, V.STORED,
)
oracle(
    "takewhile_since",
    f"""SELECT source_id, post_id, dated AS "createdAt" FROM (
      SELECT *, max(CASE WHEN dated < TIMESTAMP '{SINCE}' THEN 1 ELSE 0 END)
        OVER (PARTITION BY source_id ORDER BY post_id DESC ROWS UNBOUNDED PRECEDING) AS stopped
      FROM (SELECT *, CASE WHEN is_shared THEN TIMESTAMP '{SINCE}' + INTERVAL 1 DAY ELSE created_at END AS dated FROM posts)
    ) WHERE stopped = 0""",
    POSTS,
)

# --- text ------------------------------------------------------------------------------------------

oracle("url_extract", f"SELECT post_id, array_to_string(regexp_extract_all(text, '{V.URL}'), '|') AS urls FROM posts", POSTS)
oracle("url_remove", f"SELECT post_id, {V.remove_urls('text')} AS text FROM posts", POSTS)
oracle(
    "linkify",
    f"SELECT post_id, {V.linkify('text', 'facebook')} AS facebook, {V.linkify('text', 'twitter')} AS twitter FROM posts",
    POSTS,
)
oracle(
    "hashtag_extract",
    rf"SELECT post_id, array_to_string(regexp_extract_all(text, '#{V.TAG_WORD}'), '|') AS hashtags FROM posts",
    POSTS,
)
oracle(
    "url_domain",
    f"""SELECT page_id, nullif(regexp_extract(url, '^{V.URL}', 1), '') AS domain,
      regexp_extract(url, '^https?://([^/?#:]+)', 1) AS host FROM pages""",
)
oracle("script_strip", f"SELECT page_id, {V.remove_scripts('html')} AS html FROM pages")
oracle(
    "page_text",
    f"SELECT page_id, {V.collapse(V.decode(V.remove_tags(V.remove_scripts('html'))))} AS text FROM pages",
)
oracle(
    "text_terminate",
    f"SELECT post_id, {V.terminate('said')} AS text FROM (SELECT post_id, {V.strip('text')} AS said FROM posts)",
    POSTS,
)
oracle(
    "clean_text",
    f"""SELECT post_id, raw AS "textRaw", {V.clean("raw")} AS text, {V.clean("post")} AS "textSentiment" FROM (
      SELECT post_id, post, {V.remove_scripts(V.linkify("post", "facebook"))} AS raw FROM (
        SELECT post_id, {V.terminate("said")} AS post FROM (SELECT post_id, {V.strip("text")} AS said FROM posts)))
    WHERE {V.clean("raw")} <> ''""",
    POSTS,
)
oracle(
    "date_parse",
    """SELECT CAST(post_id AS VARCHAR) AS id, date_trunc('second', created_at) AS fb,
      date_trunc('second', created_at) AS tw, date_trunc('second', created_at) AS rss FROM posts""",
    POSTS,
)

# --- pages -----------------------------------------------------------------------------------------

oracle(
    "page_paragraphs",
    "SELECT page_id, pos, text, length(text) AS n_chars, length(text) > 100 AS is_content FROM paragraphs",
    V.PARAGRAPHS,
)
oracle(
    "page_main_content",
    f"""SELECT p.page_id, count(g.page_id) AS n_paragraphs,
      coalesce({V.collapse("string_agg(g.text, '' ORDER BY g.pos)")}, '') AS text
    FROM pages p LEFT JOIN paragraphs g ON g.page_id = p.page_id AND length(g.text) > 100 GROUP BY p.page_id""",
    V.PARAGRAPHS,
)

# --- enrichment ------------------------------------------------------------------------------------

_TOLD = (V.TERMS, V.term_matches("documents", "doc_id", "text", "text"))
oracle(
    "entity_lookup",
    """SELECT doc_id, places, organizations, people FROM told
    WHERE places <> '' OR organizations <> '' OR people <> ''""",
    *_TOLD,
)
oracle(
    "opinion_score",
    f"""SELECT doc_id, {V.OPINION} AS "textOpinion", {V.LABEL.format(code=V.OPINION)} AS "textOpinionStr"
    FROM documents d LEFT JOIN told USING (doc_id)""",
    *_TOLD,
)
oracle("category_match", "SELECT doc_id, categories FROM told WHERE categories <> ''", *_TOLD)
oracle("summary_extract", "SELECT doc_id, summary FROM summaries", V.summaries("documents", "doc_id", "text"))
_EVERY = ", ".join(repr(w) for w in sorted({w for ws in config.STOPWORDS.values() for w in ws}))
_STORED_WORDS = ", ".join(repr(w) for w in config.STOPWORDS[config.STORED_LANGUAGE])


def _processed(text: str, listed: str) -> str:
    return f"array_to_string(list_filter({V.words(text)}, lambda w: NOT list_contains([{listed}], w)), ' ')"


oracle("text_processed", f"""SELECT doc_id, {_processed("text", _EVERY)} AS "textProcessed" FROM documents""")

# A document id appears once per collector: ids of posts are unique, and so are those of feed entries.
_DOCS = """
docs AS (
  SELECT 'FB_' || post_id AS id, 'facebook' AS collector, text_out AS text, sentiment, reason FROM fb_docs
  UNION ALL SELECT 'TW_' || post_id, 'twitter', text_out, sentiment, reason FROM tw_docs
  UNION ALL SELECT 'RSS_' || coalesce(guid, entry_link), 'rss', text_out, text_out, reason FROM rss_docs
)"""
_USABLE = "usable AS (SELECT * FROM docs WHERE reason IS NULL AND (collector = 'twitter' OR text <> ''))"
_SPANISH = "spanish AS (SELECT u.* FROM usable u JOIN languages USING (id) WHERE language = 'Spanish')"
_ALL_DOCS = (POSTS, V.PARAGRAPHS, V.ENTRIES, V.FACEBOOK_DOCS, V.TWITTER_DOCS, V.FEED_DOCS, _DOCS)
oracle(
    "enrich_documents",
    f"""SELECT s.id AS "documentID", collector AS "collectorID", s.text, coalesce(places, '') AS places,
      coalesce(organizations, '') AS organizations, coalesce(people, '') AS people, coalesce(categories, '') AS categories,
      {V.OPINION} AS "textOpinion", {V.LABEL.format(code=V.OPINION)} AS "textOpinionStr", summary,
      {_processed("s.text", _STORED_WORDS)} AS "textProcessed"
    FROM spanish s LEFT JOIN told t ON t.id = s.id JOIN summaries m ON m.id = s.id""",
    *_ALL_DOCS,
    _USABLE,
    V.languages("usable", "id", "text"),
    _SPANISH,
    V.TERMS,
    V.term_matches("spanish", "id", "text", "sentiment"),
    V.summaries("spanish", "id", "text"),
)
_CAPPED = f"""
fb_in AS (SELECT post_id FROM posts
  QUALIFY row_number() OVER (PARTITION BY source_id ORDER BY date_trunc('second', created_at) DESC, CAST(post_id AS VARCHAR) DESC) <= {CAP}),
tw_in AS (SELECT post_id FROM posts ORDER BY post_id DESC LIMIT {SINCE_ID}),
seen AS (
  SELECT row_number() OVER () AS id, * FROM (
    SELECT post_id, 'facebook' AS collector, text_out AS text,
      CASE WHEN reason IS NOT NULL THEN 'rejected' WHEN text_out = '' THEN 'no text' END AS outcome
    FROM fb_docs WHERE post_id IN (SELECT post_id FROM fb_in)
    UNION ALL SELECT post_id, 'twitter', text_out, CASE WHEN reason IS NOT NULL THEN 'rejected' END
    FROM tw_docs WHERE post_id IN (SELECT post_id FROM tw_in)
    UNION ALL SELECT NULL, 'rss', text_out, CASE WHEN pos >= {CAP} THEN 'over limit' WHEN reason IS NOT NULL THEN 'rejected'
      WHEN text_out = '' THEN 'no text' END
    FROM rss_docs)
)"""
oracle(
    "audit_outcomes",
    """SELECT collector AS "collectorID",
      coalesce(outcome, CASE WHEN language = 'Spanish' THEN 'stored' ELSE 'other language' END) AS outcome, count(*) AS n
    FROM seen JOIN languages USING (id) GROUP BY ALL""",
    *_ALL_DOCS[:-1],
    _CAPPED,
    V.languages("seen", "id", "text"),
)

oracle(
    "process_all_twice",
    """SELECT 'first' AS run, * FROM outcomes
    UNION ALL SELECT 'first', 'facebook', 'over limit', (SELECT count(*) FROM posts) - (SELECT count(*) FROM seen WHERE collector = 'facebook')
    UNION ALL SELECT 'first', 'twitter', 'over limit', (SELECT count(*) FROM posts) - (SELECT count(*) FROM seen WHERE collector = 'twitter')
    UNION ALL SELECT 'second', 'facebook', 'before mark', count(*) FROM posts
    UNION ALL SELECT 'second', 'twitter', 'before mark', count(*) FROM posts, mark WHERE post_id <= last
    UNION ALL SELECT 'second', 'twitter', told, count(*) FROM judged, mark
      WHERE collector = 'twitter' AND post_id > last GROUP BY told
    UNION ALL SELECT 'second', 'rss', 'before date', count(*) FROM posts
    UNION ALL SELECT 'store', * FROM outcomes WHERE outcome = 'stored'""",
    *_ALL_DOCS[:-1],
    _CAPPED,
    V.languages("seen", "id", "text"),
    """judged AS (SELECT post_id, collector, coalesce(outcome, CASE WHEN language = 'Spanish' THEN 'stored' ELSE 'other language' END) AS told
    FROM seen JOIN languages USING (id))""",
    """outcomes AS (SELECT collector AS "collectorID", told AS outcome, count(*) AS n FROM judged GROUP BY ALL)""",
    # Tweets behind the last stored one are read again, whatever became of them.
    """mark AS (SELECT max(post_id) AS last FROM judged WHERE collector = 'twitter' AND told = 'stored')""",
)

ORACLES["stream_passes"] = ORACLES["enrich_documents"]

# --- stored data -----------------------------------------------------------------------------------

oracle(
    "upsert_latest",
    """SELECT "documentID", "collectorID", CASE WHEN is_shared THEN "date" + INTERVAL 2 DAYS ELSE "date" END AS "date",
      CASE WHEN is_shared THEN 'new' ELSE 'old' END AS state FROM stored""",
    POSTS, V.STORED,
)
oracle(
    "delete_collector",
    """SELECT "documentID", "collectorID" FROM stored WHERE "collectorID" <> 'twitter'""",
    POSTS, V.STORED,
)
oracle(
    "delete_all",
    """SELECT "documentID", "collectorID", "sourceId" FROM stored WHERE "collectorID" = 'rss'""",
    POSTS, V.STORED,
)
oracle(
    "sink_insert",
    """SELECT "documentID", "collectorID", "sourceId", text, "date" FROM stored""",
    POSTS, V.STORED,
)

# --- streams and hooks -----------------------------------------------------------------------------

oracle("stream_ingest", 'SELECT source AS "sourceId", count(*) AS n FROM documents GROUP BY ALL')
oracle("stream_dedup", "SELECT DISTINCT user_id, event_type FROM events")
oracle(
    "udf_hook",
    f"""SELECT CASE WHEN text = '' THEN NULL ELSE post_id END AS post_id,
      list_max(list_transform(regexp_split_to_array({V.strip("text")}, '[{V.WS}]+'), lambda w: length(w)))
        * CASE WHEN text <> '' THEN 1 END AS longest,
      CASE WHEN text = '' THEN 'ValueError: empty text' END AS error FROM posts""",
    POSTS,
)
