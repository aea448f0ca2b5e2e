"""The derived views of :mod:`catalog.views` and the text rules as DuckDB SQL."""

from __future__ import annotations

from catalog.views import ACCOUNT, CATEGORIES, CRAWL, POLARITY, REACTION_OF
from tidemark import config

WORD = r"[\p{L}\p{N}_]"
WS = r"\x{09}-\x{0D}\x{1C}-\x{20}\x{85}\p{Z}"
URL = rf"https?://(?:www[^\n])?([\p{{L}}\p{{N}}_.\-]+?(?:\.{WORD}{{2,3}})+)(?:/[\p{{L}}\p{{N}}_./]+)?"
TAG_WORD = rf"([^{WS}]*{WORD})"


def sub(x: str, pattern: str, to: str) -> str:
    return f"regexp_replace({x}, '{pattern}', '{to}', 'g')"


def anchor(href: str, label: str) -> str:
    return f'<a href="{href}" target="_blank">{label}</a>'


def remove_urls(x: str) -> str:
    return sub(x, URL, "")


def linkify(x: str, network: str) -> str:
    base = {"facebook": "https://www.facebook.com/hashtag/", "twitter": "https://twitter.com/hashtag/"}[network]
    linked = sub(sub(x, URL, anchor(r"\0", r"\0")), "#" + TAG_WORD, anchor(base + r"\1", r"\0"))
    return sub(linked, "@" + TAG_WORD, anchor(r"https://twitter.com/\1", r"\0")) if network == "twitter" else linked


def remove_scripts(x: str) -> str:
    return sub(x, r"(?i)<script[^\n]*?/script>", "")


def remove_tags(x: str) -> str:
    return sub(x, r"<[^>\n]*>", "")


def decode(x: str) -> str:
    """The references that occur in the tables; `&amp;` last, so that nothing is decoded twice."""
    for name, mark in (("copy", "©"), ("middot", "·"), ("quot", '"'), ("amp", "&")):
        x = sub(x, f"&{name};?", mark)
    return x


def collapse(x: str) -> str:
    return sub(x, f"[{WS}]+", " ")


def clean(x: str) -> str:
    return remove_urls(collapse(decode(remove_tags(x))))


def strip(x: str) -> str:
    return sub(sub(x, f"^[{WS}]+", ""), f"[{WS}]+$", "")


def terminate(x: str) -> str:
    return f"CASE WHEN {remove_urls(x)} <> '' AND NOT ends_with({x}, '.') THEN {x} || ' .' ELSE {x} END"


def words(x: str) -> str:
    return rf"regexp_extract_all(lower({x}), '\p{{L}}+')"


def values(rows) -> str:
    return ", ".join("(" + ", ".join("NULL" if c is None else repr(c) for c in row) + ")" for row in rows)


POSTS = """
posts AS (
  SELECT d.doc_id AS post_id, d.source AS source_id, d.lang, e.user_id, e.event_type AS tag, e.ts AS created_at,
    CASE WHEN e.event_type <> 'signup' THEN p1.url END AS link,
    CASE WHEN e.event_type = 'purchase' THEN p2.url END AS link2,
    CASE WHEN coalesce(l.toxic, 0) = 1 THEN ''
      ELSE d.text || ' ' || coalesce(CASE WHEN e.event_type <> 'signup' THEN p1.url END, '')
        || ' #' || e.event_type || ' @user' || e.user_id END AS text,
    e.event_type = 'purchase' AS is_shared, coalesce(l.quality, 1) = 1 AS complete, p1.html AS html
  FROM documents d
  JOIN events e ON e.event_id = d.doc_id
  LEFT JOIN labels l ON l.doc_id = d.doc_id
  JOIN pages p1 ON p1.page_id = d.doc_id % (SELECT count(*) FROM pages)
  JOIN pages p2 ON p2.page_id = (d.doc_id + 1) % (SELECT count(*) FROM pages)
)"""

REACTIONS = f"""
reactions AS (
  SELECT CAST(event_id % (SELECT count(*) FROM documents) AS VARCHAR) AS "postID",
    CASE event_type {" ".join(f"WHEN '{t}' THEN '{r}'" for t, r in REACTION_OF.items())} END AS reaction
  FROM events
)"""

ENTRIES = f"""
entries AS (
  SELECT *,
    'https://feeds.example.org/' || source_id || '/' || (post_id // {CRAWL}) AS feed_href,
    'https://' || source_id || '.org/' AS feed_link,
    row_number() OVER (PARTITION BY source_id, post_id // {CRAWL} ORDER BY post_id) - 1 AS pos,
    CASE WHEN complete THEN 'https://' || source_id || '.org/p/' || post_id END AS entry_link,
    CASE WHEN tag <> 'error' THEN 'guid-' || post_id END AS guid,
    CASE WHEN tag <> 'view' THEN 'user' || user_id END AS author,
    CASE WHEN tag <> 'signup' THEN strftime(created_at, '%a, %d %b %Y %H:%M:%S GMT') END AS published,
    strftime(created_at, '%Y-%m-%dT%H:%M:%SZ') AS updated,
    CASE WHEN tag IN ('click', 'purchase') THEN html END AS content,
    CASE tag WHEN 'click' THEN 'audio/mpeg' WHEN 'purchase' THEN 'text/html' END AS enclosed_type
  FROM posts
)"""

# Paragraph nesting with windows. `s` opens or closes a paragraph, `g` counts closed containers (which end
# open paragraphs), `depth` is the running sum of `s`, stray ends clamped.
_html = "html"
for _element in ("script", "nav", "header", "footer", "aside", "figure", "blockquote", "li"):
    _html = sub(_html, rf"(?is)<{_element}[ >].*?</{_element}>", "")
PARAGRAPHS = f"""
kept AS (SELECT page_id, url, {_html} AS html FROM pages),
tokens AS (
  SELECT page_id, url, unnest(t) AS tok, generate_subscripts(t, 1) AS i
  FROM (SELECT page_id, url, regexp_extract_all(html, '<[^>]*>|[^<]+') AS t FROM kept)
),
marked AS (
  SELECT *,
    CASE WHEN regexp_matches(tok, '^<p[ >]') THEN 1 WHEN tok = '</p>' THEN -1 ELSE 0 END AS s,
    count(*) FILTER (tok IN ('</article>', '</div>', '</body>')) OVER (PARTITION BY page_id ORDER BY i) AS g
  FROM tokens
),
summed AS (SELECT *, sum(s) OVER (PARTITION BY page_id, g ORDER BY i) AS r FROM marked),
deep AS (
  SELECT *, r - least(0, min(r) OVER (PARTITION BY page_id, g ORDER BY i)) AS depth FROM summed
),
numbered AS (
  SELECT *, count(*) FILTER (s = 1 AND depth = 1) OVER (PARTITION BY page_id ORDER BY i) - 1 AS pos FROM deep
),
paragraphs AS (
  SELECT page_id, url, pos,
    {decode("coalesce(string_agg(tok, '' ORDER BY i) FILTER (NOT starts_with(tok, '<')), '')")} AS text
  FROM numbered WHERE depth > 0 GROUP BY page_id, url, pos
),
content AS (
  SELECT url, string_agg(
      replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '' ORDER BY pos) AS body,
    string_agg(text, '' ORDER BY pos) AS said
  FROM paragraphs WHERE length(text) > 100 GROUP BY url
)"""

QUOTE_OPEN = '<div class="alert alert-info">'


def quoted(body: str) -> str:
    return f"CASE WHEN {body} IS NULL THEN '' ELSE '{QUOTE_OPEN}' || {body} || '</div>' END"


STORED = """
stored AS (
  SELECT p.prefix || post_id AS "documentID", p.collector AS "collectorID", source_id AS "sourceId", text,
    created_at AS "createdAt", CASE WHEN p.collector = 'twitter' THEN post_id END AS "postIDNum",
    created_at + INTERVAL 1 DAY AS "date", is_shared
  FROM posts, (VALUES ('FB_', 'facebook'), ('TW_', 'twitter'), ('RSS_', 'rss')) p(prefix, collector)
)"""

# Normalized documents of each collector, without markup.
_FB_SAID = terminate("said")
FACEBOOK_DOCS = f"""
fb_said AS (SELECT p.*, {strip("p.text")} AS said, c.body FROM posts p LEFT JOIN content c ON c.url = p.link),
fb_post AS (SELECT *, {_FB_SAID} AS post FROM fb_said),
fb_raw AS (
  SELECT *, {remove_scripts(f"{linkify('post', 'facebook')} || CASE WHEN link IS NULL THEN '' ELSE '<br>' || {quoted('body')} END")} AS raw
  FROM fb_post
),
fb_docs AS (
  SELECT *, {clean("raw")} AS text_out, {clean("post")} AS sentiment,
    CASE WHEN NOT complete THEN 'missing reactions' END AS reason
  FROM fb_raw
)"""
TWITTER_DOCS = f"""
tw_said AS (
  SELECT p.*, {strip("p.text")} AS said, c1.body AS body1, c2.body AS body2
  FROM posts p LEFT JOIN content c1 ON c1.url = p.link LEFT JOIN content c2 ON c2.url = p.link2
),
tw_post AS (SELECT *, {_FB_SAID} AS post FROM tw_said),
tw_raw AS (
  SELECT *, {remove_scripts(f"{linkify('post', 'twitter')} || CASE WHEN link IS NULL THEN '' ELSE ' <br>' || {quoted('body1')} END || CASE WHEN link2 IS NULL THEN '' ELSE ' <br>' || {quoted('body2')} END")} AS raw
  FROM tw_post
),
tw_docs AS (
  SELECT *, {clean("raw")} AS text_out, {clean("post")} AS sentiment,
    CASE WHEN NOT complete THEN 'missing user' END AS reason
  FROM tw_raw
)"""
FEED_DOCS = f"""
rss_docs AS (
  SELECT *, {clean(remove_scripts("coalesce(content, text)"))} AS text_out,
    CASE WHEN NOT complete THEN 'missing link' END AS reason
  FROM entries
)"""

TERMS = f"""
openings AS (SELECT {words("text")} AS w FROM benchmark),
terms AS (
  SELECT DISTINCT w[1] AS term, 'place' AS kind, CAST(NULL AS VARCHAR) AS label, CAST(NULL AS DOUBLE) AS weight
  FROM openings WHERE len(w) >= 1
  UNION ALL SELECT DISTINCT w[1] || ' ' || w[2], 'person', NULL, NULL FROM openings WHERE len(w) >= 2
  UNION ALL SELECT DISTINCT w[1] || ' ' || w[2] || ' ' || w[3], 'organization', NULL, NULL FROM openings WHERE len(w) >= 3
  UNION ALL SELECT * FROM (VALUES {values((t, "polarity", None, w) for t, w in POLARITY.items())}) v
  UNION ALL SELECT * FROM (VALUES {values((t, "category", label, None) for label, ts in CATEGORIES.items() for t in ts)}) v
)"""


def languages(source: str, key: str, text: str) -> str:
    """CTE ``languages(key, language)``."""
    listed = values((name, w) for name, ws in config.STOPWORDS.items() for w in ws)
    return f"""
stopwords(name, word) AS (VALUES {listed}),
spoken AS (SELECT {key}, unnest({words(text)}) AS word FROM {source}),
votes AS (SELECT {key}, name, count(*) AS n FROM spoken JOIN stopwords USING (word) GROUP BY ALL),
languages AS (
  SELECT s.{key}, v.name AS language FROM {source} s LEFT JOIN (
    SELECT {key}, name FROM votes QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY n DESC, name) = 1
  ) v ON v.{key} = s.{key}
)"""


def term_matches(source: str, key: str, text: str, sentiment: str) -> str:
    """CTE ``told``: entity lists, polarity and categories of the documents with a hit."""
    return f"""
toks AS (SELECT {key}, {words(text)} AS t, {words(sentiment)} AS s FROM {source}),
grams AS (
  SELECT {key}, false AS sentiment, unnest(t) AS term FROM toks
  UNION ALL SELECT {key}, true, unnest(s) FROM toks
  UNION ALL SELECT {key}, false, unnest(list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i+1])) FROM toks
  UNION ALL SELECT {key}, false, unnest(list_transform(range(1, len(t) - 1), lambda i: t[i] || ' ' || t[i+1] || ' ' || t[i+2])) FROM toks
),
hits AS (
  SELECT {key}, kind, label, term, weight, count(*) AS n
  FROM grams JOIN terms USING (term) WHERE sentiment = (kind = 'polarity') GROUP BY ALL
),
cats AS (SELECT {key}, label FROM hits WHERE kind = 'category' GROUP BY ALL HAVING sum(n) >= 2),
told AS (
  SELECT h.{key},
    coalesce(string_agg(DISTINCT term, '|' ORDER BY term) FILTER (kind = 'place'), '') AS places,
    coalesce(string_agg(DISTINCT term, '|' ORDER BY term) FILTER (kind = 'organization'), '') AS organizations,
    coalesce(string_agg(DISTINCT term, '|' ORDER BY term) FILTER (kind = 'person'), '') AS people,
    sum(weight * n) / sum(n) FILTER (kind = 'polarity') AS polarity,
    coalesce((SELECT string_agg(label, '|' ORDER BY label) FROM cats c WHERE c.{key} = h.{key}), '') AS categories
  FROM hits h GROUP BY h.{key}
)"""


OPINION = (
    "CASE WHEN polarity IS NULL THEN '0.0' "
    "ELSE CAST(greatest(-1.0, least(1.0, round(polarity * 2) / 2)) + CAST(0 AS DOUBLE) AS VARCHAR) END"
)
LABEL = "CASE {code} " + " ".join(f"WHEN '{c}' THEN '{label}'" for c, label in config.OPINION_LABELS.items()) + " END"


def summaries(source: str, key: str, text: str) -> str:
    """CTE ``summaries(key, summary)``."""
    low, high = config.SUMMARY_WORDS
    return f"""
sents AS (
  SELECT {key}, unnest(x) AS sentence, generate_subscripts(x, 1) AS i
  FROM (SELECT {key}, regexp_extract_all({text}, '[^.!?\\n]+[.!?]*') AS x FROM {source})
),
sent_words AS (SELECT {key}, i, unnest({words("sentence")}) AS word FROM sents),
freq AS (SELECT {key}, word, count(*) AS tf FROM sent_words GROUP BY ALL),
scored AS (
  SELECT {key}, i, sum(tf)::DOUBLE / count(*) AS score FROM sent_words JOIN freq USING ({key}, word) GROUP BY ALL
),
sized AS (
  SELECT s.{key}, i, score, regexp_split_to_array({strip("sentence")}, '[{WS}]+') AS w
  FROM scored s JOIN sents USING ({key}, i)
),
totals AS (
  SELECT *, sum(len(w)) OVER (PARTITION BY {key} ORDER BY score DESC, i) AS total FROM sized
),
taken AS (
  SELECT {key}, i, array_to_string(w[1:CAST({high} - (total - len(w)) AS BIGINT)], ' ') AS cut
  FROM totals WHERE total <= {high} OR total - len(w) < {low}
),
summaries AS (
  SELECT s.{key}, coalesce(t.summary, '') AS summary FROM {source} s
  LEFT JOIN (SELECT {key}, string_agg(cut, ' ' ORDER BY i) AS summary FROM taken GROUP BY {key}) t ON t.{key} = s.{key}
)"""


ACCOUNT_SQL = f"'{ACCOUNT}'"
