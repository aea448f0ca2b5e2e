"""Main text of web pages by host suffix arrays.

A page becomes blocks of text. What the markup itself names as no content (scripts, styles, forms, menus, headers
and footers of the page, marked adverts, notices and reader comments) goes; what it names as the article (``article``,
``main`` and the like) is the page's text, without an article all other blocks are. Both are streams of tokens. The streams of
a host are put together, their suffixes of ``TOKENS`` tokens sorted by value, and suffixes that distinct pages share are
boilerplate: blocks covered by them to at least ``COVERED`` are removed. Outside articles two different contents are enough.
Inside it takes ``PAGES`` and a part of ``SHARE`` of the host's, articles with the same least suffix (copies and most near copies)
being one, and an article of nothing else stays whole. A sort over a host would put a large host into one task, so
suffixes meet by host and a range of hashes, as many ranges as the host has need of; outside articles, usually little, by their hash.

Blocks are joined in page order by an empty line; references are decoded, white space inside a block is one space.

Nulls, ties and other cases: null and empty pages give an empty text; pages without url are one host; pages of
equal content count once; broken markup is read as far as it can be, unclosed elements
end with what holds them; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import html
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import lean, slices, strings, table
from tidemark.sources.staging import drop, staged

TOKENS = 6
COVERED = 0.5
#: So many articles of a host, and this part of all, share a suffix that is no part of them.
PAGES, SHARE = 3, 0.1
#: Bits of the hash by which suffixes of one host are told apart (a boilerplate one stands in a tenth of its articles, so that equal
#: hashes of others don't matter), and how many of them a task counts at once, about.
CODE_BITS, RANGE = 32, 1 << 20
SEPARATOR = "\n\n"

_DROPPED = set(
    "script style noscript template form button select textarea nav footer aside iframe object svg head title dialog "
    "menu canvas math audio video".split()
)
_VOID = set("area base br col embed hr img input link meta source track wbr".split())
_BLOCKS = set(
    "address article blockquote body dd details div dl dt fieldset figcaption figure h1 h2 h3 h4 h5 h6 header hr html "
    "li main ol p pre section summary table tbody td tfoot th thead tr ul center caption".split()
)
_ROLES = set("navigation banner contentinfo complementary search dialog alert form menu menubar toolbar".split())
_NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|banner|sponsor\w*|promo\w*|nav\w*|menu\w*|breadcrumb\w*|sidebar\w*|footer\w*|"
    r"masthead|site-?header|page-?header|topbar|cookie\w*|consent|notice\w*|disclaimer|popup|modal|newsletter|subscri\w*|"
    r"comments?|comment-\w+|disqus|replies|respond|share|sharing|social\w*|related|recommend\w*|widget\w*|login|signup|"
    r"search\w*|pagination|pager|toolbar|skip-link|copyright)(?=$|[\s_-])",
    re.I,
)
_ARTICLE_NAMES = re.compile(
    r"(?:^|[\s_-])(?:article(?:-?(?:body|content|text))?|post-?(?:body|content)|entry-?content|main-?content|story-?body|"
    r"content-?body)(?=$|\s)",
    re.I,
)
#: Comments, declarations, elements whose content is no markup, and tags.
_MARKUP = re.compile(
    r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)"
    r"|<(script|style|textarea|noscript|template|title)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</\1\s*>|$)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"\b(class|id|role|itemprop|hidden|aria-hidden|style)\b(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)


def _marks(name: str, attributes: str, in_article: bool) -> tuple[bool, bool]:
    """Whether an element is no content, and whether it is the article."""
    if name in _DROPPED:
        return True, False
    found = {k.lower(): v.strip("\"'").lower() for k, v in _ATTRIBUTE.findall(attributes)} if attributes else {}
    article = name in ("article", "main") or found.get("role") in ("main", "article") or "articlebody" in found.get("itemprop", "")
    if "hidden" in found or found.get("aria-hidden") == "true":
        return True, False
    style = found.get("style", "").replace(" ", "")
    if "display:none" in style or "visibility:hidden" in style or found.get("role") in _ROLES:
        return True, False
    names = f"{found.get('class', '')} {found.get('id', '')}"
    if not article and names != " " and name not in ("body", "html"):
        article = bool(_ARTICLE_NAMES.search(names))
        if not article and _NAMES.search(names):
            return True, False
    # A page's header is none; one inside the article holds its title.
    return name == "header" and not in_article, article


def blocks(page: str) -> list[tuple[str, bool]]:
    """The blocks of a page that markup doesn't rule out, and whether each is marked as the article's."""
    out: list[tuple[str, bool]] = []
    stack: list[tuple[str, bool, bool]] = []  # name, dropped, in the article
    text: list[str] = []
    dropped = article = False

    def close_block() -> None:
        if text:
            plain = " ".join(html.unescape("".join(text)).split())
            if plain:
                out.append((plain, article))
            text.clear()

    at = 0
    for tag in _MARKUP.finditer(page):
        if not dropped and tag.start() > at:
            text.append(page[at : tag.start()])
        at = tag.end()
        name = tag[3]
        if name is None:
            continue
        name = name.lower()
        if name == "br":
            text.append(" ")
        if name in _VOID and name != "hr":
            continue
        closing = bool(tag[2])
        marks = (False, False) if closing else _marks(name, tag[4], article)
        if name in _BLOCKS or name in _DROPPED or marks[0]:
            close_block()
        if closing:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    del stack[k:]
                    break
                if stack[k][0] in ("article", "main", "body") and name not in ("body", "html"):
                    break  # a stray end tag doesn't close what holds it
        elif name != "hr" and not tag[4].endswith("/"):
            if name == "p" or name == "li":  # the next one ends one left open
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] == name:
                        del stack[k:]
                        break
                    if stack[k][0] in _BLOCKS:
                        break
            stack.append((name, dropped_by(stack) or marks[0], article_by(stack) or marks[1]))
        dropped, article = dropped_by(stack), article_by(stack)
    if not dropped and at < len(page):
        text.append(page[at:])
    close_block()
    return out


def dropped_by(stack: list[tuple[str, bool, bool]]) -> bool:
    return bool(stack) and stack[-1][1]


def article_by(stack: list[tuple[str, bool, bool]]) -> bool:
    return bool(stack) and stack[-1][2]


def _suffixes(plain: list[str], seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the first ``TOKENS`` tokens of a stream's suffixes and the block of each token."""
    words = [w for b in plain for w in b.split(" ")]
    of = np.repeat(np.arange(len(plain)), [b.count(" ") + 1 for b in plain])
    seed = int(seed)
    if len(words) < TOKENS:
        return np.empty(0, np.int64), of
    value = [xxhash.xxh3_64_intdigest(" ".join(words[i : i + TOKENS]), seed) for i in range(len(words) - TOKENS + 1)]
    return np.array(value, np.uint64).view(np.int64), of


def _codes(plain: list[str], seed: int) -> np.ndarray:
    return np.unique(_suffixes(plain, seed)[0].view(np.uint64) >> np.uint64(64 - CODE_BITS))


def packed(codes: np.ndarray) -> bytes:
    """Sorted numbers as their steps, byte by byte: high bytes of steps are mostly alike."""
    return zlib.compress(np.diff(codes, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes(), 1)


def unpacked(data: bytes) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(np.frombuffer(zlib.decompress(data), np.uint8).reshape(8, -1).T).view("<u8").ravel(), dtype=np.uint64)


def unique_blocks(plain: list[str], value: np.ndarray, of: np.ndarray, known: np.ndarray) -> list[str]:
    """The blocks that suffixes of ``known`` don't cover to ``COVERED``."""
    hit = np.isin(value, known).astype(np.int64)
    edge = np.zeros(len(of) + 1, np.int64)
    edge[: len(hit)] += hit
    edge[TOKENS : TOKENS + len(hit)] -= hit
    size = np.bincount(of, minlength=len(plain))
    share = np.bincount(of, np.cumsum(edge)[:-1] > 0, len(plain)) / np.maximum(size, 1)
    return [b for b, s in zip(plain, share) if s < COVERED]


def _repeated_in_articles(stream: DataFrame) -> DataFrame:
    """seed and shared, codes of the suffixes that are boilerplate inside the articles of a host. These are at most
    1 / ``SHARE`` times as many as an article has."""
    articles = stream.where("marked")
    # Of articles with the same least suffix one is counted.
    first = articles.where("least is not null").groupBy("seed", "least").agg(
        F.min(F.struct("page_id", "content", "row", "tokens")).alias("first")
    )
    first = staged(first.select("seed", "least", "first.row", "first.tokens"), "articles-counted")
    hosts = first.groupBy("seed").agg(F.count(F.lit(1)).alias("pages"), F.sum("tokens").alias("tokens"))
    hosts = hosts.where(F.col("pages") >= PAGES).select(
        "seed", F.greatest(F.lit(PAGES), F.ceil(F.col("pages") * SHARE)).alias("need"), F.ceil(F.col("tokens") / RANGE).alias("ranges")
    )
    hosts = staged(hosts, "article-hosts")
    # The others are told by narrow rows, so that texts stay where they are.
    copies = articles.select("seed", "least", "row").join(first.select("seed", "least", F.col("row").alias("first")), ["seed", "least"])
    copies = staged(copies.where("row <> first").select("row"), "article-copies")
    asked = articles.where("least is not null").select("row", "seed", F.array_join("blocks", SEPARATOR).alias("text"))
    asked = asked.join(hosts.select("seed", "ranges"), "seed").join(copies, "row", "left_anti")
    bins = first.agg(F.ceil(F.coalesce(F.sum("tokens"), F.lit(0)) / RANGE)).first()[0] or 1

    @lean
    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in slices(batches):
            out = []
            for (seed, ranges), rows in batch.groupby(["seed", "ranges"]):
                codes = np.concatenate([_codes(text.split(SEPARATOR), seed) for text in rows["text"]])
                codes, n = np.unique(codes, return_counts=True)
                part = codes % np.uint64(ranges)
                for k in range(ranges) if ranges > 1 else (0,):
                    own = slice(None) if ranges == 1 else part == k
                    out.append((seed, k, packed(codes[own]), n[own].astype("<u4").tobytes()))
            yield pd.DataFrame(out, columns=["seed", "part", "codes", "n"])

    parts = asked.select("seed", "ranges", "text").mapInPandas(spread, "seed bigint, part bigint, codes binary, n binary")
    parts = parts.withColumn("bin", F.pmod(F.xxhash64("seed", "part"), F.lit(int(bins))))

    def count(frame: pd.DataFrame) -> pd.DataFrame:
        out = []
        for (seed, _), rows in frame.groupby(["seed", "part"]):
            codes, place = np.unique(np.concatenate([unpacked(c) for c in rows["codes"]]), return_inverse=True)
            n = np.bincount(place, np.concatenate([np.frombuffer(c, "<u4") for c in rows["n"]]), len(codes))
            often = n >= PAGES
            out.append((seed, codes[often].astype(np.int64), n[often].astype(np.int64)))
        return pd.DataFrame(out, columns=["seed", "codes", "n"])

    often = parts.groupBy("bin").applyInPandas(count, "seed bigint, codes array<bigint>, n array<bigint>")
    found = often.where(F.size("codes") > 0).join(hosts, "seed")
    found = found.select("seed", F.transform(F.filter(F.arrays_zip("codes", "n"), lambda x: x["n"] >= F.col("need")), lambda x: x["codes"]).alias("codes"))
    shared = found.groupBy("seed").agg(F.flatten(F.collect_list("codes")).alias("shared"))
    shared = staged(shared.where(F.size("shared") > 0), "article-repeats")
    drop(first, hosts, copies)
    return shared


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url and text of every page."""
    host = F.coalesce(F.regexp_extract(F.lower("url"), r"^\w+://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit(""))
    pages = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", host.alias("host"), F.col("html").alias("text"))

    def streams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in slices(batches):
            parsed = [blocks(page or "") for page in batch["text"]]
            plain = [[b for b, own in found if not own] for found in parsed]
            article = [[b for b, own in found if own] for found in parsed]
            seeds = [xxhash.xxh32_intdigest(name) for name in batch["host"]]
            suffixes = [np.unique(_suffixes(p, seed)[0]) for p, seed in zip(plain, seeds)]
            codes = [_codes(p, seed) if p else [] for p, seed in zip(article, seeds)]
            kept = [own or p for p, own in zip(plain, article)]
            yield pd.DataFrame(
                {
                    "page_id": batch["page_id"].astype("Int64"),
                    "url": strings(batch["url"].tolist()),
                    "seed": seeds,
                    "marked": [bool(own) for own in article],
                    "least": pd.array([int(c[0]) if len(c) else None for c in codes], "Int64"),
                    "tokens": [len(c) for c in codes],
                    "content": [np.uint64(xxhash.xxh3_64_intdigest(SEPARATOR.join(p))).astype(np.int64) for p in kept],
                    "stream": [np.uint64(xxhash.xxh3_64_intdigest(SEPARATOR.join(p))).astype(np.int64) for p in plain],
                    "suffixes": suffixes,
                    "blocks": kept,
                }
            )

    schema = (
        "page_id bigint, url string, seed bigint, marked boolean, least bigint, tokens bigint, content bigint, stream bigint, "
        "suffixes array<bigint>, blocks array<string>"
    )
    stream = pages.mapInPandas(streams, schema).withColumn("row", F.monotonically_increasing_id())
    stream = staged(stream, "page-streams")
    # What no mark rules in or out of the article, a small part of the pages.
    found = stream.select("stream", F.explode("suffixes").alias("suffix"))
    # Counted before the shuffle: two different contents are enough.
    shared = found.groupBy("suffix").agg(F.min("stream").alias("low"), F.max("stream").alias("high"))
    shared = shared.where("low < high").select("suffix")
    unmarked = stream.where("not marked")
    asked = unmarked.select("row", F.explode("suffixes").alias("suffix"))
    repeated = asked.join(shared, "suffix").groupBy("row").agg(F.collect_set("suffix").alias("repeated"))

    def unique_runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = []
            for plain, seed, known in zip(batch["blocks"], batch["seed"], batch["repeated"]):
                value, of = _suffixes(list(plain), seed)
                texts.append(SEPARATOR.join(unique_blocks(list(plain), value, of, np.array([] if known is None else known, np.int64))))
            yield pd.DataFrame({"page_id": batch["page_id"].astype("Int64"), "url": strings(batch["url"].tolist()), "text": strings(texts)})

    def articles(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = []
            for plain, seed, known in zip(batch["blocks"], batch["seed"], batch["shared"]):
                left = list(plain)
                if known is not None:
                    value, of = _suffixes(left, seed)
                    value = value.view(np.uint64) >> np.uint64(64 - CODE_BITS)
                    left = unique_blocks(left, value, of, np.array(known, np.uint64)) or left
                texts.append(SEPARATOR.join(left))
            yield pd.DataFrame({"page_id": batch["page_id"].astype("Int64"), "url": strings(batch["url"].tolist()), "text": strings(texts)})

    result = "page_id bigint, url string, text string"
    needed = ["page_id", "url", "seed", "blocks"]
    others = unmarked.join(repeated, "row", "left").select(*needed, "repeated")
    marked = stream.where("marked").join(_repeated_in_articles(stream), "seed", "left").select(*needed, "shared")
    return marked.mapInPandas(articles, result).unionByName(others.mapInPandas(unique_runs, result))


def op2_html_extraction(spark, sf_dir) -> DataFrame:
    found = extract(table(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.length("text").cast("bigint"))
