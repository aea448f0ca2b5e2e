"""Text functions, all column in, column out.

Everything stays in the JVM but the decoding of character references: its table has over two thousand
names, so the references themselves (not the texts) go through one Arrow UDF. Texts without `&` send
nothing.
"""

from __future__ import annotations

import html
import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import patterns as P

# Workers get the helpers by value, so the package need not be installed on them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: The address a hashtag links to, per network.
HASHTAG_BASE = {
    "facebook": "https://www.facebook.com/hashtag/",
    "twitter": "https://twitter.com/hashtag/",
}
PROFILE_BASE = "https://twitter.com/"
QUOTE_OPEN, QUOTE_CLOSE = '<div class="alert alert-info">', "</div>"


def _anchor(href: str, label: str) -> str:
    return f'<a href="{href}" target="_blank">{label}</a>'


def strip(text: Column) -> Column:
    """Cut Unicode white space off both ends."""
    return F.trim(text, F.lit(P.WS_CHARS))


def urls(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(P.URL), F.lit(0))


def remove_urls(text: Column) -> Column:
    return F.regexp_replace(text, P.URL, "")


def linkify_urls(text: Column) -> Column:
    return F.regexp_replace(text, P.URL, _anchor("$0", "$0"))


def hashtags(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(P.HASHTAG), F.lit(0))


def linkify_hashtags(text: Column, network: str) -> Column:
    if network not in HASHTAG_BASE:
        raise ValueError(f"no hashtag address for {network!r}; expected one of {sorted(HASHTAG_BASE)}")
    return F.regexp_replace(text, P.HASHTAG, _anchor(HASHTAG_BASE[network] + "$1", "$0"))


def linkify_mentions(text: Column) -> Column:
    return F.regexp_replace(text, P.MENTION, _anchor(PROFILE_BASE + "$1", "$0"))


def linkify(text: Column, network: str) -> Column:
    """URLs, then hashtags, then (Twitter) mentions become anchors."""
    linked = linkify_hashtags(linkify_urls(text), network)
    return linkify_mentions(linked) if network == "twitter" else linked


def url_domain(url: Column) -> Column:
    """Domain of a URL at the start of ``url`` as the URL pattern sees it; null when there is none."""
    return F.nullif(F.regexp_extract(url, "^" + P.URL, 1), F.lit(""))


def url_host(url: Column) -> Column:
    """The full host name, for when the pattern's short domain will not do."""
    return F.try_parse_url(url, F.lit("HOST"))


def remove_scripts(text: Column, multiline: bool = False) -> Column:
    return F.regexp_replace(text, P.SCRIPT_MULTILINE if multiline else P.SCRIPT, "")


def remove_tags(text: Column, multiline: bool = False) -> Column:
    return F.regexp_replace(text, P.TAG_MULTILINE if multiline else P.TAG, "")


def collapse_spaces(text: Column) -> Column:
    return F.regexp_replace(text, P.UNEVEN_SPACES, " ")


@F.pandas_udf(T.ArrayType(T.StringType()))
def _decode_all(refs: pd.Series) -> pd.Series:
    return refs.map(lambda found: None if found is None else [html.unescape(ref) for ref in found])


def decode_entities(text: Column) -> Column:
    """Replace every character reference once, by the full HTML table.

    ``text`` is used several times: pass a plain column, not a long expression.
    """
    refs = F.when(text.contains("&"), F.regexp_extract_all(text, F.lit(P.CHARREF), F.lit(0)))
    gaps = F.split(text, P.CHARREF, -1)
    joined = F.array_join(
        F.zip_with(gaps, _decode_all(refs), lambda gap, ref: F.concat(gap, F.coalesce(ref, F.lit("")))), ""
    )
    return F.when(text.contains("&"), joined).otherwise(text)


def terminate(text: Column) -> Column:
    """Close a stripped text that says more than a URL with a full stop."""
    return F.when(
        (remove_urls(text) != "") & ~text.endswith("."), F.concat(text, F.lit(" ."))
    ).otherwise(text)


def first_nonempty(*choices: Column) -> Column:
    return F.coalesce(*[F.nullif(choice, F.lit("")) for choice in choices], F.lit(""))


def quote(content: Column) -> Column:
    """Page content as a quoted block; nothing for an empty page."""
    return F.when(
        F.coalesce(content, F.lit("")) != "",
        F.concat(F.lit(QUOTE_OPEN), content, F.lit(QUOTE_CLOSE)),
    ).otherwise(F.lit(""))


def words(text: Column) -> Column:
    """Lower-case words, letters only, in order."""
    return F.regexp_extract_all(F.lower(text), F.lit(P.LETTERS), F.lit(0))


def sentences(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(P.SENTENCE), F.lit(0))
