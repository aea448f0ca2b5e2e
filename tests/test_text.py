"""Text functions against Python's own Unicode regular expressions, on random and on hand-made texts."""

from __future__ import annotations

import html
import random
import re

import pytest
from pyspark.sql import functions as F

from tidemark.functions import text as X

URL = re.compile(r"https?://(?:www.)?([\w.-]+?(?:\.\w{2,3})+)(?:/[\w./]+)?")
HASHTAG = re.compile(r"#(\S+)\b")
MENTION = re.compile(r"@(\S+)\b")

PIECES = [
    "http://", "https://", "www.", "a", "bc", "niño", "ñu", ".com", ".es", ".info", "/", "-", "?q=1", "#", "##", "@",
    " ", "  ", "\n", "\t", "\r", "\x0b", "\x1c", "\x85", "\xa0", "\u2003", "\u2028", "\u3000", "\u200b", "<", ">", "<b>",
    "</p>", "<script>", "</script>", "<SCRIPT x", "/Script>", "&", "&amp;", "&lt", "&notit;", "&#233;", "&#x80;", "&#0;",
    "&copy", "&nbsp;", "&amp;lt;", ";", ",", "!", ".", "_", "1", "½", "é", "日本", "$1", "\\", "%",
]


@pytest.fixture(scope="module")
def samples():
    rng = random.Random(7)
    texts = ["".join(rng.choices(PIECES, k=rng.randint(0, 14))) for _ in range(3000)]
    return ["", " ", "http://a.com", "See http://www.a.es/x.", *texts]


def applied(spark, texts, *functions):
    # Two steps, as the functions ask for plain columns.
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    made = rows.select("i", *[f(F.col("t")).alias(f"f{n}") for n, f in enumerate(functions)])
    return [row[1:] for row in sorted(made.collect())]


def test_functions_match_python(spark, samples):
    got = applied(
        spark,
        samples,
        X.urls,
        X.remove_urls,
        X.hashtags,
        X.strip,
        X.collapse_spaces,
        X.remove_tags,
        X.remove_scripts,
        X.decode_entities,
        X.url_domain,
        lambda t: X.linkify(t, "twitter"),
        lambda t: X.linkify(t, "facebook"),
    )
    link = '<a href="{}" target="_blank">{}</a>'

    def linkified(t, network):
        base = {"twitter": "https://twitter.com/hashtag/", "facebook": "https://www.facebook.com/hashtag/"}[network]
        t = URL.sub(lambda m: link.format(m[0], m[0]), t)
        t = HASHTAG.sub(lambda m: link.format(base + m[1], m[0]), t)
        return MENTION.sub(lambda m: link.format("https://twitter.com/" + m[1], m[0]), t) if network == "twitter" else t

    for text, row in zip(samples, got):
        domain = URL.match(text)
        want = (
            [m[0] for m in URL.finditer(text)],
            URL.sub("", text),
            [m[0] for m in HASHTAG.finditer(text)],
            text.strip(),
            re.sub(r"\s+", " ", text),
            re.sub(r"<.*?>", "", text),
            re.sub(r"<script.*?/script>", "", text, flags=re.IGNORECASE),
            html.unescape(text),
            domain and domain[1],
            linkified(text, "twitter"),
            linkified(text, "facebook"),
        )
        assert row == want, repr(text)


@pytest.mark.parametrize(
    "text, want",
    [
        ("", ""),
        ("http://a.com", "http://a.com"),
        ("Done.", "Done."),
        ("Done!", "Done! ."),
        ("Look http://a.com", "Look http://a.com ."),
    ],
)
def test_terminate(spark, text, want):
    assert applied(spark, [text], X.terminate) == [(want,)]


@pytest.mark.parametrize(
    "url, domain, host",
    [
        ("https://blog.example.com/x", "blog.exa", "blog.example.com"),
        ("http://www.elpais.es/", "elpais.es", "www.elpais.es"),
        ("https://a.co.uk/b-c?d#e", "a.co.uk", "a.co.uk"),
        ("nothing", None, None),
    ],
)
def test_domain_is_short_and_host_is_whole(spark, url, domain, host):
    assert applied(spark, [url], X.url_domain, X.url_host) == [(domain, host)]


def test_url_stops_at_hyphen_query_and_fragment(spark):
    texts = ["http://a.com/b-c", "http://a.com/b?q=1", "http://a.com/#top", "http://a.com/ x", "http://a.museum/x"]
    got = [row[0] for row in applied(spark, texts, X.urls)]
    assert got == [["http://a.com/b"], ["http://a.com/b"], ["http://a.com"], ["http://a.com"], ["http://a.mus"]]


def test_multiline_markup_is_an_option(spark):
    text = "a<script>\nx()\n</script>b<i\nclass=c>d"
    kept, gone = applied(
        spark, [text], lambda t: X.remove_tags(X.remove_scripts(t)), lambda t: X.remove_tags(X.remove_scripts(t, True), True)
    )[0]
    assert kept == "a\nx()\nb<i\nclass=c>d" and gone == "abd"


def test_long_texts_do_not_exhaust_the_stack(spark):
    text = "http://a" + ".bc" * 50_000 + " " + "#" + "x" * 50_000 + " <script>" + "y" * 50_000
    found, tags, stripped = applied(spark, [text], X.urls, X.hashtags, X.remove_scripts)[0]
    assert len(found[0]) == 150_008 and len(tags[0]) == 50_001 and stripped == text


def test_unknown_network_is_refused(spark):
    with pytest.raises(ValueError):
        X.linkify_hashtags(F.lit("#a"), "rss")


def test_first_nonempty_and_quote(spark):
    row = spark.range(1).select(
        X.first_nonempty(F.lit(""), F.lit("b")).alias("a"),
        X.first_nonempty(F.lit(None).cast("string"), F.lit("")).alias("b"),
        X.quote(F.lit("")).alias("c"),
        X.quote(F.lit(None).cast("string")).alias("d"),
        X.quote(F.lit("<p>x</p>")).alias("e"),
    ).first()
    assert row[:4] == ("b", "", "", "") and row[4] == '<div class="alert alert-info"><p>x</p></div>'
