"""The views put posts together from narrow rows: their text travels once."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest

from catalog.queries import QUERIES, stored
from catalog.views import Views

DAY = datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    top = tmp_path_factory.mktemp("tables")
    documents = [(i, f"text of {i}", "es", f"src_{i % 3}") for i in range(12)] + [(3, "other", "en", "src_0"), (None, "x", "es", "src_1")]
    events = [(i, DAY + timedelta(hours=i), i, ["view", "click", "purchase", "signup", "error"][i % 5]) for i in range(20)]
    events += [(3, DAY, 99, "click"), (None, DAY, 7, "view")]
    made = {
        "documents": (documents, "doc_id bigint, text string, lang string, source string"),
        "events": (events, "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string"),
        "pages": ([(i, f"https://a.bc/{i}", f"<p>page {i}</p>") for i in range(4)], "page_id bigint, url string, html string"),
        "labels": ([(1, 0, 1), (2, 1, 0), (2, 0, 0)], "doc_id bigint, quality int, toxic int"),
    }
    for name, (rows, schema) in made.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{top}/{name}.parquet")
    return str(top)


def exchanges(node):
    """Names of the columns of every exchange below a physical node."""
    if node.nodeName() == "AdaptiveSparkPlan":
        node = node.initialPlan()
    own = [{node.output().apply(i).name() for i in range(node.output().size())}] if node.nodeName() == "Exchange" else []
    return own + [e for i in range(node.children().size()) for e in exchanges(node.children().apply(i))]


def test_the_text_of_a_post_is_shuffled_once(spark, tables):
    bound = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for rows in (Views(spark, tables).posts, Views(spark, tables).tweets):
            found = exchanges(rows._jdf.queryExecution().executedPlan())
            assert sum("text" in names for names in found) == 1 < len(found)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", bound)


def test_repeated_keys_give_a_post_for_every_combination(spark, tables):
    got = Views(spark, tables).posts.groupBy("post_id").count().collect()
    # Document 3 and event 3 stand there twice, document 2 has two labels.
    assert {r["post_id"]: r["count"] for r in got} == {i: {2: 2, 3: 4}.get(i, 1) for i in range(12)}


def test_only_some_feed_entries_show_their_page(spark, tables):
    rows = Views(spark, tables).entries.select("title", "content").collect()
    shown = {r["title"]: r["content"][0]["value"] for r in rows if r["content"]}
    assert shown == {f"Entry {i}": f"<p>page {i % 4}</p>" for i in range(12) if i % 5 in (1, 2) or i == 3}
    assert len(rows) == 16


def test_marks_hold_the_time_of_the_newest_post(spark, tables):
    newest = max(r["createdAt"] for r in stored(Views(spark, tables)).select("createdAt").collect())
    rows = QUERIES["high_water_mark"](spark, tables).collect()
    assert {r["collectorID"] for r in rows} == {"facebook", "twitter", "rss"}
    assert {r["lastCreatedAt"] for r in rows} == {newest}
