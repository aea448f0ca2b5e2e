"""What landed is written once, and its texts are not shuffled to leave out copies."""

from __future__ import annotations

from pyspark.sql import functions as F

from tests.test_views import exchanges
from tidemark.operators import keys as K
from tidemark.plans import collect as C
from tidemark.sources import landing


def tweets(spark):
    lines = [f'{{"id": {i}, "id_str": "{i}", "full_text": "tweet {i}", "favorite_count": {n}}}' for i in range(6) for n in range(1 + i % 2)]
    return landing.parse_tweets(spark.createDataFrame([(line,) for line in [*lines, '{"id": 7}']], "payload string"), "payload")


def test_without_a_cap_landed_rows_are_staged_once(spark, monkeypatch):
    written = []
    plain = C.staged
    monkeypatch.setattr(C, "staged", lambda rows, name: written.append((name, rows.columns)) or plain(rows, name))
    taken = C._twitter_taken(tweets(spark), -1, 5)
    assert [name for name, columns in written if "full_text" in columns] == ["tweets-landed"]
    kept = taken.rows.collect()
    assert sorted(r["id"] for r in kept) == [0, 1, 2, 3, 4, 5, 7] and taken.left_out["duplicate"] == 3
    assert "_row" not in taken.rows.columns


def test_many_copies_and_few_leave_the_same_rows(spark, monkeypatch):
    few = sorted(map(repr, C._twitter_taken(tweets(spark), None, 4).rows.collect()))
    monkeypatch.setattr(C.K, "is_small", lambda rows, bound=0: False)
    assert sorted(map(repr, C._twitter_taken(tweets(spark), None, 4).rows.collect())) == few and len(few) == 5


def test_copies_are_found_by_narrow_rows(spark):
    rows = spark.range(9).select(F.col("id").alias("_row"), (F.col("id") % 4).alias("k"), F.lit("long").alias("text"), F.rand(1).alias("r"))
    found = K.later_copies(rows, "_row", ["k"], [F.col("_row").desc()])
    assert not any("text" in names for names in exchanges(found._jdf.queryExecution().executedPlan()))
    assert sorted(r["_row"] for r in found.collect()) == [0, 1, 2, 3, 4]
