"""Document fingerprints by SpotSigs, in DataFrame functions alone.

Every common word (an anchor) is followed by a chain, the next ``CHAIN`` content words; anchor and chain together are a
signature, and a text's fingerprint is the set of its signatures as 32-bit hashes, in order, in base 64. Common words
carry no topic but stand all over running text, so lists, menus and the like have few signatures. A text with fewer than
``FEW`` also has the pairs of its neighbouring content words; one without words has its whole text.

Fingerprints are compared by the Jaccard coefficient of the sets. It can't exceed the ratio of their sizes, so
:func:`near_pairs` partitions fingerprints by size, looks only at neighbouring partitions and only at sets that share
one of the rarest signatures of both.

The document after another one is found by a range sort of the ids alone; the texts are shuffled once by row, and of a
text only what the document before it needs travels again.

Nulls, ties and other cases: a null text is an empty one; equal rows are one document in the order; rows with one id
are ordered by a hash of the text, null ids come last; the only document is its own next one; empty sets are alike
(1) if both are empty, and unlike (0) to others; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import table, whole_text
from tidemark.sources.staging import staged

CHAIN = 2
FEW = 16
#: Function words of the languages at hand.
ANCHORS = {
    "en": "the of and to in a is that it for was on with be as by this are at an from he or than then not have his",
    "de": "der die und den von das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat zu",
    "fr": "de la le et les des un du une que en est pour qui dans par sur pas au avec son se il ne ce",
    "es": "que el la y los del las se un por con no una su para es al lo como más o pero sus",
}
MARK = "\u0001"


def _anchored(text: Column) -> Column:
    """A text's words in lower case: content words after a space, anchors after ``MARK``."""
    words = "|".join(sorted({w for line in ANCHORS.values() for w in line.split()}, key=lambda w: (-len(w), w)))
    plain = F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))
    return F.regexp_replace(F.concat(F.lit(" "), plain), f" ({words})(?= |$)", MARK + "$1")


def _content(part: Column) -> Column:
    return F.substring_index(part, MARK, 1)


def signatures(rows: DataFrame, text: str, out: str) -> DataFrame:
    """``rows`` with the signature hashes of column ``text``, sorted, in column ``out``."""
    # Each element is a content word with the anchors that follow it; the first may be anchors only.
    rows = rows.withColumn("_parts", F.split(_anchored(F.col(text)), " "))

    def chains(part: Column, at: Column) -> Column:
        chain = F.concat_ws(" ", *[_content(F.get("_parts", at + k)) for k in range(1, CHAIN + 1)])
        anchors = F.slice(F.split(part, MARK), 2, 1 << 20)
        whole = part.contains(MARK) & (at + CHAIN < F.size("_parts"))
        return F.when(whole, F.transform(anchors, lambda anchor: F.hash(anchor, chain))).otherwise(
            F.array().cast("array<int>")
        )

    rows = rows.withColumn("_spots", F.array_distinct(F.flatten(F.transform("_parts", chains))))
    pairs = F.transform(
        F.slice("_parts", 2, 1 << 30),
        lambda part, at: F.hash(_content(part), _content(F.coalesce(F.get("_parts", at + 2), F.lit("")))),
    )
    few = F.when(F.size("_parts") > 1, F.array_distinct(pairs)).when(
        F.length(text) > 0, F.array(F.hash(F.col(text)))
    )
    few = F.array_union("_spots", F.coalesce(few, F.array().cast("array<int>")))
    chosen = F.when(F.size("_spots") >= FEW, F.col("_spots")).otherwise(few)
    return rows.withColumn(out, F.array_sort(chosen)).drop("_parts", "_spots")


def fingerprint(signs: str) -> Column:
    digits = F.transform(signs, lambda s: F.right(F.concat(F.lit("0000000"), F.hex(s.cast("bigint"))), F.lit(8)))
    return F.base64(F.unhex(F.array_join(digits, "")))


def likeness(one: str, other: str) -> Column:
    common = F.size(F.array_intersect(one, other))
    both = F.size(one) + F.size(other)
    return F.when(both == 0, F.lit(1.0)).otherwise((common / (both - common)).cast("double"))


def neighbours(docs: DataFrame) -> DataFrame:
    """row, doc_id, prev_row and prev_n (length) of every document in the order of ``doc_id``, the first one's being the
    last one; docs has row, doc_id and text."""
    keys = docs.select(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row", F.length("text").cast("bigint").alias("n"))
    order = ["no_id", "doc_id", "row"]
    keys = keys.distinct().repartitionByRange(*order).withColumn("part", F.spark_partition_id())
    keys = staged(keys, "spot-keys")
    # First and last document of each range: as many rows as partitions.
    last = F.max(F.struct(*order, "n")).alias("last")
    edges = keys.groupBy("part").agg(F.min(F.struct(*order)).alias("first"), last)
    by_part, everywhere = Window.orderBy("part"), Window.partitionBy(F.lit(0))
    edges = edges.select(
        "part", F.coalesce(F.lag("last").over(by_part), F.max("last").over(everywhere)).alias("before")
    )
    inside = Window.partitionBy("part").orderBy(*order)
    keys = keys.withColumn("prev", F.lag(F.struct(*order, "n")).over(inside)).join(F.broadcast(edges), "part")
    prev = F.coalesce("prev", "before")
    return keys.select("row", "doc_id", prev["row"].alias("prev_row"), prev["doc_id"].alias("prev_id"), prev["n"].alias("prev_n"))


def spot_fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next of every document."""
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text"))
    docs = docs.withColumn("row", F.xxhash64("doc_id", "text"))
    # Both sides read the same exchange of whole texts.
    same = lambda a, b: (a["row"] == b["row"]) & a["doc_id"].eqNullSafe(b["doc_id"])
    keys = neighbours(docs)
    after = docs.join(keys, same(docs, keys)).select(
        F.col("prev_row").alias("to_row"), F.col("prev_id").alias("to_id"), docs["text"].alias("whole"),
        F.substring("text", F.lit(1), F.floor(F.col("prev_n") / 4).cast("int")).alias("head"),
    )
    after = signatures(after, "whole", "next_signs").select("to_row", "to_id", "head", "next_signs")
    after = after.groupBy("to_row", "to_id").agg(F.first("head").alias("head"), F.first("next_signs").alias("next_signs"))
    rows = docs.join(after, (F.col("row") == F.col("to_row")) & F.col("doc_id").eqNullSafe(F.col("to_id")))
    n = F.length("text")
    rows = rows.select(
        "doc_id", "text", n.cast("bigint").alias("n_chars"), "next_signs",
        F.concat(F.substring("text", F.lit(1), (n - F.floor(n / 4)).cast("int")), F.col("head")).alias("edited"),
    )
    rows = signatures(signatures(rows, "text", "signs"), "edited", "edited_signs")
    return rows.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), fingerprint("signs").alias("fingerprint"),
        fingerprint("edited_signs").alias("edited_fingerprint"), likeness("signs", "edited_signs").alias("near_edited"),
        likeness("signs", "next_signs").alias("near_next"),
    )


def op3_spotsigs(spark, sf_dir) -> DataFrame:
    return spot_fingerprints(table(spark, sf_dir, "documents"))
