"""Licence scan by a trained paragraph classifier, in DataFrame functions and MLlib alone.

Paragraphs (lines of text) become sparse vectors of the words and word pairs that occur in a template. A multinomial
logistic regression with one class per licence family and one for everything else learns from every document: of half of
all paragraphs (by hash) that share no run of words with a template, each is trained on as it is, as no licence, and once
more with a template put into it, as one of the template's family; the templates alone come on top. All paragraphs of the
other half set the limit above which a paragraph counts as a licence at all, so that ``FALSE_ALARMS`` of them would. What
the classifier says is compared with the family's templates: a paragraph that holds most word triples of one is confirmed,
one that holds a few is an ``unknown`` licence.

Texts are read once. What stays of a paragraph are the terms it has in common with any template, hashes of 64 bits: training, limit
and comparison need no more. A paragraph without a template's triple can be neither confirmed nor unknown and is only trained on.

Nulls, ties and other cases: null and empty texts have licence ``none``; equal rows have equal results; of several
licences in a document the best confirmed one counts, then the likelier, the earlier and the first in the alphabet, and
``families`` lists all; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import table, whole_text
from tidemark.llm.license_templates import OTHERS, TEMPLATES
from tidemark.sources.staging import staged

FALSE_ALARMS = 0.001
CONFIRMED = 0.6
#: What shares fewer triples with all templates of the family is running text after all.
RELATED = 0.15
#: Weight of the templates alone and of ``OTHERS``, as a share of that of the paragraphs of all documents.
ALONE, COUNTER = 0.25, 0.05
NONE, UNKNOWN = "none", "unknown"
FAMILIES = [NONE, *sorted(TEMPLATES)]


def words(text: Column) -> Column:
    return F.split(F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}.+-]+|[.](?=\s|$)", " ")), " +")


def _joined(left: str, right: str, at: int, *seed: Column) -> Column:
    """Hashes of each element of ``left`` with the one of ``right`` that is ``at`` places behind."""
    rest = F.slice(right, at + 1, 1 << 30)
    return F.zip_with(F.slice(left, F.lit(1), F.size(rest)), rest, lambda a, b: F.xxhash64(a, b, *seed))


def hashed(rows: DataFrame, text: str) -> DataFrame:
    """``rows`` with the hashes of a column's words and pairs in ``terms`` and of its triples (of fewer words, of all) in ``triples``."""
    rows = rows.withColumn("_w", words(F.col(text))).withColumn("_h", F.transform("_w", lambda w: F.xxhash64(w)))
    rows = rows.withColumn("_p", _joined("_h", "_h", 1))
    triples = F.when(F.size("_w") < 3, F.array(F.xxhash64(F.array_join("_w", " "), F.lit("triple")))).otherwise(_joined("_p", "_h", 2, F.lit("triple")))
    return rows.withColumn("terms", F.concat("_h", "_p")).withColumn("triples", triples).drop("_w", "_h", "_p")


def _constants(spark, rows: list[tuple[str, str]]) -> DataFrame:
    """family and template, a few dozen rows."""
    values = F.array(*[F.struct(F.lit(f).alias("family"), F.lit(t).alias("template")) for f, t in rows])
    return spark.range(1).select(F.explode(values).alias("r")).select("r.family", "r.template")


def templates(spark) -> DataFrame:
    """family, template, number, and distinct terms and triples."""
    rows = hashed(_constants(spark, [(f, t) for f, ts in TEMPLATES.items() for t in ts]), "template")
    number = F.array_position(F.array(*[F.lit(t) for ts in TEMPLATES.values() for t in ts]), F.col("template")) - 1
    return rows.withColumn("terms", F.array_distinct("terms")).withColumn("triples", F.array_distinct("triples")).withColumn("number", number)


def _of(values: list[int]) -> Column:
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def paragraphs(docs: DataFrame, *keys: str) -> DataFrame:
    """Lines with words, with their number."""
    lines = F.posexplode(F.split(whole_text(), "\n+"))
    return docs.select(*keys, lines.alias("pos", "paragraph")).where(F.trim("paragraph") != "")


def reduced(docs: DataFrame, known: DataFrame, *keys: str) -> DataFrame:
    """keys, pos, half, hits and near of every paragraph of ``docs``: its terms and triples that a template (``known``) has too, and
    whether any is a triple."""
    own = known.select(F.array_sort("terms"), F.array_sort("triples")).collect()  # a few thousand numbers
    triples = sorted({t for _, each in own for t in each})
    lines = hashed(paragraphs(docs, *keys), "paragraph")
    hits = F.array_intersect(F.concat("terms", "triples"), _of(sorted({t for row in own for each in row for t in each})))
    lines = lines.select(*keys, "pos", F.xxhash64("paragraph", F.lit("half")).alias("half"), hits.alias("hits"))
    return lines.withColumn("near", F.arrays_overlap("hits", _of(triples)))


def train(lines: DataFrame, known: DataFrame):
    """The classifier and the least licence probability of a paragraph that counts, from all ``lines``."""
    spark = lines.sparkSession
    others = lines.where("not near").select("half", "hits")
    seen, unseen = others.where("half % 2 = 0"), others.where("half % 2 != 0")
    total = max(1, seen.count())
    count = sum(map(len, TEMPLATES.values()))
    inside = seen.withColumn("number", F.pmod(F.xxhash64("half", F.lit("template")), F.lit(count))).join(
        F.broadcast(known.select("number", "family", F.col("terms").alias("own"))), "number"
    )
    alone, counter = max(1.0, total * ALONE / count), max(1.0, total * COUNTER / len(OTHERS))
    rows = (
        seen.select(F.lit(NONE).alias("family"), "hits", F.lit(1.0).alias("weight"))
        .unionByName(inside.select("family", F.array_union("hits", "own").alias("hits"), F.lit(1.0).alias("weight")))
        .unionByName(known.select("family", F.col("terms").alias("hits"), F.lit(alone).alias("weight")))
        .unionByName(hashed(_constants(spark, [(NONE, t) for t in OTHERS]), "template").select("family", F.col("terms").alias("hits"), F.lit(counter).alias("weight")))
    )
    label = F.array_position(F.array(*[F.lit(f) for f in FAMILIES]), F.col("family")) - 1
    vocabulary = sorted(r[0] for r in known.select(F.explode("terms")).distinct().collect())
    vectors = CountVectorizerModel.from_vocabulary([str(t) for t in vocabulary], "_terms", "features")
    vectors.setBinary(True)
    rows = featured(vectors, rows).select(label.cast("double").alias("label"), "weight", "features")
    model = LogisticRegression(family="multinomial", maxIter=40, regParam=0.0005, weightCol="weight").fit(rows)
    limit = scored(model, featured(vectors, unseen)).agg(F.percentile_approx("p", 1 - FALSE_ALARMS, 10000)).first()[0]
    return model, vectors, min(0.95, max(0.5, limit or 0.0))


def featured(vectors, rows: DataFrame) -> DataFrame:
    """``rows`` with the words and pairs among ``hits`` in ``features``."""
    return vectors.transform(rows.withColumn("_terms", F.col("hits").cast("array<string>"))).drop("_terms")


def scored(model, rows: DataFrame) -> DataFrame:
    """``rows`` (with ``features``) with ``p``, the probability of a licence, and ``family``, the likeliest one."""
    rows = model.transform(rows).withColumn("_p", vector_to_array("probability"))
    names = F.array(*[F.lit(f) for f in FAMILIES[1:]])
    licences = F.slice("_p", 2, len(FAMILIES))
    best = F.get(names, (F.array_position(licences, F.array_max(licences)) - 1).cast("int"))
    return rows.withColumn("p", 1 - F.get("_p", F.lit(0))).withColumn("family", best)


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, license, score, overlap, families and n_license_paragraphs of every document."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    row = F.xxhash64("doc_id", "text").alias("row")
    known = staged(templates(spark), "licence-templates")
    lines = staged(reduced(docs.select(row, "text"), known, "row"), "licence-lines")
    model, vectors, limit = train(lines, known)
    found = scored(model, featured(vectors, lines.where("near"))).where(F.col("p") >= limit).select("row", "pos", "hits", "family", "p")
    # Few templates a family; each paragraph found is held against those of its own.
    against = known.select("family", F.col("triples").alias("own"))
    shares = F.size(F.array_intersect("hits", "own")) / F.size("own")
    compared = found.join(F.broadcast(against), "family").groupBy("row", "pos", "family").agg(
        F.max(shares).alias("overlap"), F.max("p").alias("p")
    )
    kind = F.when(F.col("overlap") >= CONFIRMED, F.col("family")).when(F.col("overlap") >= RELATED, UNKNOWN)
    compared = compared.withColumn("license", kind).where("license is not null")
    best = F.max(F.struct((F.col("license") != UNKNOWN).alias("sure"), "overlap", "p", (-F.col("pos")).alias("at"), "license"))
    per = compared.groupBy("row").agg(
        best.alias("best"), F.array_sort(F.collect_set("license")).alias("families"), F.countDistinct("pos").alias("n")
    )
    rows = docs.select("doc_id", row).join(per, "row", "left")
    return rows.select(
        "doc_id", F.coalesce("best.license", F.lit(NONE)).alias("license"), F.coalesce("best.p", F.lit(0.0)).alias("score"),
        F.coalesce("best.overlap", F.lit(0.0)).alias("overlap"),
        F.coalesce("families", F.array().cast("array<string>")).alias("families"),
        F.coalesce("n", F.lit(0)).cast("bigint").alias("n_license_paragraphs"),
    )


def op9_license_scan(spark, sf_dir) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
