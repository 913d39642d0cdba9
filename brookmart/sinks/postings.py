"""A stored word index, and ranked search in it.

Every batch of documents adds postings ``(term, doc, n, length)`` to the buckets of
its terms; a search reads the buckets of the words it asks for and no text. A document
that comes again replaces its former self: a forward table, in buckets of documents,
knows its former words, and those it has lost become postings of no occurrences, which
go when their bucket is merged. The number of documents and of words are sums kept the
same way. A batch that runs again changes nothing, at whatever step it failed before.

A batch must hold a document once. A null or empty text is a document without words.
Terms are words in lower case, of letters and digits, counted within a document's row;
postings are written by the tasks that counted them, without a shuffle, and scored row by
row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from brookmart.functions.text import words
from brookmart.operators.keyed import last_per_key
from brookmart.sinks import buckets

# The usual parameters of the BM25 score.
K, B = 1.2, 0.75
#: Decimal places of a score; what the order of additions may change lies far below.
PLACES = 6

_LONG, _TEXT = T.LongType(), T.StringType()
POSTINGS = T.StructType([T.StructField("term", _TEXT), T.StructField("doc", _LONG), T.StructField("n", _LONG),
                         T.StructField("length", _LONG), T.StructField("seen", _LONG)])
TEXTS = T.StructType([T.StructField("doc", _LONG), T.StructField("terms", T.ArrayType(_TEXT)),
                      T.StructField("length", _LONG)])
TOTALS = T.StructType([T.StructField("part", _LONG), T.StructField("docs", _LONG), T.StructField("words", _LONG)])


def _newest(rows: DataFrame, more: Sequence[str] = ()) -> DataFrame:
    return last_per_key(rows, ["term", "doc", *more], ["seen"])


def _summed(rows: DataFrame, more: Sequence[str] = ()) -> DataFrame:
    return rows.groupBy("part", *more).agg(F.sum("docs").alias("docs"), F.sum("words").alias("words"))


def _counts(words: Column) -> Column:
    """``(term, n)`` of each different word of an array, from its runs in order."""
    def runs(s: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(1), F.size(s)), lambda i: (i == 1) | (F.get(s, i - 1) != F.get(s, i - 2)))
        ends = F.concat(F.slice(starts, 2, F.size(s)), F.array(F.size(s) + 1))
        return F.zip_with(starts, ends, lambda i, j: F.struct(
            F.get(s, i - 1).alias("term"), (j - i).cast("bigint").alias("n")))

    # an array of one array binds the sorted words, which are sorted once
    return F.when(F.size(words) > 0, F.get(F.transform(F.array(F.array_sort(words)), runs), F.lit(0)))


def _made(rows: DataFrame, former: DataFrame) -> DataFrame:
    """``(term, doc, n, length)`` of documents ``(doc, w, length)`` that come once; the words
    they had in ``former`` and have no more count 0. Words are counted in their row."""
    now = rows.select("doc", "length", F.explode(_counts(F.col("w"))).alias("c")).select(
        "c.term", "doc", "c.n", "length")
    lost = rows.select("doc", F.array_distinct("w").alias("_now")).join(former.select("doc", "terms"), "doc").select(
        "doc", F.explode(F.array_except("terms", "_now")).alias("term"))
    zero = F.lit(0).cast("bigint").alias("n")
    return now.unionByName(lost.select("term", "doc", zero, F.lit(None).cast("bigint").alias("length")))


def _summed_up(rows: DataFrame, former: DataFrame) -> DataFrame:
    """The same of documents that a batch holds several times, of which all words count."""
    each = rows.select("doc", "length", F.explode("w").alias("term"), F.lit(1).alias("n")).unionByName(
        former.select("doc", F.lit(None).cast("bigint").alias("length"), F.explode("terms").alias("term"), F.lit(0).alias("n")))
    return each.groupBy("term", "doc").agg(F.sum("n").alias("n"), F.max("length").alias("length"))


def add(docs: DataFrame, path: str, batch_id: int, key: str, text: str, n: int | None = None) -> bool:
    """Add or replace documents; False if the batch is there already."""
    found = F.filter(words(F.coalesce(F.col(text), F.lit(""))), lambda w: w != "")
    rows = docs.select(F.col(key).cast("bigint").alias("doc"), found.alias("w")).withColumn(
        "length", F.size("w").cast("bigint"))
    known = buckets.lookup(rows, ["doc"], f"{path}/texts", TEXTS, ["doc"], before=batch_id)
    former = known.join(rows.select("doc"), "doc", "left_semi")
    again = rows.groupBy("doc").count().where("count > 1").select(F.col("doc").alias("_doc"))
    if again.isEmpty():
        made = _made(rows, former)
    else:
        def of(r: DataFrame, how: str) -> DataFrame:
            return r.join(again, r["doc"].eqNullSafe(again["_doc"]), how)

        made = _made(of(rows, "left_anti"), of(former, "left_anti")).unionByName(
            _summed_up(of(rows, "left_semi"), of(former, "left_semi")))
    buckets.upsert(made.withColumn("seen", F.lit(batch_id).cast("bigint")).select(POSTINGS.names),
                   f"{path}/postings", batch_id, ["term"], n, combine=_newest, fresh=F.col("n") > 0, spread=False)
    change = rows.select(F.lit(1).alias("docs"), F.col("length").alias("words")).unionByName(
        former.select(F.lit(-1).alias("docs"), (-F.col("length")).alias("words")))
    buckets.upsert(_summed(change.withColumn("part", F.lit(0).cast("bigint"))), f"{path}/totals", batch_id,
                   ["part"], 1, combine=_summed)
    # last: until it is there, a repeated batch finds the former words
    return buckets.upsert(rows.select("doc", F.array_distinct("w").alias("terms"), "length"),
                          f"{path}/texts", batch_id, ["doc"], n, spread=False)


def postings(spark: SparkSession, path: str, asked: Sequence[str]) -> DataFrame:
    """``(term, doc, n, length)`` of some words, from the buckets they fall in."""
    terms = spark.createDataFrame([(t,) for t in asked], "term string")
    rows = buckets.parts(terms, ["term"], f"{path}/postings", POSTINGS).drop(buckets.BATCH)
    return _newest(rows.where(F.col("term").isin(*asked))).where("n > 0").drop("seen")


def search(spark: SparkSession, path: str, asked: Sequence[str], size: int = 10) -> DataFrame:
    """The best ``size`` documents ``(doc, score)`` for some words, by BM25; of equal
    scores the smaller id comes first. Words count once, in whatever case."""
    asked = sorted({w.lower() for w in asked})
    total = _summed(buckets.everything(spark, f"{path}/totals", TOTALS)).first()
    n_docs, mean = (total.docs, max(total.words / total.docs, 1e-9)) if total and total.docs else (0, 1.0)
    found = postings(spark, path, asked)
    # one row per word asked for
    counts = F.broadcast(found.groupBy("term").agg(F.count(F.lit(1)).alias("df")))
    rarity = F.log(1 + (n_docs - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weight = F.col("n") * (K + 1) / (F.col("n") + K * (1 - B + B * F.col("length") / mean))
    scored = found.join(counts, "term").groupBy("doc").agg(F.round(F.sum(rarity * weight), PLACES).alias("score"))
    return scored.orderBy(F.desc("score"), "doc").limit(size)
