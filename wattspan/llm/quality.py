"""Quality rules: base rules, then a hashed n-gram log-likelihood ratio per document.

Words and word pairs are hashed into fixed tables of buckets. One multinomial is counted over every
document (raw), one over all trusted documents: labelled quality 1. Documents meet their labels as arrays
of bucket numbers, two bytes each, not as texts. A document's score is the mean log ratio of the two over its n-grams;
it is kept at `THRESHOLD` or more. Spark SQL functions only: the counts are combined before their
shuffle to `2 * BUCKETS` groups, and the weights reach the documents as one array from a scalar
subquery of that fixed size.

Defined results: NULL text has no words; a document without n-grams scores 0; rows with NULL or
repeated doc_id are judged row by row, and all rows of a trusted id count as trusted; labels with NULL
fields are ignored; without trusted documents every score is 0, so that only base rules reject. Other
columns are not read. An empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, whole_text, words

BUCKET_BITS = 16
BUCKETS = 1 << BUCKET_BITS
SMOOTHING = 0.5
THRESHOLD = -0.3
MIN_WORDS = 20
MAX_REPEATED_PERCENT = 30
SYMBOLS = "[#*$%&|<>]"


def _pairs(hashed: Column, apart: int) -> Column:
    """Hash of every two entries that stand `apart` entries from each other.

    The list is bound first: a filter above may push its expression into this lambda.
    """
    def pair(entries: Column) -> Column:
        return F.when(F.size(entries) > apart, F.transform(
            F.sequence(F.lit(0), F.size(entries) - 1 - apart),
            lambda i: F.xxhash64(F.get(entries, i), F.get(entries, i + apart)),
        )).otherwise(F.array().cast("array<bigint>"))

    return let(hashed, pair)


def _bucket(value: Column) -> Column:
    return value.bitwiseAND(BUCKETS - 1).cast("int")


def hashed(docs: DataFrame) -> DataFrame:
    """Add `w1` and `w2`: hashes of words and of word pairs."""
    return (docs.withColumn("w1", F.transform(words(F.col("text")), lambda w: F.xxhash64(w)))
            .withColumn("w2", _pairs(F.col("w1"), 1)))


def trusted_ids(labels: DataFrame) -> DataFrame:
    return (labels.where("quality = 1 AND doc_id IS NOT NULL").select("doc_id").distinct()
            .withColumn("trusted", F.lit(1)))


def weights(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row with the array of log ratios: word buckets first, then pair buckets."""
    half = BUCKETS // 2  # bucket numbers less this fit two bytes

    def small(values: str) -> Column:
        return F.transform(values, lambda v: (_bucket(v) - half).cast("smallint"))

    grams = (
        hashed(docs).select("doc_id", small("w1").alias("b1"), small("w2").alias("b2"))
        .join(trusted_ids(labels).hint("merge"), "doc_id", "left")  # the ids grow with the corpus
        .select(F.coalesce("trusted", F.lit(0)).alias("trusted"), F.explode(F.concat(
            F.transform("b1", lambda v: v.cast("int") + half),
            F.transform("b2", lambda v: v.cast("int") + half + BUCKETS),
        )).alias("bucket"))
    )
    counts = grams.groupBy("bucket").agg(
        F.count(F.lit(1)).cast("double").alias("raw"), F.sum("trusted").cast("double").alias("aim")
    )

    def total(name: str, low: bool) -> Column:
        side = F.col("bucket") < BUCKETS if low else F.col("bucket") >= BUCKETS
        return F.coalesce(F.sum(F.when(side, F.col(name))), F.lit(0.0))

    def fold(kept: Column) -> Column:
        def ratio(c: Column) -> Column:
            low = c["bucket"] < BUCKETS
            aim_all = F.when(low, F.col("aim_low")).otherwise(F.col("aim_high"))
            raw_all = F.when(low, F.col("raw_low")).otherwise(F.col("raw_high"))
            flat = SMOOTHING * BUCKETS
            return F.when(aim_all > 0, F.log((c["aim"] + SMOOTHING) / (aim_all + flat))
                          - F.log((c["raw"] + SMOOTHING) / (raw_all + flat))).otherwise(0.0)

        return F.map_from_entries(F.transform(kept, lambda c: F.struct(c["bucket"], ratio(c))))

    # At most 2 * BUCKETS rows meet here, whatever the corpus holds.
    gathered = counts.agg(
        F.collect_list(F.struct("bucket", "raw", "aim")).alias("kept"),
        total("raw", True).alias("raw_low"), total("raw", False).alias("raw_high"),
        total("aim", True).alias("aim_low"), total("aim", False).alias("aim_high"),
    )
    every = counts.sparkSession.range(2 * BUCKETS).select(F.col("id").cast("int").alias("bucket"))
    rated = gathered.select(F.explode(fold(F.col("kept"))).alias("bucket", "weight"))
    return every.join(rated, "bucket", "left").agg(F.transform(
        F.sort_array(F.collect_list(F.struct("bucket", F.coalesce("weight", F.lit(0.0)).alias("weight")))),
        lambda p: p["weight"],
    ).alias("weights"))


def repeated_words(w2: Column) -> Column:
    """Words inside eight-word windows that occur twice or more, the first occurrence included.

    Windows are hashed from word pairs; only texts with an equal pair of windows are looked at closer.
    """
    def covered(windows: Column) -> Column:
        def pick(pairs: Column) -> Column:
            at = F.sort_array(F.transform(F.filter(
                pairs, lambda p, i: ((i > 0) & (p["h"] == F.get(pairs, i - 1)["h"]))
                | F.coalesce(p["h"] == F.get(pairs, i + 1)["h"], F.lit(False)),
            ), lambda p: p["i"]))
            zero = F.struct(F.lit(0).cast("long").alias("words"), F.lit(0).alias("end"))
            return F.aggregate(at, zero, lambda a, i: F.struct(
                (a["words"] + i + 8 - F.greatest(a["end"], i)).alias("words"), (i + 8).alias("end")
            ), lambda a: a["words"])

        return let(F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), pick)

    def twice(ordered: Column) -> Column:
        return F.exists(F.sequence(F.lit(1), F.greatest(F.size(ordered) - 1, F.lit(1))),
                        lambda i: F.get(ordered, i - 1) == F.get(ordered, i))

    windows = let(_pairs(w2, 2), lambda w4: _pairs(w4, 4))
    return let(windows, lambda w: F.when(let(F.sort_array(w), twice), covered(w))
               .otherwise(F.lit(0).cast("long")))


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    own = docs.select("doc_id", whole_text().alias("text"))
    table = weights(own, labels).scalar()
    grams = hashed(own).withColumn("table", table)

    def score(all_weights: Column) -> Column:
        def total(grams: Column, shift: int) -> Column:
            return F.aggregate(grams, F.lit(0.0), lambda a, v: a + F.get(all_weights, _bucket(v) + shift))

        count = F.greatest(F.size("w1") + F.size("w2"), F.lit(1))
        return (total(F.col("w1"), 0) + total(F.col("w2"), BUCKETS)) / count

    judged = grams.select(
        "doc_id", F.size("w1").cast("long").alias("n_words"),
        F.length(F.array_join(words(F.col("text")), "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        duplicate_lines(F.col("text")).alias("n_dup_lines"),
        repeated_words(F.col("w2")).alias("n_repeat_words"),
        let(F.col("table"), score).alias("llr"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))
    return (judged.withColumn("base_failed", failed)
            .withColumn("kept", ~F.col("base_failed") & (F.col("llr") >= THRESHOLD)))
