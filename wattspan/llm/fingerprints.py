"""Document fingerprints: one-permutation MinHash with densification and packed low-order bits.

Every five-word shingle is hashed once; the high bits of the hash name its bin and each bin keeps its
least hash. An empty bin borrows from the first occupied bin of its own fixed random sequence of
attempts (optimal densification), and `BITS` low-order bits of each bin are kept. The share of equal
bins is corrected for the chance that unequal values agree in their low bits.

Spark SQL functions only. Successors are found on ids alone: ids are range-partitioned, written to the
shared folder, led within a part, and parts are linked by their first ids. Texts are joined by id.

Defined results: NULL text counts as empty; a text with one to four words is one shingle of them all;
a text without words has the fingerprint '' and likeness 1 to another such text, 0 to any other. Rows
whose doc_id repeats share one successor; as a successor, such an id stands for its least head. Rows
with NULL doc_id have no successor: their last quarter is replaced by nothing and `near_next` is 0.
Other columns are not read. An empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise
from .common import let, whole_text, words

BIN_BITS = 7
BINS = 1 << BIN_BITS
BITS = 8
SHINGLE = 5
_QUICK = 6


def _attempts() -> Column:
    """For each bin, all bins in a fixed pseudo-random order of attempts."""
    def rank(bin_: int, other: int) -> bytes:
        return hashlib.blake2b(f"{bin_}:{other}".encode(), digest_size=8).digest()

    rows = [sorted(range(BINS), key=lambda other: rank(b, other)) for b in range(BINS)]
    return F.from_json(F.lit(json.dumps(rows)), "array<array<int>>")


def shingle_hashes(text: Column) -> Column:
    """Hashes of all five-word shingles; a shorter text is one shingle."""
    def slide(hashed: Column) -> Column:
        last = F.greatest(F.size(hashed) - SHINGLE, F.lit(0))
        return F.transform(
            F.sequence(F.lit(0), last),
            lambda i: F.xxhash64(*[F.get(hashed, i + k) for k in range(SHINGLE)]),
        )

    return let(F.transform(words(text), lambda w: F.xxhash64(w)), slide)


def _bin(value: Column) -> Column:
    return F.shiftrightunsigned(value, 64 - BIN_BITS).cast("int")


def bins(text: Column) -> Column:
    """The low-order bits of all bins as array<tinyint>; NULL for a text without words."""
    def least(ordered: Column) -> Column:
        return F.filter(
            ordered, lambda v, i: (i == 0) | (_bin(v) != _bin(F.get(ordered, i - 1)))
        )

    def densify(sparse: Column) -> Column:
        attempts = _attempts()

        def borrowed(j: Column) -> Column:
            row = F.get(attempts, j)
            quick = [F.get(sparse, F.get(row, F.lit(t))) for t in range(_QUICK)]
            rest = F.get(F.filter(row, lambda b: F.get(sparse, b).isNotNull()), F.lit(0))
            return F.coalesce(*quick, F.get(sparse, rest))

        return F.transform(sparse, lambda v, j: F.coalesce(v, borrowed(j)))

    def spread(minima: Column) -> Column:
        def place(by_bin: Column) -> Column:
            return F.transform(
                F.sequence(F.lit(0), F.lit(BINS - 1)), lambda j: F.element_at(by_bin, j)
            )

        return let(F.map_from_arrays(F.transform(minima, _bin), minima), place)

    def low(values: Column) -> Column:
        return F.transform(values, lambda v: (v.bitwiseAND((1 << BITS) - 1) - (1 << (BITS - 1))).cast("tinyint"))

    full = let(F.sort_array(shingle_hashes(text)),
               lambda s: let(least(s), lambda m: let(spread(m), lambda d: low(densify(d)))))
    return F.when(text.rlike(r"[^\x20\x09-\x0D]"), full)


def packed(values: Column) -> Column:
    """Two hexadecimal digits per bin; '' for a text without words."""
    digits = F.transform(values, lambda v: F.lpad(F.hex(v.cast("int") + (1 << (BITS - 1))), BITS // 4, "0"))
    return F.lower(F.coalesce(F.array_join(digits, ""), F.lit("")))


def likeness(one: Column, other: Column) -> Column:
    """Estimated Jaccard similarity, corrected for chance agreement of the kept bits.

    Both arrays are bound first: a filter above may push their expressions into the lambda.
    """
    chance = 2.0 ** -BITS

    def rated(a: Column, b: Column) -> Column:
        equal = F.size(F.filter(F.sequence(F.lit(0), F.lit(BINS - 1)), lambda i: F.get(a, i) == F.get(b, i)))
        corrected = F.greatest(F.lit(0.0), (equal / F.lit(float(BINS)) - chance) / (1 - chance))
        return F.when(a.isNull() & b.isNull(), 1.0).when(a.isNull() | b.isNull(), 0.0).otherwise(corrected)

    return let(one, lambda a: let(other, lambda b: rated(a, b)))


def successors(docs: DataFrame) -> DataFrame:
    """(of_id, next_id, need): the next greater id, after the last the first; need: code points asked of it."""
    ids = (docs.where("doc_id IS NOT NULL").select("doc_id", F.floor(F.length(whole_text()) / 4).alias("need"))
           .groupBy("doc_id").agg(F.max("need").alias("need")))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    laid = materialise(
        ids.repartitionByRange(parts, "doc_id").withColumn("part", F.spark_partition_id()), "successors"
    )
    firsts = laid.groupBy("part").agg(F.min("doc_id").alias("first_id"))
    by_part = Window.orderBy("part")  # one row per part
    onward = firsts.select(
        "part",
        F.coalesce(F.lead("first_id").over(by_part),
                   F.first("first_id").over(by_part.rowsBetween(Window.unboundedPreceding, 0))).alias("onward"),
    )
    in_part = Window.partitionBy("part").orderBy("doc_id")
    return (laid.withColumn("next_id", F.lead("doc_id").over(in_part)).join(onward, "part")
            .select(F.col("doc_id").alias("of_id"), F.coalesce("next_id", "onward").alias("next_id"), "need"))


def query(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and the likenesses between them."""
    own = docs.select("doc_id", whole_text().alias("text")).withColumn("bins", bins(F.col("text")))
    known = own.where("doc_id IS NOT NULL")
    after = known.alias("after")  # the same frame by the same key: its exchange is made once
    heads = (successors(docs).join(after, F.col("next_id") == F.col("after.doc_id"))
             .select(F.col("of_id"), F.substring("after.text", F.lit(1), F.col("need").cast("int")).alias("head"),
                     F.col("after.bins").alias("next_bins"))
             .groupBy("of_id").agg(F.min(F.struct("head", "next_bins")).alias("next")))
    paired = (known.join(heads, known["doc_id"] == heads["of_id"])
              .select("doc_id", "text", "bins", "next.head", "next.next_bins"))
    alone = own.where("doc_id IS NULL").select("doc_id", "text", "bins", F.lit("").alias("head"),
                                                F.lit(None).cast("array<tinyint>").alias("next_bins"))
    n = F.length("text")
    cut = F.floor(n / 4).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - cut), F.substring(F.col("head"), F.lit(1), cut))
    return (
        paired.unionByName(alone)
        .withColumn("edited", edited).withColumn("edited_bins", bins(F.col("edited")))
        .select(
            "doc_id", n.cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
            packed(F.col("bins")).alias("fingerprint"), packed(F.col("edited_bins")).alias("edited_fingerprint"),
            likeness(F.col("bins"), F.col("edited_bins")).alias("near_edited"),
            F.when(F.col("doc_id").isNull(), 0.0).otherwise(likeness(F.col("bins"), F.col("next_bins"))).alias("near_next"),
        )
    )
