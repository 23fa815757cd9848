"""Small column helpers that several operators share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD_GAP = r"[\x20\x09-\x0D]+"
_BLOCK = 256


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def whole_text(name: str = "text") -> Column:
    """The text; NULL counts as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def unused(docs: DataFrame, name: str) -> str:
    """The name, or the name with underscores, that no column of docs has."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def words(text: Column) -> Column:
    """Runs of anything but ASCII white space, in order."""
    return F.array_remove(F.split(text, WORD_GAP), "")


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with `value` evaluated once, also where a lambda inside reads it many times."""
    return F.element_at(F.transform(F.array(value), use), 1)


def running_starts(lengths: Column) -> Column:
    """Start offset of every piece, given the pieces' lengths.

    Sums run inside blocks and over block totals, so that long lists don't copy a growing array
    once per element.
    """
    def extend(total: Column, step: Column) -> Column:
        return F.concat(total, F.array(F.element_at(total, -1) + step))

    def within(sizes: Column) -> Column:
        count = F.ceil(F.size(sizes) / _BLOCK).cast("int")
        blocks = F.transform(
            F.sequence(F.lit(0), F.greatest(count, F.lit(1)) - 1),
            lambda b: F.slice(sizes, b * _BLOCK + 1, _BLOCK),
        )
        zero = F.array(F.lit(0).cast("long"))

        def spread(parts: Column) -> Column:
            firsts = F.aggregate(
                parts, zero,
                lambda t, p: extend(t, F.aggregate(p, F.lit(0).cast("long"), lambda a, x: a + x)),
            )
            return let(firsts, lambda at: F.flatten(F.transform(
                parts,
                lambda p, b: F.slice(
                    F.aggregate(p, F.array(F.get(at, b)), extend), F.lit(1), F.size(p)
                ),
            )))

        return let(blocks, spread)

    return let(lengths, within)
