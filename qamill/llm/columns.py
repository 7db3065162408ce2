"""Column helpers built from Spark's own functions: they run in the JVM, without Python."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space between words: space and 0x09-0x0D.
BLANKS = r"[\x20\x09-\x0D]+"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value computed once however often use refers to it, also inside lambdas."""
    return F.transform(F.array(value), use)[0]


def words(text: Column) -> Column:
    """Words of a text, null as empty."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANKS), "")


def covered(places: Column, width: int) -> Column:
    """How many places the stretches [p, p + width) of a sorted array of places cover."""
    step = lambda acc, p: F.struct(
        (p + width).alias("end"), (acc["n"] + p + width - F.greatest(p, acc["end"])).alias("n"))
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
    return F.aggregate(places, zero, step, lambda acc: acc["n"].cast("long"))
