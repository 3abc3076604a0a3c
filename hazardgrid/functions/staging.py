"""Keep costly expressions in one place of the plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def evaluate_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add ``value`` as column ``name`` so that later filters do not copy it.

    Catalyst pushes a filter below a projection by repeating the projected
    expression in the filter. For a parser or a long rule chain that means
    running it twice per row. A filter cannot pass a generator whose output it
    uses, so the value goes through a one-element ``explode``, which adds no
    rows and no shuffle. The value is computed in a projection before it: what
    stands inside a generator is interpreted once its stage is too large to
    compile as a whole.
    """
    return df.withColumn("_once", value).select("*", F.explode(F.array("_once")).alias(name)).drop("_once")

