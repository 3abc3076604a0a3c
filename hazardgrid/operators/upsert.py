"""Key-based merge of a batch of rows into a table's rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unique_by_key(source: DataFrame, keys: list[str]) -> DataFrame:
    """The source rows, failing the job on a repeated or incomplete key.

    Implemented as an aggregation so that a heavily repeated key is combined
    before the shuffle; the merge join then reuses the partitioning.
    """
    values = [c for c in source.columns if c not in keys]
    counted = source.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), F.any_value(F.struct(*values)).alias("_row")
    )
    shown = F.concat_ws(", ", *[F.coalesce(F.col(k).cast("string"), F.lit("null")) for k in keys])
    incomplete = ~F.concat(*[F.col(k).cast("string") for k in keys]).isNotNull()
    checked = (
        F.when(F.col("_n") > 1, F.raise_error(F.concat(F.lit("duplicate merge key: "), shown)))
        .when(incomplete, F.raise_error(F.concat(F.lit("incomplete merge key: "), shown)))
        .otherwise(F.col("_row"))
    )
    return counted.select(*keys, checked.alias("_row")).select(
        *keys, *[F.col("_row")[c].alias(c) for c in values]
    )


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    update_cols: list[str],
    insert_defaults: dict[str, Column] | None = None,
) -> DataFrame:
    """Target rows after the merge.

    A matched row takes ``update_cols`` from the source and keeps the rest; an
    unmatched source row is inserted with ``insert_defaults`` for the columns
    it does not bring.
    """
    defaults = insert_defaults or {}
    src = (
        unique_by_key(source.select(*keys, *update_cols), keys)
        .withColumn("_hit", F.lit(True))
        .withColumnsRenamed({c: f"_src_{c}" for c in update_cols})
    )
    merged = target.withColumn("_kept", F.lit(True)).join(src, keys, "full_outer")

    def value(name: str) -> Column:
        if name in keys:
            return F.col(name)
        if name in update_cols:
            return F.when(F.col("_hit"), F.col(f"_src_{name}")).otherwise(F.col(name)).alias(name)
        default = defaults.get(name, F.lit(None).cast(target.schema[name].dataType))
        return F.when(F.col("_kept"), F.col(name)).otherwise(default).alias(name)

    return merged.select(*[value(c) for c in target.columns])
