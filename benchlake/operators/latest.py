"""Latest-wins writes as plans: the last row of each key, whole, or column by column."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_wins(rows: DataFrame, keys: tuple[str, ...], seq: str) -> DataFrame:
    """The last row of each key by ``seq``, every column with its nulls. A max of a struct combines on
    the map side, where a window would shuffle and sort every version."""
    rest = [c for c in rows.columns if c not in (*keys, seq)]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), seq).alias("r")).select(*keys, *(F.col(f"r.{c}").alias(c) for c in rest))


def merge_non_null(rows: DataFrame, keys: tuple[str, ...], seq: str, overwrite: tuple[str, ...] = ()) -> DataFrame:
    """Column by column the last value that is not null; columns in ``overwrite`` take the last row's."""
    rest = [c for c in rows.columns if c not in (*keys, seq)]
    pick = {c: F.max_by(c, seq) if c in overwrite else F.max_by(c, F.when(F.col(c).isNotNull(), F.col(seq))) for c in rest}
    return rows.groupBy(*keys).agg(*(x.alias(c) for c, x in pick.items()))


def replace_partitions(old: DataFrame, new: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """All rows of new, and those of old whose partition new does not hold."""
    return old.join(new.select(*keys).distinct(), list(keys), "left_anti").unionByName(new, allowMissingColumns=True)
