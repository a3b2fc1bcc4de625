"""Set-based building blocks of the upserts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T


def keep_one(df: DataFrame, key: list[str], order: str, keep: str) -> DataFrame:
    """The first or last row per key by ``order``, which is dropped.

    An aggregate, not a window: copies of a busy key are reduced before the shuffle.
    """
    pick = {"first": F.min_by, "last": F.max_by}[keep]
    rest = [c for c in df.columns if c not in key and c != order]
    if not rest:
        return df.select(*key).distinct()
    return (
        df.groupBy(*key).agg(pick(F.struct(*rest), F.col(order)).alias("_row"))
        .select(*key, *[F.col(f"_row.{c}").alias(c) for c in rest])
    )


def greatest_leads(df: DataFrame, key: list[str], order: str) -> DataFrame | None:
    """(key.., _lead): the greatest first field of ``order`` for each key; None for other orders.

    A whole number or day is kept in a hash table, while rows in whole are sorted by their key.
    """
    kind, lead = df.schema[order].dataType, F.col(order)
    if isinstance(kind, T.StructType) and kind.fields:
        kind, lead = kind.fields[0].dataType, lead.getField(kind.names[0])
    if not isinstance(kind, (T.IntegralType, T.DateType, T.TimestampType)):
        return None
    return df.groupBy(*key).agg(F.max(lead).alias("_lead"))


def leading_rows(df: DataFrame, leads: DataFrame, key: list[str], order: str) -> DataFrame:
    """The rows that can be the last of their key: those with its greatest lead.

    ``leads`` are sent to all tasks. Rows that have the same lead are all kept.
    """
    kind, lead = df.schema[order].dataType, F.col(f"row.{order}")
    if isinstance(kind, T.StructType):
        lead = lead.getField(kind.names[0])
    same = [F.col(f"row.{k}").eqNullSafe(F.col(f"top.{k}")) for k in key]
    return df.alias("row").join(F.broadcast(leads).alias("top"), [
        *same, lead.eqNullSafe(F.col("top._lead"))], "left_semi")


def full_merge(current: DataFrame, incoming: DataFrame, key: list[str],
               values: dict[str, Column]) -> DataFrame:
    """Full outer join of two key-unique frames.

    ``values`` may refer to ``cur`` and ``inc`` columns and to their presence flags,
    ``cur._here`` and ``inc._here``.
    """
    cur = current.withColumn("_here", F.lit(True)).alias("cur")
    inc = incoming.withColumn("_here", F.lit(True)).alias("inc")
    same = [F.col(f"cur.{k}") == F.col(f"inc.{k}") for k in key]
    return cur.join(inc, same, "full_outer").select(
        *[F.coalesce(f"cur.{k}", f"inc.{k}").alias(k) for k in key],
        *[value.alias(name) for name, value in values.items()],
    )


def unknown_keys(df: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Distinct values of ``key`` that ``known`` lacks.

    Distinct comes first, so only keys are shuffled, and usually few of them remain.
    """
    return (
        df.select(key).filter(F.col(key).isNotNull()).distinct()
        .join(known.select(key), key, "left_anti")
    )
