"""The ends of ordered lists.

Several reports build an ordered list per group only to read its first, second
and last member. Gathering the list would put a whole group into one buffer, so
the members are found directly, with state of fixed size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def list_ends(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    order: str | Sequence[str],
    descending: bool = False,
    carry: Sequence[str] = (),
    few: bool = False,
) -> DataFrame:
    """Per key: `first`, `second` and, where there are three or more, `last`.

    ``carry`` names columns that depend on the keys, to be kept beside them.

    Nulls are not members, yet a group of nulls keeps its row. The first two
    come from a row-number filter, which Spark applies on the map side before
    the shuffle as well as after it; the last one and the count from plain
    partial aggregates. Both halves are hashed by the same keys, so putting
    them together needs no further shuffle; they are put together as a union, since a join
    would shuffle them again where rows came hashed by some of the keys only, and
    with that all steps above. Both read the same rows, nulls
    sorted last instead of filtered, so that shuffles below them are reused.
    Keys must not be null, and `order` must be total, but for ties between equal
    values.

    ``few`` says that the rows were restricted to a small part of their table. They
    are then dealt out by the first key here, so that the halves share one pass
    over the table also where the restriction is a broadcast and no shuffle
    lies below them. Otherwise the map-side limits save more than that.
    """
    if few:
        df = df.repartition(keys[0])
    names = [order] if isinstance(order, str) else list(order)
    by = F.col(names[0]) if len(names) == 1 else F.struct(*names)
    member = F.col(value).isNotNull()

    rank = F.row_number().over(
        Window.partitionBy(*keys).orderBy(
            F.desc(member), *(F.desc(n) if descending else F.asc(n) for n in names)
        )
    )
    front = (
        df.withColumn("_rank", rank)
        .filter(F.col("_rank") <= 2)
        .groupBy(*keys)
        .agg(
            F.max(F.when(F.col("_rank") == 1, F.col(value))).alias("first"),
            F.max(F.when(F.col("_rank") == 2, F.col(value))).alias("second"),
            *(F.max(c).alias(f"_{c}") for c in carry),
        )
    )
    final = F.min_by if descending else F.max_by
    back = df.groupBy(*keys).agg(
        final(F.col(value), F.when(member, by)).alias("_last"),
        F.count(value).alias("_members"),
        *(F.max(c).alias(c) for c in carry),
    )
    return (
        back.unionByName(front, allowMissingColumns=True)
        .groupBy(*keys)
        # One row of each half, with a null where the other has its value.
        .agg(*(F.max(c).alias(c) for c in (*carry, *(f"_{c}" for c in carry), "first", "second", "_last", "_members")))
        .select(
            *keys,
            # Read from both halves, so that both ask for the same columns below.
            *(F.coalesce(c, f"_{c}").alias(c) for c in carry),
            "first",
            "second",
            F.when(F.col("_members") >= 3, F.col("_last")).alias("last"),
        )
    )


def comma_text(first: str = "first", second: str = "second", last: str = "last") -> Column:
    """The ends as a comma list.

    Its first two tokens and its last token are those of the whole list, which
    is all that rank parsing looks at. Null where the list has no member.
    """
    ends = F.concat_ws(",", first, second, last)
    return F.when(F.col(first).isNotNull(), ends)
