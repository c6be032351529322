"""Aggregations used by the reports.

Each is built from aggregates of bounded state, so that a group is reduced on
the map side and a key with a large share of the rows reaches one task only as
partial results.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def eav_pivot(
    obs: DataFrame,
    keys: Sequence[str],
    columns: Mapping[str, tuple[int, str]],
    concept: str = "concept_id",
) -> DataFrame:
    """One row per key, one column per concept: the largest value of that concept.

    Text columns are empty where a group lacks the concept; numbers and dates
    are null there, and compare as numbers and dates.
    """
    types = {f.name: f.dataType for f in obs.schema.fields}
    aggs = []
    for alias, (code, value) in columns.items():
        picked = F.when(F.col(concept) == code, F.col(value))
        if isinstance(types[value], T.StringType):
            picked = picked.otherwise(F.lit(""))
        aggs.append(F.max(picked).alias(alias))
    return obs.groupBy(*keys).agg(*aggs)


def mode_pivot(
    payments: DataFrame,
    key: str,
    mode: str,
    amount: str,
    modes: Mapping[str, int],
    total: str,
    extra: Sequence[Column] = (),
) -> DataFrame:
    """One row per key, the largest amount of each payment mode, and the sum of all."""
    money = T.DecimalType(18, 2)
    picks = [
        F.max(F.when(F.col(mode) == code, F.col(amount))).cast(money).alias(name)
        for name, code in modes.items()
    ]
    return payments.groupBy(key).agg(*extra, *picks, F.sum(amount).cast(money).alias(total))


def _is_collated(kind: T.DataType) -> bool:
    return isinstance(kind, T.StringType) and not kind.isUTF8BinaryCollation()


def pick_first(
    df: DataFrame, keys: Sequence[str], order: str | Sequence[str], columns: Mapping[str, str]
) -> DataFrame:
    """One row per key; the columns come from the row that is first in order."""
    by = F.col(order) if isinstance(order, str) else F.struct(*order)
    picks = [F.min_by(F.col(src), by).alias(alias) for alias, src in columns.items()]
    return df.groupBy(*keys).agg(*picks)


def distinct_concat(
    df: DataFrame,
    keys: Sequence[str],
    columns: Mapping[str, str],
    separator: str = ", ",
    carry: Sequence[str] = (),
) -> DataFrame:
    """Per key, the distinct non-null values of each column, sorted and joined.

    ``carry`` names columns that depend on the keys, to be kept beside them.

    Values are made distinct first, in a shuffle spread over key and value, so
    what one group gathers is bounded by the vocabulary and not by its rows. Values
    of a collated column are distinct by its collation; the smallest spelling is shown.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    collations = {types[c].collation for c in columns.values() if _is_collated(types[c])}
    if len(collations) > 1:
        raise ValueError(f"values of several collations: {sorted(collations)}")

    def item(alias: str, src: str) -> Column:
        fields = [F.lit(alias).alias("_slot"), F.col(src).cast("string").alias("_value")]
        if collations:
            # Distinct by either: the collated text, or the bytes of a column without collation.
            folded, none = _is_collated(types[src]), F.lit(None).cast("string")
            fields += [
                F.collate(F.col(src) if folded else none, *collations).alias("_folded"),
                (none if folded else F.col(src).cast("string")).alias("_exact"),
            ]
        return F.struct(*fields)

    tagged = F.explode(F.array(*(item(alias, src) for alias, src in columns.items()))).alias("_item")
    # Nulls of the first column stay, so that a key without values keeps its row.
    wanted = F.col("_value").isNotNull() | (F.col("_slot") == next(iter(columns)))
    items = df.select(*keys, *carry, tagged).select(*keys, *carry, "_item.*").filter(wanted)
    if collations:
        by = ["_slot", "_folded", "_exact"]
        spelled = items.groupBy(*keys, *carry, *by).agg(F.min("_value").alias("_value"))
        distinct = spelled.drop("_folded", "_exact")
    else:
        distinct = items.distinct()
    lists = []
    for alias in columns:
        value = F.when(F.col("_slot") == alias, F.col("_value"))
        # array_sort + array_join gives null-free, ordered text; an empty list is null.
        items = F.array_sort(F.collect_list(value))
        lists.append(F.when(F.size(items) > 0, F.array_join(items, separator)).alias(alias))
    return distinct.groupBy(*keys).agg(*(F.max(c).alias(c) for c in carry), *lists)


def ordered_concat(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    order: Sequence[str],
    chunk: Column,
    alias: str,
    separator: str = ",",
    descending: bool = False,
) -> DataFrame:
    """Per key, all non-null values in order, joined.

    ``chunk`` must not decrease as the order increases. Each chunk of a group
    is sorted and joined by itself, wherever it is hashed to, and the final
    step joins ready pieces; only the text that was asked for meets in one
    place. Groups without a value keep a row, with null.
    """
    piece = F.when(
        F.col(value).isNotNull(),
        F.struct(*(F.col(o) for o in order), F.col(value).cast("string").alias("_text")),
    )

    def ordered(items: Column) -> Column:
        return F.sort_array(F.collect_list(items), asc=not descending)

    pieces = (
        df.groupBy(*keys, chunk.alias("_chunk"))
        .agg(ordered(piece).alias("_items"))
        .select(
            *keys,
            F.when(
                F.size("_items") > 0,
                F.struct("_chunk", F.array_join(F.col("_items._text"), separator).alias("_text")),
            ).alias("_piece"),
        )
    )
    joined = pieces.groupBy(*keys).agg(ordered(F.col("_piece")).alias("_pieces"))
    return joined.select(
        *keys,
        F.when(
            F.size("_pieces") > 0, F.array_join(F.col("_pieces._text"), separator)
        ).alias(alias),
    )


def half_year_counts(
    df: DataFrame, quarter: Column, weight: Column, counted: Column | None = None
) -> DataFrame:
    """Per quarter, how much weight falls into either half-year, and in all.

    ``counted`` is the column whose nulls the total leaves out, as a count of it
    would; the half-years count rows whatever it holds.
    """
    in_all = weight if counted is None else F.when(counted.isNotNull(), weight).otherwise(0)

    def count_in(*quarters: int) -> Column:
        inside = F.when(F.col("_quarter").isin(*quarters), F.col("_weight")).otherwise(F.lit(0))
        return F.sum(inside).cast("bigint")

    return (
        df.select(
            quarter.alias("_quarter"),
            weight.cast("bigint").alias("_weight"),
            in_all.cast("bigint").alias("_in_all"),
        )
        .groupBy("_quarter")
        .agg(
            count_in(1, 2).alias("jan_jun"),
            count_in(3, 4).alias("jul_dec"),
            F.sum("_in_all").alias("total"),
        )
        .drop("_quarter")
    )


def one_row_statistic(quarters: DataFrame, combine: str = "min") -> DataFrame:
    """Combine the quarter rows into one row, zero where there is none.

    ``min`` takes the smallest quarter of each column, as the reports define
    it; ``sum`` gives the figure for the whole year.
    """
    merge = {"min": F.min, "sum": F.sum}[combine]
    return quarters.agg(
        *(
            F.coalesce(merge(c), F.lit(0)).cast("bigint").alias(c)
            for c in ("jan_jun", "jul_dec", "total")
        )
    )
