"""Join shapes used by the reports.

No join of tables carries a broadcast hint, only a filter of fixed size (`maybe_within`) and the
list of crowded buckets (`interval_join`), which has a row for some 250,000 of the table, do:
Spark broadcasts a side only when its size is known to be under
`spark.sql.autoBroadcastJoinThreshold`, and sorts and merges otherwise, with adaptive
execution splitting keys that hold too many rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Uncoded rows are spread over this many join keys; see `with_name`.
_SCATTER = 4096

# Words of 64 bits, at most, in a filter of keys; see `maybe_within`.
FILTER_WORDS = 1 << 20

# A larger filter, for keys by the ten million: rows, words in each and bits of a key; 16 MB of bits.
WIDE = {"words": 1 << 18, "wide": 8, "marks": 3}

# Cells that codes or buckets are counted in, and how many cells of codes are taken as frequent; see
# `with_frequent_name` and `interval_join`.
_CELLS = 1 << 14
_FREQUENT = 64

# Right rows of one key and bucket that one task of an interval join may hold; some 100 bytes each.
PIECE_ROWS = 250_000


def semi_lookup(df: DataFrame, key: str, lookup: DataFrame, lookup_key: str) -> DataFrame:
    """Keep the rows whose key is in a lookup; no lookup column is read."""
    ids = lookup.select(F.col(lookup_key).alias(key))
    return df.join(ids, key, "left_semi")


def within(df: DataFrame, key: str, ids: DataFrame | None) -> DataFrame:
    """Restrict a table to the keys another step kept; no-op without one.

    The keys must be unique. An inner join then keeps the same rows as a semi
    join, but may build its hash table from either side, and is not copied into
    every branch where the table is a union.
    """
    return df if ids is None else df.join(ids.select(key), key)


def maybe_within(
    df: DataFrame, key: str, ids: DataFrame, words: int = FILTER_WORDS, wide: int = 1, marks: int = 1
) -> DataFrame:
    """Drop rows whose key is surely not among ``ids``, by a filter of bits on a hash of the key.

    The filter has at most ``words`` rows of ``wide`` words whatever the size of ``ids``, which is why it may be
    broadcast; where it fills up, fewer rows are dropped. A key has up to ``marks`` bits, all in one word. An exact
    join has to follow.
    """
    place = F.pmod(F.xxhash64(F.col(key)), F.lit(64 * words * wide))

    def one(at: Column) -> Column:
        # A long's shift takes its distance modulo 64.
        return F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(at, F.lit(64)).cast("int"))

    bit = one(place)
    for i in range(1, marks):
        bit = bit.bitwiseOR(one(F.xxhash64(F.col(key), F.lit(i))))
    word = F.pmod(F.shiftright(place, 6), F.lit(words))
    part = F.expr("0") if wide == 1 else F.floor(F.shiftright(place, 6) / F.lit(words)).cast("int")
    names = [f"_hits{i}" for i in range(wide)]
    hits = ids.filter(F.col(key).isNotNull()).groupBy(word.alias("_word")).agg(
        *(F.bit_or(F.when(part == i, bit)).alias(name) for i, name in enumerate(names))
    )
    some = df.withColumn("_word", word).join(F.broadcast(hits), "_word")
    found = F.lit(None).cast("bigint")
    for i, name in enumerate(names):
        found = F.when(part == i, F.col(name)).otherwise(found)
    return some.filter(bit.bitwiseAND(found) == bit).select(*df.columns)


def left_join_filtered(
    df: DataFrame, dim: DataFrame, condition: Column, on: Sequence[str]
) -> DataFrame:
    """Left join to a dimension whose filter belongs to the join, not to the result."""
    return df.join(dim.filter(condition), list(on), "left")


def left_join_many(
    left: DataFrame, right: DataFrame, on: Sequence[str], among: DataFrame | None = None
) -> DataFrame:
    """Left join to a side where one key may hold very many rows.

    Adaptive execution can split such a key on either side of an inner join, but
    not on the right of a left join. So the right side gets a row of nulls for
    each key it lacks, and the join is an inner one, done once. Only distinct keys
    are compared for that. ``among`` is any table that has all keys of the left
    side, if one is cheaper to read; the left side must then hold no null keys.
    """
    keys = list(on)
    asked = (left if among is None else among).select(*keys).distinct()
    lacking = asked.join(right.select(*keys).distinct(), keys, "left_anti")
    joined = left.join(right.unionByName(lacking, allowMissingColumns=True), keys)
    if among is not None:
        return joined
    some_null = F.lit(False)
    for key in keys:
        some_null |= F.col(key).isNull()
    return joined.unionByName(left.filter(some_null), allowMissingColumns=True)


def with_name(
    df: DataFrame, code: Column, names: DataFrame, spread_by: str, alias: str = "name"
) -> DataFrame:
    """Left join a coded value to its display name.

    Rows without a code match nothing. Left as nulls they would all be sent to
    one shuffle partition, so they get negative keys instead, which no
    dictionary uses, spread by another column.
    """
    scattered = -1 - F.pmod(F.hash(spread_by), F.lit(_SCATTER)).cast("bigint")
    key = F.coalesce(code.cast("bigint"), scattered)
    dim = names.select(F.col("concept_id").alias("_code"), F.col("name").alias(alias))
    return df.withColumn("_code", key).join(dim, "_code", "left").drop("_code")


def with_frequent_name(
    df: DataFrame, code: Column, names: DataFrame, spread_by: str, alias: str = "name"
) -> DataFrame:
    """`with_name`, for many rows of which most have one of few codes, or none.

    Codes are counted by cells of a hash. The names in the cells that hold most rows, some 1 in
    256 of the dictionary, are broadcast; rows of these cells, and rows without a code, are not shuffled
    for their names. All others are joined as ever, so each row gets what `with_name` gives it. ``df`` is read
    three times.
    """
    cell = F.pmod(F.hash("_code"), F.lit(_CELLS)).alias("_cell")
    coded = df.withColumn("_code", code.cast("bigint"))
    dim = names.select(F.col("concept_id").cast("bigint").alias("_code"), F.col("name").alias(alias))
    most = (
        coded.filter(F.col("_code").isNotNull())
        .groupBy(cell)
        .count()
        .orderBy(F.desc("count"), "_cell")
        .limit(_FREQUENT)
        .select("_cell", F.lit(True).alias("_often"))
    )
    marked = coded.select("*", cell).join(F.broadcast(most), "_cell", "left")
    often = F.col("_often").isNotNull() | F.col("_code").isNull()
    known = dim.select("*", cell).join(F.broadcast(most), "_cell").select("_code", alias)
    near = marked.filter(often).join(F.broadcast(known), "_code", "left").select(*df.columns, alias)
    far = with_name(marked.filter(~often).select(*df.columns, "_code"), F.col("_code"), names, spread_by, alias)
    return near.union(far.select(*df.columns, alias))


def interval_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[tuple[str, str]],
    left_ts: str,
    right_ts: str,
    days_before: int = 2,
    days_after: int = 2,
    how: str = "inner",
    piece_rows: int | None = None,
    counted: tuple[DataFrame, Sequence[str], str] | None = None,
) -> DataFrame:
    """Equal keys, and the right time within a span of days around the left time.

    Both ends are inclusive. Joining on the key alone would put every row of
    one key into one partition and compare all of its pairs. So time is cut
    into buckets as wide as the span: a left row belongs to one bucket, a right
    row to the (at most two) buckets its possible partners lie in, and the
    bucket is part of the join key. A left row meets a right row in its own
    bucket only, so no pair appears twice and an outer join stays exact.

    ``piece_rows`` splits what one key has within one bucket, which adaptive
    execution cannot do for the right of an outer join: buckets with more right
    rows are dealt into pieces of about that many by a hash of the row, and the left
    rows of just these buckets are copied to each piece (halving such a bucket's time would
    copy as much, since the span covers all of it, and would not part equal
    times). An outer join needs to know whether any piece has a partner: two times of the
    bucket tell that exactly. ``counted``
    is a cheaper table to count, with its keys and time column; it may have more
    rows than the right side, and must not have fewer in any bucket.

    The sides must not share column names.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"unsupported join type {how!r}")
    if piece_rows is not None and days_before + days_after < 1:
        raise ValueError("buckets are split for spans of a day or more")
    width = max(days_before + days_after, 1)

    def day(column: str) -> Column:
        return F.unix_date(F.to_date(column))

    def bucket(days: Column) -> Column:
        return F.floor(days / F.lit(width)).cast("int")

    def buckets(ts: str) -> Column:
        return F.explode(
            F.sequence(bucket(day(ts) - F.lit(days_after)), bucket(day(ts) + F.lit(days_before)))
        )

    probe = left.withColumn("_bucket", bucket(day(left_ts)))
    build = right.withColumn("_bucket_r", buckets(right_ts))
    low = F.col(left_ts) - F.expr(f"INTERVAL '{days_before}' DAY")
    high = F.col(left_ts) + F.expr(f"INTERVAL '{days_after}' DAY")

    condition = F.col("_bucket") == F.col("_bucket_r")
    for l_key, r_key in on:
        condition &= F.col(l_key) == F.col(r_key)
    condition &= F.col(right_ts).between(low, high)
    if piece_rows is None:
        return probe.join(build, condition, how).drop("_bucket", "_bucket_r")

    right_keys = [r for _, r in on]
    rows, keys, ts = counted or (right, right_keys, right_ts)
    dealt = rows.select(
        *(F.col(k).alias(r) for k, r in zip(keys, right_keys, strict=True)), buckets(ts).alias("_bucket_r")
    ).withColumn("_cell", F.pmod(F.xxhash64(*right_keys, "_bucket_r"), F.lit(_CELLS)))
    # Only buckets in cells of more rows than that are counted one by one.
    full = dealt.groupBy("_cell").count().filter(F.col("count") > piece_rows).select("_cell")
    crowded = (
        dealt.join(F.broadcast(full), "_cell")
        .groupBy(*right_keys, "_bucket_r")
        .agg(F.ceil(F.count(F.lit(1)) / F.lit(piece_rows)).cast("int").alias("_pieces"))
        .filter(F.col("_pieces") > 1)
    )
    # Each of these buckets stands for more than piece_rows rows, so their list is short and both sides
    # need not be shuffled for it.
    build = build.join(F.broadcast(crowded), [*right_keys, "_bucket_r"], "left")
    place = F.pmod(F.xxhash64(*right.columns), F.col("_pieces")).cast("int")
    build = build.withColumn("_piece_r", place)
    # Spans of a bucket's left rows begin in the first half of the days its right rows cover and
    # end in the second. So there is a partner just if the last time of the first half is not
    # before the span, or the first time of the second half not after it.
    second = day(right_ts) - F.col("_bucket_r") * F.lit(width) + F.lit(days_before) >= F.lit(width)
    # By piece first: that reads the columns the join reads, so that shuffles below the right side are reused.
    times = (
        build.filter(F.col("_pieces").isNotNull())
        .groupBy(*right_keys, "_bucket_r", "_pieces", "_piece_r")
        .agg(
            F.max(F.when(~second, F.col(right_ts))).alias("_before"),
            F.min(F.when(second, F.col(right_ts))).alias("_after"),
        )
        .groupBy(*right_keys, "_bucket_r", "_pieces")
        .agg(F.max("_before").alias("_before"), F.min("_after").alias("_after"))
    )
    names = {r: f"_key{i}" for i, r in enumerate(right_keys)}
    split = times.select(
        *(F.col(r).alias(n) for r, n in names.items()), F.col("_bucket_r").alias("_split"), "_pieces", "_before", "_after"
    )
    same = F.col("_bucket") == F.col("_split")
    for l_key, r_key in on:
        same &= F.col(l_key) == F.col(names[r_key])
    partner = F.coalesce(F.col("_before") >= low, F.lit(False)) | F.coalesce(F.col("_after") <= high, F.lit(False))
    kept = [*left.columns, "_bucket"]
    probe = probe.join(F.broadcast(split), same, "left").select(
        *kept,
        F.col("_pieces").alias("_copies"),
        partner.alias("_partner"),
        F.explode(F.sequence(F.lit(0), F.coalesce("_pieces", F.lit(1)) - 1)).alias("_piece"),
    )
    build = build.select(*right.columns, "_bucket_r", F.coalesce("_piece_r", F.lit(0)).alias("_piece_r"))
    joined = probe.join(build, condition & (F.col("_piece") == F.col("_piece_r")), how)
    if how == "left":
        # A copied row without a partner anywhere stays once, and one with a partner only where it met it.
        once = F.col("_copies").isNull() | (~F.col("_partner") & (F.col("_piece") == 0))
        joined = joined.filter(F.col("_bucket_r").isNotNull() | once)
    return joined.select(*left.columns, *right.columns)
