"""Key-based routing: which partition a key's rows go to, and how even that is."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def topic_partition(key: Column, partitions: int) -> Column:
    """A stable partition number for a key, from its MD5; the same in any engine.

    Usable as the ``partition`` column of the Kafka sink.  A null key has none: there
    the sink is free to choose.
    """
    digits = F.substring(F.md5(key.cast("string").cast("binary")), 1, 8)
    return F.pmod(F.conv(digits, 16, 10).cast("bigint"), F.lit(partitions)).cast("int")


def spread_key(key: Column, spread_by: Column, ways: int) -> Column:
    """``key`` split into ``ways`` sub-keys by a second column's hash.

    For keys that may hold a large share of all rows.  The sub-key follows from
    the row alone, so a retried task routes it the same way.
    """
    return F.concat_ws("#", key.cast("string"), F.pmod(F.xxhash64(spread_by), F.lit(ways)))


def placed(df: DataFrame, partitions: int, key: Column) -> DataFrame:
    """Rows in the partition ``topic_partition`` names, and the number as ``partition``.
    Rows without a key have none; they are dealt over all partitions by what they hold."""
    numbered = df.withColumn("partition", topic_partition(key, partitions))
    free = F.pmod(F.xxhash64(*[c for c in df.columns if _hashable(df, c)]), F.lit(partitions))
    return numbered.repartitionById(partitions, F.coalesce("partition", free.cast("int")))


def _hashable(df: DataFrame, column: str) -> bool:
    return not any(kind in df.schema[column].dataType.simpleString() for kind in ("map<", "variant"))


def route(
    df: DataFrame, partitions: int, key: str, spread_by: str | None = None, ways: int = 1
) -> DataFrame:
    """Equal keys to equal partitions; with ``ways`` > 1, to that many of them.
    The placement is that of ``topic_partition``, so of a topic and of the report."""
    target = F.col(key)
    if spread_by is not None and ways > 1:
        target = spread_key(F.col(key), F.col(spread_by), ways)
    return placed(df, partitions, target).select(*df.columns)


# Sub-keys per even share: small pieces fall more evenly than large ones.
PIECES = 4
# Keys that a sketch tracks, for each piece of a partition.
MARGIN = 16


def hot_keys(df: DataFrame, partitions: int, key: str) -> DataFrame:
    """Keys with more than an even share of all rows, and the ``ways`` to divide each.

    Fewer than ``partitions`` keys can have more than 1/``partitions`` of the rows,
    so the result is small whatever the data holds.
    """
    counts = rows_per_key(df, key)
    total = counts.agg(F.sum("row_count")).scalar()
    share = F.col("row_count") * partitions / total
    return counts.filter(share > 1).withColumn("ways", F.ceil(share * PIECES))


def key_sketch(df: DataFrame, key: str, partitions: int) -> DataFrame:
    """One row, of bounded size: the frequent keys of the rows (``sketch``, to be combined with
    others) and their number.  A table gives it in one pass that sends one sketch a task."""
    tracked = max(PIECES * MARGIN * partitions, 256)
    frequent = F.expr(f"approx_top_k_accumulate(cast(`{key}` AS STRING), {tracked})")
    return df.agg(frequent.alias("sketch"), F.count(F.lit(1)).alias("row_count"))


def hot_keys_of(sketches: DataFrame, partitions: int) -> DataFrame:
    """What ``hot_keys`` gives, of the rows that some sketches saw, by estimated counts.

    A count is off by at most 3.5 rows in as many as keys are tracked, which is 3.5 in
    ``MARGIN * PIECES``, a twentieth, of an even share; so a key with a tenth more than an even share is
    always found, and one with a tenth less never.
    """
    tracked = max(PIECES * MARGIN * partitions, 256)
    # Grouped, as a task without sketches cannot give an empty one.
    whole = sketches.groupBy(F.lit(0).alias("_all")).agg(
        F.expr(f"approx_top_k_estimate(approx_top_k_combine(sketch, {tracked}), {2 * partitions})").alias("found"),
        F.sum("row_count").alias("total"),
    )
    counts = whole.select("total", F.inline("found").alias("key", "row_count"))
    share = F.col("row_count") * partitions / F.col("total")
    hot = counts.withColumn("share", share).filter("share > 1")
    return hot.select("key", "row_count", F.ceil(F.col("share") * PIECES).alias("ways"))


def with_even_key(
    df: DataFrame, partitions: int, key: str, spread_by: str, hot: DataFrame | None = None
) -> DataFrame:
    """The rows with ``_even_key``: their key, or a sub-key where it is hot.

    ``hot`` are the keys to divide (``hot_keys_of``); without it they are counted, which takes a
    pass over the input, so not on a stream.  All other keys stay whole; rows without
    a key are a key like any other, and may be the hot one.
    """
    hot = (hot_keys(df, partitions, key) if hot is None else hot).select(
        F.col("key").alias("_hot"), F.col("ways").alias("_ways")
    )
    # Bounded by the number of partitions, hence safe to broadcast.
    marked = df.join(F.broadcast(hot), F.col(key).eqNullSafe(F.col("_hot")), "left")
    piece = F.concat_ws("#", F.coalesce(F.col(key).cast("string"), F.lit("")),
                        F.pmod(F.xxhash64(spread_by), F.col("_ways")))
    even = F.when(F.col("_ways").isNotNull(), piece).otherwise(F.col(key).cast("string"))
    return marked.withColumn("_even_key", even).select(*df.columns, "_even_key")


def route_evenly(df: DataFrame, partitions: int, key: str, spread_by: str) -> DataFrame:
    """Like ``route``, but hot keys are divided by the hash of ``spread_by``."""
    keyed = with_even_key(df, partitions, key, spread_by)
    return placed(keyed, partitions, F.col("_even_key")).select(*df.columns)


def rows_per_key(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("row_count"))


def routing_report(df: DataFrame, partitions: int, key: str) -> DataFrame:
    """Rows and keys per partition, with ``skew`` = rows over an even share.

    Counts keys first and places the counts, so no row is moved.  Partitions
    that no key reaches have no line.
    """
    placed = rows_per_key(df, key).withColumn(
        "partition", topic_partition(F.col("key"), partitions)
    )
    loads = placed.groupBy("partition").agg(
        F.sum("row_count").alias("row_count"), F.count(F.lit(1)).alias("key_count")
    )
    # At most ``partitions`` lines are left here, so one task can total them.
    total = F.sum("row_count").over(Window.partitionBy(F.lit(0)))
    return loads.withColumn("skew", F.col("row_count") * partitions / total)
