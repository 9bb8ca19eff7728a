"""Joins on keys of which one may hold a large share of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

GUARD = "key_hash"


def distinct_keys(df: DataFrame, key: str) -> DataFrame:
    """Each key once; combining before the shuffle keeps a hot key from gathering in one task."""
    return df.where(F.col(key).isNotNull()).select(key).distinct()


def splittable_join(left: DataFrame, right: DataFrame, key: str, how: str) -> DataFrame:
    """A join on ``key`` whose oversized partitions adaptive execution can split.

    Skew handling splits a join partition only when both inputs come straight
    from the join's own shuffle. An input that was just aggregated by ``key`` is
    already partitioned that way and would be joined without one, so a hot key
    on the other side stayed in one task. Joining on the key and its hash, which
    matches exactly the same rows, gives both inputs a shuffle of their own. The
    hash depends on the key alone, so retried tasks place rows as before.
    """
    guard = F.xxhash64(key)
    return left.withColumn(GUARD, guard).join(right.withColumn(GUARD, guard), [key, GUARD], how).drop(GUARD)


def shared(df: DataFrame) -> DataFrame:
    """A frame behind one exchange that all its readers in a query have in common.

    Spark computes equal exchanges of a query once. Two readers of a frame seldom have equal ones, as
    each is pruned to the columns it needs. Here rows are dealt by a hash of all their columns, which
    no reader can prune; and as the hash spreads any key's rows, no later step inherits a hot
    partition. Readers should ask for keys with :func:`asked_keys`, which leaves no filter to push
    below the exchange. Results never depend on whether the exchange was shared.
    """
    return df.repartition(F.xxhash64(*df.columns))


# Stand-ins for a missing key among keys asked for: no row has them.
ABSENT = {"string": "\u0000absent", "bigint": -(1 << 63), "int": -(1 << 31)}


def asked_keys(df: DataFrame, key: str) -> DataFrame:
    """Each key of a shared frame once. A missing key becomes a value that no row has."""
    kind = df.schema[key].dataType.simpleString()
    return df.select(F.coalesce(F.col(key), F.lit(ABSENT[kind]).cast(kind)).alias(key)).distinct()


# A key with more matching rows than this is spread over several tasks.
ROWS_PER_SALT = 1_000_000
POSITION = "row_position"


def with_position(df: DataFrame) -> DataFrame:
    """Adds a number that tells rows apart, equal ones too.

    It is the row's place in its file split, so ``df`` must come straight from its source: a task
    that is run again then numbers its rows as before.
    """
    return df.withColumn(POSITION, F.monotonically_increasing_id())


def fanout_left_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    rows_per_salt: int = ROWS_PER_SALT,
    wanted: DataFrame | None = None,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Left join to a side that may hold very many rows of one key.

    Adaptive execution splits the left side of a left join, never the right one.
    So right keys with more than ``rows_per_salt`` rows are counted out and
    salted: their rows are spread by their position, which spreads equal rows
    as well, and left rows of such a key are repeated once per salt. A repeated
    row that met nothing in its salt is dropped, which is exact because a hot
    key has matches elsewhere. At most ``rows / rows_per_salt`` keys can be hot,
    which bounds the broadcast.

    ``right`` comes straight from its source, or brings its positions along from
    there (:func:`with_position`). ``wanted`` holds at least the left side's
    keys: the right side is cut to them first, and what is left of it is counted
    and joined from one exchange. ``counted`` may stand in for ``right`` when
    counting, if it is cheaper and every key of it that occurs in ``left`` also
    occurs in ``right``.
    """
    columns = [name for name in right.columns if name != POSITION]
    if POSITION not in right.columns:
        right = with_position(right)
    if wanted is not None:
        right = shared(splittable_join(right, wanted, key, "left_semi"))
    hot = F.broadcast(
        (right if counted is None else counted)
        .groupBy(key)
        .agg(F.count("*").alias("key_rows"))
        .where(F.col("key_rows") > rows_per_salt)
        .select(key, F.ceil(F.col("key_rows") / rows_per_salt).cast("int").alias("salts"))
    )
    place = F.pmod(F.xxhash64(POSITION), F.coalesce("salts", F.lit(1))).cast("int")
    spread = right.join(hot, key, "left").select(*columns, place.alias("salt"), F.lit(True).alias("met"))
    every_salt = F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1))
    repeated = left.join(hot, key, "left").withColumn("salt", every_salt)
    joined = repeated.join(spread, [key, "salt"], "left")
    return joined.where(F.col("salts").isNull() | F.col("met")).drop("salt", "salts", "met")
