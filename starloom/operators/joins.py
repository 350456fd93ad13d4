"""Key lookups: many source rows against one side with a key of its own.

The lookup side is broadcast when its measured size is under the budget. Above
it the join is shuffled on the key, whatever Spark makes of the sizes of files: a
compressed or exploded side is far larger than these. A task hashes its part of the
side, as sorting the source rows would cost more. Source keys that hold more rows than
one task should take are spread over several copies of their few lookup rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from starloom.session import setting, stage

BROADCAST_BYTES = 64 * 1024 * 1024
ROWS_PER_TASK = 1_000_000
SKEW_SAMPLE = 0.01
_ROW_OVERHEAD = 32  # row header and hash slot of a broadcast row


def measured_bytes(df: DataFrame) -> int:
    """Upper bound of the rows' in-memory size, from one aggregate over ``df``."""
    fixed = _ROW_OVERHEAD
    widest = []
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            widest.append(F.max(F.octet_length(field.name)))
            fixed += 16
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            widest.append(F.max(F.octet_length(F.to_json(F.struct(field.name)))))
            fixed += 64
        else:
            fixed += 16
    row = df.agg(F.count(F.lit(1)), *widest).first()
    return row[0] * (fixed + sum(w or 0 for w in row[1:]))


def fits_broadcast(df: DataFrame) -> bool:
    budget = setting(df.sparkSession, "broadcastBytes", BROADCAST_BYTES)
    return budget > 0 and measured_bytes(df) <= budget


def _key_hash(columns: list[str]) -> Column:
    return F.xxhash64(*[F.col(c).cast("string") for c in columns])


def _hot_keys(src: DataFrame, columns: list[str]) -> DataFrame | None:
    """Hash and number of shares of keys too large for one task.

    Keys are counted on a sample, which decides how a key is spread and nothing
    else: the join keeps every row however good the guess was. Every key past the
    limit is listed, so the list has fewer rows than the source has tasks.
    """
    spark = src.sparkSession
    rows_per_task = setting(spark, "rowsPerTask", ROWS_PER_TASK)
    fraction = setting(spark, "skewSample", SKEW_SAMPLE)
    counted = src.select(_key_hash(columns).alias("__hot")).sample(fraction, seed=0).groupBy("__hot").count()
    shares = F.ceil(F.col("count") / fraction / rows_per_task).cast("int").alias("__shares")
    hot = stage(counted.where(F.col("count") > rows_per_task * fraction).select("__hot", shares), "hot-keys")
    return None if hot.isEmpty() else hot


def _spread_join(
    src: DataFrame,
    side: DataFrame,
    pairs: list[tuple[str, str]],
    extra: Column | None,
    how: str,
    keys_of: DataFrame | None,
) -> DataFrame:
    src_keys = [s for s, _ in pairs]
    side_keys = [k for _, k in pairs]
    condition = _equal(pairs, extra)
    hot = None if keys_of is None else _hot_keys(keys_of, src_keys)
    if hot is None:
        return src.join(side.hint("shuffle_hash"), condition, how)
    if fits_broadcast(hot):
        hot = F.broadcast(hot)
    shares = F.coalesce(F.col("__shares"), F.lit(1))
    # The share of a row depends on its content and input split only, so a task
    # that runs again sends every row where it went the first time.
    place = F.pmod(F.xxhash64(F.spark_partition_id(), *src.columns), shares).cast("int")
    left = (
        src.join(hot, _key_hash(src_keys) == F.col("__hot"), "left")
        .withColumn("__share", F.when(shares > 1, place).otherwise(0))
        .drop("__hot", "__shares")
    )
    right = (
        side.join(hot, _key_hash(side_keys) == F.col("__hot"), "left")
        .withColumn("__copy", F.explode(F.sequence(F.lit(0), shares - 1)))
        .drop("__hot", "__shares")
    )
    joined = left.join(right.hint("shuffle_hash"), condition & (F.col("__share") == F.col("__copy")), how)
    return joined.drop("__share", "__copy")


def _equal(pairs: list[tuple[str, str]], extra: Column | None) -> Column:
    condition = extra if extra is not None else F.lit(True)
    for left, right in pairs:
        condition = condition & (F.col(left) == F.col(right))
    return condition


def lookup(
    src: DataFrame,
    side: DataFrame,
    on: dict[str, str],
    take: dict[str, str] | None = None,
    how: str = "inner",
    when: Column | None = None,
    keys_of: DataFrame | None = None,
    unique: bool = False,
    large: bool = False,
) -> DataFrame:
    """Join ``src`` to ``side`` on ``{source column: side column}``.

    ``take`` maps side columns to their names in the result, ``when`` is a
    further condition over source columns and taken names. ``how`` is inner,
    left, left_semi or left_anti.

    ``keys_of`` is a cheaper frame with the same source keys to look for large
    ones in, such as ``src`` before earlier lookups. ``unique`` says that no
    source key repeats, ``large`` that measuring the side is not worth a pass.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"a lookup keeps or drops source rows, it cannot be {how}")
    taken = set((take or {}).values()) & set(src.columns)
    if taken:
        raise ValueError(f"the source has these columns already: {', '.join(sorted(taken))}")
    pairs = [(s, f"__k{i}") for i, s in enumerate(on)]
    keys = [F.col(k).alias(alias) for k, (_, alias) in zip(on.values(), pairs)]
    side = side.select(*keys, *[F.col(c).alias(n) for c, n in (take or {}).items()])
    if not large and fits_broadcast(side):
        joined = src.join(F.broadcast(side), _equal(pairs, when), how)
    else:
        if how in ("left_semi", "left_anti"):
            side = side.distinct()  # partitioned by the key, as the join needs it
        sampled = None if unique else src if keys_of is None else keys_of
        joined = _spread_join(src, side, pairs, when, how, sampled)
    return joined.drop(*[alias for _, alias in pairs])
