"""Joins that hold their shape when one key carries much of the data."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from flowtables.functions.text import ColumnLike, as_col, is_filled
from flowtables.operators.windows import keep_latest

#: Largest side that is broadcast, as text.  The driver holds a broadcast at several times its text, and
#: those of one job side by side.
BROADCAST_BYTES = 8 * 1024 * 1024
SALTS = 16
#: A key with more rows than this is spread over several tasks; the most frequent ones, at most so many.
HOT_ROWS, HOT_KEYS = 100_000, 1000
_SALT, _HOT = "__salt", "__hot"
_UNHASHED = (T.MapType, T.VariantType)


def measured_bytes(df: DataFrame) -> int:
    """Size of the rows of ``df`` as text, summed on the executors."""
    row = F.octet_length(F.to_json(F.struct(*df.columns))) if df.columns else F.lit(0)
    return df.agg(F.sum(row.cast("bigint"))).first()[0] or 0


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    return measured_bytes(df) <= limit


def no_null(names: Sequence[str]) -> Column:
    """No key is NULL, in the form that reaches the scan."""
    return reduce(lambda a, b: a & b, [F.col(n).isNotNull() for n in names])


def salted_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str, salts: int = SALTS) -> DataFrame:
    """Equi-join with every hot key of ``left`` spread over ``salts`` tasks; never broadcast.

    ``right`` has at most one row per key; the rows of hot keys, and only those, are repeated
    once per salt.  Hot keys are found by counting their hashes.  The salt is a hash of the
    left row, so a retried task gives the same rows, and both sides get their own exchange, so
    adaptive execution can split a partition that is still too large.  Rows with a NULL key
    match nothing and are spread the same way.  The hint is for Spark's planner, which goes by
    the size of files: packed columns of a side found too large here may be small on disk.
    """
    keys = list(keys)
    hashed = [f.name for f in left.schema if not isinstance(f.dataType, _UNHASHED)]
    salt = F.pmod(F.xxhash64(*hashed), F.lit(salts)).cast("int")
    counted = left.filter(no_null(keys)).groupBy(F.xxhash64(*keys).alias(_HOT)).count().filter(F.col("count") > HOT_ROWS)
    names = [r[_HOT] for r in counted.orderBy(F.desc("count")).limit(HOT_KEYS).collect()]
    hot = F.xxhash64(*keys).isin(names) if names else F.lit(False)
    spread = right.withColumn(_SALT, F.lit(0))
    if names:
        repeated = left.filter(no_null(keys) & hot).select(*keys).distinct().withColumn(_HOT, F.lit(True))
        places = F.when(F.col(_HOT), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
        spread = right.join(F.broadcast(repeated), keys, "left").select(*right.columns, F.explode(places).alias(_SALT))
    salted = left.withColumn(_SALT, F.when(hot | ~no_null(keys), salt).otherwise(F.lit(0)))
    return salted.join(spread.hint("merge"), [*keys, _SALT], how).drop(_SALT)


def join_unique(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    limit: int = BROADCAST_BYTES,
    salts: int = SALTS,
    size_of: DataFrame | None = None,
) -> DataFrame:
    """Join to a side with at most one row per key.

    The side is broadcast when its measured size is within ``limit``; otherwise the join
    shuffles with salted keys.  ``size_of`` may name a cheaper frame that is known to be at
    least as large, such as the rows before deduplication.
    """
    keys = list(keys)
    if fits_broadcast(right if size_of is None else size_of, limit):
        return left.join(F.broadcast(right), keys, how)
    return salted_join(left, right, keys, how, salts)


def unique_by_key(dim: DataFrame, key: ColumnLike, order: Sequence[Column] = (), key_name: str = "JOIN_KEY") -> DataFrame:
    """Lookup with one row per *normalised* key; rows with a blank key are left out.

    Deduplicating on the same key that is joined on is what keeps two spellings of one
    name from doubling the rows they match.
    """
    keyed = dim.withColumn(key_name, as_col(key)).filter(is_filled(key_name))
    return keep_latest(keyed, [key_name], list(order))


def duplicate_names(dim: DataFrame, key: ColumnLike, name: str) -> DataFrame:
    """Report of keys reached by more than one spelling, with how many and the outer two."""
    return (
        dim.select(as_col(key).alias("JOIN_KEY"), F.col(name).alias("__name"))
        .filter(is_filled("JOIN_KEY"))
        .distinct()
        .groupBy("JOIN_KEY")
        .agg(F.count("*").alias("SPELLINGS"), F.min("__name").alias("FIRST_NAME"), F.max("__name").alias("LAST_NAME"))
        .filter(F.col("SPELLINGS") > 1)
    )


def lookup_by_key(
    df: DataFrame,
    dim: DataFrame,
    key: ColumnLike,
    dim_key: ColumnLike,
    cols: Mapping[str, str] | Sequence[str],
    order: Sequence[Column] = (),
    how: str = "left",
    **join_options,
) -> DataFrame:
    """Left lookup of ``cols`` on a normalised key; never multiplies rows of ``df``.

    ``cols`` maps dimension columns to output names.
    """
    cols = dict(cols) if isinstance(cols, Mapping) else {c: c for c in cols}
    keyed = dim.withColumn("__jk", as_col(dim_key))
    chosen = unique_by_key(keyed, "__jk", order, "__jk").select(
        "__jk", *[F.col(source).alias(target) for source, target in cols.items()]
    )
    bound = keyed.select("__jk", *cols)
    joined = join_unique(df.withColumn("__jk", as_col(key)), chosen, ["__jk"], how, size_of=bound, **join_options)
    return joined.drop("__jk")


def map_codes(
    df: DataFrame,
    codes: DataFrame,
    col: str,
    code_col: str,
    value_col: str,
    **join_options,
) -> DataFrame:
    """Replace ``col`` by its mapped value; codes without a mapping stay as they are.

    A code listed twice takes its smallest value.
    """
    chosen = codes.groupBy(F.col(code_col).alias("__code")).agg(F.min(value_col).alias("__value"))
    joined = join_unique(
        df.withColumn("__code", F.col(col)), chosen, ["__code"], size_of=codes.select(code_col, value_col), **join_options
    )
    return joined.withColumn(col, F.coalesce("__value", col)).select(*df.columns)


def enrich(
    df: DataFrame,
    dim: DataFrame,
    on: tuple[str, str],
    cols: Sequence[str],
    **join_options,
) -> DataFrame:
    """Add ``cols`` of the one dimension row whose ``on[1]`` equals ``on[0]``."""
    dim = dim.select(F.col(on[1]).alias("__on"), *cols).filter(F.col("__on").isNotNull())
    chosen = dim.groupBy("__on").agg(*[F.min(c).alias(c) for c in cols]) if len(cols) == 1 else keep_latest(dim, ["__on"], [])
    joined = join_unique(df.withColumn("__on", F.col(on[0])), chosen, ["__on"], size_of=dim, **join_options)
    return joined.drop("__on")


def anti_join(
    source: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    small: bool | None = None,
    limit: int = BROADCAST_BYTES,
    salts: int = 2,
    wanted: DataFrame | None = None,
) -> DataFrame:
    """Rows of ``source`` whose key is not in ``target``; a NULL key is never found.

    A source within ``limit`` is the usual case, a new batch against a long history.  Its
    keys are broadcast to cut the history down to the keys that can match at all, so the
    history is scanned for its key columns but never shuffled.  A larger source shuffles
    both sides; few salts are enough there, since adaptive execution splits what is left.
    ``wanted`` may name a cheaper frame holding at least the keys of ``source``.
    """
    keys = list(keys)
    known = target.select(*keys).filter(no_null(keys))
    wanted = source.select(*keys) if wanted is None else wanted.select(*keys)
    if small is None:
        small = fits_broadcast(wanted, limit)
    if small:
        known = known.join(F.broadcast(wanted), keys, "left_semi").distinct()
        return source.join(F.broadcast(known), keys, "left_anti")
    return salted_join(source, known.distinct(), keys, "left_anti", salts)


def new_rows(source: DataFrame, target: DataFrame, keys: Sequence[str], **options) -> DataFrame:
    """Rows of ``source`` that ``target`` does not have yet, by key."""
    return anti_join(source, target, keys, **options).select(*source.columns)
