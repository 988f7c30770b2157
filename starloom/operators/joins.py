"""Looking up dimension values for fact rows."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce
from operator import add, and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.names import as_pairs, col, fresh
from starloom.operators.dedup import dedup
from starloom.scratch import materialise

# A lookup up to this size, measured before the join, is sent to every executor.
BROADCAST_BYTES = 64 * 1024 * 1024
# A key with more than this share of the fact rows is hot; there are fewer than
# 1 / HOT_SHARE of them.
HOT_SHARE = 0.00001


@dataclass(frozen=True)
class LookupSize:
    bytes: int
    max_per_key: int | None


def measure_lookup(lookup: DataFrame, keys: Iterable[str] = ()) -> LookupSize:
    """The lookup's estimated bytes, and the most rows any non-NULL key has."""
    keys = list(keys)
    size = F.sum(_row_bytes(lookup))
    if not keys:
        return LookupSize(lookup.agg(size).first()[0] or 0, None)
    known = reduce(and_, [col(k).isNotNull() for k in keys])
    rows, sizes = fresh("_rows", keys), fresh("_bytes", keys)
    per_key = lookup.groupBy(*[col(k) for k in keys]).agg(
        F.count(F.lit(1)).alias(rows), size.alias(sizes)
    )
    total = per_key.agg(F.sum(sizes), F.max(F.when(known, F.col(rows)))).first()
    return LookupSize(total[0] or 0, total[1] or 0)


def _row_bytes(df: DataFrame) -> Column:
    return reduce(add, [_cell_bytes(f) for f in df.schema.fields])


def _cell_bytes(field: T.StructField) -> Column:
    """16 bytes for a fixed-width cell, 16 and its text length for any other."""
    fixed = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)
    if isinstance(field.dataType, fixed):
        return F.lit(16)
    value = col(field.name)
    if not isinstance(field.dataType, (T.StringType, T.BinaryType)):
        value = value.cast("string")
    return F.lit(16) + F.coalesce(F.octet_length(value), F.lit(0))


def lookup_join(
    fact: DataFrame,
    lookup: DataFrame,
    on: str | Iterable[str] | Mapping[str, str],
    duplicates: str = "error",
    broadcast_bytes: int = BROADCAST_BYTES,
    hot_share: float = HOT_SHARE,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Left join that keeps exactly the fact's rows.

    ``on`` names the shared columns or maps fact columns to lookup columns; the
    lookup's key columns do not appear in the result, and its other columns must
    not be named like a fact column. A NULL or unmatched key gives NULLs. A lookup
    with several rows per key is refused, or reduced to its first row by all
    columns with ``duplicates="first"``.

    A lookup measured below ``broadcast_bytes`` is broadcast. For a larger one the
    fact's keys are counted, which reads the key columns only, of ``counted`` if it
    is given (the fact before other lookups were joined to it). Then one pass over
    the fact joins a broadcast of the hot keys' lookup rows and shuffles for the
    rest; rows that need no shuffled lookup (hot, or without a key) are spread
    evenly.
    """
    if hot_share <= 0:
        raise ValueError("hot_share must be positive: it bounds the number of hot keys")
    pairs = as_pairs(on)
    keys = list(pairs.values())
    payload = [c for c in lookup.columns if c not in keys]
    clash = {c.lower() for c in fact.columns} & {c.lower() for c in payload}
    if clash:
        raise ValueError(f"fact and lookup both have columns {sorted(clash)}: rename them first")
    size = measure_lookup(lookup, keys)
    if (size.max_per_key or 0) > 1:
        if duplicates != "first":
            raise ValueError(f"lookup has up to {size.max_per_key} rows per key {keys}")
        lookup = dedup(lookup, keys)
        if size.bytes > broadcast_bytes:
            lookup = materialise(lookup, "lookup-firsts")
            size = measure_lookup(lookup)
    names = _key_names(pairs, fact, payload)
    right = lookup.select(
        *[col(r).alias(n) for r, n in zip(keys, names)], *[col(c) for c in payload]
    )
    if size.bytes <= broadcast_bytes:
        return _left_join(fact, F.broadcast(right), list(pairs), names)
    used = (fact if counted is None else counted).select(*[col(k).alias(n) for k, n in zip(pairs, names)])
    hot = _hot_rows(used, right, names, payload, hot_share, broadcast_bytes)
    return _left_join_large(fact, right, hot, list(pairs), names, payload)


def bucketed_lookup_join(
    fact: DataFrame, lookup: DataFrame, on: str | Iterable[str] | Mapping[str, str]
) -> DataFrame:
    """:func:`lookup_join` of two tables written in the same buckets of the key.

    Both are merged bucket by bucket, so neither is shuffled. The lookup must have one
    row per key, which is checked, without a shuffle too.
    """
    pairs = as_pairs(on)
    keys = list(pairs.values())
    payload = [c for c in lookup.columns if c not in keys]
    clash = {c.lower() for c in fact.columns} & {c.lower() for c in payload}
    if clash:
        raise ValueError(f"fact and lookup both have columns {sorted(clash)}: rename them first")
    size = measure_lookup(lookup, keys)
    if (size.max_per_key or 0) > 1:
        raise ValueError(f"lookup has up to {size.max_per_key} rows per key {keys}")
    names = _key_names(pairs, fact, payload)
    right = lookup.select(*[col(r).alias(n) for r, n in zip(keys, names)], *[col(c) for c in payload])
    return _left_join(fact, right.hint("merge"), list(pairs), names)


def lookup_joins(
    fact: DataFrame, *lookups: tuple[DataFrame, str | Iterable[str] | Mapping[str, str]], **settings
) -> DataFrame:
    """Several lookups whose keys are columns of ``fact``; keys are counted on it alone."""
    joined = fact
    for lookup, on in lookups:
        joined = lookup_join(joined, lookup, on, counted=fact, **settings)
    return joined


def _key_names(pairs: Mapping[str, str], fact: DataFrame, payload: list[str]) -> list[str]:
    return [fresh(f"_key{i}", fact.columns, payload) for i in range(len(pairs))]


def _left_join(fact: DataFrame, right: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    same = reduce(and_, [col(k) == col(n) for k, n in zip(keys, names)])
    return fact.join(right, same, "left").drop(*names)


def _left_join_large(
    fact: DataFrame,
    right: DataFrame,
    hot: DataFrame,
    keys: list[str],
    names: list[str],
    payload: list[str],
) -> DataFrame:
    """One pass: hot keys by broadcast, then the rest by a shuffle on key and salt.

    A row that is done, or has no key, goes into the shuffle with a NULL key and a
    hash of its cells as salt: it matches nothing and lands anywhere.
    """
    taken = [fact.columns, payload, names]
    local = {c: fresh(f"_hot_{c}", *taken) for c in payload}
    done, salt = fresh("_done", *taken), fresh("_salt", *taken)
    marked = hot.select(
        *[col(n) for n in names], *[col(c).alias(local[c]) for c in payload], F.lit(True).alias(done)
    )
    first = _left_join(fact, F.broadcast(marked), keys, names)
    ready = reduce(and_, [col(k).isNotNull() for k in keys]) & col(done).isNull()
    spread = F.xxhash64(*[F.hash(col(k)) for k in fact.columns if _hashable(fact, k)])
    moved = [fresh(f"_shuffled{i}", *taken, local.values()) for i in range(len(keys))]
    sent = first.select(
        "*",
        *[F.when(ready, col(k)).alias(m) for k, m in zip(keys, moved)],
        F.when(ready, F.lit(0).cast("long")).otherwise(spread).alias(salt),
    )
    same = [col(m) == col(n) for m, n in zip(moved, names)]
    zero = fresh("_zero", *taken)
    other = right.withColumn(zero, F.lit(0).cast("long"))
    joined = sent.join(other, reduce(and_, [*same, col(salt) == col(zero)]), "left")
    return joined.select(
        *[col(c) for c in fact.columns],
        *[F.when(col(done), col(local[c])).otherwise(col(c)).alias(c) for c in payload],
    )


def _hashable(df: DataFrame, name: str) -> bool:
    return not isinstance(df.schema[name].dataType, (T.MapType, T.VariantType))


def _hot_rows(
    used: DataFrame,
    right: DataFrame,
    names: list[str],
    payload: list[str],
    hot_share: float,
    broadcast_bytes: int,
) -> DataFrame:
    """Lookup rows of the keys that more than ``hot_share`` of the rows use.

    If they exceed ``broadcast_bytes``, the share is raised until they fit. Keys are
    counted once; the keys sent to tasks are fewer than ``1 / hot_share``.
    """
    rows, size = (fresh(n, names, payload) for n in ("_rows", "_bytes"))
    known = reduce(and_, [col(n).isNotNull() for n in names])
    counts = used.groupBy(*names).agg(F.count(F.lit(1)).alias(rows))
    counts = materialise(counts, "key-counts")
    total = counts.agg(F.sum(rows)).first()[0] or 0
    frequent = counts.where(known & (col(rows) > total * hot_share))
    measured = frequent.select(*names, rows)
    bytes_ = measured.agg(F.sum(reduce(add, [_cell_bytes(f) for f in measured.schema.fields]))).first()[0] or 0
    side = F.broadcast(measured) if bytes_ <= broadcast_bytes else measured
    found = materialise(right.join(side, names), "hot-lookups")
    share = hot_share
    while True:
        hot = found.where(col(rows) > total * share).drop(rows)
        if (hot.agg(F.sum(_row_bytes(hot)).alias(size)).first()[0] or 0) <= broadcast_bytes:
            return hot
        share *= 4
