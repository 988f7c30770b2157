"""Members that keep their keys from load to load."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.names import as_list, col, fresh
from starloom.operators.dedup import distinct_values
from starloom.operators.keys import with_surrogate_key


def unseen(rows: DataFrame, saved: DataFrame, keys: str | Iterable[str]) -> DataFrame:
    """Rows whose ``keys`` no row of ``saved`` has; NULL keys equal each other."""
    keys = as_list(keys)
    names = {k: fresh(f"_saved_{k}", rows.columns) for k in keys}
    known = saved.select(*[col(k).alias(n) for k, n in names.items()])
    same = reduce(and_, [col(k).eqNullSafe(col(n)) for k, n in names.items()])
    return rows.join(known, same, "left_anti")


def new_members(
    saved: DataFrame, rows: DataFrame, natural_key: str | Iterable[str], name: str = "id"
) -> DataFrame:
    """The members of ``rows`` that ``saved`` lacks, with keys after the saved ones.

    ``saved`` holds the natural key and the dense key ``name`` of every known member.
    The new members are numbered by the rank of their natural key, NULL first, from
    the largest saved key + 1, so keys depend on the loads and their order alone and
    no saved key ever changes. Rows are reduced to distinct members before the
    anti-join; what returns is as small as what is new, and empty where nothing is.
    """
    natural_key = as_list(natural_key)
    members = unseen(distinct_values(rows, natural_key), saved, natural_key)
    ranked = with_surrogate_key(members, natural_key, name)
    last = saved.agg(F.max(col(name))).first()[0]
    return ranked.withColumn(name, col(name) + F.lit(0 if last is None else last + 1))
