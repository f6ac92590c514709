"""Equi join of many rows with a side that has one row per key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_MIX = "_key_mix"
_MIXES = 16


def common_type(rows: DataFrame, a: str, keyed: DataFrame, b: str) -> T.DataType:
    """The type in which Spark compares two columns of different types."""
    left, right = rows.schema[a].dataType, keyed.schema[b].dataType
    if left == right:
        return left
    fields = [T.StructField("a", left), T.StructField("b", right)]
    both = rows.sparkSession.createDataFrame([], T.StructType(fields))
    return both.select(F.coalesce("a", "b").alias("c")).schema["c"].dataType


def _as(name: str, own: T.DataType, kind: T.DataType) -> Column:
    """The column in the common type; text that does not fit it matches nothing. Minus
    zero becomes zero, which equals it but has another hash."""
    column = F.col(f"`{name}`")
    if own != kind:
        column = column.try_cast(kind)
    return column + F.lit(0).cast(kind) if isinstance(kind, T.FractionalType) else column


def _mix(*keys: Column) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(_MIXES))


def join_by_key(
    rows: DataFrame,
    keyed: DataFrame,
    on: Sequence[str] | Mapping[str, str],
    how: str = "inner",
    where: Column | None = None,
) -> DataFrame:
    """Join ``rows`` to ``keyed`` on equal keys, where one key may hold a large share
    of ``rows``. ``on`` lists common names, or maps names of ``rows`` to names of
    ``keyed``; the key columns of ``keyed`` are not in the result. ``where`` is a
    further condition on columns of both. Keys of different types are compared in their
    common type.

    ``keyed`` usually comes from an aggregate over the same key, and Spark would
    join it in place. Adaptive execution splits a hot key only where both sides
    were shuffled for the join itself, so the keys are joined together with a hash
    of them: the small side is shuffled once more, and the hot key can be split. Four bits of the hash do;
    all of it would be eight bytes that no shuffle compresses in every row.
    A ``keyed`` side below the broadcast threshold is broadcast as ever.
    """
    pairs = dict(on) if isinstance(on, Mapping) else {name: name for name in on}
    kinds = [common_type(rows, a, keyed, b) for a, b in pairs.items()]
    own = [_as(a, rows.schema[a].dataType, k) for a, k in zip(pairs, kinds, strict=True)]
    theirs = [
        _as(b, keyed.schema[b].dataType, k) for b, k in zip(pairs.values(), kinds, strict=True)
    ]
    extra = [name for name in keyed.columns if name not in pairs.values()]
    right = keyed.select(
        *[c.alias(f"_key_{i}") for i, c in enumerate(theirs)],
        *[F.col(f"`{name}`") for name in extra],
    ).withColumn(f"{_MIX}_2", _mix(*[F.col(f"_key_{i}") for i in range(len(pairs))]))
    left = rows.withColumn(f"{_MIX}_1", _mix(*own))
    same: list[Column] = [F.col(f"{_MIX}_1") == F.col(f"{_MIX}_2")]
    same += [c == F.col(f"_key_{i}") for i, c in enumerate(own)]
    same += [] if where is None else [where]
    joined = left.join(right, reduce(Column.__and__, same), how)
    kept = [F.col(f"`{name}`") for name in rows.columns]
    if how in ("left_semi", "left_anti"):
        return joined.select(*kept)
    return joined.select(*kept, *[F.col(f"`{name}`") for name in extra])
