"""Row changes as DataFrame rewrites: upsert, insert-or-ignore, delete, update.

Each takes the current rows and returns the new rows; :mod:`tidemark.sources.tables`
publishes them.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators._columns import as_column, hashable, names, require_columns, spread
from tidemark.operators.filters import equals_all


def align(batch: DataFrame, schema: T.StructType) -> DataFrame:
    """The batch with the target's columns, order and types; absent columns are NULL."""
    extra = [c for c in batch.columns if c not in schema.names]
    if extra:
        raise ValueError(f"columns not in the target: {', '.join(extra)}")
    return batch.select(*[
        (F.col(f"`{f.name}`") if f.name in batch.columns else F.lit(None)).cast(f.dataType)
        .alias(f.name)
        for f in schema.fields
    ])


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN in floating columns becomes NULL."""
    return df.select(*[
        F.when(~F.isnan(F.col(f"`{f.name}`")), F.col(f"`{f.name}`")).alias(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])


def _has_key(keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"`{k}`").isNotNull() for k in keys])


def _apart(keys: list[str], df: DataFrame, match_nulls: bool) -> Column:
    """0 for rows with a full key; rows without one match nothing and are spread out."""
    if match_nulls:
        return F.lit(0).cast("long")
    return F.when(_has_key(keys), F.lit(0).cast("long")).otherwise(spread(df))


def _one_per_key(batch: DataFrame, keys: list[str], on_duplicate: str,
                 order_by: list[str], match_nulls: bool) -> DataFrame:
    """One batch row per key, and all rows without a full key.

    The aggregate shuffles the batch by key, which the join that follows needs anyway.
    Rows without a full key are grouped by a hash of the whole row and given back as often
    as they came.
    """
    rest = [c for c in batch.columns if c not in keys]
    payload = F.struct(*rest)
    if on_duplicate == "last":
        if not order_by:
            raise ValueError("on_duplicate='last' needs order_by")
        # the other columns break ties, so that the choice is repeatable
        row = F.max_by(payload, F.struct(*order_by, *hashable(batch, rest)))
    elif on_duplicate == "error":
        row = F.first(payload)
    else:
        raise ValueError("on_duplicate must be 'error' or 'last'")
    marked = batch.withColumn("_apart", _apart(keys, batch, match_nulls)).withColumn(
        "_row_hash", F.when(F.col("_apart") != 0, F.hash(*hashable(batch))))
    picked = marked.groupBy(*keys, "_apart", "_row_hash").agg(
        row.alias("_row"), F.count(F.lit(1)).alias("_n"))
    matches = F.lit(True) if match_nulls else _has_key(keys)
    times = F.when(~matches, F.col("_n")).otherwise(F.lit(1).cast("long"))
    if on_duplicate == "error":
        times = F.when(matches & (F.col("_n") > 1), F.raise_error(F.lit(
            "upsert cannot touch a row twice: duplicate key in the batch")).cast("long")
        ).otherwise(times)
    copies = picked.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), times)))
    return copies.select(*keys, "_apart", *[F.col("_row")[c].alias(c) for c in rest])


def _check_upsert(target: DataFrame, batch: DataFrame, keys, update) -> tuple[list, list]:
    keys = names(keys)
    if not keys:
        raise ValueError("key columns are required")
    require_columns(target, keys)
    require_columns(batch, keys)
    update = names(update) if update is not None else [c for c in batch.columns if c not in keys]
    if not update:
        raise ValueError("nothing to update: the batch has only key columns")
    require_columns(batch, update)
    require_columns(target, batch.columns)
    return keys, update


def upsert(
    target: DataFrame,
    batch: DataFrame,
    keys: str | Iterable[str],
    update: Iterable[str] | None = None,
    on_duplicate: str = "error",
    order_by: str | Iterable[str] = (),
    mark: str | None = None,
    match_nulls: bool = False,
) -> DataFrame:
    """The target after inserting the batch, updating rows whose key exists.

    ``update`` defaults to every non-key column of the batch.  Other columns keep their
    value on update and are NULL on insert.  A NULL key never matches, unless ``match_nulls``
    makes NULL a value like any other, as in a group key.  ``mark`` names a column that tells
    changed rows from untouched ones.
    """
    keys, update = _check_upsert(target, batch, keys, update)
    single = _one_per_key(batch, keys, on_duplicate, names(order_by), match_nulls)
    old = target.select(
        *[F.col(f"`{c}`").alias(f"o_{c}") for c in target.columns],
        _apart(keys, target, match_nulls).alias("_apart_o"), F.lit(True).alias("_old"))
    new = single.select(*[F.col(f"`{c}`").alias(f"n_{c}") for c in batch.columns],
                        F.col("_apart").alias("_apart_n"), F.lit(True).alias("_new"))
    on = reduce(lambda a, b: a & b, [
        F.col(f"o_{k}").eqNullSafe(F.col(f"n_{k}")) if match_nulls else F.col(f"o_{k}") == F.col(f"n_{k}")
        for k in keys])
    both = old.join(new, on & (F.col("_apart_o") == F.col("_apart_n")), "full")

    fresh, inserted = F.col("_new").isNotNull(), F.col("_old").isNull()
    out = []
    for field in target.schema.fields:
        c = field.name
        if c not in batch.columns:
            value = F.col(f"o_{c}")
        elif c in update:
            value = F.when(fresh, F.col(f"n_{c}").cast(field.dataType)).otherwise(F.col(f"o_{c}"))
        else:
            value = F.when(inserted, F.col(f"n_{c}").cast(field.dataType)).otherwise(
                F.col(f"o_{c}"))
        out.append(value.alias(c))
    if mark:
        out.append(fresh.alias(mark))
    return both.select(*out)


def upsert_returning(target: DataFrame, batch: DataFrame, keys: str | Iterable[str],
                     update: Iterable[str] | None = None, **options) -> DataFrame:
    """Only the rows that the upsert inserted or updated, as they are afterwards."""
    return upsert(target, batch, keys, update, mark="_changed", **options).filter(
        "_changed").drop("_changed")


def insert_ignore(target: DataFrame, batch: DataFrame, keys: str | Iterable[str]) -> DataFrame:
    """Batch rows, in the target's schema, whose key the target does not hold yet.

    Of several batch rows with one key, one is kept.
    """
    keys = names(keys)
    require_columns(target, keys)
    aligned = align(batch, target.schema)
    keyed = aligned.filter(_has_key(keys))
    rest = [c for c in aligned.columns if c not in keys]
    if rest:
        # ordered by a comparable form, so that the choice is repeatable
        pick = F.min_by(F.struct(*rest), F.struct(*hashable(aligned, rest)))
        single = keyed.groupBy(*keys).agg(pick.alias("_row")).select(
            *keys, *[F.col("_row")[c].alias(c) for c in rest])
    else:
        single = keyed.distinct()
    fresh = single.select(*aligned.columns).join(
        target.filter(_has_key(keys)).select(*keys), keys, "left_anti")
    return fresh.select(*aligned.columns).unionByName(aligned.filter(~_has_key(keys)))


def _condition(df: DataFrame, where: Mapping[str, Any] | Column | str) -> Column:
    if where is None or (not isinstance(where, Column) and not where):
        raise ValueError("where must not be empty")
    matched = equals_all(df, where) if isinstance(where, Mapping) else as_column(where)
    # a NULL condition does not match
    return F.coalesce(matched, F.lit(False))


def delete_where(df: DataFrame, where: Mapping[str, Any] | Column | str) -> DataFrame:
    """The rows that stay."""
    return df.filter(~_condition(df, where))


def update_where(df: DataFrame, values: Mapping[str, Any],
                 where: Mapping[str, Any] | Column | str) -> DataFrame:
    """All rows, with ``values`` (constants or columns) set where the condition holds."""
    if not values:
        raise ValueError("values must not be empty")
    require_columns(df, values)
    matched = _condition(df, where)
    return df.select(*[
        F.when(matched, (values[f.name] if isinstance(values[f.name], Column)
                         else F.lit(values[f.name])).cast(f.dataType))
        .otherwise(F.col(f"`{f.name}`")).alias(f.name)
        if f.name in values else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])


def truncate(df: DataFrame) -> DataFrame:
    """No rows, same schema."""
    return df.limit(0)


# --- effects of deleting parents --------------------------------------------------

def _deleted_keys(parent: DataFrame, where, key: list[str]) -> DataFrame:
    return parent.filter(_condition(parent, where)).select(
        *[F.col(k).alias(f"_deleted_{i}") for i, k in enumerate(key)]).distinct()


def on_parent_delete(
    child: DataFrame,
    parent: DataFrame,
    where: Mapping[str, Any] | Column | str,
    child_key: str | Iterable[str],
    parent_key: str | Iterable[str],
    action: str,
    defaults: Mapping[str, Any] | None = None,
) -> DataFrame:
    """The child table after deleting matching parents.

    ``CASCADE`` drops the child rows, ``SET NULL`` and ``SET DEFAULT`` rewrite their key,
    ``RESTRICT`` and ``NO ACTION`` return one row with the number of child rows in the way.
    """
    child_key, parent_key = names(child_key), names(parent_key)
    if len(child_key) != len(parent_key) or not child_key:
        raise ValueError("child_key and parent_key must pair up")
    gone = _deleted_keys(parent, where, parent_key)
    on = reduce(lambda a, b: a & b,
                [F.col(c) == F.col(f"_deleted_{i}") for i, c in enumerate(child_key)])
    action = action.upper()
    if action == "CASCADE":
        return child.join(gone, on, "left_anti")
    if action in ("SET NULL", "SET DEFAULT"):
        values = dict(defaults or {}) if action == "SET DEFAULT" else {}
        # the deleted keys are unique, so the join keeps every child row once
        hit = child.join(gone.withColumn("_hit", F.lit(True)), on, "left")
        types = {f.name: f.dataType for f in child.schema.fields}
        return hit.select(*[
            F.when(F.col("_hit"), F.lit(values.get(c)).cast(types[c])).otherwise(F.col(c)).alias(c)
            if c in child_key else F.col(c) for c in child.columns
        ])
    if action in ("RESTRICT", "NO ACTION"):
        return child.join(gone, on, "left_semi").agg(F.count(F.lit(1)).alias("blocking_rows"))
    raise ValueError(f"unknown action: {action}")


# --- lookups ----------------------------------------------------------------------

def key_mapping(df: DataFrame, lookup: DataFrame, on: Mapping[str, str], key: str,
                alias: str) -> DataFrame:
    """Replace matching values by the lookup's key; rows without a match drop out."""
    side = lookup.select(*[F.col(r).alias(f"_on_{r}") for r in on.values()],
                         F.col(key).alias(alias))
    match = reduce(lambda a, b: a & b, [F.col(c) == F.col(f"_on_{r}") for c, r in on.items()])
    return df.join(side, match, "inner").drop(*[f"_on_{r}" for r in on.values()])


def lookup_one(df: DataFrame, lookup: DataFrame, on: Mapping[str, str], value: str,
               alias: str) -> DataFrame:
    """Add one matching value (the smallest, so that it is repeatable), or NULL."""
    side = lookup.groupBy(*[F.col(r).alias(f"_on_{r}") for r in on.values()]).agg(
        F.min(value).alias(alias))
    match = reduce(lambda a, b: a & b, [F.col(c) == F.col(f"_on_{r}") for c, r in on.items()])
    return df.join(side, match, "left").drop(*[f"_on_{r}" for r in on.values()])


def distinct_values(df: DataFrame, columns: str | Iterable[str]) -> DataFrame:
    """Distinct non-NULL values."""
    columns = names(columns)
    return df.select(*columns).dropna(subset=columns).distinct()


def drop_nulls(*columns: str):
    """Transform step that drops rows with a NULL in ``columns``."""
    def step(df: DataFrame) -> DataFrame:
        return df.dropna(subset=list(columns))
    step.__name__ = "drop_nulls"
    return step


def trim_lower(*columns: str):
    """Transform step that lower-cases and trims text columns."""
    def step(df: DataFrame) -> DataFrame:
        return df.withColumns({c: F.lower(F.trim(F.col(c))) for c in columns})
    step.__name__ = "trim_lower"
    return step
