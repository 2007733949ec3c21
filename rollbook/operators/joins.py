"""Join operators.

No side is broadcast by hint: Spark broadcasts a lookup when its measured size is under
``spark.sql.autoBroadcastJoinThreshold`` and otherwise sort-merges, where adaptive execution splits a hot key.
It can only split a join whose two sides were both shuffled for it. A side grouped on the join keys would keep the
partitioning of its grouping, so every join here carries one more key (see ``fresh``) that asks for a new shuffle of
the small grouped side.
"""
from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook.functions import col, norm, precedes
from rollbook.operators.picks import latest

Keys = Sequence[str] | Mapping[str, str]


def _pairs(keys: Keys) -> list[tuple[str, str]]:
    return list(keys.items()) if isinstance(keys, Mapping) else [(k, k) for k in keys]


def fresh(*keys: Column) -> Column:
    """Always 0, but computed from the keys: as a join key it makes both sides shuffle for this join."""
    return F.pmod(F.xxhash64(*keys), F.lit(1))


def _conditions(keys: Keys, prefix: str) -> Column:
    """Equality of all keys with the right-hand ones of ``_renamed``."""
    left = [F.col(mine) for mine, _ in _pairs(keys)]
    return reduce(lambda a, b: a & b, [*[c == F.col(f"{prefix}{i}") for i, c in enumerate(left)],
                                       fresh(*left) == F.col(f"{prefix}fresh")])


def _renamed(keys: Keys, prefix: str) -> list[Column]:
    """Right-hand keys under private names, so that both sides may use the same column names."""
    right = [F.col(theirs) for _, theirs in _pairs(keys)]
    return [*[c.alias(f"{prefix}{i}") for i, c in enumerate(right)], fresh(*right).alias(f"{prefix}fresh")]


def _without(df: DataFrame, keys: Keys, prefix: str) -> DataFrame:
    return df.drop(f"{prefix}fresh", *[f"{prefix}{i}" for i in range(len(_pairs(keys)))])


def enrich(df: DataFrame, lookups: Sequence[tuple[DataFrame, Keys, Mapping[str, str | Column]]],
           how: str = "left", colocated: bool = False) -> DataFrame:
    """Chain of lookup joins: (dimension, keys, {new column: source column}). Several matches repeat the row.

    ``colocated``: both sides may keep the partitioning they have, as frames bucketed by or grouped on the keys; for keys without
    hot values, as such a join cannot be split.
    """
    for i, (dim, keys, take) in enumerate(lookups):
        prefix = f"_dim{i}_"
        if colocated:
            renamed = dim.select(*[F.col(theirs).alias(f"{prefix}{j}") for j, (_, theirs) in enumerate(_pairs(keys))],
                                 *[col(source).alias(name) for name, source in take.items()])
            on = reduce(lambda a, b: a & b, [F.col(mine) == F.col(f"{prefix}{j}") for j, (mine, _) in enumerate(_pairs(keys))])
            df = df.join(renamed, on, how).drop(*[f"{prefix}{j}" for j in range(len(_pairs(keys)))])
            continue
        side = dim.select(*_renamed(keys, prefix), *[col(source).alias(name) for name, source in take.items()])
        df = _without(df.join(side, _conditions(keys, prefix), how), keys, prefix)
    return df


def right_master(df: DataFrame, master: DataFrame, keys: Keys,
                 take: Mapping[str, str | Column]) -> DataFrame:
    """Keep every master row; ``keys`` maps master columns to ``df`` columns, ``take`` picks from ``df``."""
    return enrich(master, [(df, keys, take)])


def semi(df: DataFrame, other: DataFrame, keys: Keys) -> DataFrame:
    return df.join(other.select(*_renamed(keys, "_in")), _conditions(keys, "_in"), "left_semi")


def anti(df: DataFrame, other: DataFrame, keys: Keys) -> DataFrame:
    """Rows without a match; a row with a NULL key has none and stays."""
    return df.join(other.select(*_renamed(keys, "_in")), _conditions(keys, "_in"), "left_anti")


def remove_matching(df: DataFrame, other: DataFrame, keys: Keys) -> DataFrame:
    """Delete the rows that have a match."""
    return anti(df, other, keys)


def mark(df: DataFrame, other: DataFrame, keys: Keys, out: str) -> DataFrame:
    """Add a boolean column "key occurs in other": IN (subquery) for use inside an expression."""
    found = other.select(*[r for _, r in _pairs(keys)]).distinct().select(*_renamed(keys, "_in"),
                                                                          F.lit(True).alias(out))
    return (_without(df.join(found, _conditions(keys, "_in"), "left"), keys, "_in")
            .withColumn(out, F.coalesce(F.col(out), F.lit(False))))


def _not_in(df: DataFrame, other: DataFrame, key: str, other_key: str) -> tuple[DataFrame, Column]:
    """``df`` with a match marker, and the three-valued ``key NOT IN (other)`` reduced to true or not true.

    Two scalar subqueries tell whether the list is empty or holds a NULL. Written as a NOT IN, a list too large to
    broadcast would be tested by nested loops.
    """
    facts = other.agg(F.count(F.lit(1)).alias("n"), F.count(other_key).alias("known"))
    empty = facts.select(F.col("n") == 0).scalar()
    has_null = facts.select(F.col("n") > F.col("known")).scalar()
    marked = mark(df, other, {key: other_key}, "_listed")
    return marked, empty | (~has_null & F.col(key).isNotNull() & ~F.col("_listed"))


def anti_null_aware(df: DataFrame, other: DataFrame, key: str, other_key: str | None = None) -> DataFrame:
    """Rows for which ``key NOT IN (other)`` is true: none if the list holds a NULL."""
    marked, missing = _not_in(df, other, key, other_key or key)
    return marked.where(missing).drop("_listed")


def delete_not_in(df: DataFrame, other: DataFrame, key: str, other_key: str | None = None) -> DataFrame:
    """Rows left after deleting those for which ``key NOT IN (other)`` is true."""
    marked, missing = _not_in(df, other, key, other_key or key)
    return marked.where(~missing).drop("_listed")


def join_blank_safe(df: DataFrame, other: DataFrame, keys: Keys, take: Mapping[str, str | Column],
                    how: str = "left") -> DataFrame:
    """Equi-join where NULL, '' and blanks are one key value (``<=>`` would keep NULL and '' apart)."""
    pairs = _pairs(keys)
    mine, theirs = [norm(left) for left, _ in pairs], [norm(right) for _, right in pairs]
    side = other.select(*[c.alias(f"_b{i}") for i, c in enumerate(theirs)], fresh(*theirs).alias("_bfresh"),
                        *[col(source).alias(name) for name, source in take.items()])
    on = reduce(lambda a, b: a & b, [*[c == F.col(f"_b{i}") for i, c in enumerate(mine)],
                                     fresh(*mine) == F.col("_bfresh")])
    return _without(df.join(side, on, how), keys, "_b")


def eav_lookup(df: DataFrame, eav: DataFrame, name: str, keys: Keys, out: str,
               name_col: str = "name", value_col: str = "value") -> DataFrame:
    """Attach the value of one attribute from a key/value table."""
    return enrich(df, [(eav.where(F.col(name_col) == name), keys, {out: value_col})])


def eav_columns(df: DataFrame, eav: DataFrame, names: Mapping[str, str], keys: Keys, name_col: str = "name",
                value_col: str = "value") -> DataFrame:
    """``eav_lookup`` of several attributes, {new column: attribute}, by one reading, one grouping and one join.

    A row is repeated for each value of an attribute, as by one join an attribute. Equal values are counted before the
    join, so what is gathered for a key is as small as its distinct values.
    """
    theirs = [r for _, r in _pairs(keys)]
    counted = (eav.where(F.col(name_col).isin(list(names.values()))).groupBy(*theirs, F.col(name_col).alias("_name"), F.col(value_col).alias("_value"))
               .agg(F.count(F.lit(1)).cast("int").alias("_n")))
    held = [F.collect_list(F.when(F.col("_name") == name, F.struct("_value", "_n"))).alias(out) for out, name in names.items()]
    rows = enrich(df, [(counted.groupBy(*theirs).agg(*held), keys, {out: out for out in names})])
    for out in names:
        rows = rows.withColumn(out, F.explode_outer(F.flatten(F.transform(out, lambda x: F.array_repeat(x["_value"], x["_n"])))))
    return rows


def update_from(df: DataFrame, src: DataFrame, keys: Keys, values: Mapping[str, str]) -> DataFrame:
    """Set {target: source} columns on matched rows. Of several matches the row with the least source values wins,
    compared in the given order, NULL last."""
    theirs = [r for _, r in _pairs(keys)]
    row = F.struct(*[F.struct(F.col(s).isNull().alias("gone"), F.col(s).alias("value")).alias(f"c{i}")
                     for i, s in enumerate(values.values())])
    side = (src.groupBy(*theirs).agg(F.min(row).alias("_row"))
            .select(*_renamed(keys, "_upd"), "_row"))
    joined = df.join(side, _conditions(keys, "_upd"), "left")
    updated = joined.withColumns({
        t: F.when(F.col("_row").isNotNull(), F.col(f"_row.c{i}.value")).otherwise(F.col(t) if t in df.columns else F.lit(None))
        for i, t in enumerate(values)})
    return updated.select(*df.columns, *[t for t in values if t not in df.columns])


def cancelled_by(df: DataFrame, negatives: DataFrame, keys: Keys, order: Sequence[tuple[str, str]],
                 out: str = "cancelled") -> DataFrame:
    """Mark rows that the last negative row of their key follows.

    ``order`` pairs the compared columns (this row's, the negative's), most significant first. Only the last
    negative per key can decide, so it is reduced to one row per key before the join.
    """
    order_of = [n for _, n in order]
    pairs = _pairs(keys)
    last = latest(negatives.select(*[r for _, r in pairs], *[n for n in order_of if n not in dict(pairs).values()]),
                  [r for _, r in pairs], order_of)
    side = last.select(*_renamed(keys, "_neg"), *[F.col(n).alias(f"_cmp{i}") for i, n in enumerate(order_of)])
    joined = df.join(side, _conditions(keys, "_neg"), "left")
    flag = precedes([F.col(mine) for mine, _ in order], [F.col(f"_cmp{i}") for i in range(len(order))])
    return joined.withColumn(out, flag).select(*df.columns, out)


def apply_negations(current: DataFrame, negatives: DataFrame, keys: Keys, order: Sequence[tuple[str, str]],
                    null_cols: Sequence[str], cancel_keys: Sequence[str] | None = None) -> DataFrame:
    """Blank ``null_cols`` where a later negative row exists.

    ``cancel_keys`` widens the reach: every row that shares these keys with a cancelled row is blanked too.
    """
    flagged = cancelled_by(current, negatives, keys, order, "_cancelled")
    if cancel_keys is not None:
        flagged = propagate_flag(flagged, cancel_keys, {"_cancelled": F.col("_cancelled")})
    return flagged.withColumns({c: F.when(~F.col("_cancelled"), F.col(c)) for c in null_cols}).drop("_cancelled")


def propagate_flag(df: DataFrame, keys: Sequence[str], flags: Mapping[str, Column],
                   blank_safe: Sequence[str] = (), over_keys: Mapping[str, Column] | None = None) -> DataFrame:
    """Give every row the OR of a flag over its key group.

    A NULL in a plain key matches nothing, so such a row gets False; ``blank_safe`` keys treat NULL as ''. Flags in
    ``over_keys`` spread over the plain keys alone; their groups are built from the finer ones, so that the rows
    are joined once. A group is reduced by a map-side combine and joined back: a hot group never sits in one
    window partition.
    """
    over_keys = over_keys or {}
    every = {**flags, **over_keys}
    plain = [f"_g{i}" for i in range(len(keys))]
    exprs = [F.col(k) for k in keys] + [norm(k) for k in blank_safe]
    side = (df.groupBy(*[e.alias(f"_g{i}") for i, e in enumerate(exprs)])
            .agg(*[F.max(F.coalesce(flag, F.lit(False))).alias(f"_f_{name}") for name, flag in every.items()]))
    if over_keys:
        coarse = side.groupBy(*plain).agg(*[F.max(f"_f_{n}").alias(f"_f_{n}") for n in over_keys])
        side = enrich(side.drop(*[f"_f_{n}" for n in over_keys]),
                      [(coarse, plain, {f"_f_{n}": f"_f_{n}" for n in over_keys})], how="inner")
    side = side.withColumn("_gfresh", fresh(*[F.col(f"_g{i}") for i in range(len(exprs))]))
    on = reduce(lambda a, b: a & b, [*[e == F.col(f"_g{i}") for i, e in enumerate(exprs)],
                                     fresh(*exprs) == F.col("_gfresh")])
    joined = df.join(side, on, "left").withColumns(
        {name: F.coalesce(F.col(f"_f_{name}"), F.lit(False)) for name in every})
    return joined.select(*df.columns, *[n for n in every if n not in df.columns])


def single_responsible(df: DataFrame, key: str, indicator: str, current: Column,
                       demote: Sequence[str] | None = None) -> DataFrame:
    """Where a key has several YES rows and a current row, set ``demote`` to 'NO' on its other rows."""
    current = F.coalesce(current, F.lit(False))
    split = (df.groupBy(key).agg(F.count_if(norm(indicator) == "yes").alias("yes"), F.max(current).alias("current"))
             .where((F.col("yes") > 1) & F.col("current")))
    joined = enrich(df, [(split, [key], {"_split": F.lit(True)})])
    lost = F.coalesce(F.col("_split"), F.lit(False)) & ~current
    return (joined.withColumns({c: F.when(lost, "NO").otherwise(F.col(c)) for c in demote or [indicator]})
            .select(*df.columns))
