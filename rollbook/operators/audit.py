"""A set of data-quality rules in one pass over a result and its system of record.

Each rule counts, per key, the rows that the report of ``operators.quality`` for it would return. Instead of one job and join a rule, both
tables are read once, put under one another, and grouped: first by key and compared values, then by key. Both groupings combine on
the map side, so a key that holds a third of all rows costs each task one row per compared value, and nothing is joined.
"""
from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook.functions import is_blank, norm, not_blank


@dataclass(frozen=True)
class Missing:
    """Rows of the record that are ``active`` and have ``record_col``, where the result has no row or a blank ``result_col``."""
    result_col: str
    record_col: str
    active: Column


@dataclass(frozen=True)
class RuleSet:
    """Rules over a result and a record with the same keys: {result column: record column}.

    ``duplicates``: the name of the rule that a result's key occurs once. ``mismatch``: name -> {result column: record column},
    which must agree, blanks being equal. ``missing``: name -> ``Missing``. ``violated``: name -> condition on a result row.
    """
    keys: Mapping[str, str]
    duplicates: str | None = None
    mismatch: Mapping[str, Mapping[str, str]] = field(default_factory=dict)
    missing: Mapping[str, Missing] = field(default_factory=dict)
    violated: Mapping[str, Column] = field(default_factory=dict)


def _yes(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False)).cast("long")


def dq_report(result: DataFrame, record: DataFrame, rules: RuleSet) -> DataFrame:
    """(rule, keys of the result, n): every rule with the keys that break it and by how many rows (pairs of rows for a mismatch).

    NULL keys match nothing: they are no duplicates and no mismatches, and an active row of the record under one is missing.
    """
    names = list(rules.keys)
    zero, nothing = F.lit(0).cast("long"), F.lit("")
    compared = {c: norm(c) for pairs in rules.mismatch.values() for c in pairs}
    theirs = {c: norm(r) for pairs in rules.mismatch.values() for c, r in pairs.items()}

    def side(df: DataFrame, keys: Sequence[str], mine: bool) -> DataFrame:
        values = {f"v{i}": (compared if mine else theirs)[c] for i, c in enumerate(compared)}
        counts = {"mine": F.lit(1 if mine else 0).cast("long"), "record": F.lit(0 if mine else 1).cast("long")}
        for i, m in enumerate(rules.missing.values()):
            counts[f"blank{i}"] = _yes(is_blank(m.result_col)) if mine else zero
            counts[f"wanted{i}"] = zero if mine else _yes(not_blank(m.record_col) & m.active)
        for i, condition in enumerate(rules.violated.values()):
            counts[f"broken{i}"] = _yes(condition) if mine else zero
        return df.select(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], *[c.alias(n) for n, c in {**values, **counts}.items()])

    both = side(result, names, True).unionByName(side(record, list(rules.keys.values()), False))
    keys, values = [f"k{i}" for i in range(len(names))], [f"v{i}" for i in range(len(compared))]
    sums = [c for c in both.columns if c not in keys and c not in values]
    cells = both.groupBy(*keys, *values).agg(*[F.sum(c).alias(c) for c in sums])

    # per rule of mismatches: pairs in all, less those that agree on its columns
    columns = list(compared)
    agreeing, parts = {}, cells
    for i, pairs in enumerate(rules.mismatch.values()):
        own = [f"v{columns.index(c)}" for c in pairs]
        agreeing[f"equal{i}"] = own
    lists = sorted({tuple(sorted(own)) for own in agreeing.values()}, key=len, reverse=True)
    if all(set(less) <= set(more) for more, less in zip(lists, lists[1:])):
        # each list holds the next: the cells are summed up from list to list, which makes no rows, and a product of each sum counts
        # the pairs that agree
        at, held = tuple(sorted(values)), list(sums)
        for own in [*lists, ()]:
            if own != at:
                parts = parts.groupBy(*keys, *own).agg(*[F.sum(c).alias(c) for c in held])
                at = own
            met = [e for e, listed in agreeing.items() if tuple(sorted(listed)) == own and e not in held]
            parts = parts.withColumns({e: F.col("mine") * F.col("record") for e in met})
            held += met
        per_key = parts
    else:  # lists that overlap or differ: the cells, which are few, are counted once for each list of columns
        tagged = F.explode(F.array(*[F.struct(F.lit(e).alias("rule"), F.struct(*[F.when(F.lit(v in own), F.col(v)).otherwise(nothing).alias(v) for v in values]).alias("value"))
                                     for e, own in agreeing.items()]))
        each = (parts.select(*keys, *sums, tagged.alias("x")).groupBy(*keys, "x.rule", "x.value").agg(*[F.sum(c).alias(c) for c in sums]))
        first = next(iter(agreeing))
        per_key = each.groupBy(*keys).agg(*[F.sum(F.when(F.col("rule") == first, F.col(c))).alias(c) for c in sums],
                                          *[F.sum(F.when(F.col("rule") == e, F.col("mine") * F.col("record"))).alias(e) for e in agreeing])
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()

    found = {}
    if rules.duplicates:
        found[rules.duplicates] = F.when(known & (F.col("mine") > 1), F.col("mine"))
    for i, name in enumerate(rules.mismatch):
        found[name] = F.when(known, F.col("mine") * F.col("record") - F.col(f"equal{i}"))
    for i, name in enumerate(rules.missing):
        found[name] = F.col(f"wanted{i}") * F.when(known & (F.col("mine") > 0), F.col(f"blank{i}")).otherwise(1)
    for i, name in enumerate(rules.violated):
        found[name] = F.col(f"broken{i}")
    lines = F.explode(F.array(*[F.struct(F.lit(name).alias("rule"), n.alias("n")) for name, n in found.items()]))
    return (per_key.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], lines.alias("line"))
            .select("line.rule", *[F.col(f"`{n}`") for n in names], "line.n").where("n > 0"))
