"""How filters overlap, and what every order of them removes: contractions of a contingency tensor.

Each document fails or passes each of k filters. Counted per part, this is a tensor with one axis of two (pass, fail) for
each filter, and one slice each for all, good and toxic documents. Every figure of every order is that tensor contracted with
one selector an axis: pass (1, 0), fail (0, 1) or all (1, 1). What a filter removes at a step is fail on its axis, pass on the
axes of the filters before it and all on the rest; so k * 2^(k-1) contractions serve all k! orders.

The documents are reduced in Spark by counts that combine on the map side: to one row per text, part and label, where the
repeats of a text are told from its first holder, then to at most 2^k rows a part. Only these meet in a task.

Defined results: a NULL text counts as '', a NULL part as ''. The last filter fails where the whole table holds the same text
under a smaller id; a NULL id is smaller than none and larger than none, rows of one id are no repeats of each other. A
document with several labels is good (toxic) if one of them says so, without labels neither. An empty table has no parts and
no rows. Extra columns are not carried along.
"""
from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollbook.llm.common import arrow_map, batch_of, blank_split, let
from rollbook.operators.joins import fresh

PASS, FAIL, ALL = np.array([[1, 0], [0, 1], [1, 1]], np.int64)
#: The repeat filter's name, after those of ``text_failures``.
REPEAT = "E"
#: k! orders are listed for each part.
MOST_FILTERS = 7


def text_failures(text: Column) -> dict[str, Column]:
    """Name and failure condition of the filters on a text alone: short, repetitive, upper-case, symbols."""
    def repetitive(words: Column) -> Column:
        return 100 * F.size(F.array_distinct(words)).cast("long") < 80 * F.size(words).cast("long")
    capitals = F.regexp_count(text, F.lit("[A-Z]")).cast("long")
    return {"A": F.size(blank_split(text)) < 100, "B": let(blank_split(text), repetitive),
            "C": 100 * capitals > 10 * F.length(text).cast("long"), "D": text.rlike(r"[#$%&*|]")}


def cells(docs: DataFrame, labels: DataFrame, failures: Mapping[str, Column] | None = None, id_col: str = "doc_id",
          text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """(part, failed, n, good, toxic): documents per part and set of filters failed.

    ``failures`` are conditions on the column ``text`` (``text_failures`` if None); the repeat filter comes last. ``failed`` has the
    first filter in its highest bit. ``labels`` holds the id, ``quality`` and ``toxic``.
    """
    failures = text_failures(F.col("text")) if failures is None else failures
    own = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                      F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    bits = sum((F.when(c, 2 ** (len(failures) - i)).otherwise(0) for i, c in enumerate(failures.values())), F.lit(0))
    # repeated rows meet here; the copies of a text, hot as they may be, still lie apart by their ids
    rows = (own.select("id", "part", F.md5("text").alias("mark"), bits.alias("failed"))
            .groupBy("id", "part", "mark", "failed").agg(F.count("*").alias("n")))
    said = (labels.select(F.col(id_col).cast("long").alias("label_id"), (F.col("quality") == 1).alias("is_good"), (F.col("toxic") == 1).alias("is_toxic"))
            .where("label_id IS NOT NULL").groupBy("label_id")
            .agg(F.coalesce(F.max("is_good"), F.lit(False)).alias("is_good"), F.coalesce(F.max("is_toxic"), F.lit(False)).alias("is_toxic")))
    # rows without id find no label, and are dealt out by their text
    rows = rows.withColumns({"known": F.col("id").isNotNull(), "place": F.coalesce("id", F.xxhash64("mark"))})
    said = said.withColumn("labelled", F.lit(True))
    labelled = rows.join(said, (F.col("place") == F.col("label_id")) & (F.col("known") == F.col("labelled"))
                         & (fresh(F.col("place")) == fresh(F.col("label_id"))), "left")
    no = F.lit(False)
    texts = (labelled.groupBy("mark", "part", "failed", F.coalesce("is_good", no).alias("good"), F.coalesce("is_toxic", no).alias("toxic"))
             .agg(F.sum("n").alias("n"), F.sum(F.when(F.col("known"), 0).otherwise(F.col("n"))).alias("nameless"),
                  F.min(F.when(F.col("known"), F.struct("id", "n"))).alias("least")))
    # one row per part and label of a text: a window over them is as small as their number
    first = F.min("least.id").over(Window.partitionBy("mark"))
    firsts = F.col("nameless") + F.when(F.col("least.id") == first, F.col("least.n")).otherwise(0)
    told = texts.withColumn("firsts", firsts)
    split = F.explode(F.array(F.struct(F.col("failed").alias("failed"), F.col("firsts").alias("n")),
                              F.struct((F.col("failed") + 1).alias("failed"), (F.col("n") - F.col("firsts")).alias("n"))))
    told = told.select("part", "good", "toxic", split.alias("x")).select("part", "good", "toxic", "x.failed", "x.n").where("n > 0")
    return told.groupBy("part", "failed").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"),
                                              F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic"))


def contract(tensor: np.ndarray, selectors: Sequence[np.ndarray]) -> np.ndarray:
    """The leading two axes (part, slice) of a tensor whose other axes are each contracted with their selector."""
    k = len(selectors)
    operands = [tensor, list(range(k + 2))]
    for axis, selector in enumerate(selectors):
        operands += [selector, [axis + 2]]
    return np.einsum(*operands, [0, 1])


def figures(tensor: np.ndarray, names: Sequence[str]) -> dict[str, np.ndarray]:
    """Each figure as an array (part, order, step) of all orders and steps; ``tensor`` is (part, slice, 2, 2, ...)."""
    k, orders = len(names), list(permutations(range(len(names))))
    removed: dict[tuple[int, frozenset[int]], np.ndarray] = {}
    for axis in range(k):
        for chosen in range(1 << k):
            before = frozenset(i for i in range(k) if chosen >> i & 1)
            if axis not in before:
                removed[axis, before] = contract(tensor, [FAIL if i == axis else PASS if i in before else ALL for i in range(k)])
    failing = [removed[axis, frozenset()] for axis in range(k)]
    alone = [removed[axis, frozenset(range(k)) - {axis}] for axis in range(k)]
    everything = contract(tensor, [ALL] * k)
    here = np.stack([np.stack([removed[o[s], frozenset(o[:s])] for s in range(k)], axis=-1) for o in orders], axis=-2)  # part, slice, order, step
    axes = np.array(orders)
    shapley = np.stack([sum(here[:, 0, n, o.index(axis)] for n, o in enumerate(orders)) for axis in range(k)], axis=-1)
    return {"kept": everything[:, 0, None, None] - np.cumsum(here[:, 0], axis=-1), "removed": here[:, 0],
            "redundant": np.stack([f[:, 0] for f in failing], axis=-1)[:, axes] - here[:, 0],
            "unique_fails": np.stack([f[:, 0] for f in alone], axis=-1)[:, axes],
            "good_lost": here[:, 1], "toxic_lost": here[:, 2], "shapley": shapley[:, axes]}


def audit(counts: DataFrame, names: Sequence[str]) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) from ``cells``: a row per part,
    order of the filters ``names`` (texts put together) and step from 1.

    At a step: documents kept after it, removed in it, failing its filter but removed before, failing no other filter; good and
    toxic ones removed in it; and its filter's removed, summed over all orders.
    """
    k = len(names)
    if k > MOST_FILTERS:
        raise ValueError(f"{k} filters have {factorial(k)} orders; at most {MOST_FILTERS} filters are audited")
    gathered = counts.groupBy("part").agg(F.collect_list(F.struct("failed", "n", "good", "toxic")).alias("cells"))
    orders = ["".join(o) for o in permutations(names)]
    wanted = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")

    def work(batches):
        for batch in batches:
            parts = batch.column(0).to_pylist()
            tensor = np.zeros((len(parts), 3, 1 << k), np.int64)
            for i, found in enumerate(batch.column(1).to_pylist()):
                for c in found:
                    tensor[i, :, c["failed"]] = c["n"], c["good"], c["toxic"]
            found = figures(tensor.reshape(len(parts), 3, *[2] * k), names)
            each = len(orders) * k
            yield batch_of(part=pa.array(parts, pa.string()).take(pa.array(np.repeat(np.arange(len(parts)), each))),
                           filter_order=pa.array(orders * len(parts), pa.string()).take(pa.array(np.repeat(np.arange(len(parts) * len(orders)), k))),
                           step=pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(parts) * len(orders))),
                           **{name: pa.array(found[name].ravel(), pa.int64()) for name in wanted})

    return arrow_map(gathered, work, "part string, filter_order string, step int, " + ", ".join(f"{name} long" for name in wanted))
