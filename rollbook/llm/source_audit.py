"""How far the sources of a language differ in their words: exact divergences over run-length columns of counts.

A term is a run of ASCII letters and non-ASCII characters, A-Z lowered. Of each language the terms found in at least
``min_docs`` documents are kept. Each (language, source) group gives each kept term the smoothed share
p = 1 + floor(SCALE * (count + 2) / (N + 2V)), with N its count of kept terms and V their number, and two groups diverge by the sum
over the kept terms of floor((p - q)^2 / (p + q)).

Most counts are small and equal, so no group's column is written out. The vocabulary is reordered: terms with the same counts in
all sources become one row that stands for as many, and the rows are sorted by their counts, in each partition. Blocks of
neighbouring rows are run-length encoded, a column a group; two groups are compared run by run, over the union of their run
boundaries, each f multiplied by the length of its run. Blocks are bounded in size, and add up to the sums by map-side combine.

Exactness: counts and lengths are integers, shares are floored quotients of arbitrary precision, whatever the input's size.

Defined results: NULL text, language and source count as ''. A group without kept terms has N = 0 and takes part; a language without kept
terms has no terms and divergences 0. Repeated rows count as documents of their own. An empty table has no rows. Extra columns are
not carried along.
"""
from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollbook.llm.common import arrow_map, batch_of
from rollbook.operators.joins import fresh
from rollbook.sources.tables import stage

SCALE = 1_000_000_000
#: Bytes of UTF-8 that make terms: ASCII letters, and all of the characters beyond ASCII.
TERM = re.compile(rb"[A-Za-z\x80-\xff]+")
#: Terms that a task counts before it hands them on, and their bytes beyond 64 each.
TASK_TERMS, TASK_BYTES = 300_000, 32 << 20
#: Rows of a block, and counts over all its rows.
BLOCK_ROWS, BLOCK_COUNTS = 1 << 15, 1 << 19
#: Sums of pairs that a task holds before it hands them on.
TASK_PAIRS = 200_000


def term_counts(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """(lang, source, term, count, docs): partial counts, summed as far as a task's memory went."""
    def rows(held):
        for (lang, source), (count, holders) in held.items():
            terms = list(count)
            yield batch_of(lang=pa.array([lang] * len(terms), pa.string()), source=pa.array([source] * len(terms), pa.string()),
                           term=pa.array(terms, pa.binary()).cast(pa.string()), count=pa.array(count.values(), pa.int64()),
                           docs=pa.array([holders[t] for t in terms], pa.int64()))

    def work(batches):
        held, terms, extra = {}, 0, 0
        for batch in batches:
            texts = batch.column(2).cast(pa.binary())
            for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts):
                found = TERM.findall((text.as_py() or b"").lower())  # bytes.lower() lowers A-Z alone
                count, holders = held.setdefault((lang, source), (Counter(), Counter()))
                own, before = set(found), len(count)
                count.update(found)
                holders.update(own)
                terms += len(count) - before
                if len(max(own, key=len, default=b"")) > 64:
                    extra += sum(len(t) - 64 for t in own if len(t) > 64)
                if terms > TASK_TERMS or extra > TASK_BYTES:
                    yield from rows(held)
                    held, terms, extra = {}, 0, 0
        yield from rows(held)

    return arrow_map(docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (lang_col, source_col, text_col)]), work,
                     "lang string, source string, term string, count long, docs long")


def kept_terms(counts: DataFrame, min_docs: int) -> DataFrame:
    """(lang, term, total, held): the kept terms with their count, and that in each source that has them."""
    # dealt out once, by language and term; both groupings keep that partitioning
    dealt = counts.repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("count").alias("count"), F.sum("docs").alias("docs"))
    return (dealt.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("count").alias("total"),
                                              F.sort_array(F.collect_list(F.struct("source", "count"))).alias("held"))
            .where(F.col("docs") >= min_docs).drop("docs"))


def share(count: Column, n: Column, v: Column) -> Column:
    """The smoothed share, exactly."""
    whole = lambda c, digits: c.cast(f"decimal({digits},0)")
    return 1 + F.call_function("div", whole(F.lit(SCALE), 10) * (whole(count, 20) + 2), whole(n, 20) + 2 * whole(v, 19))


def difference(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def shares(counts: np.ndarray, n: int, v: int) -> np.ndarray:
    """``share`` of an array of counts, in Python's integers: one a run, not one a term."""
    return np.array([1 + SCALE * (c + 2) // (n + 2 * v) for c in counts.tolist()], np.int64)


def encoded(terms: DataFrame) -> DataFrame:
    """(lang, size, sources, ends, counts): blocks of the reordered vocabulary, with the run ends and run values of each source found there."""
    runs = terms.groupBy("lang", F.col("held").alias("vector")).agg(F.count("*").alias("length"))
    # sorted where the grouping has put them: ranges over the whole would need a sample of the vectors on the driver
    ordered = runs.sortWithinPartitions("lang", "vector")

    def block(lang, vectors, lengths):
        places = np.cumsum(lengths)
        owner = np.repeat(np.arange(len(vectors)), [len(v) for v in vectors])
        flat = [x for v in vectors for x in v]
        counts = np.array([x["count"] for x in flat], np.int64)
        names, code = np.unique(np.array([x["source"] for x in flat], object), return_inverse=True)
        ends, values = [], []
        for s in range(len(names)):
            column = np.zeros(len(vectors), np.int64)
            column[owner[code == s]] = counts[code == s]
            last = np.append(np.flatnonzero(column[1:] != column[:-1]), len(column) - 1)
            ends.append(places[last].tolist())
            values.append(column[last].tolist())
        longs = pa.list_(pa.list_(pa.int64()))
        return batch_of(lang=pa.array([lang], pa.string()), size=pa.array([int(places[-1])], pa.int64()), sources=pa.array([names.tolist()], pa.list_(pa.string())),
                        ends=pa.array([ends], longs), counts=pa.array([values], longs))

    def work(batches):
        lang, vectors, lengths, cells = None, [], [], 0
        for batch in batches:
            for row in batch.to_pylist():
                if vectors and (row["lang"] != lang or len(vectors) >= BLOCK_ROWS or cells >= BLOCK_COUNTS):
                    yield block(lang, vectors, lengths)
                    vectors, lengths, cells = [], [], 0
                lang = row["lang"]
                vectors.append(row["vector"])
                lengths.append(row["length"])
                cells += len(row["vector"])
        if vectors:
            yield block(lang, vectors, lengths)

    return arrow_map(ordered, work, "lang string, size long, sources array<string>, ends array<array<long>>, counts array<array<long>>")


def intersected(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> int:
    """Sum of f over two columns of (run ends, shares), run by run of both."""
    ends = np.union1d(a[0], b[0])
    p, q = a[1][np.searchsorted(a[0], ends)], b[1][np.searchsorted(b[0], ends)]
    return int(((p - q) ** 2 // (p + q) * np.diff(ends, prepend=0)).sum())


def pair_sums(blocks: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, a, b, value): the divergence of each two groups of a language that has kept terms, a before b."""
    listed = (groups.where("v > 0").groupBy(F.col("lang").alias("of_lang"), "v")
              .agg(F.sort_array(F.collect_list(F.struct("source", "n"))).alias("groups")))
    faced = (blocks.join(listed, (F.col("lang") == F.col("of_lang")) & (fresh(F.col("lang")) == fresh(F.col("of_lang"))))
             .select("lang", "v", "groups", "size", "sources", "ends", "counts"))

    def rows(sums):
        keys = list(sums)
        yield batch_of(lang=pa.array([k[0] for k in keys], pa.string()), a=pa.array([k[1] for k in keys], pa.string()),
                       b=pa.array([k[2] for k in keys], pa.string()), value=pa.array(list(sums.values()), pa.int64()))

    def work(batches):
        sums: dict[tuple[str, str, str], int] = {}
        for batch in batches:
            for row in batch.to_pylist():
                found = {s: (np.array(e, np.int64), np.array(c, np.int64)) for s, e, c in zip(row["sources"], row["ends"], row["counts"])}
                absent = np.array([row["size"]], np.int64), np.zeros(1, np.int64)
                columns = []
                for g in row["groups"]:
                    ends, counts = found.get(g["source"], absent)
                    columns.append((g["source"], (ends, shares(counts, g["n"], row["v"]))))
                for i, (name, column) in enumerate(columns):
                    for other, its in columns[i + 1:]:
                        key = row["lang"], name, other
                        sums[key] = sums.get(key, 0) + intersected(column, its)
                    if len(sums) > TASK_PAIRS:
                        yield from rows(sums)
                        sums = {}
        yield from rows(sums)

    return arrow_map(faced, work, "lang string, a string, b string, value long").groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def divergences(docs: DataFrame, min_docs: int = 10, top: int = 10, lang_col: str = "lang", source_col: str = "source",
                text_col: str = "text") -> DataFrame:
    """(lang, source, part, item, value, rank) of each (language, source) group.

    Part ``pair``: every other source of the language with the divergence. Part ``term``: the ``top`` kept terms that the group has
    and uses more than its language, by what each adds to the divergence from the language. Ranks go by value, largest first, then item.
    """
    terms = stage(kept_terms(term_counts(docs, lang_col, source_col, text_col), min_docs))
    sizes = terms.select("lang", F.inline("held")).groupBy("lang", "source").agg(F.sum("count").alias("n"))
    vocabulary = terms.groupBy("lang").agg(F.count("*").alias("v"), F.sum("total").alias("n_lang"))
    occurring = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name) for c, name in ((lang_col, "lang"), (source_col, "source"))]).distinct()
    groups = stage(occurring.join(sizes, ["lang", "source"], "left").join(vocabulary, "lang", "left").na.fill(0, ["n", "v", "n_lang"]))

    sums = pair_sums(encoded(terms), groups)
    none = groups.where("v = 0").select("lang", F.col("source").alias("a"))
    none = none.join(none.withColumnRenamed("a", "b"), "lang").where("a <> b").select("lang", "a", "b", F.lit(0).cast("long").alias("value"))
    pairs = sums.union(sums.select("lang", "b", "a", "value")).union(none).toDF("lang", "source", "item", "value")

    wide = terms.select("lang", F.col("term").alias("item"), "total", F.inline("held"))
    facts = groups.select(F.col("lang").alias("of_lang"), F.col("source").alias("of_source"), "n", "v", "n_lang")
    used = (wide.join(facts, (F.col("lang") == F.col("of_lang")) & (F.col("source") == F.col("of_source"))
                      & (fresh(F.col("lang"), F.col("source")) == fresh(F.col("of_lang"), F.col("of_source"))))
            .select("lang", "source", "item", share(F.col("count"), F.col("n"), F.col("v")).alias("p"), share(F.col("total"), F.col("n_lang"), F.col("v")).alias("q"))
            .where("p > q").select("lang", "source", "item", difference(F.col("p"), F.col("q")).alias("value")))

    nth = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    # the limit on the rank is applied in each task before rows of a group meet
    best = used.withColumns({"rank": nth, "part": F.lit("term")}).where(F.col("rank") <= top)
    return pairs.withColumns({"rank": nth, "part": F.lit("pair")}).select(*columns).union(best.select(*columns))
