"""Near-duplicate documents by b-bit MinHash.

A document's set is its distinct shingles of ``size`` words (A-Z lowered, words apart at ASCII blanks); with fewer words
the whole sequence is one shingle. Of each of 160 minima two bits are kept, packed into five longs. Bands of five full
minima bring candidates together; the share of equal two-bit fields, corrected for fields that are equal by chance,
estimates their similarity, and candidates that may reach the threshold are confirmed on the full sets. At a similarity
of 0.8, bands miss a pair with probability 3e-6, and the estimate (0.22 of slack, over five deviations) below 1e-7.

Documents of one set are one class from the start, so copies never meet. A band with many classes is not paired up
either: first each class is compared with the band's pivot, the class that meets most others (the text that edited copies have
in common), and linked classes become components; then only classes outside the pivot's component are compared with the
rest of the band. Pairs within a component can add nothing, so no link between different texts is lost. What is left
is estimated once more, in the first band a pair shares, from 2048 minima of two bits each (0.055 of slack, five deviations).

Defined results: NULL or empty texts, and texts without words, have an empty set and are linked with nothing. Rows with
equal sets are linked whatever their id, so repeated rows share a component; all rows with the kept id stay. A NULL id is never a
component's name unless no member has one, and such a row is kept only then. An input column named like a result column
is replaced.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.llm.common import arrow_map, batch_of, set_aside, widened, without
from rollbook.llm.components import components
from rollbook.llm.hashing import Words, windows
from rollbook.sources.tables import stage

BANDS, ROWS = 32, 5
HASHES = BANDS * ROWS
SLACK = 0.22
#: The longer sketch of classes that the pivots leave over.
MORE_HASHES, MORE_SLACK = 2048, 0.055
_rng = np.random.default_rng(20)
_A = _rng.integers(1, 1 << 63, HASHES + MORE_HASHES, dtype=np.uint64) | np.uint64(1)
_B = _rng.integers(0, 1 << 63, HASHES + MORE_HASHES, dtype=np.uint64)


def shingles(text: str | None, size: int, words: Words) -> np.ndarray:
    """Sorted distinct hashes of the shingles."""
    found = (text or "").encode("utf-8", "replace").lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    hashes = words.array(found)
    return np.unique(windows(hashes, size)) if len(found) >= size else windows(hashes, len(found))


def minima(hashes: np.ndarray, which: slice = slice(0, HASHES)) -> np.ndarray:
    a, b = _A[which], _B[which]
    least = np.full(len(a), np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(hashes), 512):
        np.minimum(least, (hashes[i:i + 512, None] * a + b).min(axis=0), out=least)
    return least


def packed(least: np.ndarray) -> np.ndarray:
    """Two bits of each minimum (bits 20 and 21, as the low ones of a linear hash mix little) in longs of 32."""
    bits = ((least >> np.uint64(20)) & np.uint64(3)).reshape(-1, 32)
    return (bits << (np.arange(32, dtype=np.uint64) * np.uint64(2))).sum(axis=1, dtype=np.uint64).view(np.int64)


def signatures(docs: DataFrame, size: int, text_col: str) -> DataFrame:
    """The documents with set_node (hash of the set; NULL if empty), n_shingles, sketch and bands added."""
    docs = without(docs, "set_node", "n_shingles", "sketch", "bands")
    out = docs.columns
    at = out.index(text_col)

    def work(batches):
        words = Words()
        for batch in batches:
            nodes, counts, sketches, bands = [], [], [], []
            for text in batch.column(at).to_pylist():
                own = shingles(text, size, words)
                counts.append(len(own))
                if not len(own):
                    nodes.append(None)
                    sketches.append(None)
                    bands.append(None)
                    continue
                least = minima(own)
                nodes.append(xxhash.xxh3_64_intdigest(own.tobytes()) - (1 << 63))
                sketches.append(packed(least).tolist())
                raw = least.tobytes()
                bands.append([xxhash.xxh3_64_intdigest(raw[8 * ROWS * b:8 * ROWS * (b + 1)], seed=b) - (1 << 63) for b in range(BANDS)])
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(nodes, pa.int64()), pa.array(counts, pa.int64()), pa.array(sketches, longs), pa.array(bands, longs)],
                names=[*out, "set_node", "n_shingles", "sketch", "bands"])

    return arrow_map(docs, work, widened(docs, "set_node long, n_shingles long, sketch array<long>, bands array<long>"))


def estimate(a: str, b: str, hashes: int = HASHES):
    """Similarity from the packed bits: the share of equal fields, less those equal by chance."""
    differing = sum((F.bit_count((x := F.element_at(a, i).bitwiseXOR(F.element_at(b, i)))
                                 .bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(0x5555555555555555)))
                     for i in range(1, hashes // 32 + 1)), F.lit(0))
    return (1 - differing / hashes - 0.25) / 0.75


def _may_link(percent: int):
    return ((100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
            & (estimate("sketch_a", "sketch_b") >= percent / 100 - SLACK))


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough, as edges (u, v)."""
    both = (pairs.select("a", "b").distinct()
            .join(sets.select(F.col("node").alias("b"), F.col("members").alias("set_b")), "b")
            .join(sets.select(F.col("node").alias("a"), F.col("members").alias("set_a")), "a").select("a", "b", "set_a", "set_b"))

    def work(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                common = int(np.isin(x, y, assume_unique=True, kind="sort").sum())
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            mask = pa.array(keep, pa.bool_())
            yield batch_of(u=batch.column(0).filter(mask), v=batch.column(1).filter(mask))

    return arrow_map(both, work, "u long, v long")


def _sets(signed: DataFrame, nodes: DataFrame, size: int, id_col: str, text_col: str) -> DataFrame:
    """(node, members) of the given (node, least_id), from the document with that id: of many copies one is read."""
    texts = (signed.join(nodes, (F.col("set_node") == F.col("node")) & F.col(id_col).eqNullSafe(F.col("least_id")), "left_semi")
             .select(F.col("set_node").alias("node"), F.col(text_col).alias("text")))

    def work(batches):
        words = Words()
        for batch in batches:
            yield batch_of(node=batch.column(0), members=pa.array([shingles(t, size, words).tobytes() for t in batch.column(1).to_pylist()], pa.binary()))

    return arrow_map(texts, work, "node long, members binary").dropDuplicates(["node"])


def _more_sketches(sets: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, more): the longer sketch."""
    which = slice(HASHES, HASHES + MORE_HASHES)

    def work(batches):
        for batch in batches:
            rows = [packed(minima(np.frombuffer(m.as_buffer(), np.uint64), which)).tolist() for m in batch.column(1)]
            yield batch_of(node=batch.column(0), more=pa.array(rows, pa.list_(pa.int64())))

    return arrow_map(sets.join(nodes, "node", "left_semi").select("node", "members"), work, "node long, more array<long>")


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """The documents with n_shingles, component_id and kept added.

    Documents whose sets have 100 * common >= percent * union are linked; component_id is the least id reachable. The bands are laid
    out for 80 percent or more; less is refused, as they would lose links.
    """
    if percent < 80:
        raise ValueError(f"{percent} percent: the bands find links of 80 percent or more")
    whole = without(docs, "n_shingles", "component_id", "kept")
    docs, _ = set_aside(whole, id_col, text_col)
    signed = stage(signatures(docs, size, text_col))
    classes = stage(signed.where("set_node IS NOT NULL").groupBy(F.col("set_node").alias("node"))
                    .agg(F.min(id_col).alias("least_id"), F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch"),
                         F.first("bands").alias("bands")))
    spread = classes.select("node", F.explode("bands").alias("band"))
    shared = spread.groupBy("band").agg(F.count("*").alias("n")).where("n > 1")
    met = stage(spread.join(shared.hint("merge"), "band"))  # the bands in which classes meet
    degrees = met.groupBy("node").agg(F.sum("n").alias("degree"))
    pivots = met.join(degrees, "node").groupBy("band").agg(F.max_by("node", F.struct("degree", "node")).alias("pivot"))
    placed = stage(met.select("band", "node").join(pivots.hint("merge"), "band"))
    chosen = classes.join(met.select("node").distinct(), "node", "left_semi").select("node", "least_id")
    sets = stage(_sets(signed, chosen, size, id_col, text_col))
    facts = classes.select("node", "n", "sketch")

    star = placed.select(F.col("node").alias("a"), F.col("pivot").alias("b")).where("a <> b").distinct()
    faced = (star.join(facts.toDF("a", "n_a", "sketch_a"), "a").join(facts.toDF("b", "n_b", "sketch_b"), "b")
             .where(_may_link(percent)))
    edges = stage(_confirmed(faced, sets, percent))
    roots = components(edges)

    parts = (placed.join(roots.withColumnRenamed("u", "node"), "node", "left")
             .select("band", "node", F.coalesce("root", "node").alias("part"), "pivot"))
    heads = parts.where("node = pivot").select("band", F.col("part").alias("main"))
    sided = stage(parts.join(heads, "band").withColumn("minor", F.col("part") != F.col("main")))
    open_bands = sided.where("minor").select("band").distinct()
    rest = stage(sided.join(open_bands, "band", "left_semi").select("band", "node", "part", "minor"))
    more = (stage(_more_sketches(sets, rest.select("node").distinct()))
            .join(classes.select("node", "n", "sketch", "bands"), "node"))
    full = rest.join(more, "node")
    a = full.where("minor").select("band", *[F.col(c).alias(f"{c}_a") for c in ("node", "part", "n", "sketch", "bands", "more")])
    b = full.select(F.col("band").alias("band_b"), *[F.col(c).alias(f"{c}_b") for c in ("node", "part", "minor", "n", "sketch", "bands", "more")])
    left = a.join(b, (F.col("band") == F.col("band_b")) & (F.col("part_a") != F.col("part_b"))
                  & (~F.col("minor_b") | (F.col("node_a") < F.col("node_b"))) & _may_link(percent)
                  & (estimate("more_a", "more_b", MORE_HASHES) >= percent / 100 - MORE_SLACK)
                  & (F.element_at(F.array_intersect("bands_a", "bands_b"), 1) == F.col("band")))
    left = left.select(F.col("node_a").alias("a"), F.col("node_b").alias("b"))
    more = stage(_confirmed(left, sets, percent))
    if not more.isEmpty():
        roots = components(edges.union(more))

    named = classes.join(roots.withColumnRenamed("u", "node"), "node", "left").select("node", F.coalesce("root", "node").alias("root"), "least_id")
    names = named.groupBy("root").agg(F.min("least_id").alias("component_id"))
    final = named.join(names, "root").select(F.col("node").alias("set_node"), "component_id")
    component = F.when(F.col("set_node").isNull(), F.col(id_col)).otherwise(F.col("component_id"))
    result = (signed.select(id_col, text_col, "set_aside", "set_node", "n_shingles").join(final, "set_node", "left")
              .withColumn("component_id", component)
              .withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.col("component_id").isNull())))
    added = ["n_shingles", "component_id", "kept"]
    kept_as = [F.col(f"`{c}`") if c in (id_col, text_col) else F.col(f"set_aside.`{c}`").alias(c) for c in whole.columns]
    return result.select(*kept_as, *added)
