"""Near-duplicate documents by SimHash, compared bit-sliced.

A document's words are apart at ASCII blanks, A-Z lowered; each shingle of ``size`` words, repeats included, is hashed by XXH64
(seed 42), and a bit of the fingerprint is 1 if it is set in over half the hashes. Fingerprints link at ``radius`` or fewer
differing bits; component_id is the least id reachable.

Equal fingerprints are one class from the start. The 64 bits are cut into blocks, radius + 1 or more; two fingerprints within the
radius agree on all but ``radius`` of them, so each choice of the others is a table of keys, and every link lies in a bucket of a table.
The blocks, and how many bits of a key are used, follow from the number of fingerprints, so that a bucket holds about
``LANES`` at every size. A larger bucket is split by the whole key, and a bucket still too large into parts of bounded size; each two
parts of it meet in a row of their own, so a large group of near copies is compared in full, spread over the cluster.

In a bucket, bit planes are stored vertically: word w of plane j has bit j of 64 fingerprints. A block of fingerprints is XORed with
the planes, two planes at a time go through a carry-save adder into the low bits of 64 counters a word, whose overflow is kept: it says
that the radius is exceeded. Fingerprints for which all counters have overflowed leave the block, and a block without any is
abandoned. Of the links found, a spanning forest leaves the task, so rows grow with the fingerprints and not with their pairs.

Defined results: fewer words than ``size`` are one shingle; NULL or empty texts and those without words have the fingerprint zero, linked
like any other. Repeated rows share a component. A NULL id is never a component's name unless no member has an id. An empty table gives
no rows. Extra columns are not carried along.
"""
from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook.llm.common import arrow_map, batch_of
from rollbook.llm.components import components
from rollbook.operators.joins import fresh
from rollbook.sources.tables import stage

SIZE, RADIUS, SEED = 3, 3, 42
#: Fingerprints aimed at in a bucket, and the largest part of a bucket that is compared at once (on average half of it).
LANES, MOST_LANES = 1024, 4096
#: Shingles hashed before their bits are counted, and fingerprints compared with all lanes at once.
SHINGLES, QUERIES = 1 << 16, 256
_FULL = np.uint64(0xFFFFFFFFFFFFFFFF)


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each bit set, bit 0 first."""
    return np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)


def fingerprint(text: bytes, size: int = SIZE) -> int:
    words = text.lower().split()  # bytes: A-Z and ASCII blanks alone
    if not words:
        return 0
    size = min(size, len(words))
    joined, n = b" ".join(words), len(words) - size + 1
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.append(0, ends[:-1] + 1)[:n].tolist()
    ends = ends[size - 1:].tolist()
    digest, counts = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, n, SHINGLES):
        part = zip(starts[at:at + SHINGLES], ends[at:at + SHINGLES])
        counts += bit_counts(np.array([digest(joined[a:b], SEED) for a, b in part], "<u8"))
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, size: int = SIZE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, bits): the fingerprint of each row as a long."""
    def work(batches):
        for batch in batches:
            found = [fingerprint(t.as_py() or b"", size) for t in batch.column(1).cast(pa.binary())]
            yield batch_of(id=batch.column(0), bits=pa.array(np.array(found, np.uint64).view(np.int64)))

    return arrow_map(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")), work, "id long, bits long")


def planes_of(values: np.ndarray) -> np.ndarray:
    """The bit planes (64, words): lane i is bit i % 64 of word i // 64."""
    lanes = -(-len(values) // 64) * 64
    bits = np.zeros((lanes, 64), np.uint8)
    bits[:len(values)] = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view(np.uint64)


def _lanes_below(limits: np.ndarray, words: int) -> np.ndarray:
    """(len(limits), words): the lanes below each limit set."""
    left = np.clip(limits[:, None] - 64 * np.arange(words)[None, :], 0, 64)
    return np.where(left == 64, _FULL, (np.uint64(1) << (left % 64).astype(np.uint64)) - np.uint64(1))


def within(queries: np.ndarray, planes: np.ndarray, over: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows, hits): the queries with a lane at ``radius`` or fewer bits, and those lanes as bits.

    ``over`` (queries, words) has the lanes set that are out of question; it is used up.
    """
    size = radius.bit_length()  # counters overflow at 2 ** size
    rows = np.arange(len(queries))
    begin = (1 << size) - 1 - radius  # so that a count over the radius overflows
    counters = [np.full(over.shape, _FULL if begin >> i & 1 else 0, np.uint64) for i in range(size)]
    for j in range(0, 64, 2):
        if j % 8 == 0 and j:
            alive = (over != _FULL).any(axis=1)
            if not alive.any():  # all lanes exceed the radius: the block is abandoned
                return rows[:0], over[:0]
            if alive.mean() < 0.75:
                rows, queries, over, counters = rows[alive], queries[alive], over[alive], [c[alive] for c in counters]
        first, second = (planes[i] ^ (np.uint64(0) - (queries >> np.uint64(i) & np.uint64(1)))[:, None] for i in (j, j + 1))
        if not size:
            over |= first | second
            continue
        # carry-save adder: counter bit 0 and two new bits give one bit and one carry
        half = counters[0] ^ first
        carry = (counters[0] & first) | (half & second)
        counters[0] = half ^ second
        for i in range(1, size):
            counters[i], carry = counters[i] ^ carry, counters[i] & carry
        over |= carry
    hits = ~over
    alive = hits.any(axis=1)
    return rows[alive], hits[alive]


def _merge(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Join the trees of each i and j; ``label`` gives each member's root, the least of its tree."""
    while True:
        a, b = label[i], label[j]
        apart = a != b
        if not apart.any():
            return
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while (label[label] != label).any():
            label[:] = label[label]


def forest(parts: list[np.ndarray], radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest (u, v) of the links within one part, or between two parts of a bucket."""
    lanes = parts[-1]
    values = lanes if len(parts) == 1 else np.concatenate(parts)
    offset = len(values) - len(lanes)
    label, planes = np.arange(len(values)), planes_of(lanes)
    words = planes.shape[1]
    padding = ~_lanes_below(np.array([len(lanes)]), words)
    for at in range(0, len(parts[0]), QUERIES):
        queries = parts[0][at:at + QUERIES]
        nth = np.arange(at, at + len(queries))
        # within one part each two meet once: lanes up to a query's own are out of question
        over = padding | (_lanes_below(nth + 1, words) if len(parts) == 1 else np.zeros((len(queries), words), np.uint64))
        rows, hits = within(queries, planes, over, radius)
        if len(rows):
            row, lane = np.nonzero(np.unpackbits(hits.view(np.uint8), axis=1, bitorder="little"))
            _merge(label, at + rows[row], offset + lane)
    member = np.flatnonzero(label != np.arange(len(label)))
    return values[member], values[label[member]]


def tables(n: int, radius: int = RADIUS) -> tuple[list[list[tuple[int, int]]], int]:
    """For n fingerprints: per table the (first bit, bits) of the blocks that make its key, and the key bits of a bucket."""
    wanted = max(0, (max(n, 1) // LANES).bit_length() - 1)
    for blocks in range(radius + 1, 64):
        cuts = [64 * i // blocks for i in range(blocks + 1)]
        chosen = [[(cuts[i], cuts[i + 1] - cuts[i]) for i in c] for c in combinations(range(blocks), blocks - radius)]
        most = min(sum(bits for _, bits in c) for c in chosen)
        if most >= wanted:
            break
    return chosen, min(wanted, most)


def _spread(classes: DataFrame, keys: list[list[tuple[int, int]]], coarse_bits: int) -> DataFrame:
    """(t, coarse, fine, bits): each fingerprint in each table, with the used bits of its key and the whole key."""
    def key(blocks: list[tuple[int, int]]) -> tuple[Column, int]:
        whole, width = F.lit(0).cast("long"), 0
        for first, bits in blocks:
            whole = F.shiftleft(whole, bits).bitwiseOR(F.shiftrightunsigned("bits", first).bitwiseAND(F.lit((1 << bits) - 1)))
            width += bits
        return whole, width
    each = []
    for t, blocks in enumerate(keys):
        whole, width = key(blocks)
        each.append(F.struct(F.lit(t).alias("t"), F.shiftrightunsigned(whole, width - coarse_bits).alias("coarse"), whole.alias("fine")))
    return classes.select("bits", F.inline(F.array(*each)))


def buckets(classes: DataFrame, n: int, radius: int = RADIUS) -> DataFrame:
    """(parts): rows of one or two parts of a bucket, each an array of fingerprints; all links lie within a row."""
    keys, coarse_bits = tables(n, radius)
    spread = _spread(classes, keys, coarse_bits)
    fine = stage(spread.groupBy("t", "coarse", "fine").agg(F.count("*").alias("n")))
    large = fine.groupBy(F.col("t").alias("lt"), F.col("coarse").alias("lc")).agg(F.sum("n").alias("m")).where(F.col("m") > MOST_LANES)
    large = (fine.join(large, (F.col("t") == F.col("lt")) & (F.col("coarse") == F.col("lc")) & (fresh(F.col("t"), F.col("coarse")) == fresh(F.col("lt"), F.col("lc"))))
             .select("lt", F.col("fine").alias("lf"), F.ceil(F.col("n") / (MOST_LANES // 2)).alias("n_parts")))
    placed = spread.join(large, (F.col("t") == F.col("lt")) & (F.col("fine") == F.col("lf")) & (fresh(F.col("t"), F.col("fine")) == fresh(F.col("lt"), F.col("lf"))), "left")
    part = F.when(F.col("n_parts") > 1, F.pmod(F.xxhash64("bits", "t"), F.col("n_parts"))).otherwise(0)
    own = F.coalesce("lf", F.lit(-1)).alias("own")  # -1: the bucket is shared by all fine keys
    packed = stage(placed.groupBy("t", "coarse", own, part.alias("part"), F.coalesce("n_parts", F.lit(1)).alias("n_parts"))
                   .agg(F.collect_list("bits").alias("members")))
    alone = packed.where((F.size("members") > 1) | (F.col("n_parts") > 1)).select(F.array("members").alias("parts"))
    # each two parts of a split bucket: a part goes into as many rows as there are others
    facing = (packed.where("n_parts > 1").select("t", "coarse", "own", "part", "members", F.explode(F.sequence(F.lit(0), F.col("n_parts") - 1)).alias("other"))
              .where("other <> part").groupBy("t", "coarse", "own", F.least("part", "other").alias("a"), F.greatest("part", "other").alias("b"))
              .agg(F.collect_list("members").alias("parts")).where(F.size("parts") == 2).select("parts"))
    return alone.union(facing)


def links(rows: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(u, v): spanning forests of the links in each row of ``buckets``."""
    def work(batches):
        for batch in batches:
            for parts in batch.column(0):
                arrays = [p.values.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64) for p in parts]
                u, v = forest(arrays, radius)
                if len(u):
                    yield batch_of(u=pa.array(u.view(np.int64)), v=pa.array(v.view(np.int64)))

    return arrow_map(rows, work, "u long, v long")


def near_duplicates(docs: DataFrame, size: int = SIZE, radius: int = RADIUS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint, component_id, kept): the fingerprint as 16 hex digits; kept is true where the id names its component."""
    signed = stage(fingerprints(docs, size, id_col, text_col))
    classes = stage(signed.groupBy("bits").agg(F.min("id").alias("least_id")))
    edges = links(buckets(classes.select("bits"), classes.count(), radius), radius)
    roots = components(edges).withColumnRenamed("u", "bits")
    named = classes.join(roots, "bits", "left").select("bits", F.coalesce("root", "bits").alias("root"), "least_id")
    names = named.groupBy("root").agg(F.min("least_id").alias("component_id")).withColumnRenamed("root", "of_root")
    final = named.join(names, (F.col("root") == F.col("of_root")) & (fresh(F.col("root")) == fresh(F.col("of_root")))).select(F.col("bits").alias("of_bits"), "component_id")
    result = signed.join(final, (F.col("bits") == F.col("of_bits")) & (fresh(F.col("bits")) == fresh(F.col("of_bits"))), "left")
    return result.select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id",
                         F.coalesce(F.col("id") == F.col("component_id"), F.col("component_id").isNull()).alias("kept"))
