"""Line deduplication over levelled sorted runs of line hashes.

A line's key is the line without ASCII blanks at both ends, A-Z lowered. Keys of at least ``min_chars`` code points in
at least ``min_docs`` documents lose all their lines except those of the largest document id that holds them.

Documents come in batches of descending id. A batch becomes one run: a table of (key hash, documents, largest id),
sorted by hash. ``LineRuns`` keeps the runs in levels; ``fanout`` runs of a level are merged into one of the next. A new
batch is anti-joined with the keys that the runs have settled (enough documents; as ids descend, their largest holder
is known too), and only what is left becomes its own run. So frequent lines stop adding to the runs, and a key never
has more than one row per run.

Defined results: a NULL or empty text is one empty line and stays as it is ('' for NULL). Rows that repeat an id count
as documents of their own, and share their fate as the largest holder. A NULL id ranks below every id; if only rows
without id hold a key, they keep it. An input column named like a result column is replaced.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.llm.common import arrow_map, batch_of, unused, widened, without
from rollbook.sources.tables import stage

BLANKS = b" \t\n\v\f\r"
KEY = ("key_hi", "key_lo")


def line_keys(text: bytes, min_chars: int) -> list[bytes | None]:
    """128-bit key hash of each line, None for lines too short to count."""
    found: list[bytes | None] = []
    for line in text.lower().split(b"\n"):  # bytes.lower() lowers A-Z alone
        line = line.strip(BLANKS)
        # at most four bytes a code point: only the lines in between need counting
        enough = len(line) >= min_chars and (len(line) >= 4 * min_chars or len(line.decode("utf-8", "replace")) >= min_chars)
        found.append(xxhash.xxh3_128_digest(line) if enough else None)
    return found


def _halves(keys: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    pairs = np.frombuffer(b"".join(keys), dtype=">i8").reshape(-1, 2).astype(np.int64)
    return pairs[:, 0], pairs[:, 1]


def line_table(docs: DataFrame, min_chars: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row (doc, key_hi, key_lo) per document and distinct long line."""
    def work(batches):
        for batch in batches:
            ids, keys, counts = batch.column(0).to_pylist(), [], []
            for text in batch.column(1).to_pylist():
                own = {k for k in line_keys((text or "").encode(), min_chars) if k}
                keys.extend(own)
                counts.append(len(own))
            hi, lo = _halves(keys)
            owner = np.repeat(np.arange(len(ids)), counts)
            yield batch_of(doc=pa.array(ids, pa.int64()).take(pa.array(owner)), key_hi=pa.array(hi), key_lo=pa.array(lo))
    return arrow_map(docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")), work,
                     "doc long, key_hi long, key_lo long")


class LineRuns:
    """Sorted runs of (key_hi, key_lo, n_docs, last_doc), each a table in the shared folder, in levels of ``fanout``."""

    def __init__(self, fanout: int = 3) -> None:
        self.fanout, self.levels = fanout, [[]]

    def merged(self) -> DataFrame | None:
        """One row per key over all runs."""
        runs = [run for level in self.levels for run in level]
        if not runs:
            return None
        union = runs[0]
        for run in runs[1:]:
            union = union.union(run)
        return union if len(runs) == 1 else _combine(union)

    def add(self, run: DataFrame) -> None:
        """Write a run (one row per key) to the lowest level, and compact each level that is full."""
        self.levels[0].append(stage(run.sortWithinPartitions(*KEY)))
        for i, level in enumerate(self.levels):
            if len(level) < self.fanout:
                break
            union = level[0]
            for other in level[1:]:
                union = union.union(other)
            if i + 1 == len(self.levels):
                self.levels.append([])
            self.levels[i + 1].append(stage(_combine(union).sortWithinPartitions(*KEY)))
            self.levels[i] = []


def _combine(runs: DataFrame) -> DataFrame:
    return runs.groupBy(*KEY).agg(F.sum("n_docs").alias("n_docs"), F.max("last_doc").alias("last_doc"))


def frequent_lines(lines: DataFrame, min_docs: int, batches: int = 4, fanout: int = 3) -> tuple[DataFrame, DataFrame]:
    """The staged lines, and (key_hi, key_lo, last_doc) of the keys in at least ``min_docs`` documents, from the runs of all batches."""
    cuts = lines.agg(F.percentile_approx("doc", [i / batches for i in range(1, batches)], 1000)).head()[0] or []
    cuts = sorted(set(cuts))
    nth = sum([(F.col("doc") > c).cast("int") for c in cuts], F.lit(0))
    lines = stage(lines.withColumn("batch", F.coalesce(nth, F.lit(0))), partition_by="batch")
    runs = LineRuns(fanout)
    for i in range(len(cuts), -1, -1):  # largest ids first
        own = (lines.where(F.col("batch") == i).groupBy(*KEY)
               .agg(F.count("*").alias("n_docs"), F.max("doc").alias("last_doc")))
        before = runs.merged()
        if before is not None:
            settled = before.where((F.col("n_docs") >= min_docs) & F.col("last_doc").isNotNull()).select(*KEY)
            own = own.join(settled.hint("merge"), list(KEY), "left_anti")
        runs.add(own)
    return lines, runs.merged().where(F.col("n_docs") >= min_docs).select(*KEY, "last_doc")


def dedup_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5, batches: int = 4, fanout: int = 3,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with ``text`` cut to the kept lines, and n_lines and n_dropped added."""
    lines, frequent = frequent_lines(line_table(docs, min_chars, id_col, text_col), min_docs, batches, fanout)
    # both sides are shuffled for this join alone, so that a line found everywhere can be split by AQE
    drops = (lines.join(stage(frequent), list(KEY)).where(F.coalesce(F.col("doc") < F.col("last_doc"), F.col("last_doc").isNotNull()))
             .groupBy("doc").agg(F.collect_set(F.struct(*KEY)).alias("own_drop_keys")))
    docs = without(docs.withColumn(text_col, F.col(text_col).cast("string")), "n_lines", "n_dropped")
    out = docs.columns
    at = out.index(text_col)
    doc, gone = unused(docs, "drop_doc"), unused(docs, "own_drop_keys")
    joined = docs.join(drops.toDF(doc, gone).hint("shuffle_hash"), F.col(id_col).cast("long").eqNullSafe(F.col(doc)), "left").select(*[f"`{c}`" for c in out], gone)

    def work(arrow):
        for batch in arrow:
            kept, n_lines, n_dropped = [], [], []
            for text, drop in zip(batch.column(at).to_pylist(), batch.column(len(out)).to_pylist()):
                lines = (text or "").split("\n")
                n_lines.append(len(lines))
                if drop:
                    gone = set(np.array([[d["key_hi"], d["key_lo"]] for d in drop], dtype=">i8").view("V16").ravel().tolist())
                    lines = [t for t, k in zip(lines, line_keys((text or "").encode(), min_chars)) if k is None or k not in gone]
                n_dropped.append(n_lines[-1] - len(lines))
                kept.append("\n".join(lines) if drop else text or "")
            columns = batch.columns[:len(out)]
            columns[at] = pa.array(kept, columns[at].type)
            yield pa.RecordBatch.from_arrays([*columns, pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())],
                                             names=[*out, "n_lines", "n_dropped"])

    return arrow_map(joined, work, widened(docs, "n_lines long, n_dropped long"))
