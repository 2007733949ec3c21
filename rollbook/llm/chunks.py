"""Documents packed into chunks, and the exchange that tells chunks which of their keys occur elsewhere.

A chunk is one row with the texts of some documents, compressed; it is written once, so its number stays the same for
all later steps. ``repeated_codes`` and ``repeated_keys`` deal the distinct keys of each chunk out to buckets by the key,
compare them there, and answer each chunk with one bit per key. A key that occurs in every document is sent once per
chunk, so no bucket grows with the number of its occurrences; the number of buckets grows with the number of keys.
"""
from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.llm.common import arrow_map, batch_of
from rollbook.sources.tables import stage

#: Bytes of text in a chunk (more if one document is longer), and keys in a bucket on average.
CHUNK_BYTES = 4 << 20
BUCKET_KEYS = 1 << 21
#: Ranks of documents without id: after all others.
NO_ID = (1 << 63) - 1
CODE_BITS = 28


def squeeze(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(data)


def expand(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def pack(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Staged (chunk, ids, sizes, marks, raw): ids with NO_ID for NULL, bytes and 128-bit hash of each text, the texts."""
    def work(batches):
        part, nth = TaskContext.get().partitionId(), 0
        ids, texts, size = [], [], 0

        def chunk():
            marks = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, texts)), ">i8").astype(np.int64)
            longs = pa.list_(pa.int64())
            return batch_of(chunk=pa.array([part << 32 | nth], pa.int64()), ids=pa.array([ids], longs),
                            sizes=pa.array([[len(t) for t in texts]], longs), marks=pa.array([marks.tolist()], longs),
                            raw=pa.array([squeeze(b"".join(texts))], pa.binary()))

        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids.append(NO_ID if i is None else i)
                texts.append((text or "").encode("utf-8", "replace"))
                size += len(texts[-1])
                if size >= CHUNK_BYTES:
                    yield chunk()
                    ids, texts, size, nth = [], [], 0, nth + 1
        if ids:
            yield chunk()

    return stage(arrow_map(docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")), work,
                           "chunk long, ids array<long>, sizes array<long>, marks array<long>, raw binary"))


def texts_of(raw: bytes, sizes: np.ndarray) -> list[bytes]:
    data, ends = expand(raw), np.cumsum(sizes)
    return [data[e - n:e] for e, n in zip(ends.tolist(), sizes.tolist())]


def copies(chunks: DataFrame) -> DataFrame:
    """(chunk, gone): places in a chunk of the texts that a document with a smaller id has too."""
    pairs = F.transform(F.sequence(F.lit(1), F.size("ids")), lambda i: F.struct(
        i.alias("nth"), F.element_at("ids", i).alias("id"), F.element_at("marks", 2 * i - 1).alias("hi"), F.element_at("marks", 2 * i).alias("lo")))
    each = chunks.select("chunk", F.inline(pairs))
    first = each.groupBy("hi", "lo").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first < last").drop("last")
    return each.join(stage(first), ["hi", "lo"]).where("id > first").groupBy("chunk").agg(F.collect_list(F.col("nth") - 1).alias("gone"))


def encode_codes(codes: np.ndarray) -> bytes:
    """Sorted distinct 28-bit codes as 16-bit gaps; a gap of 65535 only adds up."""
    gaps = np.diff(codes.astype(np.int64), prepend=0)
    more = gaps // 65535
    out = np.full(len(gaps) + int(more.sum()), 65535, np.uint16)
    out[np.arange(len(gaps)) + np.cumsum(more)] = gaps % 65535
    return out.tobytes()


def decode_codes(blob: bytes) -> np.ndarray:
    gaps = np.frombuffer(blob, np.uint16)
    return np.cumsum(gaps, dtype=np.int64)[gaps != 65535]


def bits(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes()


def flags_of(blob: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(blob, np.uint8), count=n).view(bool)


def bucket_count(total: int, each: int = BUCKET_KEYS) -> int:
    return max(1, -(-total // each))


def coded(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket and 28-bit code of each hash in one number."""
    code = hashes & np.uint64((1 << CODE_BITS) - 1)
    return (((hashes >> np.uint64(CODE_BITS)) % np.uint64(buckets)) << np.uint64(CODE_BITS)) | code


def among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which values are in a sorted array."""
    if not len(known):
        return np.zeros(len(values), bool)
    at = np.searchsorted(known, values)
    at[at == len(known)] = 0
    return known[at] == values


def split_by_bucket(sorted_codes: np.ndarray) -> list[tuple[int, int, int]]:
    """(bucket, from, to) of each bucket in a sorted array of coded hashes."""
    if not len(sorted_codes):
        return []
    owner = (sorted_codes >> np.uint64(CODE_BITS)).astype(np.int64)
    starts = np.flatnonzero(np.diff(owner, prepend=-1))
    return [(int(owner[a]), int(a), int(b)) for a, b in zip(starts, np.append(starts[1:], len(owner)))]


def counted(per_part: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values over the parts, sorted, and whether more than one part has them (parts are distinct each)."""
    values = np.sort(np.concatenate(per_part)) if per_part else np.zeros(0, np.uint64)
    new = np.append(True, values[1:] != values[:-1]) if len(values) else np.zeros(0, bool)
    starts = np.flatnonzero(new)
    return values[starts], np.diff(np.append(starts, len(values))) > 1


def repeated_codes(chunks: DataFrame, codes: Callable[[dict], tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    """(chunk, answers array<struct<bucket, bits>>): which codes of a chunk occur more than once.

    ``codes(row)`` gives the sorted distinct coded hashes of a chunk row and whether it has them more than once. Codes
    are 28 bits within a bucket of about two million keys, so below one key in a hundred is taken for repeated that is not:
    this is a filter, and loses nothing.
    """
    def send(batches):
        for batch in batches:
            for row in batch.to_pylist():
                values, many = codes(row)
                parts = split_by_bucket(values)
                own = [values[a:b] & np.uint64((1 << CODE_BITS) - 1) for _, a, b in parts]
                yield batch_of(bucket=pa.array([p[0] for p in parts], pa.int64()), chunk=pa.array([row["chunk"]] * len(parts), pa.int64()),
                               codes=pa.array([encode_codes(c) for c in own], pa.binary()),
                               many=pa.array([bits(many[a:b]) for _, a, b in parts], pa.binary()))

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        own = [decode_codes(c) for c in group["codes"]]
        values, shared = counted(own)
        flagged = [c[flags_of(m, len(c))] for c, m in zip(own, group["many"])]
        shared = np.union1d(values[shared], np.concatenate(flagged))
        return pd.DataFrame({"bucket": group["bucket"], "chunk": group["chunk"], "bits": [bits(among(c, shared)) for c in own]})

    sent = arrow_map(chunks, send, "bucket long, chunk long, codes binary, many binary")
    return _by_chunk(sent.groupBy("bucket").applyInPandas(compare, "bucket long, chunk long, bits binary"), "bits")


def _by_chunk(answers: DataFrame, *columns: str) -> DataFrame:
    return answers.groupBy("chunk").agg(F.collect_list(F.struct("bucket", *columns)).alias("answers"))


def answered(values: np.ndarray, answers: list[dict] | None, column: str = "bits") -> np.ndarray:
    """The answer for each of a chunk's sorted coded hashes."""
    found = np.zeros(len(values), bool)
    by_bucket = {a["bucket"]: a[column] for a in answers or []}
    for bucket, a, b in split_by_bucket(values):
        if bucket in by_bucket:
            found[a:b] = flags_of(by_bucket[bucket], b - a)
    return found
