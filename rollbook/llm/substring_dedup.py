"""Repeated word sequences by level-wise doubling.

Level by level, windows are extended to twice their length, and only those repeated in another document at one length are
extended to the next: first windows of half the minimum length (a filter on all words), then of ``min_words``, and from
there doubled until no candidate survives. A window of the next level exists where both its halves (overlapping if the
length is not quite doubled) survived, and its key is made from their keys. Each word that a surviving window of
``min_words`` covers is removed if the same sequence also starts in a document with a smaller id. The longer levels
give, for each document, the greatest length at which it still repeats another text.

Exact copies of a document with a smaller id are removed whole beforehand (if they have ``min_words`` words), and take
no part in the levels. Keys are 64-bit hashes; beyond the filter, a window is wrongly taken for repeated with a
probability of about its level's number of windows over 2^64.

Defined results: words are apart at ASCII blanks and compared as they are. NULL and empty texts have no words. Rows that
repeat an id are documents with the same id: neither has the smaller one. Rows without id rank after all others and
among themselves remove nothing.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.llm import chunks as ch
from rollbook.llm.common import arrow_map, batch_of
from rollbook.llm.hashing import Words, extend, windows
from rollbook.sources.tables import release, stage

STATE = "chunk long, ids array<long>, n long, blob binary, spans binary, longest array<long>, gone array<long>"


def _window_codes(length: int, buckets: int):
    """Codes of all windows of a chunk, for the filter level."""
    words = Words()

    def codes(row):
        parts = []
        for text in ch.texts_of(row["raw"], np.array(row["sizes"], np.int64)):
            own = windows(words.array(text.split()), length)
            if len(own):
                parts.append(np.unique(ch.coded(own, buckets)))
        return ch.counted(parts)
    return codes


def _blob(doc: np.ndarray, pos: np.ndarray, key: np.ndarray) -> bytes:
    return ch.squeeze(doc.astype("<u4").tobytes() + pos.astype("<u4").tobytes() + key.astype("<u8").tobytes())


def _unblob(blob: bytes, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    raw = ch.expand(blob)
    return (np.frombuffer(raw, "<u4", n).astype(np.int64), np.frombuffer(raw, "<u4", n, 4 * n).astype(np.int64),
            np.frombuffer(raw, "<u8", n, 8 * n))


def _row(chunk, ids, doc, pos, key, spans, longest, gone) -> pa.RecordBatch:
    longs = pa.list_(pa.int64())
    return batch_of(chunk=pa.array([chunk], pa.int64()), ids=pa.array([ids], longs), n=pa.array([len(doc)], pa.int64()),
                    blob=pa.array([_blob(doc, pos, key)], pa.binary()), spans=pa.array([spans], pa.binary()),
                    longest=pa.array([longest], longs), gone=pa.array([gone], longs))


def _first_level(chunks: DataFrame, answers: DataFrame, gone: DataFrame, length: int, buckets: int) -> DataFrame:
    """State with the windows that passed the filter."""
    def work(batches):
        words = Words()
        for batch in batches:
            for row in batch.to_pylist():
                texts = ch.texts_of(row["raw"], np.array(row["sizes"], np.int64))
                copies = set(row["gone"] or [])
                keys = [windows(words.array(t.split()), length) for t in texts]
                coded = [ch.coded(k, buckets) for k in keys]
                values, _ = ch.counted([np.unique(c) for c in coded if len(c)])
                shared = values[ch.answered(values, row["answers"])]
                doc, pos, key = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
                for i, (k, c) in enumerate(zip(keys, coded)):
                    if i not in copies and len(k):
                        at = np.flatnonzero(ch.among(c, shared))
                        doc.append(np.full(len(at), i))
                        pos.append(at)
                        key.append(k[at])
                yield _row(row["chunk"], row["ids"], np.concatenate(doc), np.concatenate(pos), np.concatenate(key), b"",
                           [0] * len(texts), sorted(copies))

    joined = chunks.join(answers, "chunk", "left").join(gone, "chunk", "left")
    return stage(arrow_map(joined.select("chunk", "ids", "sizes", "raw", "answers", "gone"), work, STATE))


def _candidates(row: dict, length: int, to: int):
    """Windows of the next level: those whose two halves both survived."""
    doc, pos, key = _unblob(row["blob"], row["n"])
    if not len(doc):
        return doc, pos, key
    place = doc << 32 | pos  # ascending
    other = np.searchsorted(place, place + (to - length))
    other[other == len(place)] = 0
    both = place[other] == place + (to - length)
    pair = np.concatenate([key[both], key[other[both]]])
    return doc[both], pos[both], extend(pair, 1, 1 + int(both.sum())) if both.any() else key[:0]


def _level(state: DataFrame, length: int, to: int, judge: bool) -> DataFrame:
    """State after windows of length ``to`` were compared; with ``judge`` the words to remove are put down too."""
    buckets = ch.bucket_count(state.agg(F.sum("n")).head()[0] or 0)

    def keyed(row):
        doc, pos, key = _candidates(row, length, to)
        ids = np.array(row["ids"], np.int64)[doc] if len(doc) else doc
        bucket = (key >> np.uint64(40)) % np.uint64(buckets)
        order = np.lexsort((key, bucket))
        new = np.append(True, key[order][1:] != key[order][:-1]) if len(key) else np.zeros(0, bool)
        starts = np.flatnonzero(new)
        group = np.empty(len(key), np.int64)
        group[order] = np.cumsum(new) - 1
        least = np.minimum.reduceat(ids[order], starts) if len(starts) else ids
        most = np.maximum.reduceat(ids[order], starts) if len(starts) else ids
        return doc, pos, key, ids, group, key[order][starts], bucket[order][starts].astype(np.int64), least, most

    def send(batches):
        for batch in batches:
            for row in batch.to_pylist():
                *_, keys, bucket, least, most = keyed(row)
                cuts = np.flatnonzero(np.diff(bucket, prepend=-1))
                ends = np.append(cuts[1:], len(bucket))
                blobs = [ch.squeeze(keys[a:b].tobytes() + least[a:b].tobytes() + ch.bits(least[a:b] < most[a:b])) for a, b in zip(cuts, ends)]
                yield batch_of(bucket=pa.array(bucket[cuts], pa.int64()), chunk=pa.array([row["chunk"]] * len(cuts), pa.int64()),
                               n=pa.array(ends - cuts, pa.int64()), blob=pa.array(blobs, pa.binary()))

    def compare(group):
        raws, ns = [ch.expand(b) for b in group["blob"]], group["n"].tolist()
        key = np.concatenate([np.frombuffer(r, np.uint64, n) for r, n in zip(raws, ns)])
        least = np.concatenate([np.frombuffer(r, np.int64, n, 8 * n) for r, n in zip(raws, ns)])
        many = np.concatenate([ch.flags_of(r[16 * n:], n) for r, n in zip(raws, ns)])
        order = np.argsort(key, kind="stable")
        starts = np.flatnonzero(np.append(True, key[order][1:] != key[order][:-1]))
        low, high = np.minimum.reduceat(least[order], starts), np.maximum.reduceat(least[order], starts)
        owner = np.empty(len(key), np.int64)
        owner[order] = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(key))))
        repeated = ((low < high) | np.logical_or.reduceat(many[order], starts))[owner]
        earlier = low[owner] < least
        ends = np.cumsum(ns)
        parts = [slice(e - n, e) for e, n in zip(ends, ns)]
        return group[["bucket", "chunk"]].assign(bits=[ch.bits(repeated[p]) for p in parts], earlier=[ch.bits(earlier[p]) for p in parts])

    def keep(batches):
        for batch in batches:
            for row in batch.to_pylist():
                doc, pos, key, ids, group, keys, bucket, least, _ = keyed(row)
                repeated, earlier = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
                cuts = np.flatnonzero(np.diff(bucket, prepend=-1))
                known = {a["bucket"]: a for a in row["answers"] or []}
                for a, b in zip(cuts, np.append(cuts[1:], len(bucket))):
                    answer = known[int(bucket[a])]
                    repeated[a:b], earlier[a:b] = ch.flags_of(answer["bits"], b - a), ch.flags_of(answer["earlier"], b - a)
                spans, longest = row["spans"], row["longest"]
                if judge:
                    cut = earlier[group] | (least[group] < ids)
                    spans = ch.squeeze(doc[cut].astype("<u4").tobytes() + pos[cut].astype("<u4").tobytes())
                stay = repeated[group]
                for i in np.unique(doc[stay]).tolist():
                    longest[i] = to
                yield _row(row["chunk"], row["ids"], doc[stay], pos[stay], key[stay], spans, longest, row["gone"])

    answers = ch._by_chunk(arrow_map(state, send, "bucket long, chunk long, n long, blob binary").groupBy("bucket")
                           .applyInPandas(compare, "bucket long, chunk long, bits binary, earlier binary"), "bits", "earlier")
    return stage(arrow_map(state.join(answers, "chunk", "left"), keep, STATE))


def covered(starts: np.ndarray, length: int, n: int) -> np.ndarray:
    """Which of n places the windows cover."""
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, np.minimum(starts + length, n), -1)
    return np.cumsum(step[:n]) > 0


def runs_of(flags: np.ndarray) -> np.ndarray:
    """(start, end) of each run of true places."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.view(np.int8), [0]])))
    return edges.reshape(-1, 2)


def remove_repeats(docs: DataFrame, min_words: int = 13, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, kept_text, n_words, n_removed, spans, longest) of each document.

    spans are the removed runs of words (start, end), counted from 0, end excluded; longest is the greatest level at which a
    window of the document was repeated in another text (all its words for a copy), 0 if none.
    """
    chunks = ch.pack(docs, id_col, text_col)
    half = -(-min_words // 2)
    total = chunks.agg(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x))).head()[0] or 0
    buckets = ch.bucket_count(total // 6)  # words have about six bytes
    answers = ch.repeated_codes(chunks.select("chunk", "sizes", "raw"), _window_codes(half, buckets))
    state = _first_level(chunks, answers, ch.copies(chunks), half, buckets)
    length, to = half, min_words
    while True:
        before, state = state, _level(state, length, to, judge=to == min_words)
        release(before)
        length, to = to, 2 * to
        if not state.agg(F.sum("n")).head()[0]:
            break

    def work(batches):
        for batch in batches:
            for row in batch.to_pylist():
                raw = ch.expand(row["spans"]) if row["spans"] else b""
                doc, pos = np.frombuffer(raw, "<u4").reshape(2, -1).astype(np.int64)
                cuts = np.searchsorted(doc, np.arange(len(row["ids"]) + 1))
                gone = set(row["gone"])
                ids, kept, sizes, removed, spans, longest = [], [], [], [], [], []
                for i, text in enumerate(ch.texts_of(row["raw"], np.array(row["sizes"], np.int64))):
                    words = text.split()
                    n = len(words)
                    cut = covered(pos[cuts[i]:cuts[i + 1]], min_words, n)
                    whole = i in gone and n >= min_words
                    cut |= whole
                    ids.append(None if row["ids"][i] == ch.NO_ID else row["ids"][i])
                    kept.append(b" ".join([w for w, c in zip(words, cut.tolist()) if not c]).decode())
                    sizes.append(n)
                    removed.append(int(cut.sum()))
                    spans.append([{"start": a, "end": b} for a, b in runs_of(cut).tolist()])
                    longest.append(n if whole else row["longest"][i])
                yield batch_of(id=pa.array(ids, pa.int64()), kept_text=pa.array(kept, pa.string()), n_words=pa.array(sizes, pa.int64()),
                               n_removed=pa.array(removed, pa.int64()),
                               spans=pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                               longest=pa.array(longest, pa.int64()))

    joined = chunks.join(state.select("chunk", "spans", "longest", "gone"), "chunk")
    return arrow_map(joined.select("ids", "sizes", "raw", "spans", "longest", "gone"), work,
                     f"`{id_col}` long, kept_text string, n_words long, n_removed long, "
                     "spans array<struct<start: long, end: long>>, longest long")
