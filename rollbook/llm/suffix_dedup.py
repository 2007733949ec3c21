"""Repeated byte strings by threshold-bounded interval expansion on Burrows-Wheeler transforms.

A string of ``length`` bytes that starts anywhere earlier (a smaller id, or the same document before) is removed: each byte it
covers goes. The work is dealt out so that equal strings meet:

1. Each string of ``length`` bytes has an anchor: of the 32-grams in it the one with the least hash, the rightmost of equals.
   Neighbouring strings with one anchor, of which the string reaches 32 bytes before it (or else after it), are a run; its key is
   the hash of the anchor and those 32 bytes. Equal strings have equal keys. Keys are compared between chunks (``chunks``),
   and runs whose key occurs once are dropped.
2. What is left is the context of each run: the bytes of its strings. A chunk sends each distinct context once, with its
   earliest place; contexts with one key meet in one bucket.
3. Strings of one context differ from each other, as each has the anchor at another place. So a key with one distinct context
   is settled by the earliest place of that. A bucket joins its other contexts to one text and sorts its suffixes by more than ``length`` bytes. On its
   Burrows-Wheeler transform, breadth-first backward extension starts from the interval of the empty string and goes on to the
   intervals of strings one byte longer; an interval that ends where no boundary is known yet sets one, with a common prefix of
   the present length. So boundaries appear by increasing common prefix, and the expansion stops at ``length``: suffixes
   between two boundaries then agree in at least ``length`` bytes. Each class of equal strings gets its earliest place.

Exact copies of a document with a smaller id are removed whole beforehand (from ``length`` bytes on). Defined results: NULL is
an empty text; matches never cross documents; rows that repeat an id are documents with the same id, and of two such strings at
one place neither is earlier; rows without id rank after all others, among themselves by place. Extra columns are not carried.
"""
from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.llm import chunks as ch
from rollbook.llm.common import arrow_map, batch_of
from rollbook.llm.hashing import mix, windows
from rollbook.llm.substring_dedup import runs_of
from rollbook.sources.tables import stage

GRAM = 32
#: Bytes of contexts in a bucket on average.
BUCKET_BYTES = 2 << 20
_BYTES = np.random.default_rng(4).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOW = np.uint64(0xFFFFFFFF)


def sliding_least(values: np.ndarray, w: int) -> np.ndarray:
    have = 1
    while have < w:
        to = min(2 * have, w)
        values, have = np.minimum(values[:len(values) - (to - have)], values[to - have:]), to
    return values


def anchored_runs(text: bytes, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first start, last start, key) of the runs of strings of a text."""
    none = np.zeros(0, np.int64)
    if length < 4:
        raise ValueError("length must be at least 4")
    if len(text) < length:
        return none, none, np.zeros(0, np.uint64)
    gram = min(GRAM, (length - 1) // 3)
    grams = windows(_BYTES[np.frombuffer(text, np.uint8)], gram)
    place = np.arange(len(grams), dtype=np.uint64)
    least = sliding_least((grams & ~_LOW) | (_LOW - place), length - gram + 1)
    anchor = (_LOW - (least & _LOW)).astype(np.int64)
    before = anchor - np.arange(len(anchor)) >= gram
    first = np.flatnonzero(np.append(True, (anchor[1:] != anchor[:-1]) | (before[1:] != before[:-1])))
    last = np.append(first[1:], len(anchor)) - 1
    at, side = anchor[first], before[first]
    return first, last, mix(grams[at], grams[np.where(side, at - gram, at + gram)] ^ side.astype(np.uint64))


def sorted_suffixes(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Suffix order by at least ``depth`` symbols (9 bits each), by doubling."""
    n = len(symbols)
    padded = np.concatenate([symbols.astype(np.uint64), np.zeros(7, np.uint64)])
    key = np.zeros(n, np.uint64)
    for j in range(7):
        key = key << np.uint64(9) | padded[j:j + n]
    have = 7
    while True:
        order = np.argsort(key)
        ranked = key[order]
        rank = np.empty(n, np.uint64)
        rank[order] = np.cumsum(np.append(np.uint64(1), (ranked[1:] != ranked[:-1]).astype(np.uint64)))
        if have >= depth or rank[order[-1]] == n:
            return order
        key = rank * np.uint64(n + 1)
        key[:n - have] += rank[have:]
        have *= 2


def boundaries(symbols: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """Places in the suffix order that share less than ``length`` symbols with the one before, by interval expansion.

    Symbol 0 ends a context; strings are not extended beyond it, so suffixes that begin in the last bytes of a context may be
    left together, which is of no account: no string of ``length`` begins there.
    """
    n = len(symbols)
    transform = symbols[order - 1]  # of the first suffix the last symbol, which is 0
    to = np.empty(n, np.int64)
    to[np.argsort(transform, kind="stable")] = np.arange(n)
    change = np.append(True, transform[1:] != transform[:-1])
    run = np.cumsum(change) - 1
    run_from = np.flatnonzero(change)
    run_to = np.append(run_from[1:], n)
    run_symbol = transform[run_from].astype(np.int64)
    known = np.zeros(n + 1, bool)
    known[0] = known[n] = True
    low, high = np.zeros(1, np.int64), np.full(1, n, np.int64)
    for common in range(length):
        if not len(low):
            break
        # the runs of equal symbols in each interval, cut at its ends
        r0 = run[low]
        count = run[high - 1] - r0 + 1
        owner = np.repeat(np.arange(len(low)), count)
        each = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count) + r0[owner]
        symbol = run_symbol[each]
        lo, hi = to[np.maximum(run_from[each], low[owner])], to[np.minimum(run_to[each], high[owner]) - 1] + 1
        if common:
            keep = symbol > 0
            owner, symbol, lo, hi = owner[keep], symbol[keep], lo[keep], hi[keep]
        # runs of one symbol in one interval are neighbours after the extension; most intervals are a single run
        alone = count[owner] == 1
        many = np.flatnonzero(~alone)
        if len(many):
            by = many[np.argsort(owner[many] * 257 + symbol[many], kind="stable")]
            group = owner[by] * 257 + symbol[by]
            new = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
            low = np.concatenate([lo[alone], lo[by[new]]])
            high = np.concatenate([hi[alone], hi[by[np.append(new[1:], len(by)) - 1]]])
        else:
            low, high = lo, hi
        fresh = ~known[high]
        low, high = low[fresh], high[fresh]
        known[high] = True
    return known[:n]


def earliest_places(contexts: list[bytes], strings: np.ndarray, places: np.ndarray, length: int) -> list[np.ndarray]:
    """For each string of each distinct context the least place of an equal string; places[i] is that of context i's first."""
    sizes = np.array([len(c) for c in contexts])
    symbols = np.zeros(int(sizes.sum()) + len(sizes), np.uint16)
    starts = np.cumsum(sizes + 1) - sizes - 1
    data = np.frombuffer(b"\0".join(contexts) + b"\0", np.uint8)
    symbols[:] = data
    symbols += 1
    symbols[starts + sizes] = 0
    order = sorted_suffixes(symbols, length + 1)
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(boundaries(symbols, order, length)) - 1
    offset = np.arange(int(strings.sum())) - np.repeat(np.cumsum(strings) - strings, strings)
    owner = np.repeat(np.arange(len(sizes)), strings)
    classes, place = group[starts[owner] + offset], places[owner] + offset
    least = np.full(len(order), np.iinfo(np.int64).max)
    np.minimum.at(least, classes, place)
    return np.split(least[classes], np.cumsum(strings)[:-1])


CONTEXTS = "chunk long, n_bytes long, docs binary, firsts binary, sizes binary, keys binary, ids array<long>, raw binary, own binary, gone array<long>"


def _contexts(chunks: DataFrame, answers: DataFrame, gone: DataFrame, length: int, buckets: int) -> DataFrame:
    """The distinct contexts of each chunk, and the strings that repeat an earlier context of the same chunk."""
    def work(batches):
        for batch in batches:
            for row in batch.to_pylist():
                copies = set(row["gone"] or [])
                texts = ch.texts_of(row["raw"], np.array(row["sizes"], np.int64))
                found = [anchored_runs(t, length) for t in texts]
                coded = [ch.coded(k, buckets) for _, _, k in found]
                values, _ = ch.counted(coded)
                shared = values[ch.answered(values, row["answers"])]
                first_of: dict[bytes, tuple] = {}
                sent, own = [], []
                for i in sorted(range(len(texts)), key=lambda j: row["ids"][j]):  # so the first met is the earliest
                    if i in copies:
                        continue
                    first, last, key = found[i]
                    at = np.flatnonzero(ch.among(coded[i], shared))
                    for a, b, k in zip(first[at].tolist(), last[at].tolist(), key[at].tolist()):
                        context = texts[i][a:b + length]
                        known = first_of.setdefault(context, (row["ids"][i], a))
                        if known < (row["ids"][i], a):
                            own.append((i, a, b))
                        else:  # the first, or that of a row that repeats its id
                            sent.append((i, a, k, context))
                docs, firsts, keys, kept = zip(*sent) if sent else ((), (), (), ())
                docs, firsts, keys = np.array(docs, np.int64), np.array(firsts, np.int64), np.array(keys, np.uint64)
                longs = pa.list_(pa.int64())
                raw = b"".join(kept)
                yield batch_of(chunk=pa.array([row["chunk"]], pa.int64()), n_bytes=pa.array([len(raw)], pa.int64()), docs=pa.array([docs.tobytes()], pa.binary()),
                               firsts=pa.array([firsts.tobytes()], pa.binary()), sizes=pa.array([np.array([len(c) for c in kept], np.int64).tobytes()], pa.binary()),
                               keys=pa.array([keys.tobytes()], pa.binary()), ids=pa.array([row["ids"]], longs), raw=pa.array([ch.squeeze(raw)], pa.binary()),
                               own=pa.array([ch.squeeze(np.array(own, np.int64).tobytes())], pa.binary()), gone=pa.array([sorted(copies)], longs))

    joined = chunks.join(answers, "chunk", "left").join(gone, "chunk", "left")
    return stage(arrow_map(joined.select("chunk", "ids", "sizes", "raw", "answers", "gone"), work, CONTEXTS))


def _removed(contexts: DataFrame, length: int) -> DataFrame:
    """(chunk, cuts): runs of string starts (document, first, last) with an earlier equal string in another context."""
    buckets = ch.bucket_count(contexts.agg(F.sum("n_bytes")).head()[0] or 0, BUCKET_BYTES)

    def send(batches):
        for batch in batches:
            for row in batch.to_pylist():
                docs, firsts, sizes = (np.frombuffer(row[c], np.int64) for c in ("docs", "firsts", "sizes"))
                bucket = ((np.frombuffer(row["keys"], np.uint64) >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64)
                texts, ids = ch.texts_of(row["raw"], sizes), np.array(row["ids"], np.int64)
                order = np.argsort(bucket, kind="stable")
                cuts = np.flatnonzero(np.diff(bucket[order], prepend=-1))
                low_keys = np.frombuffer(row["keys"], np.uint64).astype(np.uint32)  # keys that clash in these bits are looked at together
                rows = [(int(bucket[order[a]]), row["chunk"], b - a, ch.squeeze(b"".join(
                    [x[order[a:b]].tobytes() for x in (docs, ids[docs], firsts, sizes, low_keys)] + [texts[i] for i in order[a:b].tolist()])))
                    for a, b in zip(cuts.tolist(), np.append(cuts[1:], len(order)).tolist())]
                yield batch_of(**{n: pa.array([r[i] for r in rows], t) for i, (n, t) in enumerate(
                    (("bucket", pa.int64()), ("chunk", pa.int64()), ("n", pa.int64()), ("blob", pa.binary())))})

    def expand(group: pd.DataFrame) -> pd.DataFrame:
        facts, texts, owner, keys = [], [], [], []
        for at, (n, blob) in enumerate(zip(group["n"].tolist(), group["blob"])):
            raw = ch.expand(blob)
            own = np.frombuffer(raw, np.int64, 4 * n).reshape(4, n)
            keys.append(np.frombuffer(raw, np.uint32, n, 32 * n))
            ends = 36 * n + np.cumsum(own[3])
            texts += [raw[e - s:e] for e, s in zip(ends.tolist(), own[3].tolist())]
            facts.append(own)
            owner += [at] * n
        doc, ids, first, size = np.concatenate(facts, axis=1)
        rank = np.unique(ids, return_inverse=True)[1]
        place = rank << 32 | first
        distinct: dict[bytes, int] = {}
        which = np.array([distinct.setdefault(t, len(distinct)) for t in texts])
        least = np.full(len(distinct), np.iinfo(np.int64).max)
        np.minimum.at(least, which, place)
        contexts, key_of = list(distinct), np.empty(len(distinct), np.uint32)
        key_of[which] = np.concatenate(keys)
        _, nth, met = np.unique(key_of, return_inverse=True, return_counts=True)
        several = np.flatnonzero(met[nth] > 1)  # contexts that share their key with another
        strings = np.array([len(c) for c in contexts]) - length + 1
        found = earliest_places([contexts[i] for i in several.tolist()], strings[several], least[several], length) if len(several) else []
        earliest = dict(zip(several.tolist(), found))
        cut: dict[int, list] = {}
        for i, w in enumerate(which.tolist()):
            if w not in earliest:  # all strings of the context are earlier in its first place, or none is
                if least[w] < place[i]:
                    cut.setdefault(owner[i], []).append(np.array([[doc[i], first[i], first[i] + strings[w] - 1]]))
                continue
            gone = earliest[w] < place[i] + np.arange(len(earliest[w]))
            if gone.any():
                cut.setdefault(owner[i], []).append(np.column_stack([np.full(len(r := runs_of(gone)), doc[i]), r + first[i] - [0, 1]]))
        chunk = group["chunk"].tolist()
        return pd.DataFrame({"chunk": [chunk[o] for o in cut], "cuts": [ch.squeeze(np.concatenate(c).astype(np.int64).tobytes()) for c in cut.values()]})

    sent = arrow_map(contexts.select("chunk", "docs", "firsts", "sizes", "keys", "ids", "raw"), send, "bucket long, chunk long, n long, blob binary")
    return (sent.groupBy("bucket").applyInPandas(expand, "chunk long, cuts binary")
            .groupBy("chunk").agg(F.collect_list("cuts").alias("cuts")))


def remove_repeated_bytes(docs: DataFrame, length: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, kept binary, n_bytes, n_removed, spans) of each document; spans are the maximal removed runs (start, end)."""
    chunks = ch.pack(docs, id_col, text_col)
    total = chunks.agg(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x))).head()[0] or 0
    buckets = ch.bucket_count(total // 18)  # about one run in 18 bytes

    def codes(row):
        texts = ch.texts_of(row["raw"], np.array(row["sizes"], np.int64))
        return ch.counted([ch.coded(anchored_runs(t, length)[2], buckets) for t in texts])

    answers = ch.repeated_codes(chunks.select("chunk", "sizes", "raw"), codes)
    contexts = _contexts(chunks, answers, ch.copies(chunks), length, buckets)
    removed = _removed(contexts, length)

    def work(batches):
        for batch in batches:
            for row in batch.to_pylist():
                blobs = [row["own"], *(row["cuts"] or [])]
                cuts = np.concatenate([np.frombuffer(ch.expand(b), np.int64).reshape(-1, 3) for b in blobs])
                cuts = cuts[np.argsort(cuts[:, 0], kind="stable")]
                at = np.searchsorted(cuts[:, 0], np.arange(len(row["ids"]) + 1))
                gone = set(row["gone"])
                ids, kept, sizes, counts, spans = [], [], [], [], []
                for i, text in enumerate(ch.texts_of(row["raw"], np.array(row["sizes"], np.int64))):
                    n = len(text)
                    step = np.zeros(n + 1, np.int64)
                    np.add.at(step, cuts[at[i]:at[i + 1], 1], 1)
                    np.add.at(step, cuts[at[i]:at[i + 1], 2] + length, -1)
                    cut = np.cumsum(step[:n]) > 0
                    cut |= i in gone and n >= length
                    ids.append(None if row["ids"][i] == ch.NO_ID else row["ids"][i])
                    kept.append(np.frombuffer(text, np.uint8)[~cut].tobytes())
                    sizes.append(n)
                    counts.append(int(cut.sum()))
                    spans.append([{"start": a, "end": b} for a, b in runs_of(cut).tolist()])
                yield batch_of(id=pa.array(ids, pa.int64()), kept=pa.array(kept, pa.binary()), n_bytes=pa.array(sizes, pa.int64()),
                               n_removed=pa.array(counts, pa.int64()), spans=pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))))

    joined = chunks.join(contexts.select("chunk", "own", "gone"), "chunk").join(removed, "chunk", "left")
    return arrow_map(joined.select("ids", "sizes", "raw", "own", "gone", "cuts"), work,
                     f"`{id_col}` long, kept binary, n_bytes long, n_removed long, spans array<struct<start: long, end: long>>")
