"""Language identification with error-correcting output codes.

Each learned language gets a codeword of +1 and -1. For each bit a binary n-gram classifier (log odds of hashed byte
n-grams, from languages with +1 against languages with -1) gives a margin. Decoding sums, over the bits, the logistic
loss of the margins against each codeword, weighted by how well the bit's two sides can be told apart, and takes the
codeword of the least loss. ``ambiguous`` marks texts whose second codeword is nearly as near.

The model is fitted on at most ``fit_rows`` labelled documents per language, chosen by a hash of their id, each with
its whole text; Spark counts the n-grams, and only the counts (languages x buckets) come to the driver.

Defined results: NULL texts and texts without a letter are ``und`` with score 0; so is everything if no label was
given. With one learned language that language has score 1. NULL labels are not learned. Repeated rows count each.
"""
from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.llm.common import arrow_map, batch_of, widened, without

BUCKETS = 1 << 14
BITS = 15
UNKNOWN = "und"
LETTER = regex.compile(r"\p{L}")
#: ASCII bytes other than letters count as blanks.
_TABLE = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def grams(text: str) -> np.ndarray:
    """Buckets of the byte 1-, 2- and 3-grams of a lowered text."""
    b = np.frombuffer(text.lower().encode("utf-8", "replace").translate(_TABLE), dtype=np.uint8).astype(np.uint32)
    two = b[:-1] * np.uint32(257) + b[1:]
    three = two[:-1] * np.uint32(257) + b[2:]
    mixed = [(x * np.uint32(2654435761)) >> np.uint32(18) for x in (b + np.uint32(1 << 28), two + np.uint32(1 << 29), three)]
    return np.concatenate(mixed).astype(np.int64)


def codewords(n: int, bits: int = BITS) -> np.ndarray:
    """n distinct rows of +1 and -1, the most distant of 300 seeded draws, no column constant."""
    bits = max(bits, 4 * int(np.ceil(np.log2(max(n, 2)))))
    best, far = None, -1
    for seed in range(300):
        rng = np.random.default_rng(seed)
        half = np.where(np.arange(n) % 2 == 0, 1, -1)
        draw = np.stack([rng.permutation(half) for _ in range(bits)], axis=1) if n > 1 else np.ones((1, bits), int)
        apart = (draw[:, None, :] != draw[None, :, :]).sum(axis=2) + bits * np.eye(n, dtype=int)
        if apart.min() > far:
            best, far = draw, apart.min()
    return best.astype(np.float64)


@dataclass
class Model:
    languages: list[str]
    codes: np.ndarray     # languages x bits
    weights: np.ndarray   # buckets x bits, log odds of each n-gram
    trust: np.ndarray     # weight of each bit's loss


def build(counts: dict[str, np.ndarray]) -> Model:
    """Closed-form classifiers from the n-gram counts of each language."""
    languages = sorted(counts)
    if not languages:
        return Model([], np.zeros((0, BITS)), np.zeros((BUCKETS, BITS), np.float32), np.ones(BITS))
    p = np.stack([(counts[k] + 0.5) / (counts[k].sum() + 0.5 * BUCKETS) for k in languages])
    codes = codewords(len(languages))
    up, down = (codes > 0).astype(float), (codes < 0).astype(float)
    if len(languages) == 1:
        return Model(languages, codes, np.zeros((BUCKETS, codes.shape[1]), np.float32), np.ones(codes.shape[1]))
    yes, no = (up.T @ p) / up.sum(0)[:, None], (down.T @ p) / down.sum(0)[:, None]
    odds = np.log(yes / no)
    apart = ((yes - no) * odds).sum(axis=1)  # symmetric divergence of a bit's two sides
    return Model(languages, codes, odds.T.astype(np.float32), apart / apart.mean())


def fit(labelled: DataFrame, lang_col: str, text_col: str, id_col: str, fit_rows: int = 1500) -> Model:
    """Count the n-grams of at most about ``fit_rows`` documents of each language."""
    known = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    sizes = {r[0]: r[1] for r in known.groupBy(lang_col).count().collect()}
    if not sizes:
        return build({})
    share = F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, min(1.0, fit_rows / n))])
    draw = F.pmod(F.xxhash64(F.col(id_col).cast("string"), F.lit("fit")), F.lit(1 << 24)) / F.lit(float(1 << 24))
    sample = known.where(draw < share[F.col(lang_col)])

    def work(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = sums.setdefault(lang, np.zeros(BUCKETS))
                own += np.bincount(grams(text), minlength=BUCKETS)
        for lang, own in sums.items():
            used = np.flatnonzero(own)
            yield batch_of(lang=pa.array([lang] * len(used)), bucket=pa.array(used), n=pa.array(own[used]))

    table = (arrow_map(sample.select(F.col(lang_col), F.col(text_col)), work, "lang string, bucket long, n double")
             .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas())
    counts = {}
    for lang, part in table.groupby("lang"):
        counts[lang] = np.zeros(BUCKETS)
        counts[lang][part["bucket"].to_numpy()] = part["n"].to_numpy()
    return build(counts)


def decode(model: Model, sums: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Index of the nearest codeword, its score, and whether the second is nearly as near."""
    margins = sums / np.sqrt(np.maximum(sizes, 1))[:, None]
    loss = (np.logaddexp(0, -margins[:, None, :] * model.codes[None, :, :]) * model.trust).sum(axis=2)
    best = loss.argmin(axis=1)
    chance = np.exp(-(loss - loss.min(axis=1, keepdims=True)))
    score = 1 / chance.sum(axis=1)
    ambiguous = np.zeros(len(best), bool)
    if loss.shape[1] > 1:
        two = np.partition(loss, 1, axis=1)[:, :2]
        ambiguous = two[:, 1] - two[:, 0] < 0.05 * np.maximum(two[:, 1], 1e-9)
    return best, score, ambiguous


def predict(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The documents with lang_pred, score and ambiguous added."""
    docs = without(docs, "lang_pred", "score", "ambiguous")
    out = docs.columns
    at = out.index(text_col)

    def work(batches):
        for batch in batches:
            texts = batch.column(at).to_pylist()
            counts = np.zeros((len(texts), BUCKETS), np.float32)
            known = np.zeros(len(texts), bool)
            for i, text in enumerate(texts):
                if text and model.languages and LETTER.search(text):
                    known[i] = True
                    counts[i] = np.bincount(grams(text), minlength=BUCKETS)
            best, score, ambiguous = decode(model, (counts @ model.weights).astype(float), counts.sum(axis=1)) \
                if model.languages else (np.zeros(len(texts), int), np.zeros(len(texts)), np.zeros(len(texts), bool))
            names = [model.languages[b] if k else UNKNOWN for b, k in zip(best, known)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(names), pa.array(np.where(known, score, 0.0)), pa.array(ambiguous & known)],
                names=[*out, "lang_pred", "score", "ambiguous"])

    return arrow_map(docs, work, widened(docs, "lang_pred string, score double, ambiguous boolean"))


def held_out(id_col: str = "doc_id"):
    """Documents whose crc32 of the id as text leaves 2 on division by 4 are never learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))
