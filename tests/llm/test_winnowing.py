"""Winnowing against brute force: every document, its edited text, and lengths around every bound."""
from __future__ import annotations

import random
from functools import lru_cache

import brute
import pytest
import xxhash
from pyspark.sql import functions as F

from rollbook.llm import winnowing
from rollbook.llm.queries import QUERIES

K, W = winnowing.K, winnowing.W


@lru_cache(1_000_000)
def gram(text):
    return xxhash.xxh64_intdigest(text.encode(), seed=42) >> 28


def picked(text):
    """{(hash, position)}: of each window the least hash, the rightmost of equal ones."""
    h = [(gram(text[j:j + K]), -j) for j in range(max(1, len(text) - K + 1))] if text else []
    return {min(h[a:a + W]) for a in range(max(1, len(h) - W + 1)) if h}


def written(found):
    return " ".join(f"{x:x}@{-j}" for x, j in sorted(found, key=lambda s: (-s[1], s[0])))


def alike(a, b):
    a, b = {x for x, _ in a}, {x for x, _ in b}
    return len(a & b) / len(a | b) if a | b else 1.0


def compare(rows, docs):
    found = {r["doc_id"]: r for r in rows}
    own = [picked(t) for _, t in docs]
    for n, (i, text) in enumerate(docs):
        follow, half = docs[(n + 1) % len(docs)][1], len(text) // 2
        edited = text[:len(text) - half] + follow[:half]
        changed, r = picked(edited), found[i]
        assert r["n_chars"] == len(text) and r["fingerprint"] == written(own[n]), i
        assert r["edited_fingerprint"] == written(changed), (i, len(text), len(edited))
        assert r["near_edited"] == pytest.approx(alike(own[n], changed)) and r["near_next"] == pytest.approx(alike(own[n], own[(n + 1) % len(docs)]))
        yield r, edited


def test_query_against_brute_force(spark):
    docs = [(r["doc_id"], r["text"] or "") for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").collect()]
    for r, edited in compare(QUERIES["op7_winnowing"](spark, "/root/testdata/sf0.001").collect(), docs):
        assert r["edited_sha256"] == brute.sha(edited)


@pytest.mark.parametrize("seed", range(2))
def test_lengths_around_the_bounds_and_characters_beyond_the_first_plane(spark, seed):
    rng = random.Random(seed)
    bounds = [0, 1, 2, K - 1, K, K + 1, W, W + K - 2, W + K - 1, W + K, 2 * (W + K) - 3, 2 * (W + K - 1), 2 * (W + K) + 1, 160, winnowing.SEGMENT - 1,
              winnowing.SEGMENT, winnowing.SEGMENT + W + K, 2 * winnowing.SEGMENT + 30, 5000]
    rng.shuffle(bounds)
    alphabets = ["ab", "a", "abcdefghij \n", "aé😀𝄞z", "😀🎉"]
    docs = [(i, "".join(rng.choice(alphabets[(i + seed) % 5]) for _ in range(n))) for i, n in enumerate(bounds)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    for r, edited in compare(winnowing.compared(df).collect(), docs):
        assert r["edited"] == edited


def test_a_shared_passage_is_found_at_its_place(spark):
    passage = "".join(random.Random(1).choice("abcdefgh 😀") for _ in range(W + K - 1))
    texts = ["x" * 3000 + passage + "y" * 100, "zz 😀" * 700 + passage]
    rows = spark.createDataFrame([(t,) for t in texts], "text string").select(winnowing.fingerprint_of(winnowing.places(F.col("text"))).alias("f")).collect()
    found = [dict(p.split("@") for p in r["f"].split()) for r in rows]
    shared = [(int(found[0][h]) - 3000, int(found[1][h]) - 2800) for h in found[0].keys() & found[1].keys()]
    assert shared and all(a == b and 0 <= a < W for a, b in shared)


@pytest.mark.parametrize("text", ["plain " * 40, "aé😀𝄞z" * 30, "x" * 63 + "é" + "y" * 90, "a" * K, "b" * (K + W)])
def test_blocks_hold_every_run_by_position(spark, text):
    """Also where a block is of single bytes and the next is not."""
    rows = spark.createDataFrame([(text,)], "t string").select(winnowing._blocks(F.col("t"), F.lit(7), K, W).alias("b")).head()["b"]
    assert all(len(b) == W for b in rows[:-1]) and 0 < len(rows[-1]) <= W
    assert [((x >> 27), winnowing._TOP - (x & winnowing._TOP)) for b in rows for x in b] == [(gram(text[i:i + K]), i + 7) for i in range(len(text) - K + 1)]
