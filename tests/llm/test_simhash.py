"""SimHash near-dedup against brute force."""
from __future__ import annotations

import random
from itertools import combinations

import brute
import numpy as np
import pytest
import xxhash

from rollbook.llm import simhash
from rollbook.llm.common import documents


def fingerprint(text, size=3):
    w = brute.words((text or "").translate(brute.LOWER))
    if not w:
        return 0
    size = min(size, len(w))
    hashes = [xxhash.xxh64_intdigest(" ".join(w[i:i + size]).encode(), seed=42) for i in range(len(w) - size + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def rooted(values, radius):
    """{value: least value reachable} of the distinct values."""
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v
    for a, b in combinations(sorted(set(values)), 2):
        if (a ^ b).bit_count() <= radius:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {v: find(v) for v in root}


def expected(rows, radius=3):
    prints = [fingerprint(t) for _, t in rows]
    root, least = rooted(prints, radius), {}
    for (i, _), p in zip(rows, prints):
        if i is not None:
            least[root[p]] = min(i, least.get(root[p], i))
    return sorted(((i, f"{p:016x}", least.get(root[p])) for (i, _), p in zip(rows, prints)), key=str)


def found(df):
    return sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in df.collect()), key=str)


def test_whole_table_equals_brute_force(spark):
    docs = documents(spark, "/root/testdata/sf0.01").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    assert found(simhash.near_duplicates(docs)) == expected(rows)


def test_edge_cases(spark):
    long = " ".join(f"w{i % 977}" for i in range(200_000))
    rows = [(5, None), (4, ""), (3, " \t\n"), (9, "One"), (8, "one"), (7, "a B"), (6, "A b"), (2, long), (2, long), (1, long.upper()),
            (None, "only here and nowhere else"), (None, "one"), (11, "naïve ÀÉ café 😀 text"), (12, "NAÏVE ÀÉ CAFÉ 😀 TEXT"), (13, "x\x00y z w"), (14, "é")]
    docs = spark.createDataFrame([(i, t, "f", i) for i, t in rows], "doc_id long, text string, fingerprint string, component_id long")
    out = simhash.near_duplicates(docs)
    assert found(out) == expected(rows)
    assert out.columns == ["doc_id", "fingerprint", "component_id", "kept"]
    assert sorted(r["doc_id"] for r in out.where("kept AND doc_id IS NOT NULL").collect()) == sorted(
        i for i, _, c in expected(rows) if i is not None and i == c)
    assert simhash.near_duplicates(docs.limit(0)).collect() == []


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 5])
def test_bit_slices_find_every_pair_within_the_radius(radius):
    rng = random.Random(radius)
    values = [rng.getrandbits(64) for _ in range(300)]
    for v in values[:150]:
        for bits in (1, 2, 3, 4, 5, 6):
            values.append(v ^ sum(1 << b for b in rng.sample(range(64), bits)))
    values = sorted(set(values))
    lanes = np.array(values, np.uint64)
    planes = simhash.planes_of(lanes)
    over = np.repeat(~simhash._lanes_below(np.array([len(lanes)]), planes.shape[1]), len(lanes), axis=0)
    rows, hits = simhash.within(lanes, planes, over, radius)
    row, lane = np.nonzero(np.unpackbits(hits.view(np.uint8), axis=1, bitorder="little"))
    got = {(int(rows[r]), int(x)) for r, x in zip(row, lane)}
    assert got == {(i, j) for i, a in enumerate(values) for j, b in enumerate(values) if (a ^ b).bit_count() <= radius}


@pytest.mark.parametrize("n", [0, 1, 5_000, 10**7, 10**9, 10**12])
def test_tables_agree_for_any_pair_within_the_radius(n):
    keys, used = simhash.tables(n)
    rng = random.Random(n)
    assert n < 4096 or n >> used < 4 * simhash.LANES
    for _ in range(300):
        differing = sum(1 << b for b in rng.sample(range(64), 3))
        assert any(all(differing >> first & ((1 << bits) - 1) == 0 for first, bits in blocks) for blocks in keys)


def test_large_buckets_are_split_without_loss(spark, monkeypatch):
    """A third of all fingerprints lie around one, far beyond a part's bound."""
    monkeypatch.setattr(simhash, "MOST_LANES", 128)
    monkeypatch.setattr(simhash, "LANES", 64)
    rng = random.Random(3)
    base = rng.getrandbits(64)
    values = [base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 6))) for _ in range(700)]
    values += [rng.getrandbits(64) for _ in range(1300)]
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    classes = spark.createDataFrame(signed, "bits long").distinct()
    rows = simhash.buckets(classes, 2000)
    assert max(len(p) for r in rows.collect() for p in r["parts"]) <= 128
    root = rooted(values, 3)
    from rollbook.llm.components import components
    got = {r["u"] % (1 << 64): r["root"] % (1 << 64) for r in components(simhash.links(rows)).collect()}
    same = lambda names: {frozenset(v for v in set(values) if names.get(v, v) == n) for n in {names.get(v, v) for v in set(values)}}
    assert same(got) == same(root)


def test_private_names_do_not_clash(spark):
    """Columns named like those that line dedup and decontamination join by."""
    from rollbook.llm import decontaminate, line_dedup, minhash
    line = "a line of more than forty characters, found in five texts"
    docs = spark.createDataFrame([(i, f"{line}\nown {i}", "kept", i, "k") for i in range(6)], "doc_id long, text string, own_drop_keys string, drop_doc long, BAD_KEY string")
    cut = line_dedup.dedup_lines(docs)
    assert cut.columns[:5] == docs.columns and sorted((r["doc_id"], r["n_dropped"], r["drop_doc"]) for r in cut.collect()) == [(i, int(i < 5), i) for i in range(6)]
    items = spark.createDataFrame([(1, line)], "item_id long, text string")
    clean = decontaminate.clean_documents(docs.unionByName(docs.limit(1).selectExpr("99L doc_id", "'something else' text", "own_drop_keys", "drop_doc", "BAD_KEY")), items)
    assert [(r["doc_id"], r["BAD_KEY"]) for r in clean.collect()] == [(99, "k")]
    with pytest.raises(ValueError, match="80 percent"):
        minhash.near_duplicates(docs, percent=45)


def test_a_worker_drops_the_caches_of_other_operators():
    from rollbook.llm import common
    mine, other = common.worker_cache("mine"), common.worker_cache("other")
    mine["a"], other["b"] = 1, 2
    common.release_caches("mine")
    assert mine == {"a": 1} and other == {} and common.worker_cache("mine") is mine
    common.release_caches(None)
    assert mine == {}
