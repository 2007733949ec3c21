"""Filter interaction audit and source divergence audit: edges, and brute force on small tables."""
from __future__ import annotations

import re
from collections import Counter, defaultdict
from itertools import permutations

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from rollbook.llm import filter_audit, source_audit

DOCS = "doc_id long, text string, lang string, source string"
LONG = " ".join(f"w{i}" for i in range(150))


def failed(rows):
    """The failing letters of each (id, text, lang)."""
    first = {}
    for i, text, _ in rows:
        if i is not None:
            first[text or ""] = min(i, first.get(text or "", i))
    for i, text, lang in rows:
        text, w = text or "", brute.words(text)
        yield (lang or "", i, {x for x, bad in zip("ABCDE", (
            len(w) < 100, 100 * len(set(w)) < 80 * len(w), 100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
            re.search(r"[#$%&*|]", text), i is not None and i > first.get(text, i))) if bad})


def audited(rows, labels):
    good, toxic = {i for i, q, _ in labels if q == 1} - {None}, {i for i, _, t in labels if t == 1} - {None}  # no id, no match
    parts, out = defaultdict(list), {}
    for part, i, fails in failed(rows):
        parts[part].append((i, fails))
    for part, docs in parts.items():
        shapley = Counter()
        for order in map("".join, permutations("ABCDE")):
            left = docs
            for k, x in enumerate(order):
                gone, left = [d for d in left if x in d[1]], [d for d in left if x not in d[1]]
                shapley[x] += len(gone)
                out[part, order, k + 1] = [len(left), len(gone), sum(x in f for _, f in docs) - len(gone), sum(f == {x} for _, f in docs),
                                           sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone)]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(shapley[order[step - 1]])
    return out


CASES = [(1, None, "en", None), (2, "", "en", ""), (3, LONG, "en", "a"), (4, LONG, "fr", "b"), (4, LONG, "fr", "b"), (4, LONG, None, "b"), (7, LONG, "", "b"),
         (8, LONG + " # x", "en", None), (9, "SHOUT " * 200, "en", "a"), (None, LONG, "en", "a"), (None, LONG, "en", "a"), (None, None, "en", "a"), (10, "word " * 120, "fr", "a"),
         (11, "é" * 300, "fr", "a"), (12, LONG.upper(), "de", "a"), (13, "y " * 300_000, "de", "a"), (5, LONG, "en", "c")]
LABELS = [(3, 1, 0), (3, 0, 1), (4, 1, 1), (8, 0, 1), (9, None, 1), (None, 1, 1), (99, 1, 1)]


def test_filter_audit_equals_brute_force(spark):
    docs = spark.createDataFrame([(*r, 1, 2) for r in CASES], DOCS + ", part int, n int")
    labels = spark.createDataFrame([(*r, "x") for r in LABELS], "doc_id long, quality int, toxic int, part string")
    out = filter_audit.audit(filter_audit.cells(docs, labels), list("ABCDE"))
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    got = {(r["part"], r["filter_order"], r["step"]): [r[n] for n in names] for r in out.collect()}
    assert got == audited([r[:3] for r in CASES], LABELS)
    assert filter_audit.audit(filter_audit.cells(docs.limit(0), labels), list("ABCDE")).collect() == []
    assert filter_audit.audit(filter_audit.cells(docs, labels.limit(0)), list("ABCDE")).agg(F.sum("good_lost"), F.sum("toxic_lost")).head() == (0, 0)


def test_filter_audit_takes_other_filters(spark):
    """Two filters: ``failures`` of one's own, and the repeats."""
    docs = spark.createDataFrame([(1, "a", "x", ""), (2, "a", "x", ""), (3, "bb", "x", ""), (4, "bb", "y", "")], DOCS)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    counts = filter_audit.cells(docs, labels, {"long": F.length("text") > 1})
    rows = {(r["part"], r["filter_order"], r["step"]): (r["removed"], r["redundant"], r["shapley"]) for r in filter_audit.audit(counts, ["L", "R"]).collect()}
    assert rows == {("x", "LR", 1): (1, 0, 2), ("x", "LR", 2): (1, 0, 2), ("x", "RL", 1): (1, 0, 2), ("x", "RL", 2): (1, 0, 2),
                    ("y", "LR", 1): (1, 0, 1), ("y", "LR", 2): (0, 1, 1), ("y", "RL", 1): (1, 0, 1), ("y", "RL", 2): (0, 1, 1)}
    with pytest.raises(ValueError, match="orders"):
        filter_audit.audit(counts, list("ABCDEFGH"))


def test_contraction_selects_along_each_axis():
    tensor = np.arange(2 * 3 * 8).reshape(2, 3, 2, 2, 2)
    got = filter_audit.contract(tensor, [filter_audit.FAIL, filter_audit.PASS, filter_audit.ALL])
    assert (got == tensor[:, :, 1, 0, :].sum(axis=-1)).all()


def diverging(rows, min_docs=10):
    low = lambda t: re.findall("[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate(brute.LOWER))
    langs, out = defaultdict(lambda: defaultdict(Counter)), {}
    holders = defaultdict(Counter)
    for _, text, lang, source in rows:
        langs[lang or ""][source or ""].update(low(text))
        holders[lang or ""].update(set(low(text)))
    for lang, sources in langs.items():
        kept = sorted(t for t, n in holders[lang].items() if n >= min_docs)
        p = {}
        for name, count in [*sources.items(), (None, sum(sources.values(), Counter()))]:
            n = sum(count[t] for t in kept)
            p[name] = {t: 1 + 10**9 * (count[t] + 2) // (n + 2 * len(kept)) for t in kept}
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for name in sources:
            pairs = [(-sum(f(p[name][t], p[o][t]) for t in kept), o) for o in sources if o != name]
            terms = [(-f(p[name][t], p[None][t]), t) for t in kept if sources[name][t] and p[name][t] > p[None][t]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms, key=lambda x: (x[0], x[1].encode()))[:10])):
                for k, (value, item) in enumerate(found):
                    out[lang, name, part, item] = (-value, k + 1)
    return out


def got_divergences(out):
    return {(r["lang"], r["source"], r["part"], r["item"]): (r["value"], r["rank"]) for r in out.collect()}


ROWS = ([(i, f"Alpha beta é😀 {'gamma ' * (i % 4)}x{i % 3}y", "en", f"s{i % 5}") for i in range(40)] + [(i, "eins zwei", "de", None) for i in range(12)]
        + [(i, None, "de", "q") for i in range(2)] + [(1, "few words", "fr", "a"), (2, "", "fr", "b"), (3, "words", None, "a"), (None, "Same ROW", "it", "z")]
        + [(None, "same row", "it", "z")] * 11 + [(7, "B" * 200_000 + " zwei", "de", "q")])


def test_source_audit_equals_brute_force(spark):
    docs = spark.createDataFrame([(*r, "t", 1) for r in ROWS], DOCS + ", term string, count int")
    assert got_divergences(source_audit.divergences(docs)) == diverging(ROWS)
    assert source_audit.divergences(docs.limit(0)).collect() == []


def test_source_audit_in_small_blocks_and_flushes(spark, monkeypatch):
    """Blocks, task memory and pair sums of a few rows add up to the same."""
    for name, value in (("BLOCK_ROWS", 2), ("TASK_TERMS", 3), ("TASK_PAIRS", 2)):
        monkeypatch.setattr(source_audit, name, value)
    assert got_divergences(source_audit.divergences(spark.createDataFrame(ROWS, DOCS))) == diverging(ROWS)


def test_shares_are_exact_beyond_64_bits(spark):
    n, v = 9 * 10**18, 10**6
    counts = [0, 1, 10**12 + 7, n]
    row = spark.createDataFrame([(c, n, v) for c in counts], "c long, n long, v long").select(source_audit.share(F.col("c"), F.col("n"), F.col("v")).alias("p"))
    wanted = [1 + 10**9 * (c + 2) // (n + 2 * v) for c in counts]
    assert [r["p"] for r in row.collect()] == wanted == source_audit.shares(np.array(counts), n, v).tolist()


def test_term_limit_is_applied_before_the_rows_of_a_group_meet(spark):
    plan = source_audit.divergences(spark.createDataFrame(ROWS, DOCS))._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan.split("WindowGroupLimit", 1)[1]
