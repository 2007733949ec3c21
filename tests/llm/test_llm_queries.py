"""The registered queries against their SQL, or a brute-force version, on the smallest tables."""
import re
import struct

import pytest

import brute
import corpus_pipeline
from check_queries import compare, connect
from pyspark.sql import functions as F
from rollbook.llm.queries import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_agrees_with_sql(spark, name):
    verdict, _ = compare(spark, connect(FOLDER), FOLDER, name)
    assert verdict.startswith("ok"), verdict


def test_language_id_on_held_out_documents(spark):
    truth = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang")
    rows = QUERIES["op1_language_id"](spark, FOLDER).join(truth, "doc_id").where("held_out").collect()
    assert rows and sum(r.lang == r.lang_pred for r in rows) >= 0.98 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_bpe_is_tiktoken(spark, docs):
    own = {r.doc_id: r for r in QUERIES["op3_byte_bpe"](spark, FOLDER).collect()}
    encoding = brute.encoding()
    for i, text in docs:
        ids = encoding.encode_ordinary(text or "")
        assert own[i].n_tokens == len(ids)
        assert own[i].ids_sha256 == brute.sha(struct.pack(f"<{len(ids)}I", *ids))
        assert own[i].decoded_sha256 == brute.sha(text or "")


def test_license_scan_finds_the_planted_notices(spark, docs):
    notices = {"Released under the MIT License.": "MIT", "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
               "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
               "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0", "All rights reserved.": "proprietary"}
    wanted = {(i, n, notices[x]) for i, text in docs for n, x in enumerate((text or "").split("\n")) if x in notices}
    found = {(r.doc_id, r.paragraph, r.family) for r in QUERIES["op5_license_scan"](spark, FOLDER).collect()}
    assert found == wanted and wanted


def test_suffix_dedup_against_brute_force(spark, docs):
    wanted = brute.bytes_removed(docs)
    for r in QUERIES["op9_suffix_dedup"](spark, FOLDER).collect():
        n, removed, spans, kept = wanted[r.doc_id]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (n, removed, spans, brute.sha(kept))


def test_pipeline_against_brute_force(spark, docs):
    kept = [(i, t) for i, t in docs if t and re.search(r"[^\W\d_]", t)]
    cut = brute.lines(kept)
    kept = [(i, cut[i][2]) for i, _ in kept]
    parts = brute.near(kept, 5)
    kept = [(i, t) for i, t in kept if parts[i][1] == i]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    bad = {i for i, _ in brute.leaks(kept, items)}
    encoding = brute.encoding()
    wanted = {i: encoding.encode_ordinary(t) for i, t in kept if i not in bad}
    found = {r.doc_id: list(r.ids) for r in corpus_pipeline.run(spark, FOLDER).collect()}
    assert found == wanted and bad
