"""NULLs, empty and long texts, ties, repeated rows, empty tables and clashing columns, for each operator and stage."""
import itertools
import random
import struct
import textwrap
import zlib

import public_tokenizers
import pytest

import brute
import corpus_pipeline
from pyspark.sql import functions as F
from rollbook.llm import (bpe, components, decontaminate, language_id, licenses, line_dedup, minhash, substring_dedup,
                          suffix_dedup, warc, winnowing)
from rollbook.llm.queries import TOKENIZER

LONG = "An unusually long line of words that many documents of this table share with each other"
BIG = " ".join(f"word{i % 977}x{i}" for i in range(40_000)) + "\n" + LONG
ROWS = [(1, None, "en"), (2, "", "en"), (3, "  \n\t ", None), (4, BIG, "en"), (5, LONG, "en"), (6, LONG, "de"), (7, LONG + "\nDas ist ein Satz.", "de"),
        (8, LONG.upper() + " ", "en"), (9, "12 34 !!", None), (10, "Haus", "de"), (10, "Haus", "de"), (11, "퟿\U0001f600é", "en"), (None, LONG, "en"),
        (None, None, None), (12, "a", "en"), (12, "b", "en")]
#: Columns named like results of the operators.
CLASH = ("n_lines long, kept string, score string, ids string, n_tokens string, set_node string, component_id string, bands string, key string, drop_keys "
         "string, decoded string, chunk string, place string, lang_pred string")
DDL = f"doc_id long, text string, lang string, source string, n_chars long, {CLASH}"


@pytest.fixture(scope="module")
def odd(spark):
    width = len(spark.createDataFrame([], DDL).columns)
    return spark.createDataFrame([r + ("s", 0) + (None,) * (width - 5) for r in ROWS], DDL)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DDL)


def test_language_id(spark, odd, none):
    model = language_id.fit(odd, "lang", "text", "doc_id")
    assert model.languages == ["de", "en"]
    rows = language_id.predict(odd, model).collect()
    assert len(rows) == len(ROWS)
    for r in rows:
        blank = not r.text or not any(map(str.isalpha, r.text))
        assert (r.lang_pred == "und") == blank and (r.score == 0) == blank
    assert all(r.lang_pred == "und" for r in language_id.predict(odd, language_id.fit(none, "lang", "text", "doc_id")).collect())
    assert language_id.predict(none, model).count() == 0
    one = language_id.fit(odd.where("lang = 'de'"), "lang", "text", "doc_id")
    assert {(r.lang_pred, r.score) for r in language_id.predict(odd, one).where("text = 'Haus'").collect()} == {("de", 1.0)}
    held = odd.where("doc_id is not null").select("doc_id", language_id.held_out().alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in held)


def test_codewords_are_apart():
    for n in (2, 4, 9):
        codes = language_id.codewords(n)
        assert len({tuple(c) for c in codes.tolist()}) == n and all(abs(c.sum()) < n for c in codes.T)


def test_line_dedup(odd, none):
    rows = line_dedup.dedup_lines(odd, batches=3, fanout=2).collect()
    assert len(rows) == len(ROWS)
    by = {r.doc_id: r for r in rows if r.doc_id is not None}
    # held by 4, 5, 6, 7, 8 (upper case, blank at the end) and a row without id: stays in 8 alone
    assert by[8].n_dropped == 0 and by[8].text == LONG.upper() + " "
    assert (by[5].text, by[5].n_lines, by[5].n_dropped) == ("", 1, 1)
    assert by[7].text == "Das ist ein Satz." and by[4].text == BIG[:-len(LONG) - 1]
    assert (by[1].text, by[1].n_lines, by[1].n_dropped) == ("", 1, 0) and by[3].n_lines == 2
    assert sorted(r.n_dropped for r in rows if r.doc_id is None) == [0, 1]
    assert line_dedup.dedup_lines(none).count() == 0


def test_line_runs_are_compacted(spark, frame):
    runs = line_dedup.LineRuns(fanout=2)
    for i in range(5):
        runs.add(frame("key_hi long, key_lo long, n_docs long, last_doc long", [(1, 1, 2, 10 - i), (i, 7, 1, i)]))
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    assert {(r.key_hi, r.n_docs, r.last_doc) for r in runs.merged().where("key_lo = 1").collect()} == {(1, 10, 10)}


def test_minhash(odd, none):
    rows = minhash.near_duplicates(odd, size=2).collect()
    assert len(rows) == len(ROWS)
    by = {(r.doc_id, r.text): r for r in rows}
    assert {by[i, LONG].component_id for i in (5, 6)} == {5} and by[None, LONG].component_id == 5
    assert by[8, LONG.upper() + " "].component_id == 5 and not by[8, LONG.upper() + " "].kept and by[5, LONG].kept
    assert (by[1, None].n_shingles, by[1, None].component_id, by[1, None].kept) == (0, 1, True)
    assert by[2, ""].component_id == 2 and by[10, "Haus"].n_shingles == 1
    assert [r.kept for r in rows if r.doc_id == 10] == [True, True]
    assert minhash.near_duplicates(none).count() == 0


def test_minhash_finds_every_link_of_a_large_group(spark):
    """Edited copies of one text, many of which are similar only to the original or to some other copy."""
    import random
    rng = random.Random(3)
    base = [f"w{rng.randrange(4000)}" for _ in range(120)]
    docs = [(0, " ".join(base))]
    for i in range(1, 140):
        w = list(base)
        for _ in range(rng.randrange(2, 14)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(9000)}"
        docs.append((i, " ".join(w)))
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), size=2).collect()}
    assert found == brute.near(docs, 2) and len({c for _, c in found.values()}) > 3


def test_components(frame):
    edges = frame("u long, v long", [(i, i + 1) for i in range(40)] + [(100, 101), (101, 101), (200, 100), (5, 6)])
    roots = {r.u: r.root for r in components.components(edges).collect()}
    assert roots == {i: 0 for i in range(1, 41)} | {101: 100, 200: 100}
    assert components.components(frame("u long, v long", [])).count() == 0


def test_decontamination(spark, odd, none):
    item = "Which of the seven rivers in the old song runs north before it meets the sea at dawn"
    items = spark.createDataFrame([(1, item), (2, None), (3, ""), (4, "Haus"), (5, item)], "item_id long, text string")
    docs = odd.select("doc_id", "text").union(spark.createDataFrame(
        [(50, BIG[:3000] + " " + item.upper() + " " + BIG[:2000]), (51, "some words here " + item.replace("seven", "nine") + " end"),
         (52, " ".join(item.split()[:9]))], "doc_id long, text string"))
    found = {(r.doc_id, r.item_id): r for r in decontaminate.contaminations(docs, items).collect()}
    assert set(found) == {(50, 1), (50, 5), (10, 4)}
    assert found[50, 1].similarity == 1.0 and found[50, 1].n_words == 18
    edited = {(r.doc_id, r.item_id) for r in decontaminate.contaminations(docs, items, percent=50).collect()}
    assert (51, 1) in edited
    left = decontaminate.clean_documents(docs, items)
    assert sorted(r.doc_id or -1 for r in left.collect()) == sorted(r.doc_id or -1 for r in docs.collect() if r.doc_id not in (50, 10))
    assert decontaminate.contaminations(none, items).count() == 0
    assert decontaminate.contaminations(docs, items.limit(0)).count() == 0
    assert decontaminate.clean_documents(odd, items.limit(0)).count() == len(ROWS)


def leaks_by_brute_force(frame, docs, texts):
    items = list(enumerate(texts))
    found = decontaminate.contaminations(frame("doc_id long, text string", docs), frame("item_id long, text string", items))
    return {(r.doc_id, r.item_id) for r in found.collect()}, brute.leaks(docs, items)


def test_truncated_passages_behind_a_long_token(frame):
    texts, docs = [], []
    for n in range(20):
        own = [f"w{(7 * n + 13 * i * i) % 9973}x{i}" for i in range(60 + 2 * n)]
        cut = 3 + n % 6
        texts.append(" ".join(own))
        docs.append((n, " ".join(f"front{n}x{i}" for i in range(30)) + f" {'u' * (30 + 5 * (n % 7))} " + " ".join(own[cut:]) + f" end{n} of it"))
        docs.append((100 + n, " ".join(own[:-cut]) + f" {'u' * 40} tail{n} more"))
    found, wanted = leaks_by_brute_force(frame, docs, texts)
    assert found == wanted and len([d for d, _ in wanted if d < 100]) >= 8


def test_passages_with_one_long_word(frame):
    texts, docs = [], []
    for n in range(24):
        own = [f"w{(7 * n + 13 * i * i) % 9973}x{i}" for i in range(200)]
        texts.append(" ".join(own))
        own[50 + n] = "".join(chr(97 + (n * i + i * i) % 26) for i in range(100 + 4 * n))
        docs.append((n, f"front{n} " + " ".join(own) + f" end{n}"))
    found, wanted = leaks_by_brute_force(frame, docs, texts)
    assert found == wanted and len(wanted) == 24


def test_radius_and_repeated_rows(frame):
    """The radius alone finds at least 0.9 of the pairs that hold; a NULL id is found; the blocks miss nothing within the radius."""
    texts, docs = [], []
    for n in range(60):
        own = [f"w{(7 * n + 13 * i * i) % 9973}x{i}" for i in range(40 + 2 * n)]
        texts.append(" ".join(own))
        own[20:20 + n % 3] = [f"new{n}x{i}" for i in range(n % 3)]
        docs.append((None if n == 7 else n, f"front{n} " + " ".join(own) + f" end{n}"))
    items = frame("item_id long, body string", list(enumerate(texts)))
    found = decontaminate.contaminations(frame("doc_id long, text string", docs + docs[:3]), items, item_text_col="body").collect()
    wanted = {(i, item) for i, item in brute.leaks(docs, list(enumerate(texts)))}
    assert sorted(map(str, wanted)) == sorted(str((r.doc_id, r.item_id)) for r in found) and len(wanted) > 50
    assert sum(r.hamming is not None for r in found) >= 0.9 * len(found)
    rng = random.Random(3)
    base = [rng.getrandbits(63) for _ in range(6)]
    near = [(i, 5, n, base[i % 6] ^ sum(1 << b for b in rng.sample(range(63), n % 24))) for n, i in enumerate(range(300))]
    rows = decontaminate.within_radius(frame("key long, m int, start int, print long", near), frame("item_id long, m int, print long", [(i, 5, p) for i, p in enumerate(base)])).collect()
    exact = {(k, i): (p ^ q).bit_count() for k, _, _, p in near for i, q in enumerate(base) if (p ^ q).bit_count() <= decontaminate.RADIUS}
    assert {(r.key, r.item_id): r.hamming for r in rows} == exact and len(rows) >= 150


def test_bpe(odd, none):
    rows = bpe.encode_documents(odd, TOKENIZER, public_tokenizers.PATTERN).collect()
    encoding = brute.encoding()
    assert len(rows) == len(ROWS)
    for r in rows:
        ids = encoding.encode_ordinary(r.text or "")
        assert list(r.ids) == ids and r.decoded == (r.text or "") and r.ids_sha256 == brute.sha(struct.pack(f"<{len(ids)}I", *ids))
    assert bpe.encode_documents(none, TOKENIZER, public_tokenizers.PATTERN).count() == 0


def test_bpe_pieces_and_streams():
    import random
    own, encoding, rng = bpe.codec(TOKENIZER, public_tokenizers.PATTERN), brute.encoding(), random.Random(1)
    parts = ["a", "th", "ing", " ", "  ", "\n", "é", "日", "0", "'s", "\0", "😀", "\x85", "　", "."]
    for text in ["".join(rng.choice(parts) for _ in range(rng.randrange(80))) for _ in range(2000)] + ["a" * 5000, "ab" * 999, " " * 3000, "=" * 4001]:
        assert own.encode(text) == encoding.encode_ordinary(text)
    emoji = encoding.encode_ordinary("x😀")
    old, bpe.BLOCK = bpe.BLOCK, 1
    try:
        assert "".join(t for _, t in own.stream(emoji)) == "x😀" and "".join(t for _, t in own.stream(emoji[:-1])).endswith("�")
    finally:
        bpe.BLOCK = old


def test_licenses(odd, none, frame):
    model = licenses.train(licenses.sample_lines(odd, "doc_id", "text", 100))
    docs = frame("doc_id long, text string", [(1, "First.\nReleased under the MIT License.\nLast."), (2, None), (3, ""), (4, "licence"), (5, "The house was released."),
                                              (6, "Code: licensed under the Apache License, Version 2.0, see file."), (6, "All rights reserved.")])
    found = {(r.doc_id, r.paragraph, r.family) for r in licenses.scan(docs, model).collect()}
    assert found == {(1, 1, "MIT"), (6, 0, "Apache-2.0"), (6, 0, "proprietary")}
    assert licenses.scan(odd, model).count() == 0 and licenses.scan(none, licenses.train([])).count() == 0


@pytest.mark.parametrize("mark", ["", " * ", "# "])
def test_wrapped_licenses(spark, frame, mark):
    wrap = lambda text, width=72: "\n".join(mark + x for x in textwrap.wrap(text, width))
    mit = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "
           "\"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, "
           "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so.")
    gpl = ("This program is free software{} you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
           "the Free Software Foundation{} either version {} of the License, or (at your option) any later version.")
    bsd = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
    lgpl = gpl.replace("GNU General", "GNU Lesser General").replace("program", "library").format(";", ";", "2.1")
    texts = {"MIT": mit, "GPL-3.0": gpl.format(":", ",", 3), "GPL-2.0": gpl.format(";", ";", 2), "BSD-3-Clause": bsd, "LGPL-2.1": lgpl}
    rows = [(n, f"int x;\n\n{mark}Copyright 2020 Some Body\n{wrap(t)}\n\nint main();") for n, t in enumerate(texts.values())]
    rows += [(20, "x\nMIT License\ny"), (21, "not under the MIT License here"), (22, "This project is licensed under\n\nthe terms of the MIT license."), (23, wrap(mit) + "\n\n" + wrap(bsd))]
    found = licenses.scan(frame("doc_id long, text string", rows), licenses.train([])).collect()
    assert {(r.doc_id, r.family) for r in found} == {*enumerate(texts), (20, "MIT"), (23, "MIT"), (23, "BSD-3-Clause")}
    spans = {r.doc_id: (r.paragraph, r.last_line) for r in found if r.doc_id in (0, 20)}
    assert spans[20] == (1, 1) and spans[0][0] == 3 and spans[0][1] >= 7


def test_warc(spark, tmp_path, frame):
    pages = frame("page_id long, url string, html string, title string", [
        (1, "http://a/é", '<html lang="fr"><head><title>T &amp;\n U</title></head><body><!-- x --><p>Un<br>deux</p><script>x("</p>")</script><a href="/b">b</a></body></html>'),
        (2, None, None), (3, "http://b", ""), (3, "http://b", "")])
    found = warc.derive(warc.responses(pages.drop("title"), "2020-01-01T00:00:00Z"))
    rows = found.orderBy("page_id").collect()
    assert rows[0].text == "T & U\nUn\ndeux\nb".replace("T & U", "T &\nU") and rows[0].lang == "fr" and rows[0].links == ["/b"]
    assert rows[1].text == "" and rows[1].target_uri == "" and rows[2].record_id == rows[3].record_id
    for column in ("response_record", "metadata_record", "conversion_record"):
        warc.write(found.coalesce(1), column, str(tmp_path / column), "none")
        data = b"".join(p.read_bytes() for p in sorted((tmp_path / column).glob("part-*")))
        seen = []
        while data:  # a strict reader: header lines, a block of the stated length, two line ends
            head, rest = data.split(b"\r\n\r\n", 1)
            fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
            n = int(fields["Content-Length"])
            assert head.startswith(b"WARC/1.1") and rest[n:n + 4] == b"\r\n\r\n" and fields["WARC-Block-Digest"] == "sha256:" + brute.sha(rest[:n])
            seen.append(fields.get("WARC-Refers-To", fields["WARC-Record-ID"]))
            data = rest[n + 4:]
        assert sorted(seen) == sorted(r.record_id for r in rows)
    assert "source-header: Content-Type: text/html; charset=utf-8" in rows[0].fields and "outlink: /b" in rows[0].fields
    assert warc.derive(warc.responses(pages.limit(0).drop("title"), "x")).count() == 0


def test_warc_attributes_references_and_names(spark, frame):
    html = ("<html\nlang='fr' class=x><title>caf&eacute; &#x1F600;&#55296;&nosuch;&amp;lt;</title><p\nclass=a>1&nbsp;\u00a02</p><a title='a>b' href='/1?a=1&amp;b=2'>x</a><a href=/2>"
            "<a\nhref = \"/3\"><a data-href=\"/no\" HREF=\"/4\"><a name=q><a href=\"/4\"><a href=''>")
    pages = frame("url string, html string, title string, Payload string, record_id string, lang string, extra int", [("u", html, "t", "p", "r", "l", 5)])
    row = warc.derive(warc.responses(pages, "2020-01-01T00:00:00Z")).collect()[0]
    assert row.links == ["/1?a=1&b=2", "/2", "/3", "/4", ""] and row.lang == "fr" and row.extra == 5
    assert row.title == "café 😀\ufffd&nosuch;&lt;" and row.text.split("\n")[:2] == [row.title, "1 2"]
    assert row.payload == html and row.record_id.startswith("<urn:uuid:")


@pytest.mark.parametrize("compression", ["none", "gzip"])
def test_warc_responses_read_back(spark, tmp_path, frame, compression):
    pages = frame("url string, html string", [("http://a/é", "<p>é</p>\n\n<a href=x>"), (None, None), ("http://b", "line\r\n\r\nWARC/1.1 is no record\n"),
                                              ("http://c", "cut WARC/1.1\r\nhere")])
    made = warc.responses(pages, "2020-01-01T00:00:00Z")
    warc.write(warc.derive(made).repartition(2), "response_record", str(tmp_path / "w"), compression)
    found = warc.read_responses(spark, str(tmp_path / "w"))
    whole = found.where("intact").drop("intact")
    assert sorted(whole.collect()) == sorted(made.where("target_uri <> 'http://c'").select(*whole.columns).collect())
    assert [r.target_uri for r in found.where("NOT intact").collect()] == ["http://c"]
    again = {r.record_id: r.metadata_record for r in warc.derive(whole).collect()}
    assert again == {r.record_id: r.metadata_record for r in warc.derive(made).collect() if r.target_uri != "http://c"}


def test_winnowing(odd, none):
    rows = winnowing.compared(odd).collect()
    assert len(rows) == len(ROWS) and all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    same = {}
    for r in rows:
        same.setdefault(r.doc_id, set()).add(r.fingerprint)
    assert same[5] == same[6] and same[1] == same[2] == {""} and len(same[10]) == 1
    assert winnowing.compared(none).count() == 0


def test_winnowing_keeps_positions_across_segments(spark):
    text = " ".join(f"w{i * 7919 % 10007}" for i in range(1500))
    row = spark.createDataFrame([(text,)], "text string").select(winnowing.fingerprint_of(winnowing.places(F.col("text"))).alias("fingerprint")).head()
    places = [int(p.split("@")[1]) for p in row.fingerprint.split(" ")]
    assert places == sorted(places) and max(b - a for a, b in zip(places, places[1:])) <= winnowing.W
    assert places[0] < winnowing.W and places[-1] >= len(text) - winnowing.K - winnowing.W + 1


def _tiny(rng, n):
    part = [f"w{i}" for i in range(60)]
    shared = [rng.choice(part) for _ in range(200)]
    out = []
    for i in range(n):
        at = rng.randrange(150)
        w = [rng.choice(part) for _ in range(rng.randrange(30))] + shared[at:at + rng.randrange(50)] + [rng.choice(part) for _ in range(rng.randrange(30))]
        out.append((i, " ".join(w)))
    return out + [(n, None), (n + 1, ""), (n + 2, out[3][1]), (n + 3, "x " * 400)]


def test_substring_dedup(spark, odd, none):
    import random
    docs = _tiny(random.Random(2), 40)
    wanted = brute.repeats(docs)
    rows = substring_dedup.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_text) for r in rows} == wanted
    assert all(sum(s.end - s.start for s in r.spans) == r.n_removed for r in rows) and any(r.longest >= 26 for r in rows)
    rows = substring_dedup.remove_repeats(odd).collect()
    assert len(rows) == len(ROWS) and {r.n_removed for r in rows if r.doc_id in (6, None)} == {0, 16}
    assert substring_dedup.remove_repeats(none).count() == 0


def test_suffix_dedup(spark, odd, none):
    import random
    docs = _tiny(random.Random(4), 40) + [(90, "é" * 300), (91, "日本" * 90 + "é" * 120)]
    wanted = brute.bytes_removed(docs)
    rows = suffix_dedup.remove_repeated_bytes(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)) for r in rows} == wanted
    rows = suffix_dedup.remove_repeated_bytes(odd, length=60).collect()
    assert len(rows) == len(ROWS)
    assert {r.n_removed for r in rows if r.doc_id == 6} == {len(LONG)} and {r.n_removed for r in rows if r.doc_id in (1, 2, 12)} == {0}
    assert suffix_dedup.remove_repeated_bytes(none).count() == 0


@pytest.mark.parametrize("nth", range(5))
def test_pipeline_stages(spark, odd, none, nth):
    name, work = corpus_pipeline.STAGES[nth]
    for docs in (odd, none):
        found = work(spark, docs, "/root/testdata/sf0.001")
        assert nth == 4 or found.columns == docs.columns
        kept = found.count()
        assert kept <= docs.count() and (kept > 0 or not docs.count())


def test_an_edge_that_emits_nothing_follows_no_way_back(monkeypatch):
    """Ways back are followed once where tokens are settled and once where a piece ends."""
    ranks = {bytes([b]): i for i, b in enumerate(b"abcd")} | {b"ab": 4, b"cd": 5, b"abcd": 6, b"bc": 7, b"aa": 8, b"aab": 9, b"dd": 10}
    machine, followed = bpe.Transducer(ranks), []
    plain = machine._way_back
    monkeypatch.setattr(machine, "_way_back", lambda end, lasts: followed.append(end) or plain(end, lasts))
    for n in range(1, 7):
        for piece in map(bytes, itertools.product(b"abcd", repeat=n)):
            assert machine.run(piece) == machine.merge(piece)
    assert len(followed) <= sum(bool(tokens) for _, tokens in machine.edges.values()) + len(machine.ends)
