"""Plain Python versions of the operators, for small tables."""
from __future__ import annotations

import hashlib
import re
from collections import defaultdict

import public_tokenizers
import tiktoken

BLANK = re.compile(r"[\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def words(text):
    return [w for w in BLANK.split(text or "") if w]


def lines(docs, min_chars=40, min_docs=5):
    """docs: (id, text) -> {id: (n_lines, n_dropped, kept)}"""
    key = lambda line: line.strip(" \t\n\v\f\r").translate(LOWER)
    holders = defaultdict(set)
    for i, text in docs:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders[key(line)].add(i)
    out = {}
    for i, text in docs:
        own = (text or "").split("\n")
        kept = [x for x in own if len(holders[key(x)]) < min_docs or i == max(holders[key(x)])]
        out[i] = (len(own), len(own) - len(kept), "\n".join(kept))
    return out


def near(docs, size, percent=80):
    """{id: (n_shingles, component)}"""
    sets = {}
    for i, text in docs:
        w = words((text or "").translate(LOWER))
        sets[i] = {tuple(w[j:j + size]) for j in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()
    parent = {i: i for i, _ in docs}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                ra, rb = root(a), root(b)
                parent[max(ra, rb)] = min(ra, rb)
    return {i: (len(sets[i]), root(i)) for i in ids}


def leaks(docs, items, size=5, percent=80):
    """{(doc, item)}: some window of the item's number of words is similar enough."""
    def weighed(w):
        k = min(size, len(w))
        found = defaultdict(int)
        for j in range(len(w) - k + 1):
            g = " ".join(w[j:j + k])
            found[g] += len(g)
        return found
    out = set()
    for item, text in items:
        b = words((text or "").lower())
        target = weighed(b)
        for i, t in docs:
            w = words((t or "").lower())
            if not b or not any(g in " ".join(w) for g in target):
                continue
            for j in range(max(1, len(w) - len(b) + 1)):
                own = weighed(w[j:j + len(b)])
                low = sum(min(v, target.get(g, 0)) for g, v in own.items())
                if 100 * low >= percent * (sum(own.values()) + sum(target.values()) - low) and low:
                    out.add((i, item))
                    break
    return out


def repeats(docs, size=13):
    """{id: (n_words, n_removed, kept)}"""
    first = {}
    for i, text in sorted(docs):
        w = words(text)
        for j in range(len(w) - size + 1):
            first.setdefault(tuple(w[j:j + size]), i)
    out = {}
    for i, text in docs:
        w, gone = words(text), set()
        for j in range(len(w) - size + 1):
            if first[tuple(w[j:j + size])] < i:
                gone.update(range(j, j + size))
        out[i] = (len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone))
    return out


def bytes_removed(docs, length=100):
    """{id: (n_bytes, n_removed, n_spans, kept)}"""
    seen, out = set(), {}
    for i, text in sorted(docs):
        b = (text or "").encode()
        cut = bytearray(len(b))
        for j in range(len(b) - length + 1):
            s = b[j:j + length]
            if s in seen:
                cut[j:j + length] = b"\1" * length
            seen.add(s)
        out[i] = (len(b), sum(cut), len(re.findall(b"\1+", bytes(cut))), bytes(c for c, x in zip(b, cut) if not x))
    return out


def encoding():
    import base64
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
