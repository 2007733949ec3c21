"""Byte-level BPE as a lazily determinised finite-state transducer, and a streaming decoder.

For a rank vocabulary the merges of a piece have one result, and it can be read left to right: a sequence of tokens is
the merge result exactly if each neighbouring pair is (both tokens are what merging their joined bytes gives). So the
last token of every prefix of a piece is determined by the prefixes before it. The transducer's state is the last
token emitted and the bytes read since. Reading a byte finds the last token of the longer prefix, keeps the positions
where a vocabulary token could still begin, and emits the tokens that the ways back from all of them share; no token is
longer than the vocabulary's longest, so the lookahead is bounded. States and edges are made when first met and kept in a
table; when it is full it is emptied, which costs time but changes no result.

Decoding feeds the bytes of the tokens through an incremental UTF-8 state machine, which holds an unfinished character
back until its last byte comes; what is not UTF-8 becomes U+FFFD.
"""
from __future__ import annotations

import base64
import codecs
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.llm.common import arrow_map, widened, without, worker_cache

#: Entries of the transducer's tables, and of each generation of the table of whole pieces.
MAX_EDGES = 900_000
MAX_PIECES = 250_000
#: Tokens decoded at a time.
BLOCK = 4096


def read_ranks(lines: Iterable[bytes]) -> dict[bytes, int]:
    """token bytes -> rank, from lines of base64 and number."""
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class Transducer:
    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.token_bytes = {i: t for t, i in ranks.items()}
        self.sizes = {i: len(t) for t, i in ranks.items()}
        # every prefix of a token -> its rank, -1 where it is no token itself
        self.starts = {t[:n]: -1 for t in ranks for n in range(1, len(t))} | ranks
        self.pairs: dict[tuple[int, int], bool] = {}
        self.grown: dict[int, tuple[list, list, bool]] = {}
        self.clear()

    def clear(self) -> None:
        # last token emitted, bytes since, last token of each prefix of them, positions where a token can begin
        self.states: list[tuple[int, bytes, tuple[int, ...], tuple[int, ...]]] = [(-1, b"", (), (0,))]
        self.index: dict[tuple[int, bytes], int] = {(-1, b""): 0}
        self.edges: dict[int, tuple[int, tuple[int, ...]]] = {}
        self.ends: dict[int, tuple[int, ...]] = {}

    def merge(self, piece: bytes) -> list[int]:
        """The merges themselves, lowest rank first; used on pairs of tokens when an edge is made."""
        parts = [piece[i:i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            rank, at = min((self.ranks.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1))
            if rank == 1 << 60:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def sides(self, token: int) -> tuple[list, list, bool]:
        """How the first and the last part of a token grow while its bytes are merged: (rank, part) from the single
        byte on; and whether the merges give the token, in order of rank."""
        if token not in self.grown:
            raw = self.token_bytes[token]
            parts = [raw[i:i + 1] for i in range(len(raw))]
            first, last, rank, ordered = [(-1, parts[0])], [(-1, parts[-1])], -1, True
            while len(parts) > 1:
                before = rank
                rank, at = min((self.ranks.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1))
                if rank == 1 << 60:
                    break
                ordered &= before <= rank
                parts[at:at + 2] = [parts[at] + parts[at + 1]]
                if at == 0:
                    first.append((rank, parts[0]))
                if at == len(parts) - 1:
                    last.append((rank, parts[-1]))
            self.grown[token] = (first, last, ordered and len(parts) == 1)
        return self.grown[token]

    def fits(self, left: int, right: int) -> bool:
        """Whether merging the joined bytes of two tokens gives the two (a lone token: itself).

        Merges run in order of rank, so while the two grow apart, their touching parts are known at each rank; the pair
        stays apart if no touching parts form a token that would be merged before either part grows.
        """
        key = (left, right)
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) > MAX_EDGES:
                self.pairs.clear()
            known = self.pairs[key] = self._apart(left, right)
        return known

    def _apart(self, left: int, right: int) -> bool:
        if left < 0:
            return self.merge(self.token_bytes[right]) == [right]
        (_, ends, plain), (begins, _, plain_right) = self.sides(left), self.sides(right)
        if not (plain and plain_right):
            return self.merge(self.token_bytes[left] + self.token_bytes[right]) == [left, right]
        i = j = 0
        while True:
            across = self.ranks.get(ends[i][1] + begins[j][1])
            left_grows = ends[i + 1][0] if i + 1 < len(ends) else 1 << 60
            right_grows = begins[j + 1][0] if j + 1 < len(begins) else 1 << 60
            if across is not None and across < left_grows and across <= right_grows:  # of equal ranks the left is first
                return False
            if left_grows == right_grows == 1 << 60:
                return True
            if left_grows <= right_grows:
                i += 1
            else:
                j += 1

    def _way_back(self, end: int, lasts: tuple[int, ...]) -> list[int]:
        """Tokens from the start of the pending bytes to position ``end``."""
        way: list[int] = []
        while end > 0:
            way.append(lasts[end - 1])
            end -= self.sizes[way[-1]]
        return way[::-1]

    def _settled(self, live: list[int], lasts: tuple[int, ...]) -> int:
        """The last position that lies on the ways back from all of the ``live`` ones, which are in order."""
        at, sizes = live[-1], self.sizes
        for other in live[-2::-1]:
            while at != other:
                if at > other:
                    at -= sizes[lasts[at - 1]]
                else:
                    other -= sizes[lasts[other - 1]]
        return at

    def step(self, state: int, byte: int) -> tuple[int, tuple[int, ...]]:
        """Make the edge of a state for a byte: next state and tokens emitted."""
        before, pending, known, live = self.states[state]
        pending += bytes([byte])
        still, starts = [], self.starts
        last = -1  # stays so where the true last token begins before what was emitted; no token can begin after it
        for p in live:
            token = starts.get(pending[p:])
            if token is not None:
                still.append(p)
                if last < 0 <= token and self.fits(known[p - 1] if p else before, token):
                    last = token
        lasts = (*known, last)
        if last >= 0:
            still.append(len(pending))  # a token may begin with the next byte
        # nothing is settled while a token may begin where the pending bytes do
        cut = self._settled(still, lasts) if still[0] else 0
        if not cut:
            key = (before, pending)
            if key not in self.index:
                self.index[key] = len(self.states)
                self.states.append((before, pending, lasts, tuple(still)))
            edge = self.edges[state << 8 | byte] = (self.index[key], ())
            return edge
        shared = self._way_back(cut, lasts)
        key = (shared[-1], pending[cut:])
        if key not in self.index:
            self.index[key] = len(self.states)
            self.states.append((*key, lasts[cut:], tuple([p - cut for p in still])))
        edge = (self.index[key], tuple(shared))
        self.edges[state << 8 | byte] = edge
        return edge

    def run(self, piece: bytes) -> list[int]:
        """Tokens of one piece."""
        if len(self.edges) > MAX_EDGES:
            self.clear()
        state, out, edges = 0, [], self.edges
        for byte in piece:
            edge = edges.get(state << 8 | byte) or self.step(state, byte)
            state, tokens = edge
            if tokens:
                out += tokens
        rest = self.ends.get(state)
        if rest is None:
            rest = self.ends[state] = tuple(self._way_back(len(self.states[state][1]), self.states[state][2]))
        out += rest
        return out


class Codec:
    """Encoder and decoder for one vocabulary and one pattern that splits texts into pieces."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.fst, self.pattern = Transducer(ranks), regex.compile(pattern)
        # pieces met lately and before that; the older ones go when the younger table is full, so common ones stay
        self.pieces: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}

    def _piece(self, piece: str) -> tuple[int, ...]:
        known = self.older.get(piece)
        if known is None:
            raw = piece.encode("utf-8", "replace")
            whole = self.fst.ranks.get(raw)  # a piece that is a token is that token, reachable by merges or not
            known = (whole,) if whole is not None else tuple(self.fst.run(raw))
        if len(piece) <= 64:
            if len(self.pieces) >= MAX_PIECES:
                self.pieces, self.older = {}, self.pieces
            self.pieces[piece] = known
        return known

    def encode(self, text: str) -> list[int]:
        ids: list[int] = []
        for piece in self.pattern.findall(text):
            ids += self.pieces.get(piece) or self._piece(piece)
        return ids

    def stream(self, ids: list[int]) -> Iterator[tuple[bytes, str]]:
        """Bytes of a block of tokens, and their text as far as its characters are complete."""
        machine = codecs.getincrementaldecoder("utf-8")("replace")
        for i in range(0, max(1, len(ids)), BLOCK):
            block = b"".join(map(self.fst.token_bytes.__getitem__, ids[i:i + BLOCK]))
            yield block, machine.decode(block, final=i + BLOCK >= len(ids))


_CODECS: dict[tuple[str, str], Codec] = worker_cache("bpe")


def codec(path: str, pattern: str) -> Codec:
    """One codec per Python worker, until another operator's task runs in it."""
    if (path, pattern) not in _CODECS:
        with open(path, "rb") as lines:
            _CODECS[path, pattern] = Codec(read_ranks(lines), pattern)
    return _CODECS[path, pattern]


RESULTS = {"ids": "array<int>", "n_tokens": "long", "decoded": "string", "ids_sha256": "string", "decoded_sha256": "string"}


def encode_documents(docs: DataFrame, path: str, pattern: str, text_col: str = "text",
                     results: tuple[str, ...] = tuple(RESULTS)) -> DataFrame:
    """The documents with the ``results``: token ids, their number, the decoded text, and digests of ids and decoded bytes.

    A NULL or empty text has no tokens and decodes to ''. ``path`` is a rank file installed on every executor. An input
    column named like a result column is replaced.
    """
    docs = without(docs, *RESULTS)
    out = docs.columns
    at = out.index(text_col)

    def work(batches):
        own = codec(path, pattern)
        for batch in batches:
            found = {name: [] for name in RESULTS}
            for text in batch.column(at).to_pylist():
                listed = own.encode(text or "")
                tokens = np.array(listed, dtype="<u4")
                digest, texts = hashlib.sha256(), []
                for block, part in own.stream(listed):
                    digest.update(block)
                    texts.append(part)
                found["ids"].append(tokens.view("<i4"))
                found["n_tokens"].append(len(tokens))
                found["decoded"].append("".join(texts))
                found["ids_sha256"].append(hashlib.sha256(tokens.tobytes()).hexdigest())
                found["decoded_sha256"].append(digest.hexdigest())
            types = {"ids": pa.list_(pa.int32()), "n_tokens": pa.int64()}
            yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array(found[r], types.get(r, pa.string())) for r in results]],
                                             names=[*out, *results])

    return arrow_map(docs, work, widened(docs, ", ".join(f"{r} {RESULTS[r]}" for r in results)), owner="bpe")
