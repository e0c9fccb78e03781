"""Byte-level BPE encoding and decoding in linear time.

A token sequence is the BPE encoding of its bytes exactly when every
adjacent pair of tokens is the encoding of its own bytes.  So a piece is
encoded by backtracking: at each byte offset take the longest vocabulary
token that starts there (one Aho-Corasick pass finds them all; bytes are
mapped to Latin-1 characters for it), step to shorter prefixes while the
pair with the token before is not compatible, and go back one token when
none is left.  An offset given up once is never entered again, because the
encoding of the bytes before it is unique.  Pair compatibility is decided
once by running the merges on the two tokens' bytes and memoised.

Texts are cut by the split pattern.  No match of it spans the step from a
non-space to a space character, so texts are first cut there and the ids of
such segments are memoised (bounded).  Results: null and empty texts have
no ids; repeated rows each get their own row.
"""

from __future__ import annotations

import base64
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from clickspark.llm.common import TwoGenerations, pick

#: Space characters as the split pattern sees them: Unicode white space,
#: which Python's \s equals but for the four separators 1C to 1F.
SEGMENT = re.compile(r"[^\S\x1c-\x1f]*[\S\x1c-\x1f]+|[^\S\x1c-\x1f]+")
MEMO_SEGMENTS = 250_000
MEMO_PIECES = 100_000
MEMO_PAIRS = 500_000
MEMO_CHARS = 48


def parse_ranks(data: bytes) -> dict[bytes, int]:
    """Token bytes -> rank of a rank file (base64 and rank per line)."""
    return {base64.b64decode(t): int(r) for t, r in (ln.split() for ln in data.splitlines() if ln)}


def merge_ranks(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The defining merges: join the adjacent pair of lowest rank (leftmost
    first) until no pair is in the vocabulary."""
    parts = [piece[i:i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        best, at = None, -1
        for i in range(len(parts) - 1):
            r = ranks.get(parts[i] + parts[i + 1])
            if r is not None and (best is None or r < best):
                best, at = r, i
        if best is None:
            break
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
    return [ranks[p] for p in parts]


class ByteBPE:
    """Encoder and decoder for one rank file and split pattern."""

    def __init__(self, rank_data: bytes, pattern: str):
        import ahocorasick
        import regex
        self.ranks = parse_ranks(rank_data)
        size = max(self.ranks.values()) + 1
        self.bytes_of: list[bytes] = [b""] * size
        for t, r in self.ranks.items():
            self.bytes_of[r] = t
        self.len_of = [len(t) for t in self.bytes_of]
        self.blob = np.frombuffer(b"".join(self.bytes_of), np.uint8)
        self.lengths = np.array(self.len_of)
        self.offsets = np.cumsum(self.lengths) - self.lengths
        self.split = regex.compile(pattern).findall
        # A token that its own merges do not give can only stand for a whole
        # piece, so it takes no part in the search.
        self.shorter = [-1] * size
        self.automaton = ahocorasick.Automaton()
        usable = {t for t, r in self.ranks.items() if len(t) == 1 or merge_ranks(t, self.ranks) == [r]}
        for t in usable:
            r = self.ranks[t]
            self.automaton.add_word(t.decode("latin-1"), r)
            for n in range(len(t) - 1, 0, -1):
                if t[:n] in usable:
                    self.shorter[r] = self.ranks[t[:n]]
                    break
        self.automaton.make_automaton()
        self.pairs: list[dict[int, bool]] = [{} for _ in range(size)]
        self.n_pairs = 0
        self.segments = TwoGenerations(MEMO_SEGMENTS)
        self.pieces = TwoGenerations(MEMO_PIECES)

    def compatible(self, a: int, b: int) -> bool:
        if self.n_pairs >= MEMO_PAIRS:
            for seen in self.pairs:
                seen.clear()
            self.n_pairs = 0
        ok = merge_ranks(self.bytes_of[a] + self.bytes_of[b], self.ranks) == [a, b]
        self.pairs[a][b] = ok
        self.n_pairs += 1
        return ok

    def encode_piece(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        n, len_of, shorter, pairs = len(piece), self.len_of, self.shorter, self.pairs
        longest = [0] * n
        for end, tok in self.automaton.iter(piece.decode("latin-1")):
            longest[end + 1 - len_of[tok]] = tok  # later ends are longer
        given_up = bytearray(n + 1)
        tok = longest[0]
        ids, pos, last = [tok], len_of[tok], tok
        tok = longest[pos]
        while True:
            # here ids encode piece[:pos], and tok is to be tried at pos
            end = pos + len_of[tok]
            if not given_up[end]:
                ok = pairs[last].get(tok) if ids else True
                if ok is None:
                    ok = self.compatible(last, tok)
                if ok:
                    ids.append(tok)
                    if end == n:
                        return ids
                    pos, last = end, tok
                    tok = longest[end]
                    continue
            tok = shorter[tok]
            while tok < 0:
                given_up[pos] = 1
                tok = ids.pop()
                pos -= len_of[tok]
                last = ids[-1] if ids else -1
                tok = shorter[tok]

    def encode_segment(self, seg: str) -> bytes:
        # a space and letters, or letters alone, are one piece
        rest = seg[1:] if seg[0] == " " else seg
        out = []
        for p in [seg] if rest.isalpha() else self.split(seg):
            ids = self.pieces.get(p)
            if ids is None:
                found = self.encode_piece(p.encode())
                ids = struct.pack(f"<{len(found)}I", *found)
                if len(p) <= MEMO_CHARS:
                    self.pieces.put(p, ids)
            out.append(ids)
        return b"".join(out)

    def encode(self, text: str) -> bytes:
        """Ids of the text as little-endian unsigned 32-bit integers."""
        memo, out = self.segments, []
        young = memo.young
        for seg in SEGMENT.findall(text):
            ids = young.get(seg)
            if ids is None:
                ids = memo.get(seg)
                if ids is None:
                    ids = self.encode_segment(seg)
                    if len(seg) <= MEMO_CHARS:
                        memo.put(seg, ids)
                young = memo.young
            out.append(ids)
        return b"".join(out)

    def decode(self, ids: bytes) -> bytes:
        i = np.frombuffer(ids, "<u4")
        if not len(i):
            return b""
        n = self.lengths[i]
        ends = np.cumsum(n)
        at = np.arange(ends[-1]) + np.repeat(self.offsets[i] - (ends - n), n)
        return self.blob[at].tobytes()


_CODECS: dict[tuple, ByteBPE] = {}


def _codec(data: bytes, pattern: str) -> ByteBPE:
    key = (hash(data), pattern)
    if key not in _CODECS:  # kept by a reused Python worker
        _CODECS.clear()
        _CODECS[key] = ByteBPE(data, pattern)
    return _CODECS[key]


def _read(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def encode_decode(df: DataFrame, rank_path: str, pattern: str, id_col: str = "doc_id",
                  text_col: str = "text", keep_text: bool = False) -> DataFrame:
    """Encode every whole text and decode the ids again.

    Returns ``doc_id`` (as given, null too), ``ids`` (binary, little-endian
    unsigned 32-bit), ``decoded`` (binary) and, if asked for, ``text``.  The
    rank file (fixed size) is read on the driver and broadcast.
    """
    data = df.sparkSession.sparkContext.broadcast(_read(rank_path))
    src = pick(df, doc_id=id_col, text=text_col)
    schema = T.StructType([src.schema["doc_id"], T.StructField("ids", T.BinaryType()),
                           T.StructField("decoded", T.BinaryType())]
                          + [src.schema["text"]] * keep_text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(data.value, pattern)
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                ids = [codec.encode(t or "") for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(ids, pa.binary()),
                     pa.array([codec.decode(x) for x in ids], pa.binary())]
                    + [part.column(1)] * keep_text, names=schema.names)
    return src.mapInArrow(run, schema)
