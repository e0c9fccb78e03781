"""Token counts of whole texts, huge ones by overlapping chunks.

The tokenizer normalises, drops white space and splits before it merges, so
no token spans white space: a word start after white space is a stable
boundary, and what stands before it never changes the tokens after it.  That
is used twice.

* Texts are cut at white space and the library's count of each word is
  memoised (bounded, per worker).
* Huge texts (over ``chunk`` characters) are encoded in overlapping chunks,
  with offsets.  Two neighbours are spliced at a word start in their overlap
  where both have a token start, and where all later token starts of the
  overlap agree up to its last word.  If there is none, the overlap is
  doubled, in the end up to the rest of the text; so the count is that of the
  whole text in one go, and memory that of a chunk.

Null texts count as empty (0 tokens).  Special strings inside a text count as
the library takes them by default.
"""

from __future__ import annotations

import os
import re
from bisect import bisect_left

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickspark.llm.common import TwoGenerations, map_text, pick

CHUNK = 32_768
OVERLAP = 512
MEMO_WORDS = 500_000
MEMO_CHARS = 64
#: Python's split() also cuts at the separators 1C to 1F, which the
#: tokenizer does not take as white space.
ODD = re.compile("[\x1c-\x1f]")
PLAIN = re.compile(r"[ \t\n\r]+")
SPACE = re.compile(r"[ \t\n\r]")
WORD_START = re.compile(r"(?<=[ \t\n\r])[^ \t\n\r]")


class Counter:
    def __init__(self, data: bytes, chunk: int = CHUNK, overlap: int = OVERLAP):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark owns the cores
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_buffer(data)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.chunk, self.overlap = chunk, overlap
        self.memo = TwoGenerations(MEMO_WORDS)

    def library(self, texts: list[str]) -> list[int]:
        return [len(e.ids) for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def count(self, text: str) -> int:
        if len(text) > self.chunk:
            return self.count_huge(text)
        words = PLAIN.split(text) if ODD.search(text) else text.split()
        get = self.memo.get
        counts = list(map(get, words))
        if None in counts:
            known: dict[str, int] = {}
            new = list({w for w, c in zip(words, counts) if c is None})
            for w, n in zip(new, self.library(new)):
                known[w] = n
                if len(w) <= MEMO_CHARS:
                    self.memo.put(w, n)
            counts = [known[w] if c is None else c for w, c in zip(words, counts)]
        return sum(counts)

    def starts(self, text: str, at: int, end: int) -> list[int]:
        """Token starts of ``text[at:end]`` as offsets into the text."""
        enc = self.tok.encode(text[at:end], add_special_tokens=False)
        return [at + s for s, _ in enc.offsets]

    def count_huge(self, text: str) -> int:
        total, at, size = 0, 0, len(text)
        end = min(size, self.chunk)
        have = self.starts(text, at, end)
        low = 0  # tokens of `have` before this index belong to earlier chunks
        while end < size:
            overlap, reach = self.overlap, end
            while True:
                begin = max(at, end - overlap)
                if begin > at and not WORD_START.search(text, begin + 1, end):
                    # a run without white space crosses the boundary: begin
                    # before it, and take it to its end, so it is encoded at
                    # most twice however long it is
                    last = max(text.rfind(c, at, end) for c in " \t\n\r")
                    begin = max(at, last - self.overlap) if last > at else at
                    gap = SPACE.search(text, end)
                    reach = gap.start() if gap else size
                stop = min(size, reach + self.chunk)
                if begin == at:  # widened to the whole chunk: encode both in one go
                    have_next, cut_i, cut_j = self.starts(text, at, stop), None, None
                else:
                    have_next = self.starts(text, begin, stop)
                    cut_i, cut_j = self.splice(text, have, have_next, begin, end)
                if begin == at or cut_i is not None:
                    break
                overlap = 2 * max(overlap, end - begin)
            if cut_i is None:
                have = have_next  # same begin, so `low` still holds
            else:
                total += max(cut_i, low) - low
                have, low, at = have_next, cut_j, begin
            end = stop
        return total + len(have) - low

    @staticmethod
    def splice(text: str, left: list[int], right: list[int], begin: int, end: int):
        """Indices into the two lists of the first proven common boundary."""
        words = [m.start() for m in WORD_START.finditer(text, begin + 1, end)]
        if not words:
            return None, None
        last = words[-1]  # what follows it in the overlap may be cut off
        for p in words:
            i, j = bisect_left(left, p), bisect_left(right, p)
            li, rj = bisect_left(left, last), bisect_left(right, last)
            if left[i:li] == right[j:rj] and (p == last or (i < li and left[i] == p)):
                return i, j
        return None, None


_COUNTERS: dict[tuple, Counter] = {}


def _counter(data: bytes, chunk: int, overlap: int) -> Counter:
    key = (hash(data), chunk, overlap)
    if key not in _COUNTERS:
        _COUNTERS.clear()
        _COUNTERS[key] = Counter(data, chunk, overlap)
    return _COUNTERS[key]


def count_tokens(df: DataFrame, tokenizer_path: str, id_col: str = "doc_id",
                 text_col: str = "text", limit: int = 2048, chunk: int = CHUNK,
                 overlap: int = OVERLAP) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every row.  The tokenizer
    file (fixed size) is read on the driver and broadcast."""
    with open(tokenizer_path, "rb") as f:
        data = df.sparkSession.sparkContext.broadcast(f.read())
    src = pick(df, doc_id=id_col, text=text_col)
    counted = map_text(
        src, lambda c, t: (len(t.encode()), c.count(t)),
        [T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())],
        make=lambda: _counter(data.value, chunk, overlap))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
