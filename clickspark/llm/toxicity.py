"""Toxicity by compression distance.

Two zstandard dictionaries are trained: one on windows of ordinary texts that
hold no telling fragment, one on pieces of toxic texts.  The pieces are the runs covered by telling
fragments: byte sequences inside words (with the spaces around them) that
turn up in far more toxic texts than their rate per byte of ordinary text lets
expect, by a Poisson likelihood ratio over parts of texts.  So whole words
tell as well as stems glued into many words, in any language, and a repeated
line counts little.

A text is cut into overlapping windows of the whole text.  Each window is
compressed against the ordinary dictionary and against the toxic one placed
before it; as the nearer content is the same, a window gets shorter only if
the toxic dictionary explains part of it.  Per text, the bytes saved in its
windows are counted at several thresholds, and a logistic calibration, fitted
on texts that the dictionaries did not see, turns the counts, per text and per
length, into a score.

Empty and null texts have no window with savings and get the score of such a
text.  Without training texts of both classes every score is the share of
label 1 (0 if there is none).
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickspark.llm.common import pick, positional
from clickspark.llm.labels import Logistic, held_out, sample

WINDOW, STRIDE = 64, 52  # bytes; the overlap holds a word of 12
BASE_BYTES = 16_384
MAX_TOXIC_BYTES = 8192  # most; the toxic dictionary has the size of its pieces
MAX_TRAIN = 1500  # texts of each class
MAX_BASE_WINDOWS = 20_000  # sampled for the ordinary dictionary
LEVELS = (1, 2, 3, 4, 5, 6, 8)
SIZES = (4, 6, 8, 10, 12)  # bytes of a fragment
PART_BYTES, MAX_PARTS = 512, 4  # a text counts for each such part that holds a fragment, up to four
MIN_TEXTS, MIN_RATIO = 4, 3.0  # toxic texts that hold a telling fragment, times the expected
MIN_GAIN = 6.0  # of its log likelihood ratio over the logarithm of the number of candidates
FOLDS, FOLD = 4, 2
CUT = 0.3
SPACE = re.compile(rb"[\x20\x09-\x0D]+")


def normalise(text: str) -> bytes:
    return b" " + SPACE.sub(b" ", text.encode().lower()).strip(b" ") + b" "


SEPARATES = np.ones(256, bool)
SEPARATES[[*range(ord("a"), ord("z") + 1), *range(128, 256)]] = False


def _fragments(data: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Size, offsets and hashes of the byte sequences that hold no separator
    but at their ends and begin and end between characters."""
    before = np.concatenate([[0], np.cumsum(SEPARATES[data])]).astype(np.int32)
    whole = np.concatenate([(data & 0xC0) != 0x80, [True]])
    h = np.zeros(len(data), np.uint64)
    for size in range(1, max(SIZES) + 1):
        n = len(data) - size + 1
        if n < 1:
            return
        h = h[:n] * np.uint64(1099511628211) + data[size - 1:] + np.uint64(1)
        if size in SIZES:
            inner = before[size - 1:size - 1 + n] - before[1:1 + n]
            at = np.flatnonzero((inner == 0) & whole[:n] & whole[size:size + n]).astype(np.int32)
            x = h[at]
            x = (x ^ x >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
            yield size, at, x ^ x >> np.uint64(32)


def _bytes(bodies: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(bodies), np.uint8)


def _chunks(bodies: list[bytes], limit: int = 1 << 20) -> Iterator[np.ndarray]:
    group, size = [], 0
    for b in bodies:
        group.append(b)
        size += len(b)
        if size >= limit:
            yield _bytes(group)
            group, size = [], 0
    yield _bytes(group)


def telling(plain: list[bytes], bad: list[bytes]) -> dict[int, np.ndarray]:
    """Sorted hashes, by size, of the fragments that toxic texts hold far more
    often than their share of the text lets expect: by the likelihood ratio of
    the two rates, where a text counts for each of its parts, up to MAX_PARTS."""
    sizes = np.array([len(b) for b in bad])
    # which text a byte is in, and which of its parts
    owner = np.repeat(np.arange(len(bad), dtype=np.int32), sizes)
    cell = np.concatenate([np.zeros(0, np.int32)] + [
        np.arange(n, dtype=np.int32) // PART_BYTES + at for n, at in
        zip(sizes, np.cumsum(-(-sizes // PART_BYTES)) - -(-sizes // PART_BYTES))]).astype(np.int32)
    counted = np.minimum(sizes, PART_BYTES * MAX_PARTS).sum()
    room = max(1, sum(map(len, plain)))
    share = counted / (counted + room)
    # by offset: the most toxic texts of a telling fragment that covers it
    most = np.zeros(len(owner), np.int32)
    out, told, rows = {}, [], {}
    for size, at, h in _fragments(_bytes(bad)):
        if not len(h):
            continue
        order = np.lexsort((cell[at], h))
        at = at[order]
        h, who, which = h[order], owner[at], cell[at]
        new = np.concatenate([[True], (h[1:] != h[:-1]) | (who[1:] != who[:-1])])
        held = np.concatenate([[True], new[1:] | (which[1:] != which[:-1])])
        seen = np.minimum(np.add.reduceat(held.astype(np.int64), np.flatnonzero(new)), MAX_PARTS)
        found, slot, texts = np.unique(h[new], return_inverse=True, return_counts=True)
        seen = np.bincount(slot, seen)
        found, texts, seen = (x[texts >= MIN_TEXTS] for x in (found, texts, seen))
        if len(found):
            rows[size] = found, texts, seen
        del order, h, who, which, new, held, at
    # the more candidates, the more chance makes one look telling
    least = MIN_GAIN + np.log(max(1, sum(len(found) for found, _, _ in rows.values())))
    used = {size: np.zeros(len(found), np.int64) for size, (found, _, _) in rows.items()}
    for body in _chunks(plain):
        for size, _, h in _fragments(body):
            if size in rows:
                found = rows[size][0]
                slot = np.minimum(np.searchsorted(found, h), len(found) - 1)
                used[size] += np.bincount(slot[found[slot] == h], minlength=len(found))
    for size, start, raw in _fragments(_bytes(bad)):
        if size not in rows:
            continue
        found, texts, seen = rows[size]
        total = seen + used[size]
        gain = (seen * np.log(seen / (total * share))
                + used[size] * np.log(np.maximum(used[size], 0.5) / (total * (1 - share))))
        rate = (used[size] + 0.5) / room * counted
        tells = (seen >= MIN_RATIO * rate) & (gain >= least)
        slot = np.minimum(np.searchsorted(found, raw), len(found) - 1)
        own = np.where((found[slot] == raw) & tells[slot], texts[slot], 0).astype(np.int32)
        start, raw, own = start[own > 0], raw[own > 0], own[own > 0]
        for shift in range(size):
            most[start + shift] = np.maximum(most[start + shift], own)
        told.append((size, start, raw, own))
    for size, start, raw, own in told:
        # a fragment that overlaps one of twice as many texts wherever it
        # stands only continues that one
        over = np.max([most[start + shift] for shift in range(size)], 0) if len(start) else own
        kept, slot = np.unique(raw, return_inverse=True)
        fresh = np.bincount(slot, 2 * own > over, len(kept))
        out[size] = kept[2 * fresh >= np.bincount(slot, minlength=len(kept))]
    return out


def _hits(data: np.ndarray, marks: dict[int, np.ndarray]) -> Iterator[tuple[int, np.ndarray]]:
    """Size and offsets of the telling fragments."""
    for size, at, h in _fragments(data):
        known = marks.get(size)
        if known is not None and len(known):
            yield size, at[known[np.minimum(np.searchsorted(known, h), len(known) - 1)] == h]


def pieces(body: bytes, marks: dict[int, np.ndarray]) -> list[bytes]:
    """The runs of ``body`` that its telling fragments cover."""
    cover = np.zeros(len(body) + 1, np.int64)
    for size, hit in _hits(np.frombuffer(body, np.uint8), marks):
        cover[hit] += 1
        cover[hit + size] -= 1
    on = np.concatenate([[0], np.cumsum(cover[:-1]) > 0, [0]]).astype(np.int8)
    return [body[s:e] for s, e in zip(np.flatnonzero(np.diff(on) == 1), np.flatnonzero(np.diff(on) == -1))]


def without(parts: list[bytes], marks: dict[int, np.ndarray]) -> list[bytes]:
    """The parts that hold no telling fragment."""
    ends = np.cumsum([len(p) for p in parts])
    held = np.zeros(len(parts), bool)
    for size, hit in _hits(_bytes(parts), marks):
        first, last = (np.searchsorted(ends, at, "right") for at in (hit, hit + size - 1))
        held[first[first == last]] = True
    return [p for p, h in zip(parts, held) if not h]


def windows(body: bytes) -> tuple[np.ndarray, np.ndarray]:
    starts = np.arange(0, max(1, len(body) - (WINDOW - STRIDE)), STRIDE)
    return starts, np.minimum(WINDOW, len(body) - starts)


def _dictionary(size: int, parts: list[bytes]) -> bytes:
    import zstandard
    if not parts:
        return b""
    try:
        return zstandard.train_dictionary(size, parts).as_bytes()
    except zstandard.ZstdError:  # too few samples to train on: take them as they are
        return b"".join(sorted(set(parts)))[-size:]


def _content(size: int, found: Counter) -> bytes:
    """A raw-content dictionary of the pieces that MIN_TEXTS texts hold, the
    most frequent last (nearest).  zstd's own trainer picks segments of texts,
    which cuts pieces of a few bytes apart."""
    kept = sorted((n, p) for p, n in found.items() if n >= MIN_TEXTS)
    return b"".join(p for _, p in kept)[-size:]


class Distance:
    """Bytes saved per window by the toxic dictionary."""

    def __init__(self, base: bytes, toxic: bytes):
        self.base, self.toxic = base, toxic
        self._ready = None

    def __getstate__(self):
        return self.base, self.toxic

    def __setstate__(self, state):
        self.__init__(*state)

    @classmethod
    def train(cls, ordinary: list[str], toxic: list[str]) -> Distance:
        plain = [normalise(t) for t in sorted(set(ordinary))]
        bad = [normalise(t) for t in sorted(set(toxic))]
        marks = telling(plain, bad) if plain and bad else {}
        found = Counter(p for b in bad for p in set(pieces(b, marks)))  # a text counts a piece once
        cut = [b[s:s + n] for b in plain for s, n in zip(*windows(b))]
        keep = np.random.default_rng(0).permutation(len(cut))[:MAX_BASE_WINDOWS]
        # marks also turn up in ordinary text by chance; explained by the
        # ordinary dictionary, they would save nothing anywhere
        return cls(_dictionary(BASE_BYTES, without([cut[i] for i in sorted(keep)], marks)),
                   _content(MAX_TOXIC_BYTES, found))

    def _compressors(self):
        if self._ready is None:
            import zstandard as z
            # the hash table is far larger than the dictionaries, so that none of
            # the far (toxic) content is pushed out of its rows
            how = z.ZstdCompressionParameters(
                window_log=17, chain_log=16, hash_log=18, search_log=4, min_match=6,
                target_length=32, strategy=z.STRATEGY_GREEDY, write_content_size=False,
                write_checksum=False, write_dict_id=False)
            self._ready = []
            for content in (self.base, self.toxic + self.base):
                d = z.ZstdCompressionDict(content or b" " * 8, dict_type=z.DICT_TYPE_RAWCONTENT)
                d.precompute_compress(compression_params=how)
                self._ready.append(z.ZstdCompressor(dict_data=d, compression_params=how))
        return self._ready

    def saved(self, data: bytes, segments: np.ndarray) -> np.ndarray:
        """``segments``: (offset, length) rows into ``data``."""
        import zstandard as z
        lengths = []
        for c in self._compressors():
            done = c.multi_compress_to_buffer(
                z.BufferWithSegments(data, segments.astype(np.uint64).tobytes()), threads=0)
            lengths.append(np.fromiter((len(x) for x in done), np.int64, len(done)))
        return lengths[0] - lengths[1]

    def features(self, texts: list[str]) -> np.ndarray:
        """One row per text, from all windows of all texts in one pass."""
        bodies = [normalise(t) for t in texts]
        cuts = [windows(b) for b in bodies]
        first = np.cumsum([0] + [len(b) for b in bodies])
        segments = np.concatenate([np.stack([s + first[i], n], 1) for i, (s, n) in enumerate(cuts)])
        owner = np.repeat(np.arange(len(texts)), [len(s) for s, _ in cuts])
        saved = self.saved(b"".join(bodies), segments)
        n = np.bincount(owner, minlength=len(texts))
        most = np.zeros(len(texts))
        np.maximum.at(most, owner, saved)
        at = [np.bincount(owner, saved >= v, len(texts)) for v in LEVELS]
        return np.stack([np.log1p(c) for c in at] + [np.log1p(100 * c / n) for c in at]
                        + [np.minimum(most, 12), np.log1p(n)], 1)


class Model:
    """``share``: of label 1 in the whole table, where the sample's differs."""

    def __init__(self, texts: list[str], labels: list[int], share: float | None = None):
        y = np.array(labels)
        self.share = float(y.mean()) if share is None and len(y) else share or 0.0
        self.distance = None
        if len(set(labels)) < 2:
            return
        fold = np.zeros(len(y), int)  # halves with an equal share of each class
        for c in (0, 1):
            fold[y == c] = np.random.default_rng(c).permutation((y == c).sum()) % 2
        x = None
        for k in (0, 1):  # each half is scored by the dictionaries of the other
            d = self._train(texts, y, fold != k)
            f = d.features([texts[i] for i in np.flatnonzero(fold == k)])
            x = np.zeros((len(texts), f.shape[1])) if x is None else x
            x[fold == k] = f
        # a text shorter than all of them counts as the shortest
        self.least = x[:, -1].min()
        self.calibration = Logistic(x, y, share=self.share)
        self.distance = self._train(texts, y, np.ones(len(y), bool))

    @staticmethod
    def _train(texts, y, use) -> Distance:
        return Distance.train([t for t, v, u in zip(texts, y, use) if u and not v],
                              [t for t, v, u in zip(texts, y, use) if u and v])

    def score(self, texts: list[str]) -> np.ndarray:
        if not texts or self.distance is None:
            return np.full(len(texts), self.share)
        x = self.distance.features(texts)
        x[:, -1] = np.maximum(x[:, -1], self.least)
        return self.calibration.predict(x)


def fit(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> Model:
    """Fit on at most ``max_train`` texts of each class outside the held-out
    fold, corrected to the share of label 1 among all rows outside it."""
    rows, share = sample(docs, labels, "toxic", FOLDS, FOLD, max_train)
    return Model([t for t, _ in rows], [y for _, y in rows], share)


def _groups(texts: list[str], limit: int = 1 << 20) -> Iterator[list[str]]:
    group, size = [], 0
    for t in texts:
        group.append(t)
        size += len(t)
        if size >= limit:
            yield group
            group, size = [], 0
    if group:
        yield group


def score_batches(model: Model, column: str, batches: Iterator[pa.RecordBatch]):
    for b in batches:
        texts = [t or "" for t in b.column(column).to_pylist()]
        got = [model.score(g) for g in _groups(texts)]
        yield b, np.concatenate(got) if got else np.zeros(0)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
          cut: float = CUT) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row."""
    src = pick(docs, doc_id=id_col, text=text_col)
    schema = T.StructType([src.schema["doc_id"], T.StructField("score", T.DoubleType())])

    def run(batches):
        for b, s in score_batches(model, "text", batches):
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(s)],
                                             names=["doc_id", "score"])
    return src.mapInArrow(run, schema).select(
        "doc_id", held_out(FOLDS, FOLD).alias("held_out"), "score",
        (F.col("score") >= cut).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, model: Model, text_col: str = "text",
               cut: float = CUT) -> DataFrame:
    """All columns of the rows that score below ``cut``."""
    flat, names = positional(docs)
    col = f"_p{names.index(text_col)}"

    def run(batches):
        for b, s in score_batches(model, col, batches):
            yield b.filter(pa.array(s < cut))
    return flat.mapInArrow(run, flat.schema).toDF(*names)
