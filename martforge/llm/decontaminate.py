"""Benchmark decontamination by SimHash of item-sized windows."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martforge.llm.common import chunks

#: Words in a shingle; largest fingerprint distance; least weighted Jaccard similarity.
WORDS, RADIUS, SIMILARITY = 5, 20, 0.8
#: Benchmark words that one index may hold: a larger benchmark is indexed and
#: searched in several blocks of items, so what is broadcast stays bounded.
BLOCK_WORDS = 500_000
REMEMBER = 400_000

_RNG = np.random.default_rng(10)
_PLACE = _RNG.integers(1, 1 << 63, WORDS, dtype=np.uint64) | np.uint64(1)
_GAP = -1                       # between texts; every word is another number


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` words from each word on."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    x = np.full(n, size, np.uint64)
    for j in range(size):
        x += words[j:j + n].view(np.uint64) * _PLACE[j]
    return _mix(x)


def normal(word: str) -> str:
    """A word in lower case without the signs around it ('' if it has only signs)."""
    if word.isalnum():
        return word
    start, end = 0, len(word)
    while start < end and not word[start].isalnum():
        start += 1
    while end > start and not word[end - 1].isalnum():
        end -= 1
    return word[start:end]


class Words(dict):
    """Numbers of words: those of the benchmark from 0, others below -2 by
    hash, words of signs only None; remembers what it has seen."""

    def __init__(self, known: dict[str, int]):
        super().__init__()
        self.known = known

    def __missing__(self, word: str):
        w = normal(word)
        n = None if not w else self.known[w] if w in self.known else -3 - (hash_word(w) >> 2)
        if len(self) < REMEMBER:
            self[word] = n
        return n

    def of(self, text: str) -> list[int]:
        return [n for n in map(self.__getitem__, text.lower().split()) if n is not None]


def hash_word(word: str) -> int:
    import xxhash
    return xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"), 1)


class Index:
    """A block of benchmark items, ready to be searched in a Python worker."""

    def __init__(self, items: list[tuple[int, str]]):
        known: dict[str, int] = {}
        numbers = []
        for _, text in items:
            cut = [w for w in map(normal, text.lower().split()) if w]
            numbers.append(np.array([known.setdefault(w, len(known)) for w in cut], np.int64))
        used = [k for k, n in enumerate(numbers) if len(n)]
        self.ids = [items[k][0] for k in used]
        self.words = known
        self.size = [len(numbers[k]) for k in used]
        self.k = [min(WORDS, n) for n in self.size]
        counts = [Counter(shingle_hashes(numbers[k], s).tolist()) for k, s in zip(used, self.k)]
        df = Counter(h for c in counts for h in c)
        self.items_of: dict[int, list[int]] = {}
        for i, c in enumerate(counts):
            for h in c:
                self.items_of.setdefault(h, []).append(i)
        self.top = float(np.log1p(len(used)))                       # weight of a shingle of no or one item
        self.weight = {h: float(np.log1p(len(used) / n)) for h, n in df.items()}
        self.counts = counts
        self.mass = [sum(self.weight[h] * n for h, n in c.items()) for c in counts]
        self.by_size: dict[int, np.ndarray] = {s: np.sort(np.array([h for h, own in self.items_of.items()
                                                                    if any(self.k[i] == s for i in own)], np.uint64)) for s in set(self.k)}
        prints = [fingerprint_rows(np.array(list(c.elements()), np.uint64), self)[-1] for c in counts]
        self.prints = [int(p) for p in prints]
        cuts = [64 * b // (RADIUS + 1) for b in range(RADIUS + 2)]
        self.blocks = [(a, (1 << b - a) - 1) for a, b in zip(cuts, cuts[1:])]
        self.tables: list[dict[int, list[int]]] = []
        for shift, mask in self.blocks:
            table: dict[int, list[int]] = {}
            for i, p in enumerate(self.prints):
                table.setdefault(p >> shift & mask, []).append(i)
            self.tables.append(table)

    def near(self, fingerprint: int, size: int) -> set[int]:
        """Items of ``size`` words within ``RADIUS`` bits: at most so many
        differing bits leave one of the ``RADIUS`` + 1 blocks equal."""
        found: set[int] = set()
        for (shift, mask), table in zip(self.blocks, self.tables):
            found.update(table.get(fingerprint >> shift & mask, ()))
        return {i for i in found if self.size[i] == size and (self.prints[i] ^ fingerprint).bit_count() <= RADIUS}

    def similarity(self, item: int, hashes: list[int]) -> float:
        """Weighted Jaccard similarity of an item's and a window's shingles."""
        own, both, mass = self.counts[item], 0.0, 0.0
        for h, n in Counter(hashes).items():
            w = self.weight.get(h, self.top)
            mass += w * n
            both += w * min(n, own[h])
        return both / (mass + self.mass[item] - both)


def fingerprint_rows(hashes: np.ndarray, index: Index, window: int | None = None) -> np.ndarray:
    """SimHash (uint64) of each window of ``window`` shingles (None: of all)."""
    window = window or len(hashes)
    weights = np.array([index.weight.get(h, index.top) for h in hashes.tolist()])
    signs = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little") * 2.0 - 1
    total = np.concatenate((np.zeros((1, 64)), np.cumsum(signs * weights[:, None], axis=0)))
    return np.packbits(total[window:] - total[:-window] > 1e-9, axis=1, bitorder="little").view("<u8")[:, 0]


def search(index: Index, words: Words, texts: list[str]) -> list[tuple[int, int, float, int, int]]:
    """(text, item, similarity, first word, words) of the best window of each
    item in each text.

    A window that shares no shingle with an item has similarity zero to it,
    so windows are formed only around shared shingles; every other step sees
    all the windows that could pass.
    """
    numbers = [words.of(t) for t in texts]
    sizes = np.fromiter(map(len, numbers), np.int64, len(numbers))
    flat = np.array([n for own in numbers for n in (*own, _GAP)], np.int64)
    ends = np.cumsum(sizes + 1) - 1
    known = flat >= 0
    out = []
    for k, listed in index.by_size.items():
        if len(flat) < k:
            continue
        all_known = known[:len(flat) - k + 1].copy()
        for j in range(1, k):
            all_known &= known[j:len(flat) - k + 1 + j]
        at = np.flatnonzero(all_known)
        if not len(at):
            continue
        x = np.full(len(at), k, np.uint64)
        for j in range(k):
            x += flat[at + j].view(np.uint64) * _PLACE[j]
        x = _mix(x)
        place = np.searchsorted(listed, x)
        hit = listed[np.minimum(place, len(listed) - 1)] == x
        at, x = at[hit], x[hit]
        text_of = np.searchsorted(ends, at, side="right")
        spots: dict[tuple[int, int], list[int]] = {}
        for p, h, t in zip(at.tolist(), x.tolist(), text_of.tolist()):
            for i in index.items_of[h]:
                if index.k[i] == k:
                    spots.setdefault((t, index.size[i]), []).append(p)
        best: dict[tuple[int, int], tuple[float, int, int]] = {}
        for (t, size), where in spots.items():
            begin, end = int(ends[t] - sizes[t]), int(ends[t])
            for lo, hi in _regions(sorted(set(where)), size, k, begin, end):
                own = shingle_hashes(flat[lo:hi], k)
                span = min(size, hi - lo) - k + 1
                for s, f in enumerate(fingerprint_rows(own, index, span).tolist()):
                    for i in index.near(f, size):
                        value = index.similarity(i, own[s:s + span].tolist())
                        if value >= SIMILARITY and value > best.get((t, i), (0.0, 0, 0))[0]:
                            best[t, i] = (value, lo + s - begin, min(size, hi - lo))
        out += [(t, i, *b) for (t, i), b in best.items()]
    return sorted(out)


def _regions(where: list[int], size: int, k: int, begin: int, end: int) -> Iterator[tuple[int, int]]:
    """Word ranges that hold every window of ``size`` words (or the whole
    text, if shorter) with one of the shared shingles at ``where``."""
    lo = hi = None
    for p in where:
        a, b = max(begin, p + k - size), min(end, p + size)
        if hi is not None and a <= hi:
            hi = max(hi, b)
            continue
        if hi is not None:
            yield _wide(lo, hi, size, begin, end)
        lo, hi = a, b
    if hi is not None:
        yield _wide(lo, hi, size, begin, end)


def _wide(lo: int, hi: int, size: int, begin: int, end: int) -> tuple[int, int]:
    if hi - lo < size:
        lo = max(begin, min(lo, end - size))
        hi = min(end, max(hi, lo + size))
    return lo, hi


def _blocks(benchmark: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple[int, str]]]:
    block, words = [], 0
    for r in (benchmark.filter(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).select(id_col, text_col)
              .distinct().toLocalIterator()):
        n = len(r[1].split())
        if block and words + n > BLOCK_WORDS:
            yield block
            block, words = [], 0
        block.append((r[0], r[1]))
        words += n
    if block:
        yield block


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          item_col: str = "item_id") -> DataFrame:
    """(id_col, item_id, similarity, first_word, n_words): the most similar
    window of each leaked item in each whole text.

    Words are lower-cased and lose the signs around them.  Windows have the
    item's number of words (a shorter text is one window), shingles five (all
    of a shorter item).  A window counts if its SimHash lies within ``RADIUS``
    bits of the item's and its weighted Jaccard similarity is 0.8 or more; a
    shingle's weight falls with the number of items that hold it.  Null or
    empty texts and items leak nothing; rows with a null id are left out;
    repeated rows give repeated rows; of several windows alike the first is
    returned; an empty table gives no rows.  One map-only pass for each block
    of ``BLOCK_WORDS`` benchmark words (a benchmark below that is one block).
    """
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, {item_col} long, similarity double, first_word long, n_words long"
    own = docs.filter(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).select(id_col, text_col)
    parts = [_search_block(spark, own, block, schema, item_col) for block in _blocks(benchmark, item_col, "text")]
    found = spark.createDataFrame([], schema) if not parts else parts[0]
    for p in parts[1:]:
        found = found.unionByName(p)
    return found


def _search_block(spark: SparkSession, own: DataFrame, block: list, schema: str, item_col: str) -> DataFrame:
    sent = spark.sparkContext.broadcast(sorted(block))
    id_col = own.columns[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(sent.value)
        words = Words(index.words)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for s, e in chunks(texts):
                found = search(index, words, texts[s:e])
                if found:
                    t, i, v, first, n = zip(*found)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array([s + x for x in t])), pa.array([index.ids[x] for x in i], pa.int64()),
                         pa.array(v, pa.float64()), pa.array(first, pa.int64()), pa.array(n, pa.int64())],
                        [id_col, item_col, "similarity", "first_word", "n_words"])

    return own.mapInArrow(run, schema)


def drop_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` (all columns) without the texts that hold a benchmark item."""
    spark = docs.sparkSession
    kept = docs
    for block in _blocks(benchmark, "item_id", "text"):
        sent = spark.sparkContext.broadcast(sorted(block))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            index = Index(sent.value)
            words = Words(index.words)
            for batch in batches:
                texts = [t or "" for t in batch.column(text_col).to_pylist()]
                good = np.ones(len(texts), bool)
                for s, e in chunks(texts):
                    good[[s + x[0] for x in search(index, words, texts[s:e])]] = False
                yield batch.filter(pa.array(good))

        kept = kept.mapInArrow(run, docs.schema)
    return kept
