"""Language-model scoring with a log-frequency Bloom filter.

Counts are gathered with Spark over all training texts.  The filter holds, for
every word and word pair that occurs twice, whatever the size of the corpus,
its quantised log count: level j is a member if the count reaches the j-th step.
A count is read back by probing levels until one is missing.

The filter grows with the corpus and is never in one place: it is cut by key
into parts of some ``PART_TOKENS`` tokens.  Texts are read once and kept as
chunks of numbered words; a chunk asks each part for its words and pairs in one
row of packed keys, a part is counted, filled and read back in one task, and the
levels go back to the chunk.  What moves is a row for each chunk and part, and in
these a key for each unlike word or pair of a chunk.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martforge.llm.common import chunks, stage

#: Least relative frequency of a word or pair in the filter: none, at any size (two occurrences do).
LEAST = 0
#: Ratio of neighbouring count steps; probes per member; bits per member; bits of a region.
STEP, PROBES, BITS, REGION = 1.25, 5, 12, 1 << 20
#: Steps in which the share of a word's followers that the filter holds is kept.
SHARES = 8
#: Words whose exact counts are broadcast for the base score; the others' counts are joined.
COMMON = 1 << 20
COUNT_BYTES = 2 << 20
#: Tokens of a part of the filter; the pairs of words that are a sixteenth of that or more
#: are spread over the parts (of HOT words at most, for no more can have that share of all).
PART_TOKENS, HOT = 1 << 20, 1 << 17
REMEMBER = 100_000
#: Places in which a filter remembers the levels that it has read back (9 bytes each).
PLACES = 1 << 20

WORD, PAIR, SHARE = 1, 2, 3
#: The end of a text; also what precedes its first word.  (No word holds a line feed.)
END = np.int64(np.uint64(xxhash.xxh64_intdigest(b"\n", 42)).astype(np.int64))


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def base(kind: int, v: np.ndarray, w: np.ndarray | None = None) -> np.ndarray:
    x = mix(v.view(np.uint64) + np.uint64(kind * 0x51ED270B))
    return x if w is None else mix(x * np.uint64(3) + w.view(np.uint64))


class Hashes(dict):
    """Signed XXH64 of words; remembers what it has seen."""

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh64_intdigest(word, 42)
        h -= (h >> 63) << 64
        if len(self) < REMEMBER:
            self[word] = h
        return h

    def of(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(tokens of all texts, tokens per text); each text ends with END."""
        split = [t.lower().split() for t in texts]  # of bytes: A-Z, and the six ASCII white spaces
        sizes = np.fromiter(map(len, split), np.int64, len(split)) + 1
        out = np.full(int(sizes.sum()), END)
        words = np.ones(len(out), bool)
        words[np.cumsum(sizes) - 1] = False
        out[words] = np.fromiter(map(self.__getitem__, chain.from_iterable(split)), np.int64, int(sizes.sum()) - len(split))
        return out, sizes


def before(which: np.ndarray, first: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """The place in ``kinds`` of the token before each token; END before a
    text's first (every text ends with it, so it is among the kinds)."""
    out = np.concatenate(([0], which[:-1]))
    out[first] = np.searchsorted(kinds, END)
    return out


@dataclass
class Filter:
    bits: np.ndarray          # regions x bytes
    least: int                # count of the first step

    def __post_init__(self):
        self.flat = self.bits.reshape(-1)
        # A place holds one key and its levels, those of the last key that fell there; 0: none.
        self.seen, self.seen_levels = np.zeros(PLACES, np.uint64), np.zeros(PLACES, np.uint8)

    def __reduce__(self):
        return Filter, (self.bits, self.least)

    def _regions(self, key: np.ndarray) -> np.ndarray:
        return (key % np.uint64(len(self.bits))).astype(np.int64) * (REGION // 8)

    def _probe(self, key: np.ndarray, region: np.ndarray, level) -> np.ndarray:
        """Which keys have that level (their places); the probes after the
        first see only what the ones before found set."""
        left = np.arange(len(key))
        a, b = halves(key, level)
        for i in range(PROBES):
            at = place(a, b, i)
            hit = self.flat[region + (at >> 3)] >> (at & 7).astype(np.uint8) & 1 > 0
            left, a, b, region = left[hit], a[hit], b[hit], region[hit]
        return left

    def has(self, key: np.ndarray, level: int) -> np.ndarray:
        out = np.zeros(len(key), bool)
        out[self._probe(key, self._regions(key), level)] = True
        return out

    def levels(self, key: np.ndarray) -> np.ndarray:
        """Levels read back one by one, for keys with any only once in a while."""
        at = (key & np.uint64(PLACES - 1)).astype(np.int64)
        out = np.where(self.seen[at] == key, self.seen_levels[at], 0).astype(np.int64)
        new = np.flatnonzero(out == 0)
        own, at = key[new], at[new]
        active, region, level, got = np.arange(len(own)), self._regions(own), 1, np.zeros(len(own), np.int64)
        while len(active):
            found = self._probe(own[active], region[active], level)
            active = active[found]
            got[active] = level
            level += 1
        out[new] = got
        # Of several keys of one place the last is kept, both times.
        keep = np.flatnonzero((got > 0) & (got < 256))
        self.seen[at[keep]], self.seen_levels[at[keep]] = own[keep], got[keep]
        return out

    def counts(self, key: np.ndarray) -> np.ndarray:
        """Counts read back (the middle of their step), 0 if absent."""
        n = self.levels(key)
        return np.where(n > 0, self.least * STEP ** (n - 0.5), 0.0)


def halves(key: np.ndarray, level) -> tuple[np.ndarray, np.ndarray]:
    h = mix(key + np.asarray(level).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return h & np.uint64(0xFFFFFFFF), (h >> np.uint64(32)) | np.uint64(1)


def place(a: np.ndarray, b: np.ndarray, i: int) -> np.ndarray:
    """Bit number of a member's ``i``-th probe inside its region."""
    return ((a + np.uint64(i) * b) & np.uint64(REGION - 1)).astype(np.int64)


def steps(count: Column, least: int) -> Column:
    """Number of steps that a count reaches."""
    return (F.floor(F.log(count / F.lit(least)) / math.log(STEP) + 1e-9) + 1).cast("int")


def held_out(id_col: str = "doc_id") -> Column:
    """Texts the model never sees: crc32 of the id as text, modulo 7, is 2 (a null id is not)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 7 == 2, F.lit(False))


def packed(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The slices of ``values`` between ``ends`` as binaries."""
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer((ends * values.itemsize).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))])


def unpacked(column, dtype) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype)


def squeezed(which: np.ndarray) -> bytes:
    """Small numbers, byte by byte of all, compressed."""
    return pa.compress(np.ascontiguousarray(which.astype(np.int32).view(np.uint8).reshape(-1, 4).T), codec="zstd", asbytes=True)


def unsqueezed(which: pa.Scalar, n: int) -> np.ndarray:
    own = np.frombuffer(pa.decompress(which.as_buffer(), 4 * n, codec="zstd"), np.uint8)
    return np.ascontiguousarray(own.reshape(4, n).T).view(np.int32)[:, 0]


def ends_of(part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(parts, where their runs end, from 0) of sorted ``part``."""
    cuts = np.flatnonzero(np.diff(part)) + 1
    return part[np.concatenate(([0], cuts))] if len(part) else part, np.concatenate(([0], cuts, [len(part)])) if len(part) else np.zeros(1, int)


def tokenised(own: DataFrame) -> DataFrame:
    """Chunks of whole texts of ``own`` (id, text binary, held_out): ``chunk``,
    the number of its first text; the ids and held_out of its texts; how many
    tokens they have (``sizes``); the unlike ones (``kinds``), how often each is
    in texts to train on (``n``), and which of them each token is (``which``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, at = Hashes(), TaskContext.get().partitionId() << 40
        for batch in batches:
            texts, held = batch.column(1), batch.column(2).to_numpy(zero_copy_only=False)
            for s, e in chunks(pc.binary_length(texts).to_pylist(), int, COUNT_BYTES):
                tokens, sizes = known.of(texts[s:e].to_pylist())
                kinds, which = np.unique(tokens, return_inverse=True)
                n = np.bincount(which[np.repeat(~held[s:e], sizes)], minlength=len(kinds))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([at]), pa.ListArray.from_arrays([0, e - s], batch.column(0).slice(s, e - s)), pa.ListArray.from_arrays([0, e - s], batch.column(2).slice(s, e - s)),
                     pa.array([len(tokens)]), *(pa.array([x]) for x in (sizes.tobytes(), kinds.tobytes(), squeezed(n), squeezed(which)))],
                    ["chunk", "ids", "held_out", "tokens", "sizes", "kinds", "n", "which"])
                at += e - s

    name, *_ = own.columns
    return own.mapInArrow(run, f"chunk long, ids array<{own.schema[name].dataType.simpleString()}>, held_out array<boolean>, tokens long, "
                               "sizes binary, kinds binary, n binary, which binary")


def trained_on(texts: DataFrame) -> DataFrame:
    """Chunks of ``texts`` (text binary), all to be trained on."""
    return tokenised(texts.select(F.lit(None).cast("long").alias("id"), "text", F.lit(False).alias("held_out")))


def word_counts(texts: DataFrame) -> DataFrame:
    """(w, c): exact counts of the tokens of all ``texts`` (text binary), or of
    those texts of chunks that are trained on."""
    own = texts if "kinds" in texts.columns else trained_on(texts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for kinds, n in zip(batch.column(0), batch.column(1)):
                w = np.frombuffer(kinds.as_buffer(), np.int64)
                n = unsqueezed(n, len(w))
                yield pa.RecordBatch.from_arrays([pa.array(w[n > 0]), pa.array(n[n > 0], pa.int64())], ["w", "n"])

    return own.select("kinds", "n").mapInArrow(run, "w long, n long").groupBy("w").agg(F.sum("n").alias("c"))


class Pairs:
    """The unlike pairs of neighbouring tokens of a chunk in the order in which
    they are asked for: by part, first and second token."""

    def __init__(self, kinds: np.ndarray, which: np.ndarray, sizes: np.ndarray, parts: int, hot: np.ndarray):
        self.first = np.cumsum(sizes) - sizes
        code, of = np.unique(before(which, self.first, kinds) * len(kinds) + which, return_inverse=True)
        v, w = code // len(kinds), code % len(kinds)
        key = mix(kinds.view(np.uint64))[v]
        spread = np.isin(kinds, hot)[v]
        key[spread] = base(PAIR, kinds[v[spread]], kinds[w[spread]])
        part = (key % np.uint64(parts)).astype(np.uint16 if parts <= 1 << 16 else np.int64)
        order = np.argsort(part, kind="stable")
        self.v, self.w, self.part = v[order], w[order], part[order]
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.of = place[of]       # of each token


def by_part(kinds: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, part) of a chunk's words as they are asked for."""
    part = (mix(kinds.view(np.uint64)) % np.uint64(parts)).astype(np.uint16 if parts <= 1 << 16 else np.int64)
    order = np.argsort(part, kind="stable")
    return order, part[order]


def asked_words(own: DataFrame, parts: int) -> DataFrame:
    """(part, chunk, w): the words of a chunk in each part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, kinds in zip(batch.column(0).to_pylist(), batch.column(1)):
                kinds = np.frombuffer(kinds.as_buffer(), np.int64)
                order, part = by_part(kinds, parts)
                part, ends = ends_of(part)
                yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array([chunk] * len(part), pa.int64()), packed(kinds[order], ends)], ["part", "chunk", "w"])

    return own.select("chunk", "kinds").mapInArrow(run, "part long, chunk long, w binary")


def asked_pairs(own: DataFrame, parts: int, hot: np.ndarray) -> DataFrame:
    """(part, chunk, v, k, w, n): the unlike pairs of a chunk in each part, as
    first tokens, numbers of their followers, these, and how often each pair
    is in texts to train on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(len(batch)):
                chunk, held = batch.column(0)[row].as_py(), batch.column(1)[row].values.to_numpy(zero_copy_only=False)
                sizes, kinds = (np.frombuffer(batch.column(i)[row].as_buffer(), np.int64) for i in (2, 3))
                p = Pairs(kinds, unsqueezed(batch.column(4)[row], sizes.sum()), sizes, parts, hot)
                n = np.bincount(p.of[np.repeat(~held, sizes)], minlength=len(p.v)).astype(np.int32)
                part, ends = ends_of(p.part)
                runs = np.flatnonzero(np.concatenate(([True], (p.v[1:] != p.v[:-1]) | (p.part[1:] != p.part[:-1]))))
                k = np.diff(np.append(runs, len(p.v))).astype(np.int32)
                run_ends = np.searchsorted(runs, ends)
                yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array([chunk] * len(part), pa.int64()), packed(kinds[p.v[runs]], run_ends), packed(k, run_ends),
                                                  packed(kinds[p.w], ends), packed(n, ends)], ["part", "chunk", "v", "k", "w", "n"])

    return own.select("chunk", "held_out", "sizes", "kinds", "which").mapInArrow(run, "part long, chunk long, v binary, k binary, w binary, n binary")


class Part:
    """The pairs that all chunks ask of one part, and their exact counts."""

    def __init__(self, table: pa.Table):
        self.chunk, self.part = table.column("chunk"), table.column("part")
        self.v = np.repeat(unpacked(table.column("v"), np.int64), unpacked(table.column("k"), np.int32))
        self.w, n = unpacked(table.column("w"), np.int64), unpacked(table.column("n"), np.int32)
        self.ends = np.concatenate(([0], np.cumsum(pc.binary_length(table.column("w")).to_numpy() // 8)))
        self.key, self.at, self.of = np.unique(base(PAIR, self.v, self.w), return_index=True, return_inverse=True)
        self.n = np.bincount(self.of, n, len(self.key)).astype(np.int64)


def pair_counts(texts: DataFrame, words: Filter) -> DataFrame:
    """(v, w, n): counts of neighbouring tokens of ``texts`` (text binary), of
    which both may be in the filter: a pair is never more frequent than either."""
    sent = texts.sparkSession.sparkContext.broadcast(words)

    def run(table: pa.Table) -> pa.Table:
        p = Part(table)
        v, w = p.v[p.at], p.w[p.at]
        both = sent.value.has(base(WORD, v), 1) & sent.value.has(base(WORD, w), 1)
        return pa.table({"v": v[both], "w": w[both], "n": p.n[both]})

    asked = asked_pairs(trained_on(texts), int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")), np.zeros(0, np.int64))
    return asked.groupBy("part").applyInArrow(run, "v long, w long, n long")


def read_pairs(asked: DataFrame, least: int) -> DataFrame:
    """What the filter holds of the pairs asked for: (chunk, part, levels) for
    each row of ``asked``, and a row for each part, without a chunk, with the
    first tokens of its pairs (v) and how often those pairs occur (m)."""

    def run(table: pa.Table) -> pa.Table:
        p = Part(table)
        often = p.n >= least
        levels = filled(p.key[often], steps_of(p.n[often], least), least).levels(p.key).astype(np.uint8)
        v, of = np.unique(p.v[p.at[often]], return_inverse=True)
        m = np.bincount(of, p.n[often], len(v)).astype(np.int64)
        none = pa.nulls(len(p.chunk), pa.binary())
        return pa.concat_tables([
            pa.table({"chunk": p.chunk, "part": p.part, "levels": packed(levels[p.of], p.ends), "v": none, "m": none}),
            pa.table({"chunk": pa.nulls(1, pa.int64()), "part": p.part.slice(0, 1), "levels": none[:1], "v": pa.array([v.tobytes()]), "m": pa.array([m.tobytes()])})])

    return asked.groupBy("part").applyInArrow(run, "chunk long, part long, levels binary, v binary, m binary")


def read_words(asked: DataFrame, words: DataFrame, parts: int, least: int) -> DataFrame:
    """(chunk, part, own, share): the levels that the filter of ``words`` (w, c,
    m: the occurrences of its pairs) holds of the words asked for, and those of
    the share of their followers."""

    def place_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part = mix(batch.column(0).to_numpy().view(np.uint64)) % np.uint64(parts)
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int64)), *batch.columns], ["part", "w", "c", "m"])

    def run(asked: pa.Table, words: pa.Table) -> pa.Table:
        w, c, m = (words.column(x).to_numpy() for x in ("w", "c", "m"))
        shares = np.ceil(m / c * SHARES).astype(np.int64)
        f = filled(np.concatenate((base(WORD, w), base(SHARE, w))), np.concatenate((steps_of(c, least), shares)), least)
        every, ends = unpacked(asked.column("w"), np.int64), np.concatenate(([0], np.cumsum(pc.binary_length(asked.column("w")).to_numpy() // 8)))
        kinds, of = np.unique(every, return_inverse=True)
        own, share = f.levels(base(WORD, kinds)), np.zeros(len(kinds), np.uint8)
        often = np.flatnonzero(own > 0)
        share[often] = np.minimum(f.levels(base(SHARE, kinds[often])), SHARES - 1)
        return pa.table({"chunk": asked.column("chunk"), "part": asked.column("part"), "own": packed(own.astype(np.uint8)[of], ends), "share": packed(share[of], ends)})

    placed = words.select("w", "c", "m").mapInArrow(place_words, "part long, w long, c long, m long")
    return asked.groupBy("part").cogroup(placed.groupBy("part")).applyInArrow(run, "chunk long, part long, own binary, share binary")


def steps_of(count: np.ndarray, least: int) -> np.ndarray:
    """``steps`` of an array."""
    return np.floor(np.log(count / least) / math.log(STEP) + 1e-9).astype(np.int64) + 1


def set_bits(key: np.ndarray, levels: np.ndarray, region: np.ndarray | int, regions: int) -> np.ndarray:
    """(regions, bytes) with the members of the keys set."""
    own = np.zeros(regions * REGION, np.uint8)
    at = np.repeat(np.arange(len(key)), levels)
    level = np.arange(len(at)) - np.repeat(np.cumsum(levels) - levels, levels) + 1
    a, b = halves(key[at], level)
    start = np.asarray(region).astype(np.int64) * REGION
    start = start[at] if start.ndim else start
    for i in range(PROBES):
        own[start + place(a, b, i)] = 1
    return np.packbits(own, bitorder="little").reshape(regions, -1)


def filled(key: np.ndarray, levels: np.ndarray, least: int) -> Filter:
    """The filter of some keys with that many levels each."""
    regions = max(1, -(-int(levels.sum()) * BITS // REGION))
    return Filter(set_bits(key, levels, key % np.uint64(regions), regions), least)


def build(entries: DataFrame, least: int) -> Filter:
    """The filter of ``entries`` (kind, v, w, levels) in one place, for as many
    as a process holds: regions are filled apart from each other and the
    finished ones collected."""
    members = entries.agg(F.sum(F.col("levels").cast("long"))).first()[0] or 0
    regions = max(1, -(-members * BITS // REGION))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kind, v, w, levels = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            key = np.zeros(len(kind), np.uint64)
            for k in (WORD, PAIR, SHARE):
                m = kind == k
                key[m] = base(k, v[m], w[m] if k == PAIR else None)
            region = (key % np.uint64(regions)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(region), pa.array(key.view(np.int64)), pa.array(levels)], ["region", "key", "levels"])

    def fill(table: pa.Table) -> pa.Table:
        key = table.column("key").to_numpy().view(np.uint64)
        levels = table.column("levels").to_numpy()
        return pa.table({"region": table.column("region").slice(0, 1), "bits": [set_bits(key, levels, 0, 1).tobytes()]})

    got = (entries.select("kind", "v", "w", "levels").mapInArrow(spread, "region int, key long, levels int")
           .groupBy("region").applyInArrow(fill, "region int, bits binary").toArrow())
    bits = np.zeros((regions, REGION // 8), np.uint8)
    for r, b in zip(got.column("region").to_pylist(), got.column("bits").to_pylist()):
        bits[r] = np.frombuffer(b, np.uint8)
    return Filter(bits, least)


@dataclass
class Model:
    tokens: int               # N
    kinds: int                # V
    least: int                # least count in the filter
    rare: float               # mean count of the words that the filter doesn't hold
    common: np.ndarray        # hashes of the common words, sorted
    common_counts: np.ndarray
    parts: int                # of the filter
    hot: np.ndarray           # first tokens whose pairs are spread over the parts

    def logs(self, own: np.ndarray, share: np.ndarray, pairs: Pairs, levels: np.ndarray) -> np.ndarray:
        """log10 of the probability of each pair's second token after its
        first: the pair's share, and for what the filter doesn't hold of the
        followers of the first, the second one's own smoothed share; from the
        levels of the words, of their followers' share, and of the pairs."""
        count, held = self.counts(own), share / SHARES
        p = (1 - held)[pairs.v] * ((np.where(count > 0, count, self.rare) + 1) / (self.tokens + self.kinds + 1))[pairs.w]
        both = np.flatnonzero((held[pairs.v] > 0) & (count[pairs.w] > 0))
        v = pairs.v[both]
        p[both] += np.minimum(self.counts(levels[both]) / count[v], held[v])
        return np.log10(np.minimum(p, 1.0))

    def counts(self, levels: np.ndarray) -> np.ndarray:
        """Counts read back (the middle of their step), 0 if absent."""
        return np.concatenate(([0.0], self.least * STEP ** (np.arange(1, 257) - 0.5)))[levels]

    def common_count(self, kinds: np.ndarray) -> np.ndarray:
        """Exact counts of the common words, 0 for all others."""
        if not len(self.common):
            return np.zeros(len(kinds), np.int64)
        at = np.minimum(np.searchsorted(self.common, kinds), len(self.common) - 1)
        return np.where(self.common[at] == kinds, self.common_counts[at], 0)


def train(own: DataFrame) -> tuple[Model, DataFrame, DataFrame]:
    """Model of the chunks ``own``, the exact counts (w, c), and the levels that
    the filter holds of what each chunk asks for (chunk, part, levels; own, share)."""
    counts = stage(word_counts(own), "lm-words")
    tokens, kinds = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    least = max(2, math.ceil(tokens * LEAST))
    kept = counts.filter(F.col("c") >= least)
    parts = max(1, -(-(own.agg(F.sum("tokens")).first()[0] or 0) // PART_TOKENS))
    hot = counts.filter(F.col("c") > max(PART_TOKENS // 16, tokens // HOT)).select("w").toArrow().column(0).to_numpy()
    pairs = stage(read_pairs(asked_pairs(own, parts, hot), least), "lm-pairs")

    def masses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(unpacked(x, np.int64)) for x in batch.columns], ["v", "m"])

    held = pairs.filter("chunk is null").select("v", "m").mapInArrow(masses, "v long, m long").groupBy("v").agg(F.sum("m").alias("m"))
    words = kept.join(held, kept["w"] == held["v"], "left").select("w", "c", F.coalesce("m", F.lit(0)).alias("m"))
    levels = read_words(asked_words(own, parts), words, parts, least)
    have, mass = kept.agg(F.count("*"), F.coalesce(F.sum("c"), F.lit(0))).first()
    rare = (tokens - mass) / (kinds - have) if kinds > have else 0.0
    # Common words: as many whole classes of counts as hold COMMON words at most.
    level = F.floor(F.log2("c") * 16)
    classes = counts.groupBy(level.alias("k")).agg(F.count("*").alias("n")).orderBy(F.desc("k")).collect()  # a few hundred rows
    total, cut = 0, None
    for r in classes:
        total += r.n
        if total > COMMON:
            break
        cut = r.k
    common = counts.filter(level >= cut if cut is not None else F.lit(False)).toArrow()
    w, c = (common.column(i).to_numpy() for i in range(2))
    order = np.argsort(w)
    answers = (pairs.filter("chunk is not null").select("chunk", "part", "levels", F.lit(None).cast("binary").alias("own"), F.lit(None).cast("binary").alias("share"))
               .unionByName(levels.withColumn("levels", F.lit(None).cast("binary"))))
    return Model(tokens, kinds, least, rare, w[order], c[order], parts, hot), counts, answers


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Train on the texts that are not held out and score all whole texts.

    Returns id_col, held_out, n_tokens, n_known, train_tokens, base_score (the
    add-one unigram model with exact counts) and score (the filter's pair
    model).  A null text counts as empty: one token, the end.  Rows with a
    null id are trained on and scored; a repeated row is another text; an
    empty table gives no rows, and without training texts every word is
    unknown (both scores are 0).  Other columns are not read.
    """
    own = docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"), held_out(id_col).alias("held_out"))
    own = stage(tokenised(own), "lm-chunks")
    model, counts, answers = train(own)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(chunk: pa.Table, answers: pa.Table) -> pa.Table:
        m = sent.value
        sizes, kinds = (np.frombuffer(chunk.column(x)[0].as_buffer(), np.int64) for x in ("sizes", "kinds"))
        which = unsqueezed(chunk.column("which")[0], sizes.sum())
        answers = answers.sort_by("part")
        pairs, order = Pairs(kinds, which, sizes, m.parts, m.hot), by_part(kinds, m.parts)[0]
        seen, share = np.empty(len(kinds), np.uint8), np.empty(len(kinds), np.uint8)
        seen[order], share[order] = (unpacked(answers.column(x).drop_null(), np.uint8) for x in ("own", "share"))
        logs = m.logs(seen, share, pairs, unpacked(answers.column("levels").drop_null(), np.uint8))
        first, c = pairs.first, m.common_count(kinds)
        here = (c > 0)[which]
        rest = np.flatnonzero(~here)
        of = np.searchsorted(first, rest, side="right") - 1
        ends = np.searchsorted(of, np.arange(len(sizes) + 1))
        ids, held = (chunk.column(x).combine_chunks().flatten() for x in ("ids", "held_out"))
        return pa.table(
            [ids, held, pa.array(chunk.column("chunk")[0].as_py() + np.arange(len(sizes))), pa.array(sizes),
             pa.array(np.add.reduceat(here.astype(np.int64), first)), pa.array(np.add.reduceat(np.log10(c + 1.0)[which], first)),
             pa.array(np.add.reduceat(logs[pairs.of], first)),
             pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(kinds[which[rest]], pa.int64()))],
            [id_col, "held_out", "row", "n_tokens", "known", "logs", "score", "rest"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = stage(own.groupBy("chunk").cogroup(answers.groupBy("chunk"))
                 .applyInArrow(run, f"`{id_col}` {kind}, held_out boolean, row long, n_tokens long, known long, logs double, score double, rest array<long>"),
                 "lm-rows")
    rest = rows.select("row", F.explode("rest").alias("w")).groupBy("row", "w").agg(F.count("*").alias("n"))
    rest = (rest.join(counts, "w").groupBy("row")
            .agg(F.sum("n").alias("more"), F.sum(F.col("n") * F.log10(F.col("c") + 1)).alias("more_logs")))
    return (rows.drop("rest").join(rest, "row", "left")
            .select(id_col, "held_out", "n_tokens", (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"),
                    F.lit(model.tokens).cast("long").alias("train_tokens"),
                    (F.col("logs") + F.coalesce("more_logs", F.lit(0.0)) - F.col("n_tokens") * math.log10(model.tokens + model.kinds + 1)).alias("base_score"),
                    "score"))
