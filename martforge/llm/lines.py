"""Fuzzy line deduplication by MinHash."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martforge.llm.common import chunks, connected_components, stage

#: Characters in a shingle; signature bands and rows; least Jaccard similarity.
SHINGLE, BANDS, ROWS, SIMILARITY = 7, 14, 5, 0.8
BINS = BANDS * ROWS
#: A line is compared with its bucket's first line and with this many before it;
#: the lines of larger buckets are joined exactly besides.
WINDOW = 8
#: Slots of the shingle counts that order a prefix; lines of a block; 64-bit words of a parity sketch.
SLOTS, CELL, PARITY = 1 << 18, 256, 4

#: Low bits of a band hash that are left out, so that a band and as many bits of a line's hash make one number to sort by.
LOW = 24
#: Bits of the filter in front of the candidates' texts (16 MB).
FILTER = 1 << 27
#: Characters hashed at once (small enough for a processor's cache).
PIECE = 1 << 16
#: Least number of parts that the bands are dealt to, and bytes of text a part; bands packed at once; bands of a part held at once.
PARTS, PART, PACK, HELD = 1 << 10, 1 << 20, 1 << 20, 1 << 21

_RNG = np.random.default_rng(9)
_LETTER = _RNG.integers(1, 1 << 63, SHINGLE, dtype=np.uint64) | np.uint64(1)
_ROW = _RNG.integers(1, 1 << 63, BINS, dtype=np.uint64) | np.uint64(1)
_DONOR = _RNG.integers(0, BINS, (256, BINS))
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def shingles(line: str) -> set[str]:
    """Character shingles of a line; a shorter line is one shingle."""
    return {line[i:i + SHINGLE] for i in range(max(1, len(line) - SHINGLE + 1))}


def _shingle_hashes(text: str) -> np.ndarray:
    """Hash of the shingle at each position (of no meaning in a line's last
    ``SHINGLE`` - 1): the hashes of two overlapping halves, each made of the
    hashes of its own halves."""
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    c = np.concatenate((c, np.zeros(SHINGLE, np.uint64)))
    n, width = len(c) - SHINGLE, 1
    while width < SHINGLE:
        step = min(width, SHINGLE - width)
        h = c[:len(c) - step] * _LETTER[width]
        h += c[step:]
        c, width = h, width + step
    x = c[:n]
    x ^= x >> np.uint64(32)
    x *= np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    return x


def signatures(lines: list[str]) -> np.ndarray:
    """Band hashes (lines x BANDS, int64).

    One hash per shingle; its high part picks a bin, the least low part in a
    bin is the bin's value; an empty bin borrows from the first non-empty one
    of a fixed random order, so that few shingles still spread over the rows.
    """
    padded = [t if len(t) >= SHINGLE else t.ljust(SHINGLE, "\0") for t in lines]
    sizes = np.fromiter(map(len, padded), np.int64, len(padded))
    least = np.full(len(padded) * BINS, _EMPTY)
    for s, e in chunks(padded, limit=PIECE):
        own = sizes[s:e]
        x = _shingle_hashes("".join(padded[s:e]))
        cell = (x >> np.uint64(40)).astype(np.int64)
        cell *= BINS
        cell >>= 24
        cell += np.repeat(np.arange(s * BINS, e * BINS, BINS), own)
        x &= np.uint64((1 << 40) - 1)
        # The last positions of a line would reach into the next one.
        x[(np.cumsum(own)[:, None] - np.arange(1, SHINGLE)).ravel()] = _EMPTY
        np.minimum.at(least, cell, x)
    least = least.reshape(-1, BINS)
    holes = np.flatnonzero((least == _EMPTY).any(1))
    if len(holes):
        given = least[holes]
        row, column = np.nonzero(given == _EMPTY)
        lent = np.full(len(row), _EMPTY)
        left = np.arange(len(row))
        for donor in _DONOR:
            lent[left] = given[row[left], donor[column[left]]]
            left = left[lent[left] == _EMPTY]
            if not len(left):
                break
        lent[left] = given.min(1)[row[left]]
        least[holes[row], column] = lent
    mixed = _mix(least * _ROW + _ROW[::-1])
    return _mix(mixed.reshape(len(padded), BANDS, ROWS).sum(2, dtype=np.uint64)
                + np.arange(BANDS, dtype=np.uint64)).view(np.int64)


def line_hash(line: str) -> int:
    h = xxhash.xxh64_intdigest(line.encode("utf-8", "surrogatepass"), 42)
    return h - (1 << 64) if h >> 63 else h


def _lines(text: str) -> list[tuple[int, str]]:
    """(number, stripped line) of the lines that aren't blank."""
    return [(i, s) for i, t in enumerate(text.split("\n")) if (s := t.strip())]


def _parts(docs: DataFrame) -> int:
    """Parts for the bands of these texts: a power of two that grows with
    them, so that a part doesn't."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(PARTS, 1 << (size // PART).bit_length())


def _packed(band: np.ndarray, h: np.ndarray, parts: int) -> pa.RecordBatch:
    """(part, band, h): a row for each part, which is the band's high bits,
    with the bands and the hashes of its lines as 64-bit numbers."""
    part = (band.view(np.uint64) >> np.uint64(65 - parts.bit_length())).astype(np.min_scalar_type(parts - 1))
    order = np.argsort(part, kind="stable")
    part = part[order]
    starts = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
    ends = pa.py_buffer((np.append(starts, len(part)) * 8).astype(np.int32))
    band, h = (pa.Array.from_buffers(pa.binary(), len(starts), [None, ends, pa.py_buffer(x[order])]) for x in (band, h))
    return pa.RecordBatch.from_arrays([pa.array(part[starts].astype(np.int32)), band, h], ["part", "band", "h"])


def _bands(docs: DataFrame, parts: int = 0) -> DataFrame:
    """(band, h) of each distinct line of each chunk of texts; a band hash has
    40 bits (lines that share one by chance are told apart by their texts).
    With ``parts``, a power of two: (part, band, h), many of a part in a row."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for s, e in chunks(texts):
                lines = list({line for t in texts[s:e] for _, line in _lines(t)})
                if lines:
                    yield (signatures(lines) >> LOW << LOW).ravel(), np.repeat(np.fromiter(map(line_hash, lines), np.int64, len(lines)), BANDS)

    def plain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for band, h in each(batches):
            yield pa.RecordBatch.from_arrays([pa.array(band), pa.array(h)], ["band", "h"])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for band, h in each(batches):
            held.append((band, h))
            n += len(band)
            if n >= PACK:
                yield _packed(*map(np.concatenate, zip(*held)), parts)
                held, n = [], 0
        if n:
            yield _packed(*map(np.concatenate, zip(*held)), parts)

    texts = docs.select("text")
    return texts.mapInArrow(packed, "part int, band binary, h binary") if parts else texts.mapInArrow(plain, "band long, h long")


def _in_order(held: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
    """(band, h) in order of the band and 24 bits of the line's hash, equal
    neighbours once."""
    band, h = map(np.concatenate, zip(*held))
    order = np.argsort(band | (h & ((1 << LOW) - 1)))
    band, h = band[order], h[order]
    fresh = np.append(True, (band[1:] != band[:-1]) | (h[1:] != h[:-1]))
    return band[fresh], h[fresh]


def _part_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of lines in a bucket, from packed rows in order of the part.

    A part with more than ``HELD`` bands has very large buckets: the pairs so
    far are made, and of each bucket its first line and its last ``WINDOW``
    stay to be compared with the lines to come.
    """

    def pairs(band: np.ndarray, h: np.ndarray) -> Iterator[pa.RecordBatch]:
        same = band[1:] == band[:-1]
        some = np.append(same, False) | np.append(False, same)
        if some.any():
            yield from _bucket_pairs(iter([pa.RecordBatch.from_arrays([pa.array(band[some]), pa.array(h[some])], ["band", "h"])]))

    held, n, room, open_part = [], 0, HELD, None
    for batch in batches:
        part = batch.column(0).to_numpy()
        starts = np.flatnonzero(np.append(True, part[1:] != part[:-1])) if len(part) else []
        for s, e in zip(starts, [*starts[1:], len(part)]):
            if part[s] != open_part:
                if held:
                    yield from pairs(*_in_order(held))
                held, n, room, open_part = [], 0, HELD, part[s]
            held.append(tuple(np.frombuffer(b"".join(batch.column(i)[s:e].to_pylist()), np.int64) for i in (1, 2)))
            n += len(held[-1][0])
            if n > room:
                band, h = _in_order(held)
                if len(band) > room // 2:
                    yield from pairs(band, h)
                    first = np.flatnonzero(np.append(True, band[1:] != band[:-1]))
                    size = np.diff(np.append(first, len(band)))
                    place = np.arange(len(band)) - np.repeat(first, size)
                    stay = (place == 0) | (place >= np.repeat(size, size) - WINDOW)
                    band, h = band[stay], h[stay]
                held, n = [(band, h)], len(band)
                room = max(HELD, 2 * n)
    if held:
        yield from pairs(*_in_order(held))


def _bucket_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of lines in a bucket, from (band, h) rows in order of the band and
    then in any that brings equal rows together (but for a few): each
    line with the bucket's first and with the ``WINDOW`` lines before it.
    All pairs of a bucket of up to ``WINDOW`` + 2 lines; from a larger one a
    number in proportion to its lines.  Keeps a few rows whatever the bucket.
    ``crowd`` marks pairs of a bucket's lines beyond ``WINDOW`` + 1; those
    pairs hold every line of such a bucket.
    """
    tail_band = tail_h = np.zeros(0, np.int64)     # the open bucket's last lines
    head: int | None = None                        # its first line, if that is not among them
    for batch in batches:
        band = np.concatenate((tail_band, batch.column(0).to_numpy()))
        h = np.concatenate((tail_h, batch.column(1).to_numpy()))
        old = len(tail_band)
        fresh = np.ones(len(band), bool)
        fresh[1:] = (band[1:] != band[:-1]) | (h[1:] != h[:-1])
        band, h, old = band[fresh], h[fresh], int(fresh[:old].sum())
        if not len(band):
            continue
        starts = np.flatnonzero(np.concatenate(([True], band[1:] != band[:-1])))
        first = np.repeat(starts, np.diff(np.append(starts, len(band))))
        left, right, crowd = [], [], []
        i = np.arange(len(band))
        many = (i - first > WINDOW) | ((first == 0) & (head is not None))
        for step in range(1, WINDOW + 1):
            at = i[(i >= old) & (i - step >= first)]
            left.append(h[at - step])
            right.append(h[at])
            crowd.append(many[at])
        at = i[(i >= old) & (i - first > WINDOW) & ((first > 0) | (head is None))]
        left.append(h[first[at]])
        right.append(h[at])
        crowd.append(many[at])
        if head is not None:  # the open bucket's first line went by in an earlier batch
            end = starts[1] if len(starts) > 1 else len(band)
            at = i[old:end]
            left.append(np.full(len(at), head))
            right.append(h[at])
            crowd.append(many[at])
        out = np.unique(np.stack((np.concatenate(left), np.concatenate(right), np.concatenate(crowd)), 1), axis=0)
        if len(out):
            yield pa.RecordBatch.from_arrays([pa.array(out[:, 0]), pa.array(out[:, 1]), pa.array(out[:, 2] > 0)], ["a", "b", "crowd"])
        begin, last = starts[-1], max(starts[-1], len(band) - WINDOW)
        if last > begin and (len(starts) > 1 or head is None):
            head = int(h[begin])
        elif len(starts) > 1:
            head = None
        tail_band, tail_h = band[last:], h[last:]


def _shingle_sets(lines: list[str]) -> Iterator[np.ndarray]:
    """Hashes of each line's shingles, sorted."""
    padded = [t if len(t) >= SHINGLE else t.ljust(SHINGLE, "\0") for t in lines]
    for s, e in chunks(padded, limit=PIECE):
        x, at = _shingle_hashes("".join(padded[s:e])), 0
        for t in padded[s:e]:
            yield _distinct(x[at:at + len(t) - SHINGLE + 1])
            at += len(t)


def _slot(x: np.ndarray) -> np.ndarray:
    return (x & np.uint64(SLOTS - 1)).astype(np.int64)


def _indexed(n: np.ndarray, similarity: float) -> np.ndarray:
    """How many of a line's rarest shingles (of ``n``) it is found by: as many
    as may be missing from a line of that similarity that isn't shorter, and one."""
    return n - np.ceil(2 * similarity / (1 + similarity) * n - 1e-6).astype(np.int64) + 1


def _prefixes(lines: DataFrame, similarity: float) -> DataFrame:
    """(token, h, root, n, at, p0..) of ``lines`` (h, root, line): the rarest
    shingles of each line, so many that lines of that similarity share one,
    with their places in the line's order; the number of its shingles and the
    parities of their hashes' classes.

    Rarity is the count of a shingle's slot, gathered over all the lines: one
    order for all, of a size that doesn't grow.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SLOTS, np.int64)
        for batch in batches:
            for x in _shingle_sets(batch.column(0).to_pylist()):
                np.add.at(total, _slot(x), 1)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["slot", "n"])

    got = lines.select("line").mapInArrow(count, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    often = np.zeros(SLOTS, np.int64)
    often[got.column("slot").to_numpy()] = got.column("n").to_numpy()
    sent = lines.sparkSession.sparkContext.broadcast(often)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank = sent.value
        for batch in batches:
            texts = batch.column(2).to_pylist()
            for s, e in chunks(texts):
                tokens, sizes, sums = [], [], []
                for x in _shingle_sets(texts[s:e]):
                    own = len(x) - int(np.ceil(similarity * len(x) - 1e-6)) + 1
                    tokens.append(x[np.lexsort((x, rank[_slot(x)]))[:own]])
                    sizes.append(len(x))
                    odd = np.bincount((x >> np.uint64(40)).astype(np.int64) % (64 * PARITY), minlength=64 * PARITY) & 1
                    sums.append(np.packbits(odd.astype(np.uint8)).view(np.int64))
                of = np.repeat(np.arange(s, e), [len(t) for t in tokens])
                sums = np.stack(sums)[of - s]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(tokens).view(np.int64)), batch.column(0).take(pa.array(of)), batch.column(1).take(pa.array(of)),
                     pa.array(np.array(sizes, np.int32)[of - s]), pa.array(np.concatenate([np.arange(len(t), dtype=np.int32) for t in tokens])),
                     *(pa.array(sums[:, i]) for i in range(PARITY))],
                    ["token", "h", "root", "n", "at", *(f"p{i}" for i in range(PARITY))])

    return lines.select("h", "root", "line").mapInArrow(
        run, "token long, h long, root long, n int, at int, " + ", ".join(f"p{i} long" for i in range(PARITY)))


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of each token dealt to cells of two blocks, so that any two
    lines of unlike roots meet in a cell.  A root with more than ``CELL`` lines
    has blocks of its own, which don't meet each other."""
    for batch in batches:
        token, h = (batch.column(i).to_numpy().view(np.uint64) for i in range(2))
        root, light, heavy = batch.column(2).to_numpy(), batch.column("light").to_numpy(), batch.column("heavy")
        rows, cells = [], []
        plain = (light <= CELL) & (heavy.value_lengths().to_numpy() == 0)
        rows.append(np.flatnonzero(plain))
        cells.append(token[plain])
        spread = _mix(h)
        for r in np.flatnonzero(~plain).tolist():
            at, size = 0, -(-int(light[r]) // CELL)
            total, own = size, None
            for big in heavy[r].as_py():
                wide = -(-big["n"] // CELL)
                if big["root"] == root[r]:
                    own = total, wide
                total += wide
            if own:
                at, size = own
            block = at + int(spread[r] % np.uint64(size))
            other = np.arange(total)
            other = other[(other < at) | (other >= at + size)] if own else other[other != block]
            if total == 1:
                other = np.zeros(1, np.int64)
            low, high = np.minimum(other, block).astype(np.uint64), np.maximum(other, block).astype(np.uint64)
            rows.append(np.full(len(other), r))
            cells.append(_mix(token[r] + low * _LETTER[0] + high * _LETTER[1]))
        at = pa.array(np.concatenate(rows))
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(cells).view(np.int64)), *(c.take(at) for c in batch.columns[1:5 + PARITY])],
                                         ["cell", "h", "root", "n", "at", *(f"p{i}" for i in range(PARITY))])


def _cell_pairs(similarity: float):
    """Pairs of lines of unlike roots in a cell, from rows in cell order, that
    may be so similar by their numbers of shingles, the places of the shared
    one and their parities.

    The shorter line of a pair must have the shared shingle among those that
    it is found by, which are the rarest of its prefix.  So the lines of a
    template meet only if they also share some of what tells them apart.
    """
    share = (1 - similarity) / (1 + similarity)  # of both lines' shingles may differ

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_rows: list[np.ndarray] | None = None
        for batch in batches:
            rows = [c.to_numpy() for c in batch.columns]
            if open_rows is not None:
                rows = [np.concatenate(x) for x in zip(open_rows, rows)]
            starts = np.flatnonzero(np.concatenate(([True], rows[0][1:] != rows[0][:-1])))
            yield from pairs([c[:starts[-1]] for c in rows])
            open_rows = [c[starts[-1]:] for c in rows]
        if open_rows is not None:
            yield from pairs(open_rows)

    def pairs(rows: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        cell, h, root, n, at, *sums = rows
        if not len(cell):
            return
        n, at, sums = n.astype(np.int64), at.astype(np.int64), [p.view(np.uint64) for p in sums]
        starts = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1])))
        size = np.diff(np.append(starts, len(cell)))
        first, many = np.repeat(starts, size), np.repeat(size, size)
        finders = np.flatnonzero(at < _indexed(n, similarity))
        found = []
        for s, e in chunks(many[finders].tolist(), size=int):
            x, width = finders[s:e], many[finders[s:e]]
            y = np.arange(width.sum()) - np.repeat(np.cumsum(width) - width, width) + np.repeat(first[x], width)
            x = np.repeat(x, width)
            ok = (root[x] != root[y]) & ((n[x] < n[y]) | ((n[x] == n[y]) & (h[x] < h[y]))) & (n[x] >= similarity * n[y] - 1e-6)
            x, y = x[ok], y[ok]
            need = np.ceil(similarity / (1 + similarity) * (n[x] + n[y]) - 1e-6)
            ok = (n[x] - at[x] >= need) & (n[y] - at[y] >= need)
            x, y = x[ok], y[ok]
            apart = sum((np.bitwise_count(p[x] ^ p[y]).astype(np.int64) for p in sums), np.zeros(len(x), np.int64))
            ok = apart <= share * (n[x] + n[y]) + 1e-6
            x, y = x[ok], y[ok]
            if len(x):
                found.append(np.stack((np.minimum(h[x], h[y]), np.maximum(h[x], h[y])), 1))
        if found:
            out = np.unique(np.concatenate(found), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(out[:, 0]), pa.array(out[:, 1])], ["a", "b"])

    return run


def _crowd_pairs(lines: DataFrame, similarity: float) -> DataFrame:
    """(a, b): all pairs of ``lines`` (h, root, line) of unlike roots that may
    be so similar, no pair of that similarity left out: an indexed join over
    rarest-shingle prefixes whose long lists are spread over many tasks."""
    tokens = stage(_prefixes(lines, similarity), "line-prefixes")
    finds = F.col("at") < F.col("n") - F.ceil(F.col("n") * (2 * similarity / (1 + similarity)) - 1e-6) + 1  # as _indexed
    each = tokens.groupBy("token", "root").agg(F.count("*").alias("n"), F.max(finds).alias("finds"))
    big = F.col("n") > CELL
    lists = (each.groupBy("token").agg(F.count("*").alias("roots"), F.coalesce(F.sum(F.when(~big, F.col("n"))), F.lit(0)).alias("light"),
                                       F.sort_array(F.collect_list(F.when(big, F.struct("root", "n")))).alias("heavy"),
                                       F.max("finds").alias("finds"))
             .filter("roots > 1 and finds").drop("roots", "finds"))
    parts = [f"p{i}" for i in range(PARITY)]
    dealt = (tokens.join(stage(lists, "line-lists"), "token").select("token", "h", "root", "n", "at", *parts, "light", "heavy")
             .mapInArrow(_cells, "cell long, h long, root long, n int, at int, " + ", ".join(f"{p} long" for p in parts)))
    return (dealt.repartition("cell").sortWithinPartitions("cell").mapInArrow(_cell_pairs(similarity), "a long, b long").distinct())


def _distinct(x: np.ndarray) -> np.ndarray:
    """Sorted, each value once (numpy's own ``unique`` hashes, which is slower here)."""
    x = np.sort(x)
    return x[np.append(True, x[1:] != x[:-1])] if len(x) else x


#: Classes of shingles by which unlike lines are told apart before their sets are made.
MARKS = 1 << 10
#: Low bits of a shingle's hash that are compared; above them stands the number of a line or pair of a chunk.
_SEEN = np.uint64(54)


def _jaccards(left: list[str], right: list[str], similarity: float) -> np.ndarray:
    """Jaccard similarity of the shingle sets of each pair of lines (at most
    1024 pairs; shingles by 54 bits of their hashes); 0 for pairs whose sizes
    or classes of shingles differ too much for ``similarity``."""
    number: dict[str, int] = {}
    a, b = (np.fromiter((number.setdefault(t, len(number)) for t in side), np.int64, len(side)) for side in (left, right))
    padded = [t if len(t) >= SHINGLE else t.ljust(SHINGLE, "\0") for t in number]
    room = np.fromiter(map(len, padded), np.int64, len(padded)) - SHINGLE + 1  # shingles, repeats included
    marks = np.empty((len(padded), MARKS // 64), np.uint64)
    pieces = []
    for s, e in chunks(padded, size=_room, limit=PIECE):
        own = room[s:e] + SHINGLE - 1
        x = _shingle_hashes("".join(padded[s:e]))
        # The last positions of a line would reach into the next one.
        keep = np.ones(len(x), bool)
        keep[(np.cumsum(own)[:, None] - np.arange(1, SHINGLE)).ravel()] = False
        x = x[keep]
        seen = np.zeros((e - s) * MARKS, bool)
        seen[(x & np.uint64(MARKS - 1)).astype(np.int64) + np.repeat(np.arange(0, len(seen), MARKS), room[s:e])] = True
        marks[s:e] = np.packbits(seen).view(np.uint64).reshape(e - s, -1)
        x >>= np.uint64(64) - _SEEN
        pieces.append((s, e, x))
    # Each class that only one line has a shingle of is a shingle that the other lacks: no more of them than may differ.
    apart = np.bitwise_count(marks[a] ^ marks[b]).sum(1, dtype=np.int64)
    maybe = apart <= (1 - similarity) / (1 + similarity) * (room[a] + room[b]) + 1e-6
    used = np.zeros(len(padded), bool)
    used[a[maybe]] = used[b[maybe]] = True
    size = np.zeros(len(padded), np.int64)
    held = []
    for s, e, x in pieces:
        x = x[np.repeat(used[s:e], room[s:e])]
        x |= np.repeat(np.flatnonzero(used[s:e]).astype(np.uint64) << _SEEN, room[s:e][used[s:e]])
        x = _distinct(x)
        size[s:e] = np.bincount((x >> _SEEN).astype(np.int64), minlength=e - s)
        held.append(x & ((np.uint64(1) << _SEEN) - np.uint64(1)))
    held, start = np.concatenate(held), np.cumsum(size) - size
    out = np.zeros(len(a))
    near = np.flatnonzero(maybe & (np.minimum(size[a], size[b]) >= similarity * np.maximum(size[a], size[b]) - 1e-6))
    if len(near):
        # Both lines of a pair after each other: two ascending runs.
        of = np.stack((a[near], b[near]), 1).ravel()
        n = size[of]
        rows = held[np.arange(n.sum()) + np.repeat(start[of] - (np.cumsum(n) - n), n)]
        rows |= np.repeat(np.arange(len(near), dtype=np.uint64).repeat(2) << _SEEN, n)
        rows.sort(kind="stable")
        both = np.bincount((rows[1:][rows[1:] == rows[:-1]] >> _SEEN).astype(np.int64), minlength=len(near))
        out[near] = both / (size[a[near]] + size[b[near]] - both)
    return out


def _room(line: str) -> int:
    """Size of a line in a chunk of at most 512 lines."""
    return max(len(line), PIECE >> 9)


def _similar(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """The pairs whose shingle sets have at least that Jaccard similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            keep = np.zeros(len(left), bool)
            for s, e in chunks([_room(x) + _room(y) for x, y in zip(left, right)], size=int, limit=4 * PIECE):
                keep[s:e] = _jaccards(left[s:e], right[s:e], similarity) >= similarity - 1e-9
            yield batch.select([0, 1]).rename_columns(["src", "dst"]).filter(pa.array(keep, pa.bool_()))

    a, b = (texts.select(F.col("h").alias(n), F.col("line").alias(f"line_{n}")) for n in "ab")
    return pairs.join(a, "a").join(b, "b").select("a", "b", "line_a", "line_b").mapInArrow(run, "src long, dst long")


def _occurrences(docs: DataFrame, id_col: str) -> DataFrame:
    """(id, line_no, h) of every line that isn't blank."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for s, e in chunks(texts):
                cut = [_lines(t) for t in texts[s:e]]
                of = np.repeat(np.arange(s, e), [len(x) for x in cut])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(of)), pa.array([i for x in cut for i, _ in x], pa.int32()),
                     pa.array([line_hash(t) for x in cut for _, t in x], pa.int64())], [id_col, "line_no", "h"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, "text").mapInArrow(run, f"`{id_col}` {kind}, line_no int, h long")


def _line_texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(h, line), one row for each of the ``wanted`` hashes.

    A bit set of ``FILTER`` bits, of that size whatever the corpus, holds the
    wanted hashes' low parts, so that most other lines aren't sent at all;
    the join decides.
    """
    slot = F.pmod("h", F.lit(FILTER))
    words = (wanted.groupBy(F.floor(slot / 64).cast("int").alias("at"))
             .agg(F.bit_or(F.expr(f"shiftleft(1L, cast(pmod(h, {FILTER}) % 64 as int))")).alias("bits")).toArrow())
    bits = np.zeros(FILTER // 64, np.int64)
    bits[words.column("at").to_numpy()] = words.column("bits").to_numpy()
    sent = docs.sparkSession.sparkContext.broadcast(bits.view(np.uint8))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maybe = sent.value
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for s, e in chunks(texts):
                lines = list({line for t in texts[s:e] for _, line in _lines(t)})
                h = np.fromiter(map(line_hash, lines), np.int64, len(lines))
                at = h % FILTER
                keep = np.flatnonzero(maybe[at >> 3] >> (at & 7).astype(np.uint8) & 1)
                yield pa.RecordBatch.from_arrays([pa.array(h[keep]), pa.array([lines[i] for i in keep], pa.string())], ["h", "line"])

    return (docs.select("text").mapInArrow(run, "h long, line string").join(wanted, "h", "left_semi")
            .groupBy("h").agg(F.first("line").alias("line")))


def repeated_lines(docs: DataFrame, similarity: float = SIMILARITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Lines to remove: (id_col, line_no from 0), each but the first occurrence
    (by id, then line) of its component of similar lines.

    Lines are stripped; blank ones never count.  Two lines are linked if the
    Jaccard similarity of their character shingles is ``similarity`` or more;
    a line with fewer characters is one shingle.  Equal lines are one node.
    A null text has no lines; rows with a null id take no part; a repeated
    row is the same document, not a second occurrence.
    """
    own = docs.filter(F.col(id_col).isNotNull()).select(id_col, F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    pairs = stage(_bands(own, _parts(own)).repartition("part").sortWithinPartitions("part").mapInArrow(_part_pairs, "a long, b long, crowd boolean")
                  .groupBy("a", "b").agg(F.max("crowd").alias("crowd")), "line-pairs")
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("h")).distinct()
    texts = stage(_line_texts(own, stage(wanted, "line-wanted")), "line-texts")
    roots = connected_components(_similar(pairs.drop("crowd"), texts, similarity), "line-components")
    crowd = pairs.filter("crowd").select(F.explode(F.array("a", "b")).alias("h")).distinct()
    crowd = stage(crowd.join(roots.withColumnRenamed("node", "h"), "h", "left").join(texts, "h")
                  .select("h", F.coalesce("root", "h").alias("root"), "line"), "line-crowd")
    if not crowd.isEmpty():
        more = stage(_similar(_crowd_pairs(crowd, similarity), texts, similarity), "line-more")
        if not more.isEmpty():
            roots = connected_components(roots.select(F.col("node").alias("src"), F.col("root").alias("dst")).unionByName(more), "line-components")
    seen = stage(_occurrences(own, id_col), "line-occurrences")
    nodes = (seen.groupBy("h").agg(F.count("*").alias("n"), F.min(F.struct(id_col, "line_no")).alias("first"))
             .join(roots.withColumnRenamed("node", "h"), "h", "left").filter("n > 1 or root is not null")
             .select("h", "first", F.coalesce("root", "h").alias("root")))
    nodes = stage(nodes, "line-nodes")
    # Written, so that the join below may split a component with very many lines.
    first = stage(nodes.groupBy("root").agg(F.min("first").alias("kept")), "line-first")
    kept = nodes.join(first, "root").select("h", "kept")
    # A repeated row's lines are removed once; dealt by id first, as the join must be free to split a frequent line.
    return (seen.join(kept, "h").filter(F.struct(id_col, "line_no") != F.col("kept")).select(id_col, "line_no", "h")
            .repartition(id_col).distinct().select(id_col, "line_no"))


def _removed_by_doc(docs: DataFrame, similarity: float, id_col: str, text_col: str) -> DataFrame:
    return (repeated_lines(docs, similarity, id_col, text_col).groupBy(id_col)
            .agg(F.sort_array(F.collect_list("line_no")).alias("removed")))


def line_report(docs: DataFrame, similarity: float = SIMILARITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_lines, n_removed, removed) for every row of ``docs``:
    ``removed`` lists the numbers of the lines that ``dedup_lines`` drops.
    A null text has no lines (an empty one has one, which is blank)."""
    rows = docs.select(id_col, F.coalesce(F.size(F.split(F.col(text_col), "\n", -1)), F.lit(0)).alias("n_lines"))
    rows = rows.withColumn("n_lines", F.when(F.col("n_lines") < 0, 0).otherwise(F.col("n_lines")))
    return (rows.join(_removed_by_doc(docs, similarity, id_col, text_col), id_col, "left")
            .select(id_col, "n_lines", F.coalesce(F.size("removed"), F.lit(0)).alias("n_removed"),
                    F.coalesce("removed", F.array().cast("array<int>")).alias("removed")))


def dedup_lines(docs: DataFrame, similarity: float = SIMILARITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` (all rows, all columns) without the lines of ``repeated_lines``;
    a text that loses all its lines becomes empty, a null text stays null."""
    extra = "removed" + "_" * max(map(len, docs.columns))  # longer than any column of theirs
    gone = _removed_by_doc(docs, similarity, id_col, text_col).withColumnRenamed("removed", extra)
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = batch.columns[:-1]
            out = []
            for text, removed in zip(columns[place], batch.column(len(columns))):
                text = text.as_py()
                if text is not None and removed.is_valid:
                    drop = set(removed.as_py())
                    text = "\n".join(t for i, t in enumerate(text.split("\n")) if i not in drop)
                out.append(text)
            columns[place] = pa.array(out, columns[place].type)
            yield pa.RecordBatch.from_arrays(columns, docs_columns)

    docs_columns = docs.columns
    return docs.join(gone, id_col, "left").select(*docs.columns, extra).mapInArrow(run, docs.schema)
