"""Quality classifier: a factorisation machine over hashed words, structure
statistics and metadata.

A document's features are its hashed words (log counts, unit length), the
statistics of ``STATS`` (standardised on the training rows) and its stated
length.  The machine adds a weight for every feature and, for every pair of
features, the inner product of their factor vectors; the pairs are summed in
linear time as half of (square of the sum - sum of the squares) per factor.
"""

from __future__ import annotations

import unicodedata
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martforge.llm.common import chunks

#: Hash slots for words, and factors per feature.
SLOTS, FACTORS = 1 << 16, 8
#: The fit uses at most this many labelled rows, those with the smallest hash
#: of their id; everything else (scores) covers all rows.
TRAIN_ROWS = 8_000
EPOCHS, BATCH, RATE, DECAY = 12, 128, 0.02, 1e-4
STATS = ("upper", "lower", "digit", "space", "line_end", "sign", "mark", "word_letters", "distinct_words", "log_words",
         "log_lines", "repeated_lines", "log_chars", "stated_chars")
REMEMBER = 400_000


def _classes() -> np.ndarray:
    """Class of each code point: upper, lower, digit, space, line end, other sign, common mark, other letter."""
    out = np.full(0x110000, 7, np.uint8)
    kinds = {"Lu": 0, "Lt": 0, "Ll": 1, "Nd": 2, "Zs": 3, "Cc": 3}
    for c in range(0x10000):
        k = unicodedata.category(chr(c))
        out[c] = kinds.get(k, 5 if k[0] in "PS" else 7)
    out[[ord(c) for c in ".,;:'\"-"]] = 6
    out[10] = 4
    return out


class Features:
    """Turns texts into features in one Python process."""

    def __init__(self):
        self.classes = _classes()
        self.slots: dict[str, int] = {}

    def _slot(self, words) -> list[int]:
        known, out = self.slots, []
        if len(known) > REMEMBER:
            known.clear()
        for w in words:
            if (s := known.get(w)) is None:
                s = known[w] = zlib.crc32(w.encode()) % SLOTS
            out.append(s)
        return out

    def __call__(self, texts: list[str], stated: list[int | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(slots, values, rows per text, statistics per text)."""
        slots, values, rows = [], [], np.zeros(len(texts), np.int64)
        stats = np.zeros((len(texts), len(STATS)))
        for i, text in enumerate(texts):
            words = text.lower().split()
            counts = Counter(words)
            slots += self._slot(counts)
            rows[i] = len(counts)
            own = np.log1p(np.fromiter(counts.values(), np.float64, len(counts)))
            values.append(own / (np.sqrt(own @ own) or 1.0))
            lines = text.split("\n")
            kinds = np.bincount(self.classes[np.frombuffer(text.encode("utf-32-le"), np.uint32)], minlength=8)
            n, w = max(len(text), 1), max(len(words), 1)
            stats[i, :7] = kinds[:7] / n
            stats[i, 7:] = ((len(text) - kinds[3] - kinds[4]) / w, len(counts) / w, np.log1p(len(words)), np.log1p(len(lines)),
                            1 - len(set(lines)) / len(lines), np.log1p(len(text)),
                            np.log1p(len(text) if stated[i] is None else max(stated[i], 0)))
        return np.array(slots, np.int64), np.concatenate(values) if values else np.zeros(0), rows, stats


@dataclass
class Machine:
    bias: float
    weight: np.ndarray      # SLOTS + statistics
    factor: np.ndarray      # the same, by FACTORS
    mean: np.ndarray
    scale: np.ndarray

    def inputs(self, slots, values, rows, stats) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Feature numbers and values, text by text, and where each text begins."""
        dense = np.clip((stats - self.mean) / self.scale, -4, 4)
        n, extra = len(rows), stats.shape[1]
        ends = np.cumsum(rows)
        at = np.repeat(ends, extra)
        idx = np.insert(slots, at, np.tile(SLOTS + np.arange(extra), n))
        val = np.insert(values, at, dense.ravel() / np.sqrt(extra))
        return idx, val, np.concatenate(([0], (ends + extra * np.arange(1, n + 1))[:-1])).astype(np.int64)

    def raw(self, idx, val, first) -> tuple[np.ndarray, np.ndarray]:
        """Logits, and each text's factor sums."""
        vx = self.factor[idx] * val[:, None]
        total = np.add.reduceat(vx, first, axis=0)
        square = np.add.reduceat(vx * vx, first, axis=0)
        return self.bias + np.add.reduceat(self.weight[idx] * val, first) + 0.5 * (total * total - square).sum(1), total

    def score(self, features) -> np.ndarray:
        if not len(features[2]):
            return np.zeros(0)
        return _sigmoid(self.raw(*self.inputs(*features))[0])


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def fit(features, labels: np.ndarray, seed: int = 7) -> Machine:
    """Logistic loss, Adam on mini-batches, decay of weights and factors.
    No rows or one class only: a constant score of (ones + 1) / (rows + 2)."""
    slots, values, rows, stats = features
    width, n = SLOTS + len(STATS), len(labels)
    rng = np.random.default_rng(seed)
    prior = (labels.sum() + 1) / (n + 2)
    m = Machine(float(np.log(prior / (1 - prior))), np.zeros(width), np.zeros((width, FACTORS)),
                stats.mean(0) if n else np.zeros(len(STATS)), stats.std(0) + 1e-6 if n else np.ones(len(STATS)))
    if not n or labels.min() == labels.max():
        return m
    m.factor = rng.normal(0, 0.05, (width, FACTORS))
    idx, val, first = m.inputs(slots, values, rows, stats)
    size = np.diff(np.append(first, len(idx)))
    moments = [[np.zeros_like(p), np.zeros_like(p)] for p in (m.weight, m.factor, np.zeros(1))]
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(n)
        for s in range(0, n, BATCH):
            pick = order[s:s + BATCH]
            own = np.repeat(np.arange(len(pick)), size[pick])
            start = np.cumsum(size[pick]) - size[pick]
            at = np.arange(len(own)) - start[own] + first[pick][own]
            i, x = idx[at], val[at]
            z, total = m.raw(i, x, start)
            g = (_sigmoid(z) - labels[pick]) / len(pick)
            gx = g[own] * x
            grad_w = np.bincount(i, gx, width) + DECAY * m.weight
            grad_v = np.stack([np.bincount(i, gx * (total[own, f] - m.factor[i, f] * x), width) for f in range(FACTORS)], 1)
            grad_v += DECAY * m.factor
            step += 1
            for k, (p, d) in enumerate(((m.weight, grad_w), (m.factor, grad_v), (np.array([m.bias]), np.array([g.sum()])))):
                a, b = moments[k]
                a += 0.1 * (d - a)
                b += 0.001 * (d * d - b)
                p -= RATE * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.999 ** step)) + 1e-8)
                if k == 2:
                    m.bias = float(p[0])
    return m


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that the fit never sees: crc32 of the id as text, modulo 3, is 1 (a null id has no label)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, id_col: str = "doc_id",
          text_col: str = "text", chars_col: str = "n_chars") -> Machine:
    """Fit on at most ``train_rows`` labelled rows that are not held out.

    A document labelled several times has the majority label (ties: 1), null
    labels are ignored; of rows that share an id the one with the smallest
    hash of the text counts (picked per id before features are made, so an id
    on a million rows is one row of the sample).  Only the bounded sample's
    features reach the driver.  Without rows the model calls all texts good.
    """
    marks = (labels.filter(F.col("quality").isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col))
             .groupBy(id_col).agg((F.avg("quality") >= 0.5).cast("int").alias("_label"))
             .join(docs.select(id_col), id_col, "left_semi")
             .orderBy(F.xxhash64(id_col), id_col).limit(train_rows))
    chars = F.col(chars_col) if chars_col in docs.columns else F.lit(None)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = (docs.select(id_col, text.alias("_text"), chars.cast("long").alias("_chars")).join(F.broadcast(marks), id_col)
            .groupBy(id_col, "_label").agg(F.min(F.struct(F.xxhash64("_text"), "_text", "_chars")).alias("r"))
            .select(id_col, "_label", "r._text", "r._chars"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = Features()
        for batch in batches:
            texts, stated = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            for i in range(len(texts)):
                slots, values, _, stats = make(texts[i:i + 1], stated[i:i + 1])
                yield pa.RecordBatch.from_pydict({
                    "id": batch.column(0).slice(i, 1).cast(pa.string()), "label": batch.column(1).slice(i, 1),
                    "slots": pa.array([slots.astype(np.int32)], pa.list_(pa.int32())),
                    "vals": pa.array([values.astype(np.float32)], pa.list_(pa.float32())),
                    "stats": pa.array([stats[0]], pa.list_(pa.float64()))})

    got = rows.mapInArrow(run, "id string, label int, slots array<int>, vals array<float>, stats array<double>").toArrow()
    names, order = got.column("id").to_pylist(), []
    for i in sorted(range(len(names)), key=lambda i: (zlib.crc32(names[i].encode()), names[i])):
        if not order or names[i] != names[order[-1]]:
            order.append(i)
    slots = [np.array(got.column("slots")[i].values, np.int64) for i in order]
    values = [np.array(got.column("vals")[i].values, np.float64) for i in order]
    stats = np.array([got.column("stats")[i].as_py() for i in order]).reshape(-1, len(STATS))
    y = np.array([got.column("label")[i].as_py() for i in order], np.float64)
    flat = lambda x, t: np.concatenate(x) if x else np.zeros(0, t)
    return fit((flat(slots, np.int64), flat(values, np.float64), np.array([len(s) for s in slots], np.int64), stats), y)


def score(docs: DataFrame, model: Machine, id_col: str = "doc_id", text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """(id_col, held_out, score, predicted) for every row of ``docs``.

    ``score`` (0 to 1) is the probability of label 1, ``predicted`` is 1 from
    0.5 up.  A null text counts as empty; an empty text is scored from its
    statistics; a null stated length is replaced by the text's own; null ids
    and repeated rows are kept; an empty table gives no rows.  Map-only.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)  # fixed size
    kind = docs.schema[id_col].dataType.simpleString()
    chars = F.col(chars_col) if chars_col in docs.columns else F.lit(None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = Features()
        for batch in batches:
            texts, stated = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            for s, e in chunks(texts):
                p = sent.value.score(make(texts[s:e], stated[s:e]))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(s, e - s), batch.column(3).slice(s, e - s), pa.array(p),
                                                  pa.array((p >= 0.5).astype(np.int32))], [id_col, "held_out", "score", "predicted"])

    return (docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("_text"), chars.cast("long").alias("_chars"),
                        held_out(id_col).alias("held_out"))
            .mapInArrow(run, f"`{id_col}` {kind}, held_out boolean, score double, predicted int"))


def keep_good(docs: DataFrame, model: Machine, text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """The rows of ``docs`` (all columns) that ``model`` does not reject."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = Features()
        for batch in batches:
            texts = [t or "" for t in batch.column(text_col).to_pylist()]
            stated = batch.column(chars_col).to_pylist() if chars_col in batch.schema.names else [None] * len(texts)
            for s, e in chunks(texts):
                good = sent.value.score(make(texts[s:e], stated[s:e])) >= 0.5
                yield batch.slice(s, e - s).filter(pa.array(good))

    return docs.mapInArrow(run, docs.schema)
