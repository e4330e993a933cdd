"""BPE encoding and decoding by a pair occurrence index.

The vocabulary and merges come from a tokenizers JSON file (byte-level BPE);
its path is a parameter, the driver reads it and broadcasts the parsed model
(its size is that of the file, whatever the data).
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martforge.llm.common import chunks

# The split pattern of byte-level BPE; white space is Unicode's White_Space.
SPLIT = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
         r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")

#: Pieces whose ids a worker remembers; the memory is emptied when it is full.
REMEMBER = 300_000


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary:
    printable Latin-1 letters stand for themselves, the others follow from
    U+0100 in byte order."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


@dataclass
class Model:
    byte_ids: list[int]                       # id of each single byte
    ranks: dict[tuple[int, int], int]         # pair of ids -> rank
    merged: list[int]                         # rank -> id
    pairs: list[tuple[int, int]]              # rank -> pair of ids
    token_bytes: list[bytes]                  # id -> bytes
    special: dict[str, int]


def load_model(path: str) -> Model:
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    letters, vocab = byte_letters(), spec["model"]["vocab"]
    as_byte = {b: c for c, b in letters.items()}
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    tokens = [b""] * (1 + max([*vocab.values(), *special.values()]))
    for t, i in vocab.items():
        tokens[i] = bytes(letters[c] for c in t)
    for t, i in special.items():
        tokens[i] = t.encode()
    merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
    pairs = [(vocab[a], vocab[b]) for a, b in merges]
    return Model([vocab[as_byte[b]] for b in range(256)], {p: r for r, p in enumerate(pairs)},
                 [vocab[a + b] for a, b in merges], pairs, tokens, special)


def merge_pieces(model: Model, pieces: list[bytes]) -> list[np.ndarray]:
    """Token ids of each piece (no token crosses a piece).

    All pieces lie in one linked sequence of symbols.  The index maps each
    pair's rank to the positions at which the pair occurs; the active ranks
    are taken in ascending order from a heap, each rank's positions from left
    to right, and a merge adds the two new neighbouring pairs to the index.
    A position whose pair has changed since is passed over.
    """
    flat = b"".join(pieces)
    sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
    ends = np.cumsum(sizes)
    ids = np.array(model.byte_ids, np.int64)[np.frombuffer(flat, np.uint8)].tolist()
    n = len(ids)
    right = list(range(1, n + 1))
    left = list(range(-1, n - 1))
    for s in (ends - sizes).tolist():
        if s < n:
            left[s] = -1
    for e in ends.tolist():
        if e:
            right[e - 1] = -1
    rank_of, merged, pairs = model.ranks.get, model.merged, model.pairs
    index: dict[int, list[int]] = {}
    for i in range(n - 1):
        if right[i] >= 0 and (r := rank_of((ids[i], ids[i + 1]))) is not None:
            index.setdefault(r, []).append(i)
    active = list(index)
    heapq.heapify(active)
    while active:
        r = heapq.heappop(active)
        places = index.pop(r, None)
        if places is None:
            continue
        places.sort()
        (a, b), new = pairs[r], merged[r]
        for i in places:
            j = right[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue
            ids[i], ids[j] = new, -1
            k = right[i] = right[j]
            if k >= 0:
                left[k] = i
                if (s := rank_of((new, ids[k]))) is not None:
                    if s not in index:
                        index[s] = []
                        heapq.heappush(active, s)
                    index[s].append(i)
            h = left[i]
            if h >= 0 and (s := rank_of((ids[h], new))) is not None:
                if s not in index:
                    index[s] = []
                    heapq.heappush(active, s)
                index[s].append(h)
    out = np.array(ids, np.int64)
    alive = out >= 0
    kept = np.concatenate(([0], np.cumsum(alive)))
    out = out[alive].astype("<u4")
    return [out[s:e] for s, e in zip(kept[ends - sizes].tolist(), kept[ends].tolist())]


class Codec:
    """Encodes and decodes texts in one Python worker."""

    def __init__(self, model: Model):
        self.model = model
        self.split = regex.compile(SPLIT).findall
        self.known: dict[str, bytes] = {}
        self.special = None
        if model.special:
            longest = sorted(model.special, key=len, reverse=True)
            self.special = regex.compile("(" + "|".join(map(regex.escape, longest)) + ")").split
            self.special_ids = {t: np.array([i], "<u4").tobytes() for t, i in model.special.items()}

    def pieces(self, text: str) -> list[str]:
        return self.split(text)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        cut = []
        for t in texts:
            parts = self.special(t) if self.special and any(s in t for s in self.special_ids) else [t]
            cut.append([p if k % 2 else self.pieces(p) for k, p in enumerate(parts)])
        if len(self.known) > REMEMBER:
            self.known = {}
        new = list({p for parts in cut for x in parts if isinstance(x, list) for p in x} - self.known.keys())
        if new:
            for p, ids in zip(new, merge_pieces(self.model, [p.encode() for p in new])):
                self.known[p] = ids.tobytes()
        known = self.known.__getitem__
        return [b"".join(self.special_ids[x] if isinstance(x, str) else b"".join(map(known, x))
                         for x in parts) for parts in cut]

    def decode(self, ids: bytes) -> str:
        tokens = self.model.token_bytes
        return b"".join(map(tokens.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


def encode(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
           keep_ids: bool = True) -> DataFrame:
    """Encode and decode every whole text.

    Returns ``id_col``, n_tokens, ids (array of longs, if ``keep_ids``),
    ids_sha256 and decoded_sha256.  A null text counts as empty (no tokens,
    digests of the empty string); a null id is kept; repeated rows give
    repeated rows; an empty table gives no rows; other columns are not read.
    A text's special-token strings become the special ids.  Map-only.
    """
    model = docs.sparkSession.sparkContext.broadcast(load_model(tokenizer))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(model.value)
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1).to_pylist()
            for s, e in chunks(texts):
                own = codec.encode(texts[s:e])
                out = {id_col: keys.slice(s, e - s), "n_tokens": pa.array([len(x) // 4 for x in own], pa.int64())}
                if keep_ids:
                    out["ids"] = pa.array([np.frombuffer(x, "<u4").astype(np.int64) for x in own], pa.list_(pa.int64()))
                out["ids_sha256"] = [hashlib.sha256(x).hexdigest() for x in own]
                out["decoded_sha256"] = [hashlib.sha256(codec.decode(x).encode()).hexdigest() for x in own]
                yield pa.RecordBatch.from_pydict(out)

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, n_tokens long" + ", ids array<long>" * keep_ids + ", ids_sha256 string, decoded_sha256 string"
    return docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("text")).mapInArrow(run, schema)
