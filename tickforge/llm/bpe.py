"""Byte-level BPE by merges on length-bucketed, padded numpy matrices.

Every distinct piece of the split pattern is a row of a matrix of token ids.  In each round every row merges its
leftmost pair of least rank, found by a hashed pair lookup, and finished rows and emptied columns are compacted away.
A very long piece has a matrix of one row, in which a round takes not only the leftmost pair of least rank but all of
that rank up to the first whose merge would bring a lesser one about; merging these one by one gives the same.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickforge.llm.bytesops import map_batches, slices

_NONE = np.int32(np.iinfo(np.int32).max)
#: Pieces of more bytes than this have a matrix of their own.
LONG = 4096
_loaded: dict[tuple[str, str], "ByteBpe"] = {}


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a file with lines "base64 rank"."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class ByteBpe:
    """Encoder and decoder for one rank table.

    encode_pieces(pieces) returns a list of id lists.  A piece that is a token itself is that one id.  Pieces of any
    length are accepted; a row of n bytes takes at most n - 1 rounds, one of more than LONG bytes about as many as there
    are different tokens in it, so that time is near linear in its length.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str, most_cached: int = 100_000):
        self.ranks, self.pattern, self.most_cached = ranks, regex.compile(pattern), most_cached
        self.token = {v: k for k, v in ranks.items()}
        self.decimal = {i: str(i) for i in self.token}
        self.byte_id = np.array([ranks[bytes([i])] for i in range(256)], dtype=np.int32)
        self.n = max(ranks.values()) + 1
        self._build_pairs()
        self.cache: dict[str, tuple[int, str, bytes]] = {}
        self.older: dict[str, tuple[int, str, bytes]] = {}

    def _build_pairs(self) -> None:
        """Open-addressing table: (left id, right id) -> merged id, for every split of a token into two tokens."""
        keys, merged = [], []
        for t, r in self.ranks.items():
            for cut in range(1, len(t)):
                a, b = self.ranks.get(t[:cut]), self.ranks.get(t[cut:])
                if a is not None and b is not None:
                    keys.append(a * self.n + b)
                    merged.append(r)
        k, m = np.array(keys, dtype=np.int64), np.array(merged, dtype=np.int32)
        bits = max(4, int(2 * max(len(k), 1) - 1).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.slot_key = np.full(1 << bits, -1, dtype=np.int64)
        self.slot_id = np.full(1 << bits, _NONE, dtype=np.int32)
        at, left = self._home(k), np.arange(len(k))
        self.probes = 0
        while len(left):
            self.probes += 1
            free = self.slot_key[at[left]] < 0
            first = np.unique(at[left[free]], return_index=True)[1]
            put = left[free][first]
            self.slot_key[at[put]], self.slot_id[at[put]] = k[put], m[put]
            left = np.setdiff1d(left, put, assume_unique=True)
            at[left] = (at[left] + 1) & self.mask

    def _home(self, key: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def _lookup(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Merged id of each pair, or the largest int32; a negative id pairs with nothing."""
        key = a.astype(np.int64) * self.n + b
        key[(a < 0) | (b < 0)] = -2
        at = self._home(key)
        out = np.where(self.slot_key[at] == key, self.slot_id[at], _NONE)
        open_ = np.flatnonzero((self.slot_key[at] != key) & (self.slot_key[at] >= 0) & (key >= 0)) if key.ndim == 1 else None
        if open_ is None:
            flat = out.reshape(-1)
            kf, af = key.reshape(-1), at.reshape(-1)
            open_ = np.flatnonzero((self.slot_key[af] != kf) & (self.slot_key[af] >= 0) & (kf >= 0))
        else:
            flat, kf, af = out, key, at
        at2 = af[open_]
        while len(open_):
            at2 = (at2 + 1) & self.mask
            hit = self.slot_key[at2] == kf[open_]
            flat[open_[hit]] = self.slot_id[at2[hit]]
            go = ~hit & (self.slot_key[at2] >= 0)
            open_, at2 = open_[go], at2[go]
        return out

    def _merge_bucket(self, rows: list[bytes], out: list, where: list[int]) -> None:
        width = max(map(len, rows))
        length = np.array([len(x) for x in rows])
        ids = np.full((len(rows), width), -1, dtype=np.int32)
        ids[np.arange(width) < length[:, None]] = self.byte_id[np.frombuffer(b"".join(rows), dtype=np.uint8)]
        index = np.array(where)
        rank = self._lookup(ids[:, :-1], ids[:, 1:]) if width > 1 else np.full((len(rows), 1), _NONE, np.int32)
        while len(ids):
            best = rank.argmin(axis=1)
            row = np.arange(len(ids))
            low = rank[row, best]
            done = low == _NONE
            if done.any():
                for i in np.flatnonzero(done).tolist():
                    out[index[i]] = ids[i, : length[i]].tolist()
                live = ~done
                ids, rank, length, index, best, low = ids[live], rank[live], length[live], index[live], best[live], low[live]
                if not len(ids):
                    return
                width = int(length.max())
                ids, rank = ids[:, :width], rank[:, : max(width - 1, 1)]
                row = np.arange(len(ids))
            # every row loses the column right of its merged pair; then the two pairs that changed are looked up
            keep = np.ones(ids.shape, dtype=bool)
            keep[row, best + 1] = False
            ids[row, best] = low
            ids = ids[keep].reshape(len(ids), -1)
            length -= 1
            keep = np.ones(rank.shape, dtype=bool)
            keep[row, best] = False
            rank = rank[keep].reshape(len(ids), -1)
            if ids.shape[1] == 1:
                rank = np.full((len(ids), 1), _NONE, np.int32)
                continue
            left = np.flatnonzero(best > 0)
            rank[left, best[left] - 1] = self._lookup(ids[left, best[left] - 1], low[left])
            right = np.flatnonzero(best < rank.shape[1])
            rank[right, best[right]] = self._lookup(low[right], ids[right, best[right] + 1])

    def _merge_long(self, piece: bytes) -> list[int]:
        """The ids of one long piece; live cells are linked, and dead ones compacted away once they are the half."""
        ids = np.append(self.byte_id[np.frombuffer(piece, dtype=np.uint8)], [-1, -1]).astype(np.int32)
        while True:
            n = len(ids) - 2  # two cells of -1 stand for both ends
            after, prior = np.arange(1, n + 3), np.arange(-1, n + 1)
            after[n + 1], prior[0], dead = n, n + 1, 0
            rank = np.full(n + 2, _NONE, dtype=np.int32)
            rank[:n] = self._lookup(ids[:n], ids[1 : n + 1])
            gone = np.zeros(n + 2, dtype=bool)
            while dead * 2 <= n and (low := rank.min()) != _NONE:
                at = np.flatnonzero(rank == low)
                # of pairs that overlap, every other one from the left
                apart = np.concatenate([[True], after[at[:-1]] != at[1:]])
                k = np.arange(len(at))
                at = at[(k - np.maximum.accumulate(np.where(apart, k, 0))) % 2 == 0]
                second = after[at]
                left = ids[prior[at]]
                left[1:][prior[at[1:]] == second[:-1]] = low
                lesser = np.flatnonzero(np.minimum(self._lookup(left, np.full(len(at), low)), self._lookup(np.full(len(at), low), ids[after[second]])) < low)
                if len(lesser):
                    at, second = at[: lesser[0] + 1], second[: lesser[0] + 1]
                ids[at], after[at] = low, after[second]
                prior[after[at]] = at
                rank[second], gone[second] = _NONE, True
                dead += len(at)
                before = prior[at]
                rank[at] = self._lookup(ids[at], ids[after[at]])
                rank[before] = self._lookup(ids[before], ids[after[before]])
                rank[n + 1] = _NONE
            ids = ids[~gone]
            if not dead or low == _NONE:
                return ids[:-2].tolist()

    def encode_pieces(self, pieces: list[bytes], cells: int = 1 << 18) -> list[list[int]]:
        out: list = [None] * len(pieces)
        todo = []
        for i, p in enumerate(pieces):
            r = self.ranks.get(p)
            if r is not None:
                out[i] = [r]
            elif len(p) > LONG:
                out[i] = self._merge_long(p)
            elif p:
                todo.append(i)
            else:
                out[i] = []
        todo.sort(key=lambda i: len(pieces[i]))
        a = 0
        while a < len(todo):
            n = len(pieces[todo[a]])
            edge = 1 << (n - 1).bit_length() if n > 1 else 1
            b, most = a, max(1, cells // edge)
            while b < len(todo) and b - a < most and len(pieces[todo[b]]) <= edge:
                b += 1
            self._merge_bucket([pieces[i] for i in todo[a:b]], out, todo[a:b])
            a = b
        return out

    def split(self, text: str) -> list[str]:
        return self.pattern.findall(text)

    def learn(self, pieces: set[str]) -> dict[str, tuple[int, str, bytes]]:
        """(number of ids, their decimals, decoded bytes) of each piece.

        What was needed lately is kept: two generations of at most most_cached pieces, the older of which goes when
        the younger is full.
        """
        out, new = {}, []
        for p in pieces:
            got = self.cache.get(p) or self.older.get(p)
            if got is None:
                new.append(p)
            else:
                out[p] = got
        for p, ids in zip(new, self.encode_pieces([p.encode("utf-8") for p in new]), strict=True):
            out[p] = (len(ids), ",".join([self.decimal[i] for i in ids]), self.decode(ids))
        if len(self.cache) + len(out) > self.most_cached:
            self.older, self.cache = self.cache, {}
        self.cache.update(out)
        return out

    def encode(self, text: str) -> list[int]:
        return [i for ids in self.encode_pieces([p.encode("utf-8") for p in self.split(text)]) for i in ids]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join([self.token[i] for i in ids])


def load(path: str, pattern: str) -> ByteBpe:
    """One encoder for each process and rank file."""
    if (path, pattern) not in _loaded:
        _loaded[path, pattern] = ByteBpe(read_ranks(path), pattern)
    return _loaded[path, pattern]


def bpe_tokens(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>) of every row; null or empty text gives an empty array; ids may be null or repeated."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path, pattern)
        for batch in batches:
            for part in slices(batch, "text"):
                split = [bpe.split(t) if t else [] for t in part.column("text").to_pylist()]
                names = list({p for ps in split for p in ps})
                ids = dict(zip(names, bpe.encode_pieces([p.encode("utf-8") for p in names]), strict=True))
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array([[i for p in ps for i in ids[p]] for ps in split], pa.list_(pa.int32()))], ["id", "ids"])

    kind = dict(df.dtypes)[id_col]
    return map_batches(df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), run, f"id {kind}, ids array<int>").withColumnRenamed("id", id_col)


def bpe_digest(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) of every row, for whole texts.

    Texts: null counts as empty (0 tokens, the digest of no bytes); long texts are taken whole.  Rows: ids may be
    null or repeated, each row gives one row; other columns are ignored, whatever their names.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path, pattern)
        try:
            for batch in batches:
                for part in slices(batch, "text"):
                    split = [bpe.split(t) if t else [] for t in part.column("text").to_pylist()]
                    known = bpe.learn({p for ps in split for p in ps})
                    count, sha, back = [], [], []
                    for ps in split:
                        got = [known[p] for p in ps]
                        count.append(sum([g[0] for g in got]))
                        sha.append(hashlib.sha256(",".join([g[1] for g in got]).encode()).hexdigest())
                        back.append(hashlib.sha256(b"".join([g[2] for g in got])).hexdigest())
                    yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(count, pa.int64()), pa.array(sha, pa.string()), pa.array(back, pa.string())], ["id", "n_tokens", "ids_sha256", "decoded_sha256"])
        finally:  # the worker lives on
            bpe.cache, bpe.older = {}, {}

    kind = dict(df.dtypes)[id_col]
    return map_batches(df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), run, f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string").withColumnRenamed("id", id_col)
