"""Problem 8: token ids of a byte-level BPE vocabulary, by batched merges in numpy.

Words (pieces of the public pre-tokenisation pattern) are encoded together: words of about one length form a
padded matrix of ids; in every round each row merges its leftmost pair of the lowest rank, found in a hashed table of
pairs, and rows are compacted by a mask. Finished rows leave the matrix. Known words come from a cache. Rounds cost a row's length each,
so words longer than the widest bucket (letters without blanks, rulers) take the same merges in the same order from a heap instead.

Defined results: null and empty texts have an empty list; signs that look like special tokens are ordinary text;
a lone surrogate cannot occur in a Spark string. Repeated rows give repeated rows; other columns are not read.
"""

from __future__ import annotations

import base64
import heapq
import os
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .arrow import CHUNK

TOKENIZERS = os.environ.get("PUBLIC_TOKENIZERS", "/opt/tokenizers")
#: Fixed value: the published pre-tokenisation pattern of the vocabulary.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
NONE = np.int32(2**31 - 1)
WIDTHS = (4, 8, 16, 32, 64, 128, 256)


class PairTable:
    """Open addressing over (left id, right id); the value is the merged id, which is also the rank."""

    def __init__(self, pairs: np.ndarray, merged: np.ndarray):
        self.bits = int(np.ceil(np.log2(max(len(merged), 2) * 4)))
        self.mask, size = (1 << self.bits) - 1, 1 << self.bits
        self.keys, self.vals = np.full(size, -1, np.int64), np.full(size, NONE, np.int32)
        key = (pairs[:, 0].astype(np.int64) << 20) | pairs[:, 1]
        slot, todo = self._slot(key), np.arange(len(key))
        self.probes, self._dict = 0, None
        while len(todo):
            self.probes += 1
            free = self.keys[slot[todo]] == -1
            at = todo[free]
            _, first = np.unique(slot[at], return_index=True)
            won = at[first]
            self.keys[slot[won]], self.vals[slot[won]] = key[won], merged[won]
            left = np.ones(len(key), bool)
            left[won] = False
            todo = todo[left[todo]]
            slot[todo] = (slot[todo] + 1) & self.mask

    def pairs(self) -> dict[int, int]:
        """The same pairs as a dict, made when first needed."""
        if self._dict is None:
            used = self.keys >= 0
            self._dict = dict(zip(self.keys[used].tolist(), self.vals[used].tolist()))
        return self._dict

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key * np.int64(0x9E3779B97F4A7C1 & 0x7FFFFFFFFFFFFFFF)) >> np.int64(63 - self.bits - 8)) & np.int64(self.mask)

    def get(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair, NONE where there is none or a side is padding (negative)."""
        key = (a.astype(np.int64) << 20) | b
        key = np.where((a < 0) | (b < 0), np.int64(-2), key)
        out, slot = np.full(key.shape, NONE, np.int32), self._slot(key)
        live = key != -2
        for _ in range(self.probes):
            k = self.keys[slot]
            hit = live & (k == key)
            out = np.where(hit, self.vals[slot], out)
            live &= ~hit & (k != -1)
            if not live.any():
                break
            slot = (slot + 1) & self.mask
        return out


@lru_cache(2)
def load(folder: str, name: str = "byte_bpe_50k.tiktoken") -> tuple[np.ndarray, PairTable, dict[bytes, int]]:
    """Ids of the 256 bytes, the pair table, and the ranks."""
    with open(os.path.join(folder, name), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f) if a}
    pairs, merged = [], []
    for token, rank in ranks.items():
        for k in range(1, len(token)):
            a, b = ranks.get(token[:k]), ranks.get(token[k:])
            if a is not None and b is not None:
                pairs.append((a, b))
                merged.append(rank)
    byte_ids = np.array([ranks[bytes([k])] for k in range(256)], np.int32)
    return byte_ids, PairTable(np.array(pairs, np.int64), np.array(merged, np.int32)), ranks


def merge_rows(ids: np.ndarray, table: PairTable) -> np.ndarray:
    """ids: rows padded with -1 at the right. Returns the same matrix after all merges."""
    rows, active = ids.copy(), np.arange(len(ids))
    work = ids
    rank = table.get(work[:, :-1], work[:, 1:]) if work.shape[1] > 1 else np.full((len(work), 1), NONE, np.int32)
    while len(active):
        at = rank.argmin(axis=1)  # the leftmost of the lowest
        best = rank[np.arange(len(work)), at]
        done = best == NONE
        if done.any():
            rows[active[done], : work.shape[1]] = work[done]
            rows[active[done], work.shape[1] :] = -1
            keep = ~done
            active, work, at, best = active[keep], work[keep], at[keep], best[keep]
            if not len(active):
                break
        r = np.arange(len(work))
        work[r, at] = best
        mask = np.ones(work.shape, bool)
        mask[r, at + 1] = False
        work = work[mask].reshape(len(work), -1)  # one id less in every row
        if work.shape[1] == 1:
            rows[active, :1] = work
            rows[active, 1:] = -1
            break
        rank = table.get(work[:, :-1], work[:, 1:])
    return rows


def merge_long(ids: list[int], table: PairTable) -> list[int]:
    """ids after all merges, each the leftmost pair of the lowest rank, in time near to the length: a heap of ranked places over linked ids."""
    n = len(ids)
    ids, after, before = list(ids), list(range(1, n + 1)), list(range(-1, n - 1))
    rank = table.get(np.array(ids[:-1], np.int32), np.array(ids[1:], np.int32))
    heap = [(r, k) for k, r in enumerate(rank.tolist()) if r != NONE]
    heapq.heapify(heap)
    pair = table.pairs()
    live = rank.tolist() + [int(NONE)]  # rank of the pair that begins at each place; entries of the heap with another are past
    while heap:
        r, k = heapq.heappop(heap)
        if live[k] != r:
            continue
        gone = after[k]
        ids[k], after[k], live[gone] = r, after[gone], -1
        if after[k] < n:
            before[after[k]] = k
        for at in (before[k], k):
            if at >= 0:
                nxt = after[at]
                live[at] = new = pair.get(ids[at] << 20 | ids[nxt], -1) if nxt < n else -1
                if new >= 0:
                    heapq.heappush(heap, (new, at))
    out, k = [], 0
    while k < n:
        out.append(ids[k])
        k = after[k]
    return out


def encode_words(words: list[str], byte_ids: np.ndarray, table: PairTable) -> list[np.ndarray]:
    """Ids of each word, by buckets of length; words longer than the widest bucket one by one."""
    raw = [w.encode("utf-8", "surrogatepass") for w in words]
    out: list[np.ndarray] = [np.empty(0, np.int32)] * len(words)
    buckets: dict[int, list[int]] = {}
    for k, b in enumerate(raw):
        n = len(b)
        if n > WIDTHS[-1]:
            out[k] = np.array(merge_long(byte_ids[np.frombuffer(b, np.uint8)].tolist(), table), np.int32)
        else:
            buckets.setdefault(next(w for w in WIDTHS if n <= w), []).append(k)
    for width, members in buckets.items():
        for s in range(0, len(members), max(1, 400_000 // width)):
            part = members[s : s + max(1, 400_000 // width)]
            m = np.full((len(part), width), -1, np.int32)
            lens = np.array([len(raw[k]) for k in part])
            m[np.arange(width) < lens[:, None]] = byte_ids[np.frombuffer(b"".join(raw[k] for k in part), np.uint8)]
            done = merge_rows(m, table)
            for k, row, n in zip(part, done, (done >= 0).sum(axis=1)):
                out[k] = row[:n]
    return out


class Encoder:
    """Keeps the ids of known words in one flat pool, so that texts are put together by gathers."""

    def __init__(self, folder: str = TOKENIZERS, most: int = 300_000):
        import regex

        self.byte_ids, self.table, _ = load(folder)
        self.find, self.most = regex.compile(PATTERN).findall, most
        self.reset()

    def reset(self) -> None:
        self.index: dict[str, int] = {}
        self.pool, self.start, self.count = np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.int64)

    def learn(self, words: list[str]) -> None:
        ids = encode_words(words, self.byte_ids, self.table)
        lens = np.array([len(x) for x in ids], np.int64)
        starts = len(self.pool) + np.cumsum(lens) - lens
        self.pool = np.concatenate([self.pool, *ids])
        self.start, self.count = np.concatenate([self.start, starts]), np.concatenate([self.count, lens])
        self.index.update(zip(words, range(len(self.index), len(self.index) + len(words))))

    def __call__(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Offsets and values of a list array, one list a text."""
        if len(self.index) > self.most:
            self.reset()
        words: list[str] = []
        ends = []
        for t in texts:
            if t:
                words += self.find(t)
            ends.append(len(words))
        new = list(dict.fromkeys(w for w in set(words) if w not in self.index))
        if new:
            self.learn(new)
        if not words:
            return np.zeros(len(texts) + 1, np.int32), np.empty(0, np.int32)
        at = np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))
        n = self.count[at]
        upto = np.cumsum(n)
        values = self.pool[np.repeat(self.start[at] - (upto - n), n) + np.arange(upto[-1])]
        return np.concatenate([[0], np.concatenate([[0], upto])[ends]]).astype(np.int32), values


def encode(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", folder: str = TOKENIZERS) -> DataFrame:
    """(id, ids) of every row; a narrow map without shuffle."""

    def run(batches):
        enc = Encoder(folder)
        for batch in batches:
            for k in range(0, batch.num_rows, CHUNK):
                part = batch.slice(k, CHUNK)
                offsets, values = enc(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))], ["doc_id", "ids"])

    kind = dict(df.dtypes)[id_col]
    return df.select(df[id_col].alias("doc_id"), df[text_col].alias("text")).mapInArrow(run, f"doc_id {kind}, ids array<int>")
