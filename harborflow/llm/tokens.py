"""Byte-level BPE ids of whole texts, for tasks that work on Arrow batches.

The tokenizer's pattern never joins what lies before white space with what follows it, so a text can be encoded in units of
white space and the word after it. Each worker keeps the ids of units that it has met, by 64-bit hash and byte length,
and encodes only new ones. Texts with white space outside ASCII are encoded whole.
"""

from __future__ import annotations

import base64
import functools

import numpy as np
import tiktoken

from harborflow.llm import words as wd

CACHE_UNITS = 2_000_000
# Fixed value: the public pattern that splits texts before byte-level BPE merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@functools.cache
def encoding(path: str, pattern: str = PATTERN) -> tiktoken.Encoding:
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding(path, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def ranges(begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The numbers begin[i] .. begin[i] + length[i] - 1, for each i in turn."""
    total = int(length.sum())
    stops = np.cumsum(length)
    return np.arange(total) + np.repeat(begin - (stops - length), length)


def _odd_space(data: np.ndarray) -> np.ndarray:
    """Bytes that may belong to white space outside 0x20 and 0x09-0x0D."""
    after = np.zeros(len(data), np.uint8)
    after[:-1] = data[1:]
    odd = (data >= 0x1C) & (data <= 0x1F)
    for lead, following in ((0xC2, (0x85, 0xA0)), (0xE1, (0x9A,)), (0xE2, (0x80, 0x81)), (0xE3, (0x80,))):
        odd |= (data == lead) & np.isin(after, following)
    return odd


class Encoder:
    """Ids of the texts of a chunk; one per worker and vocabulary file."""

    def __init__(self, path: str):
        self.encoding = encoding(path)
        self._forget()

    def _forget(self) -> None:
        self.known = np.zeros(0, np.uint64)  # sorted unit hashes
        self.begin = np.zeros(0, np.int64)
        self.length = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _learn(self, hashes: np.ndarray, start: np.ndarray, end: np.ndarray, data: np.ndarray) -> None:
        raw, encode = data.tobytes(), self.encoding.encode_ordinary
        new = [encode(raw[a:b].decode()) for a, b in zip(start.tolist(), end.tolist(), strict=True)]
        length = np.fromiter(map(len, new), np.int64, len(new))
        begin = len(self.ids) + np.cumsum(length) - length
        flat = np.fromiter((i for unit in new for i in unit), np.uint32, int(length.sum()))
        self.ids = np.concatenate([self.ids, flat])
        at = np.searchsorted(self.known, hashes)
        self.known = np.insert(self.known, at, hashes)
        self.begin, self.length = np.insert(self.begin, at, begin), np.insert(self.length, at, length)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the chunk, and where each text's begin (one more entry closes the last)."""
        start, end, first = wd.spans(data, offsets)
        texts, counts = len(offsets) - 1, np.diff(first)
        # A unit reaches from the end of the word before it to the end of its own; white space after the last is one more.
        unit_from = np.empty(len(start), np.int64)
        unit_from[1:] = end[:-1]
        unit_from[first[:-1][counts > 0]] = offsets[:-1][counts > 0]
        last_end = offsets[:-1].copy()
        last_end[counts > 0] = end[first[1:][counts > 0] - 1]
        tail = offsets[1:] > last_end
        owner = np.concatenate([np.repeat(np.arange(texts), counts), np.flatnonzero(tail)])
        order = np.argsort(owner, kind="stable")
        begin = np.concatenate([unit_from, last_end[tail]])[order]
        stop = np.concatenate([end, offsets[1:][tail]])[order]
        owner = owner[order]
        hashes = wd.text_hashes(data, begin, stop)
        odd = np.add.reduceat(np.append(_odd_space(data), False).astype(np.int64), np.minimum(offsets[:-1], len(data))) > 0
        odd &= np.diff(offsets) > 0
        plain = ~odd[owner]
        distinct, where, unit = np.unique(hashes[plain], return_index=True, return_inverse=True)
        at = np.minimum(np.searchsorted(self.known, distinct), max(len(self.known) - 1, 0))
        new = self.known[at] != distinct if len(self.known) else np.ones(len(distinct), bool)
        if new.any():
            if len(self.known) + int(new.sum()) > CACHE_UNITS:
                self._forget()
                new[:] = True
            self._learn(distinct[new], begin[plain][where[new]], stop[plain][where[new]], data)
            at = np.searchsorted(self.known, distinct)
        length = self.length[at][unit]
        ids = self.ids[ranges(self.begin[at][unit], length)]
        sizes = np.bincount(owner[plain], weights=length, minlength=texts).astype(np.int64) if len(length) else np.zeros(texts, np.int64)
        if odd.any():
            ids, sizes = self._whole(data, offsets, odd, ids, sizes)
        return ids, np.concatenate([[0], np.cumsum(sizes)])

    def _whole(self, data, offsets, odd, ids, sizes):
        parts, at = [], np.concatenate([[0], np.cumsum(sizes)])
        sizes = sizes.copy()
        for i in range(len(odd)):
            if odd[i]:
                text = data[offsets[i]:offsets[i + 1]].tobytes().decode()
                parts.append(np.array(self.encoding.encode_ordinary(text), np.uint32))
                sizes[i] = len(parts[-1])
            else:
                parts.append(ids[at[i]:at[i + 1]])
        return np.concatenate(parts), sizes


@functools.cache
def encoder(path: str) -> Encoder:
    return Encoder(path)
