"""Hashes of words and of word windows over many documents at once, and their exchange in blocks.

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D. A word's hash takes eight bytes at a time, each
step a keyed mix of all that came before (so no arithmetic of bytes survives to collide by structure), and a long
word's comes from BLAKE2; window hashes roll over word hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa

_KEY = np.uint64(0x9E3779B97F4A7C15)
_ROLL = np.uint64(0xD1342543DE82EF95)
#: For a second hash of the same windows.
_CHECK = np.uint64(0xAF251AF3B0F025B5)
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
#: Keeps the first 0 to 8 bytes of a little-endian word.
_FIRST = np.array([(1 << 8 * k) - 1 for k in range(8)] + [(1 << 64) - 1], np.uint64)
#: Words of more bytes are hashed by BLAKE2.
LONG_WORD = 256
LOW56 = np.uint64((1 << 56) - 1)


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def span_hashes(joined: bytes, starts: np.ndarray, ends: np.ndarray, key: np.uint64 = _KEY) -> np.ndarray:
    """64-bit hash of joined[start:end] for each pair. Spans of up to eight bytes never collide with one of their length."""
    padded = np.frombuffer(joined + bytes(8), np.uint8)
    eight = np.ndarray((len(joined) + 1,), "<u8", padded.data, 0, (1,))  # the eight bytes from each place on
    size = (ends - starts).astype(np.int64)
    h = mix(size.astype(np.uint64) * _ROLL ^ key)
    active = np.flatnonzero(size <= LONG_WORD)
    at = 0
    while len(active):
        block = eight[starts[active] + at] & _FIRST[np.minimum(size[active] - at, 8)]
        h[active] = mix(h[active] ^ block) + key
        at += 8
        active = active[size[active] > at]
    for i in np.flatnonzero(size > LONG_WORD).tolist():
        h[i] = int.from_bytes(blake2b(joined[starts[i] : ends[i]], digest_size=8, key=key.tobytes()).digest(), "little")
    return h


def word_hashes(texts: list[bytes], lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word of all texts in order, and the number of words of each text."""
    joined = b" ".join(texts) + b" "
    if lower:
        joined = joined.lower()  # of bytes: A-Z only
    word = np.concatenate(([0], (~_SPACE[np.frombuffer(joined, np.uint8)]).view(np.int8), [0]))
    step = np.diff(word)
    starts, ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    begins = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts])))
    counts = np.diff(np.searchsorted(starts, begins))
    return span_hashes(joined, starts, ends), counts


def rolled(h: np.ndarray, k: int, base: np.uint64 = _ROLL) -> np.ndarray:
    """Rabin-Karp hash of the k words from each word on (of all words in a row)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    w = h[:n].copy()
    for j in range(1, k):
        w *= base
        w += h[j : j + n]
    return mix(w ^ np.uint64(k))


def window_hashes(texts: list[bytes], k: int, lower: bool = False) -> tuple[np.ndarray, ...]:
    """Of every window of k words within one text: hash, a further 32 bits of hash, text number, first word."""
    h, counts = word_hashes(texts, lower)
    doc = np.repeat(np.arange(len(texts)), counts)
    pos = np.arange(len(h)) - np.repeat(np.cumsum(counts) - counts, counts)
    w, check = rolled(h, k), rolled(h, k, _CHECK)
    ok = np.flatnonzero(pos[: len(w)] + k <= counts[doc[: len(w)]])
    return w[ok], (check[ok] >> np.uint64(32)).astype(np.uint32), doc[ok], pos[ok]


def shingle_sets(texts: list[bytes], k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct k-word shingles of each text (A-Z lower-cased): hashes ordered by text, and their number.
    A text of 1 to k - 1 words has one shingle, its whole sequence; one without words has none."""
    h, counts = word_hashes(texts, lower=True)
    doc = np.repeat(np.arange(len(texts)), counts)
    first = np.cumsum(counts) - counts
    pos = np.arange(len(h)) - np.repeat(first, counts)
    w = rolled(h, k)
    ok = np.flatnonzero(pos[: len(w)] + k <= counts[doc[: len(w)]])
    hashes, docs = [w[ok]], [doc[ok]]
    for short in range(1, k):
        at = np.flatnonzero(counts == short)
        if len(at):
            hashes.append(rolled(h, short)[first[at]])
            docs.append(at)
    hashes, docs = np.concatenate(hashes), np.concatenate(docs)
    order = np.lexsort((hashes, docs))
    hashes, docs = hashes[order], docs[order]
    new = np.ones(len(docs), bool)
    new[1:] = (docs[1:] != docs[:-1]) | (hashes[1:] != hashes[:-1])
    return hashes[new], np.bincount(docs[new], minlength=len(texts))


def bucket_bits(total_bytes: int) -> int:
    """Buckets (a power of two, 256 at least) such that each holds about half a million windows."""
    bits = 8
    while total_bytes >> bits > 4 << 20:
        bits += 1
    return bits


def runs(ordered: np.ndarray) -> list[tuple[int, int]]:
    """Begin and end of each run of equal values; none of an empty array."""
    if not len(ordered):
        return []
    cuts = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1]))).tolist()
    return list(zip(cuts, [*cuts[1:], len(ordered)], strict=True))


def by_bucket(h: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of all hashes in order, and the positions in h; the top bits of a hash are its bucket."""
    bucket = h >> np.uint64(64 - bits)
    bucket = bucket.astype(np.uint16 if bits <= 16 else np.uint32)
    order = np.argsort(bucket, kind="stable")
    return bucket[order], order


def split_by_bucket(h: np.ndarray, bits: int) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, positions in h)."""
    ordered, order = by_bucket(h, bits)
    for a, b in runs(ordered):
        yield int(ordered[a]), order[a:b]


def low_bytes(h: np.ndarray) -> bytes:
    """The low 56 bits of each hash; its bucket has the others."""
    return np.ascontiguousarray(h).view(np.uint8).reshape(-1, 8)[:, :7].tobytes()


def whole_hashes(b: bytes | np.ndarray, bucket: int, bits: int) -> np.ndarray:
    full = np.zeros((len(b) // 7, 8), np.uint8)
    full[:, :7] = np.frombuffer(b, np.uint8).reshape(-1, 7)
    full[:, 7] = bucket >> (bits - 8)
    return full.view("<u8").ravel()


def cuts(ordered: np.ndarray) -> np.ndarray:
    """Where each run of equal values begins, and the end at last."""
    begins = np.flatnonzero(ordered[1:] != ordered[:-1]) + 1
    return np.concatenate(([0], begins, [len(ordered)])) if len(ordered) else np.zeros(1, np.int64)


def packed(a: np.ndarray, at: np.ndarray) -> pa.Array:
    """A binary row for each run at[i] to at[i + 1] of a: its items as they are. All rows are made in one go: the
    pairs of a block and a bucket grow with the square of the input, so none may cost a step of Python."""
    a = np.ascontiguousarray(a)
    width = a.itemsize * (a.shape[1] if a.ndim > 1 else 1)
    return pa.Array.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer((at * width).astype(np.int32)), pa.py_buffer(a)])


def packed_hashes(h: np.ndarray, at: np.ndarray) -> pa.Array:
    """The low 56 bits of each hash; its bucket has the others."""
    return packed(np.ascontiguousarray(h).view(np.uint8).reshape(-1, 8)[:, :7], at)


def packed_numbers(a: np.ndarray, at: np.ndarray) -> pa.Array:
    """Unsigned numbers, seven bits a byte."""
    a = a.astype(np.uint64)
    size = np.ones(len(a), np.int64)
    for k in range(1, 10):
        more = a >> np.uint64(7 * k) != 0
        if not more.any():
            break
        size += more
    ends = np.cumsum(size)
    out = np.empty(int(size.sum()), np.uint8)
    begins, left = ends - size, np.arange(len(a))
    for k in range(10):
        if not len(left):
            break
        last = size[left] == k + 1
        out[begins[left] + k] = (a[left] >> np.uint64(7 * k)).astype(np.uint8) & 127 | np.where(last, 0, 128).astype(np.uint8)
        left = left[~last]
    return packed(out, np.append(0, ends)[at])


def packed_ids(ids: np.ndarray, at: np.ndarray) -> pa.Array:
    """Signed 64-bit ids by their differences in a row."""
    step = np.diff(ids, prepend=np.int64(0))
    step[at[:-1]] = ids[at[:-1]]
    return packed_numbers((step << 1 ^ step >> 63).view(np.uint64), at)


def _joined(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all rows of a binary column, and where each row begins, the end at last."""
    b = (column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column).cast(pa.binary())
    _, offsets, data = b.buffers()
    if not len(b):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, np.int32)[b.offset : b.offset + len(b) + 1].astype(np.int64)
    return np.frombuffer(data or b"", np.uint8)[at[0] : at[-1]], at - at[0]


def unpacked(column: pa.Array | pa.ChunkedArray, kind: np.dtype | type = np.uint8) -> np.ndarray:
    """The items of all rows of packed()."""
    return _joined(column)[0].view(kind)


def unpacked_hashes(column: pa.Array | pa.ChunkedArray, bucket: int, bits: int) -> np.ndarray:
    return whole_hashes(unpacked(column), bucket, bits)


def _numbers(b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers in b, and the place of each one's last byte."""
    ends = np.flatnonzero(b < 128)
    begins = np.append(0, ends[:-1] + 1)[: len(ends)]
    out = (b[begins] & 127).astype(np.uint64)
    left = np.flatnonzero(ends > begins)
    for k in range(1, 10):
        if not len(left):
            break
        out[left] |= (b[begins[left] + k] & 127).astype(np.uint64) << np.uint64(7 * k)
        left = left[ends[left] > begins[left] + k]
    return out, ends


def unpacked_numbers(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return _numbers(unpacked(column))[0]


def unpacked_ids(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    b, at = _joined(column)
    step, ends = _numbers(b)
    step = (step >> np.uint64(1)).view(np.int64) ^ -(step & np.uint64(1)).view(np.int64)
    first = np.searchsorted(ends, at)
    total = np.append(np.int64(0), np.cumsum(step))
    return total[1:] - np.repeat(total[first[:-1]], np.diff(first))
