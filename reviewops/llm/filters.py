"""Counting quotient filters: sorted multisets of fixed-width keys in few bits, without loss.

A key of ``2 * half`` bits (up to 128) is first put through a permutation of its own width, which
can be undone; so keys spread evenly whatever they were, and nothing is lost.  The permuted key is
taken apart: its leading bits name a bucket (who merges it), the next ones are the quotient, the
rest the full remainder.  A filter holds the keys of one bucket in order: one bit per quotient that
occurs, one bit per key that ends its quotient's run, the remainders in whole bytes, one bit per key
whose count is not one, and those counts.  Filters of a bucket are merged by order, adding
counts.

Keys are pairs of arrays ``(high, low)`` of 64-bit words; ``high`` is all zero up to 64 bits.
"""

from __future__ import annotations

import struct

import numpy as np

from reviewops.llm.common import mix

_U = np.uint64
_ROUNDS = [_U(x) for x in (0x243F6A8885A308D3, 0x13198A2E03707344, 0xA4093822299F31D0, 0x082EFA98EC4E6C89)]
_HEAD = struct.Struct("<BBBQQ")  # quotient bits, bytes of a remainder, bytes of a count, keys, counts
Keys = tuple[np.ndarray, np.ndarray]


def _mask(bits: int) -> np.uint64:
    return _U((1 << bits) - 1)


def permuted(left: np.ndarray, right: np.ndarray, half: int) -> Keys:
    """The permutation of ``(left, right)``, halves of ``half`` bits each: rounds that add a mix of
    one half to the other."""
    for k, salt in enumerate(_ROUNDS):
        if k % 2:
            left = left ^ (mix(right + salt) & _mask(half))
        else:
            right = right ^ (mix(left + salt) & _mask(half))
    return _packed(left, right, half)


def restored(keys: Keys, half: int) -> tuple[np.ndarray, np.ndarray]:
    """The inverse: the rounds backwards."""
    left, right = _halves(keys, half)
    for k, salt in reversed(list(enumerate(_ROUNDS))):
        if k % 2:
            left = left ^ (mix(right + salt) & _mask(half))
        else:
            right = right ^ (mix(left + salt) & _mask(half))
    return left, right


def _packed(left, right, half) -> Keys:
    if 2 * half <= 64:
        return np.zeros_like(left), (left << _U(half)) | right
    # high takes the leading 2 * half - 64 bits
    return left >> _U(64 - half), (left << _U(half) if half < 64 else _U(0)) | right


def _halves(keys: Keys, half: int):
    high, low = keys
    if 2 * half <= 64:
        return low >> _U(half), low & _mask(half)
    return (high << _U(64 - half) | low >> _U(half) if half < 64 else high), low & _mask(half)


def leading(keys: Keys, bits: int, n: int) -> tuple[np.ndarray, Keys]:
    """The first ``n`` (at most 64) of ``bits`` bits, and the keys of the rest."""
    high, low = keys
    rest = bits - n
    if n == 0:
        return np.zeros_like(low), keys
    if bits <= 64:
        return (low >> _U(rest) if rest < 64 else np.zeros_like(low)), (high, low & _mask(rest))
    if rest >= 64:
        return high >> _U(rest - 64), (high & _mask(rest - 64), low)
    return (high << _U(64 - rest)) | (low >> _U(rest) if rest else low), (np.zeros_like(high), low & _mask(rest))


def joined(first: np.ndarray, keys: Keys, bits: int) -> Keys:
    """Keys of ``bits`` bits with ``first`` put in front: the inverse of ``leading``."""
    high, low = keys
    if bits >= 64:
        return high | first << _U(bits - 64), low
    return (high | (first >> _U(64 - bits) if bits else _U(0))), low | first << _U(bits)


def counted(keys: Keys, counts: np.ndarray | None = None) -> tuple[Keys, np.ndarray]:
    """Distinct keys in order, with summed counts (one each by default)."""
    high, low = keys
    if not len(low):
        return keys, np.empty(0, dtype=np.int64)
    if counts is None and not high.any():
        low, counts = np.unique(low, return_counts=True)
        return (np.zeros_like(low), low), counts.astype(np.int64)
    order = np.lexsort((low, high)) if high.any() else np.argsort(low, kind="stable")
    high, low = high[order], low[order]
    start = np.flatnonzero(np.concatenate([[True], (low[1:] != low[:-1]) | (high[1:] != high[:-1])]))
    sums = np.diff(np.append(start, len(low))) if counts is None else np.add.reduceat(counts[order], start)
    return (high[start], low[start]), sums.astype(np.int64)


def dump(keys: Keys, counts: np.ndarray, bits: int) -> bytes:
    """The filter of sorted distinct keys of ``bits`` bits."""
    n = len(counts)
    q = min(bits, max(n - 1, 0).bit_length())
    quotient, (high, low) = leading(keys, bits, q)
    occurs = np.zeros(1 << q, dtype=bool)
    occurs[quotient] = True
    ends = np.ones(n, dtype=bool)
    ends[:-1] = quotient[1:] != quotient[:-1]
    size = (bits - q + 7) // 8
    words = np.stack([low, high], axis=1).astype("<u8").view(np.uint8).reshape(n, 16)[:, :size]
    many = counts != 1
    more = counts[many]
    width = next(w for w in (1, 2, 4, 8) if not len(more) or int(more.max()) < 1 << (8 * w))
    return b"".join([_HEAD.pack(q, size, width, n, len(more)), np.packbits(occurs).tobytes(), np.packbits(ends).tobytes(),
                     words.tobytes(), np.packbits(many).tobytes(), more.astype(f"<u{width}").tobytes()])


def load(blob: bytes, bits: int) -> tuple[Keys, np.ndarray]:
    """Keys (in order) and counts of a filter."""
    q, size, width, n, more = _HEAD.unpack_from(blob)
    at = _HEAD.size

    def take(length):
        nonlocal at
        at += length
        return np.frombuffer(blob, dtype=np.uint8, count=length, offset=at - length)

    occurs = np.flatnonzero(np.unpackbits(take(((1 << q) + 7) // 8), count=1 << q)).astype(_U)
    ends = np.unpackbits(take((n + 7) // 8), count=n)
    words = np.zeros((n, 16), dtype=np.uint8)
    words[:, :size] = take(n * size).reshape(n, size)
    low, high = (words.view("<u8").astype(_U).T if n else np.empty((2, 0), dtype=_U))
    counts = np.ones(n, dtype=np.int64)
    many = np.unpackbits(take((n + 7) // 8), count=n).astype(bool)
    counts[many] = np.frombuffer(take(more * width).tobytes(), dtype=f"<u{width}")
    run = np.cumsum(ends, dtype=np.int64) - ends
    return joined(occurs[run], (high.copy(), low.copy()), bits - q), counts


def merged(blobs: list[bytes], bits: int) -> tuple[Keys, np.ndarray, list[Keys]]:
    """Distinct keys of all filters in order, summed counts, and each filter's own keys."""
    loaded = [load(b, bits) for b in blobs]
    high, low = (np.concatenate([k[i] for k, _ in loaded]) for i in (0, 1))
    keys, counts = counted((high, low), np.concatenate([c for _, c in loaded]))
    return keys, counts, [k for k, _ in loaded]
