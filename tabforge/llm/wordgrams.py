"""Words of a batch of texts as spans of one byte buffer, and a table that numbers equal spans, in array operations.

A word is a run of ASCII letters, digits and bytes beyond ASCII; A-Z only is lower-cased. All other bytes part words.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import xxhash

#: Bytes of texts whose words are in memory at once.
PIECE_BYTES = 2_000_000
_PAD = 32
_WORD = np.zeros(256, bool)
_WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32

# fixed values: the five primes of XXH64
_P1, _P2, _P3, _P4, _P5 = (
    np.uint64(p)
    for p in (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261)
)


@dataclass
class Words:
    """Words of some rows: ``data`` holds them one blank apart, and after the last ``_PAD`` blanks."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    row: np.ndarray


def _split(raw: bytes, rows: np.ndarray, bounds: np.ndarray) -> Words:
    """Words of ``raw``, whose rows begin at ``bounds`` and end with a byte that is not of a word."""
    points = np.frombuffer(raw, np.uint8)
    inside = _WORD[points]
    before = np.r_[False, inside[:-1]]
    last = np.flatnonzero(before & ~inside)
    kept = inside | before
    data = np.r_[np.where(inside, _LOWER[points], 32)[kept], np.full(_PAD, 32)].astype(np.uint8)
    end = np.flatnonzero(data[:-_PAD] == 32)
    start = np.r_[0, end[:-1] + 1] if len(end) else end
    return Words(data, start, end, rows[np.searchsorted(bounds, last, "right") - 1])


def _gap(raw: bytes, at: int) -> int:
    """The first place from ``at`` that is not of a word."""
    while at < len(raw):
        free = np.flatnonzero(~_WORD[np.frombuffer(raw[at : at + 4096], np.uint8)])
        if len(free):
            return at + int(free[0])
        at += 4096
    return len(raw)


def pieces(texts: Iterable[str | None], limit: int = PIECE_BYTES, overlap: int = 0) -> Iterator[tuple[Words, int]]:
    """The words of all texts in pieces of about ``limit`` bytes; rows are numbered from 0.

    A longer text is cut between words. Such a piece repeats the last ``overlap`` words before it; their number comes
    beside the piece. A single word is never cut, however long.
    """
    held: list[bytes] = []
    rows: list[int] = []
    size = 0

    def flush() -> Words:
        bounds = np.cumsum([0, *[len(x) + 1 for x in held[:-1]]])
        return _split(b"\n".join(held) + b"\n", np.array(rows, np.int64), bounds)

    for n, text in enumerate(texts):
        if not text:
            continue
        raw = text.encode("utf-8", "surrogatepass")
        if held and size + len(raw) > limit:
            yield flush(), 0
            held, rows, size = [], [], 0
        if len(raw) <= limit:
            held.append(raw)
            rows.append(n)
            size += len(raw)
            continue
        at, carried = 0, b""
        while at < len(raw):
            to = _gap(raw, at + limit)
            words = _split(carried + b" " + raw[at:to] + b"\n", np.array([n]), np.array([0]))
            again = len(carried.split())
            yield words, again
            if overlap and len(words.end):
                carried = words.data[words.start[-min(overlap, len(words.start))] : words.end[-1]].tobytes()
            at = to
    if held:
        yield flush(), 0


def _load(data: np.ndarray) -> np.ndarray:
    """Every 8 neighbouring bytes of ``data`` as one little-endian number, without a copy."""
    return np.lib.stride_tricks.as_strided(data[:8].view("<u8"), (len(data) - 7,), (1,))


def _turn(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << np.uint64(bits)) | (x >> np.uint64(64 - bits))


def hashes(data: np.ndarray, start: np.ndarray, length: np.ndarray, seed: int = 0) -> np.ndarray:
    """XXH64 of every span. Spans below 32 bytes are hashed together, the few longer ones by the library."""
    eight = _load(data)
    code = length.astype(np.uint64) + _P5 + np.uint64(seed)
    short = length < 32
    for k in range(3):
        on = np.flatnonzero(short & (length >= 8 * (k + 1)))
        if not len(on):
            break
        lane = _turn(eight[start[on] + 8 * k] * _P2, 31) * _P1
        code[on] = _turn(code[on] ^ lane, 27) * _P1 + _P4
    at = start + (length & ~7)
    on = np.flatnonzero(short & ((length & 4) > 0))
    lane = (eight[at[on]] & np.uint64(0xFFFFFFFF)) * _P1
    code[on] = _turn(code[on] ^ lane, 23) * _P2 + _P3
    at = start + (length & ~3)
    for k in range(3):
        on = np.flatnonzero(short & ((length & 3) > k))
        code[on] = _turn(code[on] ^ (data[at[on] + k].astype(np.uint64) * _P5), 11) * _P1
    code ^= code >> np.uint64(33)
    code *= _P2
    code ^= code >> np.uint64(29)
    code *= _P3
    code ^= code >> np.uint64(32)
    long = np.flatnonzero(~short)
    if len(long):
        spans = zip(start[long].tolist(), (start[long] + length[long]).tolist(), strict=True)
        code[long] = np.array([xxhash.xxh64_intdigest(data[a:b], seed) for a, b in spans], np.uint64)
    return code


def _crc_steps() -> np.ndarray:
    code = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        code = np.where(code & 1, (code >> 1) ^ np.uint32(0xEDB88320), code >> 1).astype(np.uint32)
    return code


_CRC = _crc_steps()


def crc32s(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRC-32 of every span: a byte of all short spans at a time, the few long ones by the library."""
    short = length <= 64
    order = np.argsort(np.where(short, length, 0).astype(np.uint8), kind="stable")[::-1]
    sizes = length[order] * short[order]
    code, at = np.full(len(start), 0xFFFFFFFF, np.uint32), start[order]
    upto = np.searchsorted(-sizes, -np.arange(1, 65), "right")  # spans of at least so many bytes
    for k in range(64):
        n = int(upto[k])
        if not n:
            break
        part = code[:n]
        code[:n] = _CRC[(part ^ data[at[:n] + k]) & 255] ^ (part >> 8)
    out = np.empty(len(start), np.int64)
    out[order] = code ^ np.uint32(0xFFFFFFFF)
    for i in np.flatnonzero(~short).tolist():
        out[i] = zlib.crc32(data[start[i] : start[i] + length[i]])
    return out


def _same(data: np.ndarray, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Whether the spans at ``a`` and ``b`` hold the same bytes."""
    eight, out = _load(data), np.ones(len(a), bool)
    todo, k = np.arange(len(a)), 0
    while len(todo) and k < 256:
        rest = np.minimum(length[todo] - k, 8)
        unlike = (eight[a[todo] + k] ^ eight[b[todo] + k]) << ((8 - rest) * 8).astype(np.uint64)
        out[todo[unlike != 0]] = False
        k += 8
        todo = todo[(unlike == 0) & (length[todo] > k)]
    for i in todo.tolist():
        out[i] = np.array_equal(data[a[i] + k : a[i] + length[i]], data[b[i] + k : b[i] + length[i]])
    return out


class SpanTable:
    """Open-addressed table of the distinct spans of a buffer: keyed by XXH64, verified byte by byte.

    ``slot`` is the place of every span given in, ``used`` lists the places taken, ``first`` holds one span of each.
    """

    def __init__(self, data: np.ndarray, start: np.ndarray, length: np.ndarray):
        bits = max(4, int(2 * len(start) - 1).bit_length()) if len(start) else 4
        mask = (1 << bits) - 1
        code = hashes(data, start, length)
        self.first = np.full(1 << bits, -1, np.int64)
        self.slot = np.empty(len(start), np.int64)
        place = (code & np.uint64(mask)).astype(np.int64)
        todo = np.arange(len(start))
        while len(todo):
            free = self.first[place] < 0
            self.first[place[free]] = todo[free]  # of those that want a place, one gets it
            owner = self.first[place]
            like = (code[owner] == code[todo]) & (length[owner] == length[todo])
            some = np.flatnonzero(like & (owner != todo))
            like[some] = _same(data, start[owner[some]], start[todo[some]], length[todo[some]])
            self.slot[todo[like]] = place[like]
            todo, place = todo[~like], (place[~like] + 1) & mask
        self.used = np.flatnonzero(self.first >= 0)
        self.data, self.start, self.length = data, start, length

    def spans(self) -> list[bytes]:
        """The bytes of each span in ``used``."""
        raw, own = self.data.tobytes(), self.first[self.used]
        return [raw[a : a + n] for a, n in zip(self.start[own].tolist(), self.length[own].tolist(), strict=True)]
