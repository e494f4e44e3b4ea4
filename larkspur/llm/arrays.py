"""Words, shingles and content keys of whole Arrow text columns, as numpy arrays.

Texts are UTF-8 and A-Z is read as a-z. Word classes are byte classes: every
byte of a character outside ASCII is 0x80 or above, so a class that takes all
of them or none needs no decoding. Hashes are 64 bits wide, keys 128.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

LOWER = bytes(b + 32 if 65 <= b < 91 else b for b in range(256))

#: Everything but space and the control characters 0x09 to 0x0D.
NOT_SPACE = bytes(not (b == 0x20 or 0x09 <= b <= 0x0D) for b in range(256))
#: Digits, letters a-z and everything outside ASCII.
ALNUM = bytes(0x30 <= b < 0x3A or 0x61 <= b < 0x7B or b >= 0x80 for b in range(256))

#: Bytes of text worked on at a time; one longer text is a piece of its own.
PIECE_BYTES = 2 << 20
#: Bytes whose words are hashed and sorted at a time where pieces may be smaller; their arrays stay in the processor's caches.
CUT_BYTES = 1 << 19

_random = np.random.Generator(np.random.PCG64(20240229))
_ODD = _random.integers(1, 2**63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


_MASK = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: What the hash of a word starts from, by its size; longer words get a digest.
_SEED = mix(np.arange(65, dtype=np.uint64) * _ODD[0])


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(max(n, 1), base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def segment_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of ``values[bounds[i]:bounds[i + 1]]``; empty segments give 0."""
    total = np.zeros(len(values) + 1, dtype=values.dtype)
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def within(sizes: np.ndarray) -> np.ndarray:
    """0, 1, 2, ... inside each segment of the given sizes."""
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null reads as empty."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(batch: pa.RecordBatch, text: int, rows: int = 50_000, size: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``size`` bytes of text in column number ``text``."""
    if batch.num_rows == 0:
        return
    _, offsets = utf8(batch.column(text))
    at = 0
    while at < batch.num_rows:
        end = int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1
        end = min(max(end, at + 1), at + rows, batch.num_rows)
        yield batch.slice(at, end - at)
        at = end


@dataclass
class Words:
    """Word hashes of many units; unit i has words bounds[i] to bounds[i + 1]."""

    hashes: np.ndarray
    bounds: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    raw: bytes  # the bytes that starts and ends count, A-Z as a-z

    def heads(self, size: int) -> np.ndarray:
        """The first ``size`` bytes of each word (8 at most) as a number; 0 for a word that isn't longer."""
        eight = np.ndarray((len(self.raw) + 1,), dtype="<u8", buffer=self.raw + b"\0" * 8, strides=(1,))
        return np.where(self.ends - self.starts > size, eight[self.starts] & _MASK[size], 0)


def words(data: np.ndarray, offsets: np.ndarray, kind: bytes) -> Words:
    """Words of units that lie one after another in ``data``; no word spans two units."""
    raw = data.tobytes().translate(LOWER)
    inside = np.frombuffer(raw.translate(kind), dtype=bool)
    edge = np.empty(len(inside) + 1, dtype=bool)
    edge[0], edge[-1] = len(inside) > 0 and inside[0], len(inside) > 0 and inside[-1]
    np.not_equal(inside[1:], inside[:-1], out=edge[1:-1])
    at = np.flatnonzero(edge)
    starts, ends = at[::2], at[1::2]
    cuts = np.unique(offsets)
    cuts = cuts[(cuts > 0) & (cuts < len(inside))]
    cuts = cuts[inside[cuts] & inside[cuts - 1]]  # units that touch: one run of word bytes is two words
    if len(cuts):
        starts, ends = (np.insert(x, np.searchsorted(x, cuts), cuts) for x in (starts, ends))
    return Words(_hash(raw, starts, ends - starts), np.searchsorted(starts, offsets), starts, ends, raw)


def _hash(raw: bytes, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """64-bit hashes of the given stretches, eight bytes at a step; very long ones by a digest."""
    eight = np.ndarray((len(raw) + 1,), dtype="<u8", buffer=raw + b"\0" * 8, strides=(1,))
    part = eight[starts] & _MASK.take(sizes, mode="clip")
    hashes = mix(part ^ _SEED.take(sizes, mode="clip")) * _ODD[1]
    live = np.flatnonzero((sizes > 8) & (sizes <= 64))
    for step in range(1, 8):
        live = live[sizes[live] > 8 * step]
        if len(live) == 0:
            break
        part = eight[starts[live] + 8 * step] & _MASK.take(sizes[live] - 8 * step, mode="clip")
        hashes[live] = mix(hashes[live] ^ part) * _ODD[1]
    for i in np.flatnonzero(sizes > 64):
        digest = hashlib.blake2b(raw[starts[i] : starts[i] + sizes[i]], digest_size=8).digest()
        hashes[i] = np.frombuffer(digest, dtype=np.uint64)[0]
    return hashes


def keys(of: Words) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each unit's whole word sequence."""
    sizes = np.diff(of.bounds)
    place = within(sizes)
    longest = int(sizes.max()) if len(sizes) else 0
    out = []
    for k in (2, 4):
        part = segment_sums(mix(of.hashes ^ _ODD[k]) * powers(_ODD[k + 1], longest)[place], of.bounds)
        out.append(mix(part + sizes.astype(np.uint64) * _ODD[k]).view(np.int64))
    return out[0], out[1]


def shingles(of: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each unit in ascending order, and their bounds.

    A unit of fewer words than ``size`` has its whole sequence as one shingle;
    a unit without words has none.
    """
    counts = np.diff(of.bounds)
    n = len(of.hashes)
    rolled = np.zeros(max(n - size + 1, 0), dtype=np.uint64)
    for k in range(size):
        rolled += of.hashes[k : k + len(rolled)] * _ODD[6 + k]
    rolled = mix(rolled)
    owner = np.repeat(np.arange(len(counts), dtype=np.uint16 if len(counts) < 65_536 else np.int64), counts)
    full = owner[: len(rolled)] == owner[min(size - 1, n) :][: len(rolled)]
    unit, values = owner[: len(rolled)][full], rolled[full]
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        whole = keys(of)[0].view(np.uint64)[short]
        unit, values = np.concatenate([unit, short.astype(unit.dtype)]), np.concatenate([values, mix(whole ^ _ODD[5])])
    # one sort by unit and the first bits of the value; values that differ in the others only, hardly ever any, need a second key
    bits = np.uint64(max(len(counts) - 1, 1).bit_length())
    order = np.argsort((unit.astype(np.uint64) << (np.uint64(64) - bits)) | (values >> bits))
    same = unit[order[1:]] == unit[order[:-1]]
    if (same & (values[order[1:]] < values[order[:-1]])).any():
        order = np.lexsort((values, unit))
    unit, values = unit[order], values[order]
    if len(values):
        new = np.ones(len(values), dtype=bool)
        new[1:] = (values[1:] != values[:-1]) | ~same
        unit, values = unit[new], values[new]
    return values, np.append(0, np.cumsum(np.bincount(unit, minlength=len(counts))))
