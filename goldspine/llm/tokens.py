"""Hashes of words and byte spans of many texts at once, in numpy.

A span's hash is a polynomial over random values of its bytes, taken from
prefix sums, so any number of spans costs a few vector operations. Where two
hashes are compared across a corpus, two lanes (128 bits) are used. Sums are
modulo 2**64, in which long texts of two alternating parts can be made to meet
whatever the base; words beyond ``LONG_WORD`` are therefore hashed modulo a prime.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Texts are handled a few at a time: arrays of eight bytes for each of theirs come and go.
CHUNK_BYTES = 1 << 18
#: What a task gathers before it packs and sends it.
PIECE_BYTES = 8 << 20
LANES = 2
_BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
U64 = np.uint64


class _Cache(dict):
    """What a task keeps for its next texts; it is sent to no task."""

    def __reduce__(self):
        return _Cache, ()


def _by_lane(make):
    """Made once for each lane."""
    made = _Cache()

    @wraps(make)
    def get(lane: int):
        if lane not in made:
            made[lane] = make(lane)
        return made[lane]

    return get


def mix(x: np.ndarray) -> np.ndarray:
    """Every bit of the input changes every bit of the result (splitmix64)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


@_by_lane
def _byte_values(lane: int) -> np.ndarray:
    return mix(np.arange(1, 257, dtype=U64) * U64(_BASES[lane]))


#: Bytes of a word that is hashed modulo a prime, and of the pieces it is taken in.
LONG_WORD, _PIECE = 64, 4096
_PRIME = (1 << 61) - 1


@_by_lane
def _field_powers(lane: int) -> tuple[np.ndarray, np.ndarray, int]:
    """The base's powers modulo the prime, their lower 31 bits and the rest apart, and the one after the last."""
    base, power, powers = _BASES[lane] % _PRIME, 1, []
    for _ in range(_PIECE):
        powers.append(power)
        power = power * base % _PRIME
    whole = np.array(powers, U64)
    return whole & U64((1 << 31) - 1), whole >> U64(31), power


def _field_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lane: int) -> np.ndarray:
    """Hashes of byte spans as polynomials modulo a prime, from the pieces of each."""
    low, high, step = _field_powers(lane)
    pieces = -(-(ends - starts) // _PIECE)
    owner = np.repeat(np.arange(len(starts)), pieces)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    begins = starts[owner] + number * _PIECE
    sizes = np.minimum(_PIECE, ends[owner] - begins)
    firsts = np.cumsum(sizes) - sizes
    place = np.arange(sizes.sum()) - np.repeat(firsts, sizes)
    values = data[np.repeat(begins, sizes) + place].astype(U64) + U64(1)
    # A byte's value times 31 bits, 4096 times: well below 2**64.
    sums = [np.add.reduceat(values * part[place], firsts) for part in (low, high)]
    out = []
    for n, a, b in zip(number.tolist(), sums[0].tolist(), sums[1].tolist()):
        piece = (a + (b << 31)) % _PRIME
        if n:
            piece = (out.pop() * step + piece) % _PRIME
        out.append(piece)
    return mix(np.array(out, U64) + (ends - starts).astype(U64) * U64(_BASES[1 - lane]))


#: Powers kept for the next texts; those of a longer text go with it.
_KEPT = 1 << 21
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = _Cache()


def _powers(lane: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The base's powers and their inverses, modulo 2**64."""
    have = _POWERS.get(lane)
    if have is None or len(have[0]) < n:
        size = max(n, CHUNK_BYTES + 1)
        both = []
        for base in (_BASES[lane], pow(_BASES[lane], -1, 1 << 64)):
            steps = np.full(size, base, U64)
            steps[0] = 1
            both.append(np.cumprod(steps))
        have = (both[0], both[1])
        if size <= _KEPT:
            _POWERS[lane] = have
    return have


class Spans:
    """Hashes of byte spans of one buffer."""

    def __init__(self, data: np.ndarray, lane: int = 0):
        self._lane, n = lane, len(data)
        powers, self._inverse = _powers(lane, n + 1)
        self._sums = np.zeros(n + 1, U64)
        np.cumsum(_byte_values(lane)[data] * powers[:n], out=self._sums[1:])

    def raw(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return (self._sums[ends] - self._sums[starts]) * self._inverse[starts]

    def hash(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix(self.raw(starts, ends) + (ends - starts).astype(U64) * U64(_BASES[1 - self._lane]))

    def sliding(self, width: int) -> np.ndarray:
        """Hash of the ``width`` bytes from each position that has as many."""
        n = len(self._sums) - 1 - width + 1
        return mix((self._sums[width:] - self._sums[:-width]) * self._inverse[:n]) if n > 0 else np.zeros(0, U64)


def joined(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all values, one after the other, and where each begins (and the end)."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    held = column.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None and held.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(batches: Iterable[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """The rows in batches of about as much text as a task should gather (one text at least)."""
    held, size = [], 0
    for batch in batches:
        for part, data, _ in chunks([batch], column, PIECE_BYTES):
            if held and size + len(data) > PIECE_BYTES:
                yield pa.concat_batches(held)
                held, size = [], 0
            held.append(part)
            size += len(data)
    if held:
        yield pa.concat_batches(held)


def chunks(
    batches: Iterable[pa.RecordBatch], column: str, most: int = CHUNK_BYTES
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Runs of rows of some bytes of text (one text at least): rows, bytes, offsets."""
    for batch in batches:
        if not batch.num_rows:
            continue
        data, offsets = joined(batch.column(column))
        start = 0
        while start < batch.num_rows:
            stop = int(np.searchsorted(offsets, offsets[start] + most, "right")) - 1
            stop = min(max(stop, start + 1), batch.num_rows)
            yield batch.slice(start, stop - start), data[offsets[start] : offsets[stop]], offsets[start : stop + 1] - offsets[start]
            start = stop


def _fold_table(separators: Iterable[int]) -> np.ndarray:
    """Each byte with A-Z lower-cased, and 0 for separators."""
    table = np.arange(256, dtype=np.uint8)
    table[ord("A") : ord("Z") + 1] += 32
    table[list(separators)] = 0
    return table


#: Words are runs of anything but spaces and the controls of lines and tabs.
SPACED = _fold_table([0x20, *range(0x09, 0x0E)])
#: Byte 0 is a word's byte there; it gets a value no other byte of UTF-8 has.
SPACED[0] = 0xFF
#: The same words with their capitals.
AS_WRITTEN = SPACED.copy()
AS_WRITTEN[ord("A") : ord("Z") + 1] = np.arange(ord("A"), ord("Z") + 1)
#: Words are runs of ASCII letters, digits and everything beyond ASCII.
ALNUM = _fold_table(b for b in range(128) if not chr(b).isalnum())


def words(data: np.ndarray, offsets: np.ndarray, table: np.ndarray, lanes: int = 1) -> tuple[list[np.ndarray], np.ndarray]:
    """Hashes of the folded words, lane by lane, and where each text's words begin in them."""
    n = len(data)
    if not n:
        return [np.zeros(0, U64) for _ in range(lanes)], np.zeros(len(offsets), np.int64)
    folded = table[data]
    inside = folded != 0
    starts, ends = inside.copy(), inside.copy()
    starts[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    borders = offsets[(offsets > 0) & (offsets < n)]
    starts[borders] |= inside[borders]
    ends[borders - 1] |= inside[borders - 1]
    first, last = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    found = [Spans(folded, lane).hash(first, last) for lane in range(lanes)]
    long = np.flatnonzero(last - first > LONG_WORD)
    if len(long):
        for lane in range(lanes):
            found[lane][long] = _field_hashes(folded, first[long], last[long], lane)
    return found, np.searchsorted(first, offsets)


def grams(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` words from each position that has as many, texts' borders ignored."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, U64)
    out = np.full(n, size, U64)
    for i in range(size):
        out = out * U64(_BASES[0]) + hashes[i : i + n]
    return mix(out)
