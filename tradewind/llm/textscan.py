"""Words and hashes of whole batches of texts at once, with numpy.

Hashes are polynomials over random 64-bit values of the bytes, modulo 2**64, taken from running sums,
so that the hash of any stretch costs two lookups. Equal stretches have equal hashes in every
task; where a collision would change a result, the caller compares the bytes themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are scanned at once; a longer text is a scan of its own.
SCAN_BYTES = 1 << 20
#: Rows whose repeats a task knows.
REMEMBERED = 1 << 16

_rng = np.random.default_rng(20240601)
BYTE_VALUES = _rng.integers(0, 1 << 64, 256, dtype=np.uint64)
BASE = int(_rng.integers(0, 1 << 63)) * 2 + 1
INVERSE = pow(BASE, -1, 1 << 64)
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 to base**(n-1), at least."""
    known = _powers.get(base)
    if known is None or len(known) < n:
        size = max(n, 1 << 16)
        out = np.full(size, base, np.uint64)
        out[0] = 1
        _powers[base] = known = np.cumprod(out, dtype=np.uint64)
    return known


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Scan:
    """Some texts' bytes in a row; text ``k`` is ``data[offsets[k]:offsets[k + 1]]``."""

    def __init__(self, texts: pa.Array):
        texts = texts.fill_null("" if pa.types.is_string(texts.type) else b"").cast(pa.large_binary())
        n = len(texts)
        bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1]
        values = texts.buffers()[2]
        raw = np.frombuffer(values, np.uint8) if values else np.empty(0, np.uint8)
        self.data = raw[bounds[0] : bounds[-1]] if n else raw[:0]
        self.offsets = bounds - bounds[0] if n else np.zeros(1, np.int64)
        self._sums = None

    @property
    def sums(self) -> np.ndarray:
        """Running sums of the bytes' values times powers of the base."""
        if self._sums is None:
            self._sums = np.zeros(len(self.data) + 1, np.uint64)
            scaled = BYTE_VALUES[self.data]
            scaled *= powers(BASE, len(self.data))[: len(self.data)]
            np.cumsum(scaled, out=self._sums[1:])
        return self._sums

    def hashes(self, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """A hash for each stretch of bytes."""
        back = powers(INVERSE, len(self.data) + 1)
        return (self.sums[ends] - self.sums[begins]) * back[begins]

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Begin and end of every word, and bounds: text ``k`` has words bounds[k] to bounds[k + 1]."""
        inside = np.zeros(len(self.data) + 2, np.int8)
        inside[1:-1] = ~SPACE[self.data]
        edge = np.diff(inside)
        begins, ends = np.flatnonzero(edge[:-1] == 1), np.flatnonzero(edge[1:] == -1) + 1
        # Where texts meet without white space, a run of bytes is cut.
        cuts = self.offsets[1:-1]
        cuts = cuts[(cuts > 0) & (cuts < len(self.data))]
        cuts = np.unique(cuts[(inside[cuts] == 1) & (inside[cuts + 1] == 1)])
        if len(cuts):
            begins, ends = np.sort(np.append(begins, cuts)), np.sort(np.append(ends, cuts))
        return begins, ends, np.searchsorted(begins, self.offsets)


def word_windows(hashes: np.ndarray, bounds: np.ndarray, size: int):
    """Hash of every window of ``size`` words inside a text, with the window's first word."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    scale = powers(BASE, size)
    total = np.zeros(n, np.uint64)
    for k in range(size):
        total += hashes[k : k + n] * scale[k]
    # A window must not go beyond its text.
    last = np.repeat(bounds[1:], np.diff(bounds))[:n]
    first = np.flatnonzero(np.arange(n) + size <= last)
    return mix(total[first]), first


def parts(batches: Iterator[pa.RecordBatch], column: int, size: int = SCAN_BYTES):
    """Slices of the batches whose texts have a bounded size together."""
    for batch in batches:
        texts = batch.column(column)
        lengths = pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False)
        ends, start = np.cumsum(lengths, dtype=np.int64), 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + size, "right")))
            yield batch.slice(start, stop - start)
            start = stop


REPEATS_SCHEMA = "hash bigint, id bigint, text string, copies bigint"


def combine_repeats(batches: Iterator[pa.RecordBatch]):
    """Rows (hash, id, text) with a number of copies, combined inside a task before a shuffle.

    Of repeated rows one is passed on with its text; what comes after it is counted and sent as rows
    of hash and copies alone. Only the last ``REMEMBERED`` hashes are known, so a row can still come
    several times, but not as often as it is repeated.
    """
    names = [c.split()[0] for c in REPEATS_SCHEMA.split(", ")]
    known: dict[int, int] = {}

    def counted():
        left = [(h, n) for h, n in known.items() if n]
        hashes, copies = zip(*left, strict=True) if left else ((), ())
        nothing = [pa.nulls(len(left), t) for t in (pa.int64(), pa.string())]
        columns = [pa.array(hashes, pa.int64()), *nothing, pa.array(copies, pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=names)

    for batch in batches:
        values, at, counts = np.unique(
            batch.column(0).to_numpy(), return_index=True, return_counts=True
        )
        new = np.array([h not in known for h in values.tolist()], bool)
        for h, n in zip(values[~new].tolist(), counts[~new].tolist(), strict=True):
            known[h] += n
        order = np.sort(at[new])
        copies = np.zeros(batch.num_rows, np.int64)
        copies[at] = counts
        rows = batch.take(pa.array(order))
        yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(copies[order])], names=names)
        known |= dict.fromkeys(values[new].tolist(), 0)
        if len(known) > REMEMBERED:
            yield counted()
            known.clear()
    yield counted()
