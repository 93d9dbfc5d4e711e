"""Vectorised hashing of words and byte windows, used inside Arrow batches.

All hashes are 64-bit.  Sums wrap around, which is what makes set hashes additive: the
hash of a set without one element is the set's sum minus that element.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
CHUNK = 1 << 20  # bytes hashed at once; the power tables are this long
_rng = np.random.Generator(np.random.PCG64(20240229))
_CODES = _rng.integers(1, 2**63, 256, dtype=np.int64).view(U64) * U64(2) + U64(1)
_FOLDED = _CODES.copy()
_FOLDED[65:91] = _CODES[97:123]
SEPARATORS = np.zeros(256, dtype=bool)
SEPARATORS[[0x20, *range(0x09, 0x0E)]] = True
_BASE = 0x9E3779B97F4A7C15
_POWERS: dict[str, np.ndarray] = {}


def _powers(name: str, base: int) -> np.ndarray:
    if name not in _POWERS:
        out = np.empty(CHUNK + 1, dtype=U64)
        out[0] = 1
        done = 1
        while done < len(out):  # doubling: out[done:2*done] = out[:done] * base**done
            step = min(done, len(out) - done)
            out[done:done + step] = out[:step] * U64(pow(base, done, 2**64))
            done += step
        _POWERS[name] = out
    return _POWERS[name]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def prefix_hash(data: np.ndarray, fold: bool = False) -> np.ndarray:
    """c with c[i] the polynomial hash of data[:i]; at most CHUNK bytes."""
    c = np.zeros(len(data) + 1, dtype=U64)
    codes = (_FOLDED if fold else _CODES)[data]
    codes *= _powers("up", _BASE)[: len(data)]
    np.cumsum(codes, out=c[1:])
    return c


def range_hash(c: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of data[start:end], the same for equal bytes wherever they stand."""
    down = _powers("down", pow(_BASE, -1, 2**64))
    return mix((c[ends] - c[starts]) * down[starts])


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of bytes that are no separators."""
    gap = np.ones(len(data) + 2, dtype=bool)
    gap[1:-1] = SEPARATORS[data]
    edge = np.flatnonzero(gap[1:] != gap[:-1])
    return edge[::2], edge[1::2]


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, hash) of every word, A-Z folded.  Works in chunks cut at separators."""
    starts, ends = word_spans(data)
    if len(data) <= CHUNK:
        return starts, range_hash(prefix_hash(data, True), starts, ends)
    out = np.empty(len(starts), dtype=U64)
    i = 0
    while i < len(starts):
        base = starts[i]
        j = int(np.searchsorted(ends, base + CHUNK, side="right"))
        if j == i:  # one word longer than a chunk: the hash of its pieces' hashes
            total = U64(0)
            for at in range(int(base), int(ends[i]), CHUNK):
                piece = prefix_hash(data[at:min(at + CHUNK, int(ends[i]))], True)
                total = mix(np.array([total + piece[-1]]))[0]
            out[i] = total
            i += 1
            continue
        c = prefix_hash(data[base:ends[j - 1]], True)
        out[i:j] = range_hash(c, starts[i:j] - base, ends[i:j] - base)
        i = j
    return starts, out


def joined(texts: pa.Array, separator: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts in a row (null: empty; a newline after each) and the n + 1 offsets."""
    raw = [b"" if t is None else t.encode("utf-8", "surrogatepass") for t in texts.to_pylist()]
    sizes = np.array([len(r) + separator for r in raw], dtype=np.int64)
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    tail = b"\n" if separator else b""
    return np.frombuffer(b"".join(r + tail for r in raw), dtype=np.uint8), offsets


def slices(batch: pa.RecordBatch, text: str, rows: int = 4096, size: int = 3 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each part has few rows and few bytes of text (one text at least)."""
    column = batch.column(text)
    lengths = np.array([0 if n is None else n for n in pc.binary_length(column).to_pylist()], dtype=np.int64)
    start, total = 0, 0
    for i, n in enumerate(lengths):
        if i > start and (i - start >= rows or total + n > size):
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += n
    if len(lengths) > start:
        yield batch.slice(start)


def shingles(data: np.ndarray, offsets: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of every document, and the n + 1 bounds in them.

    A document with fewer words than ``width`` has its whole sequence as one shingle; one
    without words has none.
    """
    starts, words = word_hashes(data)
    n = len(offsets) - 1
    first = np.searchsorted(starts, offsets)  # of each document's words
    words = mix(words)
    total = np.zeros(len(words), dtype=U64)
    for k in range(width if len(words) >= width else 0):
        total[: len(words) - k] += words[k:] * U64(pow(0xD6E8FEB86659FD93, k + 1, 2**64))
    total = mix(total + U64(width))
    out, bounds = [], np.zeros(n + 1, dtype=np.int64)
    for i in range(n):
        a, b = first[i], first[i + 1]
        if b - a >= width:
            own = np.sort(total[a:b - width + 1])
            own = own[np.concatenate([[True], own[1:] != own[:-1]])]
        elif b > a:
            own = U64(b - a) + np.zeros(1, dtype=U64)
            for k in range(b - a):
                own = mix(own + words[a + k])
        else:
            own = np.zeros(0, dtype=U64)
        out.append(own)
        bounds[i + 1] = bounds[i] + len(own)
    return (np.concatenate(out) if out else np.zeros(0, dtype=U64)), bounds


CACHES: dict[str, dict] = {}  # what an operator remembers in a worker, by operator


def remembered(operator: str) -> dict:
    """The operator's memory in this worker; those of other operators are let go, back to the system."""
    others = [o for o in CACHES if o != operator]
    for other in others:
        del CACHES[other]
    if others:
        trim()
    return CACHES.setdefault(operator, {})


def trim() -> None:
    """Give freed memory back to the system between two kinds of work, and the tables of powers, soon made anew."""
    _POWERS.clear()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # only where the C library has it
        pass


def lean(run):
    """The same function over batches; a worker that waits for its next task holds little."""
    def out(batches):
        yield from run(batches)
        trim()
    return out


def lean_group(run):
    """The same function over a group's table; a worker that waits for its next group or task holds little."""
    def out(table):
        found = run(table)
        trim()
        return found
    return out


def blob(a: np.ndarray) -> bytes:
    return np.ascontiguousarray(a).tobytes()
