"""Whole-column text work on Arrow arrays: slices of bounded size, dictionary-coded words.

A corpus has far fewer distinct words than words, so operators compute what they need once
per distinct word of a slice and gather it by code; nothing runs per word in Python.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20

try:
    _LIBC = ctypes.CDLL("libc.so.6")
    _LIBC.malloc_trim
except (OSError, AttributeError):  # another C library: only Arrow's pool is given back
    _LIBC = None


def slices(batch: pa.RecordBatch, text_col: int, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows whose texts hold about ``limit`` bytes (one row at least); after the last one
    free memory goes back to the system, as the worker stays for other stages."""
    sizes = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(batch.column(text_col)), 0)
                                 .to_numpy(zero_copy_only=False), dtype=np.int64))
    at = 0
    while at < batch.num_rows:
        before = sizes[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(sizes, before + limit, side="right")))
        yield batch.slice(at, end - at)
        at = end
    free_memory()


def free_memory() -> None:
    """Give what Arrow's pool and the C library keep for later back to the system."""
    pa.default_memory_pool().release_unused()
    if _LIBC is not None:
        _LIBC.malloc_trim(0)


def giving_back(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A task's generator that gives free memory back once it has ended: idle workers count with their executor."""
    def wrapped(batches: Iterator) -> Iterator:
        yield from run(batches)
        free_memory()
    return wrapped


def texts_of(column: pa.Array) -> pa.Array:
    """The column as strings, null as the empty text."""
    return pc.fill_null(column.cast(pa.string()), "")


class CodedWords:
    """Words of a slice of texts: ``uniq`` (Arrow strings), ``codes`` (one per word, into
    ``uniq``) and ``offsets`` (text i holds the words offsets[i]:offsets[i + 1])."""

    def __init__(self, lists: pa.ListArray) -> None:
        self.offsets = lists.offsets.to_numpy().astype(np.int64)
        self.offsets -= self.offsets[0]
        coded = lists.flatten().dictionary_encode()
        self.codes = coded.indices.to_numpy(zero_copy_only=False)
        self.uniq = coded.dictionary

    def strings(self) -> list[str]:
        """The distinct words as Python strings (by way of numpy: far quicker)."""
        return self.uniq.to_numpy(zero_copy_only=False).tolist()

    def sums(self, per_word: np.ndarray) -> np.ndarray:
        """Per text, the sum over its words of a value (or row) given per distinct word."""
        if not len(self.codes):
            return np.zeros((len(self.offsets) - 1, *per_word.shape[1:]), dtype=per_word.dtype)
        return segment_sums(per_word[self.codes], self.offsets)

    def gather(self, values: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Uint32 ids of all words after each other and their offsets by text, from the ids of each
        distinct word (little-endian bytes)."""
        sizes = np.fromiter(map(len, values), dtype=np.int64, count=len(values)) // 4
        flat = np.frombuffer(b"".join(values), dtype="<u4")
        first = np.cumsum(sizes) - sizes
        per_word = sizes[self.codes]
        ends = np.cumsum(per_word)
        at = np.repeat((first[self.codes] - (ends - per_word)), per_word)
        at += np.arange(len(at))
        return flat[at], np.concatenate([[0], ends])[self.offsets]


def segment_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums over values[offsets[i]:offsets[i + 1]]; empty segments give zero."""
    out = np.zeros((len(offsets) - 1, *values.shape[1:]), dtype=values.dtype)
    full = np.flatnonzero(np.diff(offsets) > 0)
    if len(full):
        out[full] = np.add.reduceat(values, offsets[full], axis=0)
    return out


class Characters:
    """The characters of many strings as one array, with the hash of every stretch of some characters: a polynomial
    over them, so that it is computed for all strings at once."""

    _ODD = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, strings: list[str]) -> None:
        self.sizes = np.fromiter(map(len, strings), dtype=np.int64, count=len(strings))
        self.points = np.frombuffer("".join(strings).encode("utf-32-le"), dtype="<u4")
        self.ends = np.cumsum(self.sizes)
        self.starts = self.ends - self.sizes
        mixed = (self.points.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
        self.mixed = mixed ^ (mixed >> np.uint64(29))

    @classmethod
    def _final(cls, polynomial: np.ndarray, salt: int) -> np.ndarray:
        x = (polynomial + np.uint64(salt)) * np.uint64(0x94D049BB133111EB)
        x = (x ^ (x >> np.uint64(31))) * cls._ODD
        return x ^ (x >> np.uint64(32))

    def whole(self, salt: int = 0) -> np.ndarray:
        """Hash of each string."""
        powers = np.multiply.accumulate(np.full(max(1, int(self.sizes.max(initial=1))), self._ODD))
        place = np.arange(len(self.points)) - np.repeat(self.starts, self.sizes)
        return self._final(segment_sums(self.mixed * powers[place], np.concatenate([[0], self.ends])), salt)

    def stretches(self, at: np.ndarray, size: int, salt: int = 0) -> np.ndarray:
        """Hash of the ``size`` characters from each of the places ``at`` on; it equals ``whole`` of that string."""
        total = np.zeros(len(at), dtype=np.uint64)
        for k, power in enumerate(np.multiply.accumulate(np.full(size, self._ODD))):
            total += self.mixed[at + k] * power
        return self._final(total, salt)

    def text(self, at: np.ndarray, size: int) -> list[str]:
        """The ``size`` characters from each of the places ``at`` on."""
        joined = self.points[at[:, None] + np.arange(size)].tobytes().decode("utf-32-le")
        return [joined[i:i + size] for i in range(0, len(joined), size)]


class WordTable:
    """Value per word, computed on first sight.  Two generations of at most ``limit`` words are kept: when the younger is full it
    becomes the older one, and a word found there moves back to the younger, so words that go on occurring stay.  With
    ``many``, ``make`` gives the values of a list of words at once."""

    def __init__(self, make: Callable, limit: int = 400_000, many: bool = False) -> None:
        self.make = make if many else lambda words: list(map(make, words))
        self.limit, self.known, self.older = limit, {}, {}

    def __call__(self, words: list[str]) -> list:
        out = list(map(self.known.get, words))
        missing = [i for i, value in enumerate(out) if value is None]
        if not missing:
            return out
        wanted = [words[i] for i in missing]
        values = list(map(self.older.get, wanted))
        new = [k for k, value in enumerate(values) if value is None]
        for k, value in zip(new, self.make([wanted[k] for k in new])):
            values[k] = value
        for i, value in zip(missing, values):
            out[i] = value
        at = 0
        while at < len(wanted):
            if len(self.known) >= self.limit:
                self.known, self.older = {}, self.known
            end = at + self.limit - len(self.known)
            self.known.update(zip(wanted[at:end], values[at:end]))
            at = end
        return out
