"""Words and word-sequence hashes of Arrow text columns, without a Python loop per row.

A text column is one byte buffer plus offsets, so words are found with a 256-entry byte
class table, hashed with one random number per (position in word, byte) and summed, and a
hash of k consecutive words is a difference of prefix sums. All of it works on slices of a
few megabytes, so a worker's memory does not depend on the batch or the partition.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tessera.llm.ship import ship

SLICE_BYTES = 1 << 20
_U = np.uint64
_POSITIONS = 64
_TABLE = np.random.Generator(np.random.PCG64(20240521)).integers(
    0, 2**64, size=(_POSITIONS, 256), dtype=_U).ravel()
_LONG = _U(0x9E3779B97F4A7C15)
#: Odd multipliers of the two independent sequence hashes.
MULTIPLIERS = (_U(0xD6E8FEB86659FD93), _U(0xA0761D6478BD642F))


def byte_class(separators: bytes) -> np.ndarray:
    """Table of the bytes that belong to words: all but ``separators``."""
    keep = np.ones(256, bool)
    keep[np.frombuffer(separators, np.uint8)] = False
    return keep


#: ``[^\x20\x09-\x0D]+``: what white space separates.
SPACED = byte_class(b" \t\n\x0b\x0c\r")
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` of a text whose A-Z are lower-cased.
ALNUM = byte_class(bytes(b for b in range(128) if not chr(b).isalnum()))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SAME = np.arange(256, dtype=np.uint8)


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every input bit over all 64 output bits."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


@dataclass
class Words:
    """Words of consecutive texts: byte spans in ``data``, hashes, and each text's words."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray  # words of text i: first[i]:first[i + 1]

    @property
    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (from 0) of a string column; a null text is empty."""
    if column.null_count:
        column = column.fill_null("")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offs, data = column.buffers()
    offs = np.frombuffer(offs, kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offs[0]:offs[-1]], offs - offs[0]


def find_words(column: pa.Array, keep: np.ndarray, lower: bool = False) -> Words:
    data, offs = buffers(column)
    n = len(data)
    if n == 0:
        zero = np.zeros(0, np.int64)
        return Words(data, zero, zero, np.zeros(0, _U), np.zeros(len(offs), np.int64))
    inside = keep[data]
    before = np.empty(n, bool)
    before[0], before[1:] = False, inside[:-1]
    before[offs[:-1][offs[:-1] < n]] = False
    after = np.empty(n, bool)
    after[-1], after[:-1] = False, inside[1:]
    after[offs[1:][offs[1:] > 0] - 1] = False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    first = np.searchsorted(start, offs)
    return Words(data, start, end, _hashes(data[inside], end - start, _LOWER if lower else _SAME), first)


def _hashes(data: np.ndarray, length: np.ndarray, fold: np.ndarray) -> np.ndarray:
    if len(length) == 0:
        return np.zeros(0, _U)
    begin = np.cumsum(length) - length
    at = np.arange(len(data), dtype=np.int32) - np.repeat(begin.astype(np.int32), length)
    value = _TABLE[(at & (_POSITIONS - 1)) * 256 + fold[data]]
    if length.max() > _POSITIONS:
        far = np.flatnonzero(at >= _POSITIONS)
        value[far] *= mix(_LONG * (at[far] >> 6).astype(_U)) | _U(1)
    return mix(np.add.reduceat(value, begin) + length.astype(_U))


_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of the multiplier and of its inverse modulo 2^64."""
    have = _powers.get(which)
    if have is None or len(have[0]) <= n:
        size = 1 << max(16, int(n).bit_length())
        m = int(MULTIPLIERS[which])
        tables = []
        for base in (m, pow(m, -1, 2**64)):
            t = np.full(size, _U(base))
            t[0] = 1
            tables.append(np.cumprod(t))
        have = _powers[which] = (tables[0], tables[1])
    return have


class Sequences:
    """Hashes of word runs ``[i, i + k)`` of one word-hash array."""

    def __init__(self, hashes: np.ndarray, which: int = 0):
        n = len(hashes)
        self._up, self._down = _power(which, n + 1)
        salted = hashes if which == 0 else mix(hashes + _LONG)
        self._sum = np.zeros(n + 1, _U)
        np.cumsum(salted * self._up[:n], out=self._sum[1:])

    def of(self, begin: np.ndarray, k) -> np.ndarray:
        return mix((self._sum[begin + k] - self._sum[begin]) * self._down[begin])


def slices(batch: pa.RecordBatch, column: str, max_bytes: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of a batch with at most so much text (a longer text comes alone)."""
    _, offs = buffers(batch.column(batch.schema.get_field_index(column)))
    at, n = 0, batch.num_rows
    while at < n:
        upto = int(np.searchsorted(offs, offs[at] + max_bytes, "right")) - 1
        upto = min(max(upto, at + 1), n)
        yield batch.slice(at, upto - at)
        at = upto


def release() -> None:
    """Give a finished task's buffers back: the worker process goes on with other tasks."""
    pa.default_memory_pool().release_unused()


def column(name: str):
    return F.col("`" + name.replace("`", "``") + "`")


def without(df: DataFrame, names: list[str]) -> DataFrame:
    """``df`` without columns of these names (in any case)."""
    gone = {n.lower() for n in names}
    return df.select(*[column(c) for c in df.columns if c.lower() not in gone])


def add_columns(df: DataFrame, rows_of, fields: list, keep: list[str] | None = None, text: str = "text",
                max_bytes: int = SLICE_BYTES, use: tuple[str, ...] = ()) -> DataFrame:
    """Append computed columns to ``df`` in one map pass.

    ``rows_of(batch)`` returns one Arrow array per field of ``fields`` for a slice of rows,
    and may return a boolean array as an extra last element: rows to keep. A column of
    ``df`` with the name of a new one gives way to it. ``keep`` are the columns passed on
    (all by default), ``use`` columns that only ``rows_of`` sees.
    """
    ship(df.sparkSession)
    named = {f.name.lower() for f in fields}
    keep = [c for c in (keep or df.columns) if c.lower() not in named]
    need = [c for c in df.columns if c in keep or c == text or c in use or c.lower() in named]
    source = df.select(*[column(c) for c in need])
    schema = StructType([source.schema[c] for c in keep] + list(fields))

    def run(batches):
        for batch in batches:
            for part in slices(batch, text, max_bytes):
                found = rows_of(part)
                kept = [part.column(part.schema.get_field_index(c)) for c in keep]
                out = pa.RecordBatch.from_arrays(kept + list(found[:len(fields)]),
                                                 names=keep + [f.name for f in fields])
                if len(found) > len(fields):
                    out = out.filter(found[len(fields)])
                yield out
        release()

    return source.mapInArrow(run, schema)
