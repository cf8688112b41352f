"""Words, shingles and hashes of many texts at once, as numpy arrays over Arrow's own buffers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
SHINGLE = 5

_bytes = np.arange(256)
LOWER = np.where((_bytes >= 65) & (_bytes <= 90), _bytes + 32, _bytes).astype(np.uint8)
#: ASCII letters, digits, the underscore and everything beyond ASCII make words.
WORD = ((_bytes >= 48) & (_bytes <= 57)) | ((_bytes >= 65) & (_bytes <= 90)) | ((_bytes >= 97) & (_bytes <= 122)) | (_bytes == 95) | (_bytes >= 128)
#: Whatever is not ASCII white space makes words.
SOLID = ~((_bytes == 32) | ((_bytes >= 9) & (_bytes <= 13)))
_BASE = 0x100000001B3
_POWERS = np.array([pow(_BASE, i, 1 << 64) for i in range(1024)], dtype=np.uint64)
#: Powers for every 1,024 and every 1,048,576 bytes of a long word.
_KILO = np.array([pow(_BASE, i << 10, 1 << 64) for i in range(1024)], dtype=np.uint64)
_MEGA = np.array([pow(_BASE, i << 20, 1 << 64) for i in range(2048)], dtype=np.uint64)
_MIX = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
_S30, _S27, _S31 = np.uint64(30), np.uint64(27), np.uint64(31)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that scatters its input."""
    x = x + _MIX[0]
    x = (x ^ (x >> _S30)) * _MIX[1]
    x = (x ^ (x >> _S27)) * _MIX[2]
    return x ^ (x >> _S31)


def chunks(batch: pa.RecordBatch, column: str) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets of its rows) for pieces of a batch of about a megabyte; nulls are empty."""
    arr = batch.column(batch.schema.get_field_index(column)).cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(arr.buffers()[1], dtype=np.int64)[arr.offset : arr.offset + len(arr) + 1] if len(arr) else np.zeros(1, dtype=np.int64)
    data = np.frombuffer(arr.buffers()[2], dtype=np.uint8) if arr.buffers()[2] else np.zeros(0, dtype=np.uint8)
    i, n = 0, len(arr)
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + CHUNK_BYTES, side="right")) - 1)
        j = min(j, n)
        yield i, j, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every run of marked bytes; runs end where their row does."""
    if not len(inside):
        none = np.zeros(0, dtype=np.int64)
        return none, none
    before = np.empty_like(inside)
    before[0] = False
    before[1:] = inside[:-1]
    edges = offsets[1:-1]
    before[edges[edges < len(inside)]] = False
    after = np.empty_like(inside)
    after[-1] = False
    after[:-1] = inside[1:]
    inner = edges[(edges > 0) & (edges <= len(inside))] - 1
    after[inner] = False
    return np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1


def hashes(data: np.ndarray, length: np.ndarray) -> np.ndarray:
    """A hash of each of the strings that the bytes hold one after the other."""
    first = np.cumsum(length) - length
    at = np.arange(first[-1] + length[-1]) - np.repeat(first, length)
    terms = (data.astype(np.uint64) + np.uint64(1)) * _POWERS[at & 1023]
    if length.max() > 1024:
        far = np.flatnonzero(at >= 1024)
        terms[far] *= _KILO[(at[far] >> 10) & 1023] * _MEGA[at[far] >> 20]
    return mix(np.add.reduceat(terms, first) + length.astype(np.uint64) * _MIX[1])


def words(data: np.ndarray, offsets: np.ndarray, solid: np.ndarray = WORD) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, row, start and end of every word; words are runs of ``solid`` bytes, A-Z in lower case."""
    is_word = solid[data]
    start, end = runs(is_word, offsets)
    if not len(start):
        return np.zeros(0, dtype=np.uint64), start, start, end
    return hashes(LOWER[data[is_word]], end - start), np.searchsorted(offsets, start, side="right") - 1, start, end


def shingles(code: np.ndarray, row: np.ndarray, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every run of ``k`` words; a row of fewer words, but any, has one shingle of all of them."""
    n = len(code)
    out, at = [], []
    if n >= k:
        whole = row[k - 1 :] == row[: n - k + 1]
        value = np.zeros(n - k + 1, dtype=np.uint64)
        for j in range(k):
            value = mix(value + code[j : n - k + 1 + j])
        out.append(value[whole])
        at.append(row[: n - k + 1][whole])
    if n:
        rows, first, count = np.unique(row, return_index=True, return_counts=True)
        for r, f, c in zip(rows[count < k], first[count < k], count[count < k], strict=True):
            value = np.full(1, c, dtype=np.uint64)
            for j in range(c):
                value = mix(value + code[f + j : f + j + 1])
            out.append(value)
            at.append(np.array([r]))
    if not out:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    value, row = np.concatenate(out), np.concatenate(at)
    if len(out) > 1:
        order = np.argsort(row, kind="stable")
        value, row = value[order], row[order]
    return value, row


def distinct(value: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each row's distinct values in order, and how often each occurs there; rows come in order."""
    if not len(value):
        return value, row, np.zeros(0, dtype=np.int64)
    order = np.lexsort((value, row))
    value, row = value[order], row[order]
    fresh = np.empty(len(value), dtype=bool)
    fresh[0] = True
    fresh[1:] = (value[1:] != value[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(fresh)
    return value[first], row[first], np.diff(np.append(first, len(value)))


def lists(values: np.ndarray, row: np.ndarray, rows: int, kind: pa.DataType) -> pa.ListArray:
    """One list for each row from values in row order."""
    ends = np.searchsorted(row, np.arange(rows + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values, type=kind))
