"""Postings of one block of documents as compressed bitmaps, a plane for each binary digit of the multiplicity.

A container holds the documents of one plane: below ``SPARSE`` of them as sorted 16-bit numbers, otherwise as a
bitmap of the block; its length tells which.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Documents of a block; a power of two.
BLOCK_DOCS = 4096
_BITMAP = BLOCK_DOCS // 8
SPARSE = _BITMAP // 2


def added_up(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, and the sums of their values."""
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, dtype=np.int64)
    return keys[first], np.add.reduceat(values, first) if len(first) else values


def planes(pairs: np.ndarray, docs: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, pa.ListArray]:
    """Distinct pairs, how many documents hold each, and their planes, lowest digit first.

    Postings are distinct and sorted by pair and document.  A plane without documents is an empty container.
    """
    first = np.flatnonzero(np.append(True, pairs[1:] != pairs[:-1])) if len(pairs) else np.zeros(0, dtype=np.int64)
    held = np.diff(np.append(first, len(pairs)))
    of = np.repeat(np.arange(len(first)), held)
    depth = np.zeros(len(first), dtype=np.int64)
    np.maximum.at(depth, of, np.frexp(times.astype(np.float64))[1])
    offsets = np.append(0, np.cumsum(depth))
    container, member = [], []
    for digit in range(int(depth.max(initial=0))):
        has = np.flatnonzero(times >> digit & 1)
        container.append(offsets[of[has]] + digit)
        member.append(docs[has])
    container, member = (np.concatenate(x) if x else np.zeros(0, dtype=np.int64) for x in (container, member))
    order = np.argsort(container, kind="stable")
    container, member = container[order], member[order]
    sizes = np.bincount(container, minlength=offsets[-1])
    dense = sizes >= SPARSE
    lengths = np.where(dense, _BITMAP, 2 * sizes)
    ends = np.cumsum(lengths)
    starts = ends - lengths
    data = np.zeros(int(lengths.sum()), dtype=np.uint8)
    rank = np.arange(len(container)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    thin = ~dense[container]
    place = starts[container[thin]] + 2 * rank[thin]
    data[place], data[place + 1] = member[thin] & 255, member[thin] >> 8
    np.bitwise_or.at(data, starts[container[~thin]] + (member[~thin] >> 3), (1 << (member[~thin] & 7)).astype(np.uint8))
    places = pa.py_buffer(np.append(0, ends).astype(np.int32).tobytes())
    containers = pa.Array.from_buffers(pa.binary(), len(lengths), [None, places, pa.py_buffer(data.tobytes())])
    return pairs[first], held, pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), containers)


def members(containers: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Container and document of everything that the containers hold."""
    ends = np.frombuffer(containers.buffers()[1], dtype=np.int32)[containers.offset : containers.offset + len(containers) + 1].astype(np.int64)
    data = np.frombuffer(containers.buffers()[2] or b"", dtype=np.uint8)
    lengths, starts = np.diff(ends), ends[:-1]
    dense = lengths == _BITMAP
    sizes = np.where(dense, 0, lengths // 2)
    thin = np.repeat(np.arange(len(lengths)), sizes)
    at = np.repeat(starts, sizes) + 2 * (np.arange(len(thin)) - np.repeat(np.cumsum(sizes) - sizes, sizes))
    thin_docs = data[at].astype(np.int64) | data[at + 1].astype(np.int64) << 8
    which = np.flatnonzero(dense)
    bits = np.unpackbits(data[starts[which][:, None] + np.arange(_BITMAP)], axis=1, bitorder="little") if len(which) else np.zeros((0, BLOCK_DOCS))
    row, docs = np.nonzero(bits)
    return np.append(thin, which[row]), np.append(thin_docs, docs)
