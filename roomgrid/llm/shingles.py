"""Words and shingles of Arrow batches of texts as 64-bit hashes, with numpy over whole buffers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_PIECE = 1 << 18  # bytes looked at together; a few dozen bytes of memory each
_U = np.uint64
_FACTOR = _U(0x9E3779B97F4A7C15)  # odd, so its powers have inverses
_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _powers(factor: int, n: int) -> np.ndarray:
    out = np.full(n, factor, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POWER = _powers(int(_FACTOR), _PIECE + 1)
_INVERSE = _powers(pow(int(_FACTOR), -1, 1 << 64), _PIECE + 1)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose bits all depend on all bits."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _piece_words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and starts of the words in at most ``_PIECE`` bytes."""
    space = _SPACE[data]
    edge = np.empty(len(data) + 1, dtype=bool)
    edge[0], edge[-1] = not space[0], not space[-1]
    np.not_equal(space[1:], space[:-1], out=edge[1:-1])
    at = np.flatnonzero(edge)
    start, end = at[::2], at[1::2]
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[_LOWER[data]] * _POWER[: len(data)], out=sums[1:])
    return mixed((sums[end] - sums[start]) * _INVERSE[start] + (end - start).astype(np.uint64)), start


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes (of the lower-case words) and byte places of all words in a text of any length."""
    found, places, at = [], [], 0
    while at < len(data):
        stop = min(at + _PIECE, len(data))
        if stop < len(data):  # end the piece at white space
            back = np.flatnonzero(_SPACE[data[at:stop]])
            if len(back):
                stop = at + int(back[-1]) + 1
            else:  # one word longer than a piece: hash it by itself
                far = at
                while far < len(data) and not _SPACE[data[far : far + _PIECE]].any():
                    far += _PIECE
                stop = far + int(np.argmax(_SPACE[data[far : far + _PIECE]])) if far < len(data) else len(data)
                whole = _U(0)
                for k in range(at, stop, _PIECE):
                    part = data[k : min(k + _PIECE, stop)]
                    total = np.cumsum(_BYTE[_LOWER[part]] * _POWER[: len(part)])[-1:]
                    whole = mixed(np.array([whole], dtype=np.uint64) + total)[0]
                found.append(mixed(np.array([whole + _U(stop - at)], dtype=np.uint64)))
                places.append(np.array([at]))
                at = stop
                continue
        h, p = _piece_words(data[at:stop])
        found.append(h)
        places.append(p + at)
        at = stop
    if not found:
        return np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64)
    return np.concatenate(found), np.concatenate(places)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the n + 1 offsets of its texts; nulls are empty."""
    column = column.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return (np.frombuffer(data, dtype=np.uint8) if data else np.empty(0, dtype=np.uint8)), offsets


def chunks(offsets: np.ndarray, most: int = _PIECE) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``most`` bytes together, at least one row each."""
    n, begin = len(offsets) - 1, 0
    while begin < n:
        end = max(begin + 1, int(np.searchsorted(offsets, offsets[begin] + most, side="right")) - 1)
        yield begin, min(end, n)
        begin = min(end, n)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of every text, one after another, and n + 1 offsets.

    A text with fewer words than ``size`` has its whole sequence as its only shingle; one
    without words has none.
    """
    base = offsets[0]
    # texts are parted by a blank, so that words end where their text does
    gap = np.arange(len(offsets) - 1)
    joined = np.full(int(offsets[-1] - base) + len(offsets) - 1, 32, dtype=np.uint8)
    lengths = np.diff(offsets)
    joined[np.arange(int(lengths.sum())) + np.repeat(gap, lengths)] = data[base : offsets[-1]]
    begins = offsets - base + np.arange(len(offsets))
    words, places = word_hashes(joined)
    doc = np.searchsorted(begins, places, side="right") - 1
    count = np.bincount(doc, minlength=len(gap))
    first = np.concatenate([[0], np.cumsum(count)])
    index = np.arange(len(words)) - first[doc]
    head = (index + size <= count[doc]) | ((index == 0) & (count[doc] < size))
    total = np.zeros(int(head.sum()), dtype=np.uint64)
    at = np.flatnonzero(head)
    own = doc[at]
    for k in range(size):
        there = np.minimum(at + k, max(len(words) - 1, 0))
        inside = index[at] + k < count[own]
        total = mixed(total + np.where(inside, words[there], _U(k + 1)) + _U(0x632BE59BD9B4E019))
    order = np.lexsort((total, own))
    total, own = total[order], own[order]
    new = np.ones(len(total), dtype=bool)
    new[1:] = (total[1:] != total[:-1]) | (own[1:] != own[:-1])
    total, own = total[new], own[new]
    return total, np.concatenate([[0], np.cumsum(np.bincount(own, minlength=len(gap)))])
