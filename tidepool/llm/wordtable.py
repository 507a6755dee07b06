"""Splitting of Latin-1 texts by character class and a table of encoded pieces, in numpy.

The public vocabularies split texts by patterns over letters, numbers, white space and the
rest.  For texts of Latin-1 characters the same cuts follow from the classes of neighbouring
characters, for a whole run of texts at once.  Pieces are identified by two independent 64-bit
hashes; the ids of each distinct piece are kept in flat arrays.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import regex

from tidepool.llm.common import _POWERS, mix64

LETTER, NUMBER, OTHER, SPACE = range(4)
#: What may follow an apostrophe as a piece of its own (fixed by the vocabularies' patterns).
CONTRACTIONS = (b"s", b"t", b"re", b"ve", b"m", b"ll", b"d")
_CLASS = np.array(
    [
        LETTER
        if regex.match(r"\p{L}", chr(c))
        else NUMBER
        if regex.match(r"\p{N}", chr(c))
        else SPACE
        if regex.match(r"\s", chr(c))
        else OTHER
        for c in range(256)
    ],
    dtype=np.int8,
)
_LOWER = np.frombuffer(
    bytes(ord(chr(c).lower()) for c in range(256)), dtype=np.uint8
)
_CODES = np.random.default_rng(31337).integers(1, 2**63, (2, 256), dtype=np.uint64)


def _contracted(data: np.ndarray, start: np.ndarray, kind: np.ndarray, begin: np.ndarray, blank: bool) -> None:
    """Cut apostrophe contractions; with ``blank`` an apostrophe after a blank belongs to it."""
    at = np.flatnonzero((data == 39) & start)
    if not len(at):
        return
    if blank:
        at = at[(at == 0) | begin[at] | (data[at - 1] != 32)]
    for word in CONTRACTIONS:
        n = len(word)
        fit = at[at + n < len(data)]
        for k, c in enumerate(word, 1):
            fit = fit[(data[fit + k] == c) & ~begin[fit + k]]
        start[fit + 1] = False
        after = fit + n + 1
        start[after[after < len(data)]] = True
        at = np.setdiff1d(at, fit, assume_unique=True)


def word_spans(data: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of letters, single numbers and other runs; white space is left out."""
    kind = _CLASS[data]
    start = begin.copy()
    start[1:] |= kind[1:] != kind[:-1]
    start |= kind == NUMBER
    _contracted(data, start, kind, begin, False)
    starts = np.flatnonzero(start)
    ends = np.append(starts[1:], len(data))
    keep = kind[starts] != SPACE
    return starts[keep], ends[keep]


def byte_spans(data: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of runs with at most one leading blank; every character is in a piece."""
    kind = _CLASS[data]
    start = begin.copy()
    start[1:] |= kind[1:] != kind[:-1]
    _contracted(data, start, kind, begin, True)
    # the last white space before a word: a blank joins the word, another stands alone
    last = np.flatnonzero((kind[:-1] == SPACE) & (kind[1:] != SPACE) & ~begin[1:])
    start[last] = True
    start[last[data[last] == 32] + 1] = False
    starts = np.flatnonzero(start)
    return starts, np.append(starts[1:], len(data))


class PieceTable:
    """Ids of distinct pieces: sorted hashes, check hashes, and spans of one flat id array."""

    def __init__(self, most: int) -> None:
        self.most = most
        self.clear()

    def clear(self) -> None:
        self.key = self.check = np.zeros(0, np.uint64)
        self.start = self.size = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def add(self, key: np.ndarray, check: np.ndarray, ids: list[bytes]) -> None:
        size = np.array([len(x) // 4 for x in ids], dtype=np.int64)
        start = len(self.ids) + np.cumsum(size) - size
        self.ids = np.concatenate([self.ids, np.frombuffer(b"".join(ids), dtype="<u4")])
        # only the new ones are sorted; they go between the others
        order = np.argsort(key, kind="stable")
        at = np.searchsorted(self.key, key[order])
        self.key = np.insert(self.key, at, key[order])
        self.check = np.insert(self.check, at, check[order])
        self.start = np.insert(self.start, at, start[order])
        self.size = np.insert(self.size, at, size[order])


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    up, down = _POWERS.get(len(data) + 1)
    out = []
    for codes in _CODES:
        sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(codes[data] * up[: len(data)], out=sums[1:])
        out.append(mix64((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64)))
    return out


def encode_latin(
    texts: list[bytes],
    table: PieceTable,
    spans: Callable,
    fill: Callable[[list[str]], list[bytes]],
    lower: bool,
) -> list[bytes | None]:
    """Ids of each Latin-1 text; None in the (never yet seen) case of a hash collision."""
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    sizes = np.array([len(x) for x in texts], dtype=np.int64)
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    if not len(data):
        return [b""] * len(texts)
    if lower:
        data = _LOWER[data]
    begin = np.zeros(len(data), dtype=bool)
    begin[offsets[:-1][sizes > 0]] = True
    starts, ends = spans(data, begin)
    key, check = hashes(data, starts, ends)
    if len(table.key) > table.most:
        table.clear()
    distinct, first, inverse = np.unique(key, return_index=True, return_inverse=True)
    at = np.searchsorted(table.key, distinct)
    at[at == len(table.key)] = 0
    known = table.key[at] == distinct if len(table.key) else np.zeros(len(distinct), bool)
    new = first[~known]
    if len(new):
        flat = data.tobytes()
        pieces = [flat[a:b].decode("latin-1") for a, b in zip(starts[new].tolist(), ends[new].tolist())]
        table.add(key[new], check[new], list(fill(pieces)))
        at = np.searchsorted(table.key, distinct)
    place = at[inverse]
    clash = table.check[place] != check
    size, start = table.size[place], table.start[place]
    stop = np.cumsum(size)
    total = int(stop[-1]) if len(stop) else 0
    ids = table.ids[np.arange(total) + np.repeat(start - (stop - size), size)].astype("<u4").tobytes()
    edge = np.concatenate([[0], stop])[np.searchsorted(starts, offsets)] * 4
    out: list[bytes | None] = [ids[a:b] for a, b in zip(edge[:-1].tolist(), edge[1:].tolist())]
    for k in np.unique(np.searchsorted(offsets, starts[clash], side="right") - 1).tolist():
        out[k] = None
    return out
