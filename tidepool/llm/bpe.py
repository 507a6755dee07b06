"""Byte-level BPE by batched numpy merge rounds.

Texts are split by the vocabulary's pattern.  The pieces that a worker has not met yet are
encoded together: the symbols of all of them lie in one flat array, and each round finds every
adjacent pair's rank by binary search over the sorted pair keys, takes the lowest rank of each
piece, and merges its occurrences from left to right.  Pieces without a mergeable pair leave the
array.  A merge only ever enables merges of higher rank, so this gives the ids of the reference
algorithm that merges one pair at a time.

Encoded pieces are kept per worker in a table that is emptied beyond ``TABLE`` entries.
Documents are independent: there is no shuffle, and a worker holds a run of about ``RUN_CHARS``
characters (or one longer document) and its cache.
"""

from __future__ import annotations

import hashlib
import json
import sys
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm.wordtable import PieceTable, byte_spans, encode_latin


VOCABULARY = "byte_bpe_50k.json"
CACHE = 200_000
TABLE = 1_500_000
RUN_CHARS = 2 << 20
#: Texts of other characters are split by the tokenizer library itself: beyond these ranges
#: the Unicode tables of the two libraries differ in version.
_SAME_TABLES = r"[^\u0000-՗က-₎₠-ꟍ]"
_NONE = np.int64(1) << 40


def byte_symbols() -> dict[str, int]:
    """The printable stand-ins of byte-level vocabularies: char -> byte."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def worker_store(name: str, make):
    """An object kept for the life of the Python worker."""
    store = sys.modules.setdefault("tidepool_worker_store", types.ModuleType("tidepool_worker_store"))
    if not hasattr(store, name):
        setattr(store, name, make())
    return getattr(store, name)


class Cache:
    """Values of keys, made in bulk; emptied whenever it holds more than ``size`` of them.

    Emptying costs time only: whatever is asked for again is made again.
    """

    def __init__(self, size: int) -> None:
        self.size, self.known = size, {}

    def joined(self, rows: list[list], fill) -> list[bytes]:
        """The concatenated values of each row's keys; ``fill(missing keys)`` makes new ones."""
        if len(self.known) > self.size:
            self.known.clear()
        missing = list(set().union(*rows).difference(self.known))
        self.known.update(zip(missing, fill(missing)))
        get = self.known.__getitem__
        return [b"".join(map(get, row)) for row in rows]


def runs_of(texts: list, most: int) -> Iterator[tuple[int, int]]:
    """(first, end) of runs of texts of about ``most`` units; a longer text is a run of its own."""
    a, size = 0, 0
    for k, text in enumerate(texts):
        if k > a and size + len(text) > most:
            yield a, k
            a, size = k, 0
        size += len(text)
    if a < len(texts):
        yield a, len(texts)


def vocabulary_path(name: str) -> str:
    """Where the public vocabulary files lie on the machine that runs the task."""
    import public_tokenizers

    return public_tokenizers.path(name)


def encode_run(texts, table, spans, fill, lower, added, whole) -> list[bytes]:
    """Ids of a run of texts: Latin-1 texts by the piece table, all others by ``whole``."""
    latin, rows = [], []
    for k, text in enumerate(texts):
        try:
            if not any(x in text for x in added):
                latin.append(text.encode("latin-1"))
                rows.append(k)
        except UnicodeEncodeError:
            pass
    out: list[bytes | None] = [None] * len(texts)
    for k, ids in zip(rows, encode_latin(latin, table, spans, fill, lower)):
        out[k] = ids
    rest = [k for k, ids in enumerate(out) if ids is None]
    for k, ids in zip(rest, whole([texts[k] for k in rest])):
        out[k] = ids
    return out


class Merges:
    """The merge table of a BPE vocabulary and its batched application.

    ``suffix`` marks the last symbol of a word in vocabularies with word ends.
    """

    def __init__(self, spec: dict, suffix: str = "") -> None:
        vocabulary = spec["model"]["vocab"]
        self.stand_in = byte_symbols()
        self.size = max([*vocabulary.values(), *(t["id"] for t in spec["added_tokens"])]) + 1
        self.first, self.last = np.zeros((2, 256), dtype=np.int64)
        for char, byte in self.stand_in.items():
            self.first[byte] = vocabulary[char]
            self.last[byte] = vocabulary[char + suffix]
        keys, merged = [], []
        for left, right in spec["model"]["merges"]:
            keys.append(vocabulary[left] * self.size + vocabulary[right])
            merged.append(vocabulary[left + right])
        if len(set(merged)) != len(merged):
            raise ValueError("two merges make the same symbol; batched rounds would reorder them")
        keys, merged = np.array(keys, dtype=np.int64), np.array(merged, dtype=np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks, self.merged = keys[order], order.astype(np.int64), merged[order]

    def find(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (or ``_NONE``) and table position of each pair of symbols."""
        pair = left * self.size + right
        at = np.searchsorted(self.keys, pair)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == pair, self.ranks[at], _NONE), at

    def merge(self, pieces: list[str]) -> list[bytes]:
        """The ids (little-endian 32-bit) of each piece, all pieces merged in common rounds."""
        out: list[bytes] = [b""] * len(pieces)
        raw = [p.encode("utf-8") for p in pieces]
        sizes = np.array([len(r) for r in raw], dtype=np.int64)
        flat = np.frombuffer(b"".join(raw), dtype=np.uint8)
        symbols = self.first[flat]
        ends = np.cumsum(sizes)
        symbols[ends[sizes > 0] - 1] = self.last[flat[ends[sizes > 0] - 1]]
        owner = np.repeat(np.arange(len(raw)), sizes)
        rank, at = np.full(len(symbols), _NONE), np.zeros(len(symbols), np.int64)
        fresh = np.flatnonzero(owner[1:] == owner[:-1])
        while len(symbols):
            # only pairs that a merge has made since the last round are looked up
            rank[fresh], at[fresh] = self.find(symbols[fresh], symbols[fresh + 1])
            starts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            low = np.minimum.reduceat(rank, starts)
            lengths = np.diff(np.append(starts, len(symbols)))
            lowest = np.repeat(low, lengths)
            alive = lowest < _NONE
            if not alive.all():
                done = np.flatnonzero(low == _NONE)
                ids = symbols.astype("<u4").tobytes()
                for k, a, b in zip(
                    owner[starts[done]].tolist(),
                    (starts[done] * 4).tolist(),
                    ((starts[done] + lengths[done]) * 4).tolist(),
                ):
                    out[k] = ids[a:b]
            where = np.flatnonzero(alive & (rank == lowest))
            if len(where):
                # of overlapping occurrences (one symbol repeated) every second one from the left
                run = np.flatnonzero(np.concatenate([[True], np.diff(where) != 1]))
                if len(run) < len(where):
                    odd = np.arange(len(where)) - np.repeat(run, np.diff(np.append(run, len(where))))
                    where = where[odd % 2 == 0]
                symbols[where] = self.merged[at[where]]
                alive[where + 1] = False
            moved = np.cumsum(alive) - 1
            where = moved[where]
            symbols, owner, rank, at = symbols[alive], owner[alive], rank[alive], at[alive]
            touched = np.zeros(len(symbols) + 1, dtype=bool)
            touched[where] = touched[where - 1] = True
            rank[touched[:-1]] = _NONE
            touched = touched[:-1]
            touched[:-1] &= owner[1:] == owner[:-1]
            touched[-1:] = False
            fresh = np.flatnonzero(touched)
        return out

    def fill(self, pieces: list[str]) -> Iterator[bytes]:
        for a, b in runs_of(pieces, 1 << 18):
            yield from self.merge(pieces[a:b])


class Codec:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str, pattern: str) -> None:
        import tokenizers

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.merges = Merges(spec)
        size = self.merges.size
        bytes_of = [b""] * size
        for token, number in spec["model"]["vocab"].items():
            bytes_of[number] = bytes(self.merges.stand_in[c] for c in token)
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for content, number in self.added.items():
            bytes_of[number] = content.encode("utf-8")
        self.lengths = np.array([len(b) for b in bytes_of], dtype=np.int64)
        self.begins = np.concatenate([[0], np.cumsum(self.lengths)[:-1]])
        self.blob = np.frombuffer(b"".join(bytes_of), dtype=np.uint8)
        self.pattern = regex.compile(pattern)
        self.other = regex.compile(_SAME_TABLES)
        self.special = regex.compile("|".join(map(regex.escape, self.added))) if self.added else None
        self.library = tokenizers.pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
        self.table, self.words = PieceTable(TABLE), Cache(CACHE)

    # -- encoding ------------------------------------------------------------------------

    def split(self, text: str) -> list[str]:
        if text.isascii() or not self.other.search(text):
            return self.pattern.findall(text)
        return [text[a:b] for _, (a, b) in self.library.pre_tokenize_str(text)]

    def pieces(self, text: str) -> list[str]:
        """The text's pieces; the strings of added tokens are pieces of their own."""
        if self.special is None or not self.special.search(text):
            return self.split(text)
        out, at = [], 0
        for match in self.special.finditer(text):
            out += self.split(text[at : match.start()])
            out.append(match.group())
            at = match.end()
        return out + self.split(text[at:])

    def _words(self, pieces: list[str]) -> Iterator[bytes]:
        for piece, ids in zip(pieces, self.merges.fill(pieces)):
            added = self.added.get(piece)
            yield ids if added is None else np.array([added], dtype="<u4").tobytes()

    def _whole(self, texts: list[str]) -> list[bytes]:
        return self.words.joined([self.pieces(x) for x in texts], self._words)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit integers."""
        out: list[bytes] = []
        for a, b in runs_of(texts, RUN_CHARS):
            out += encode_run(texts[a:b], self.table, byte_spans, self.merges.fill, False, self.added, self._whole)
        return out

    def decode(self, ids: bytes) -> bytes:
        """UTF-8 of the decoded ids; malformed sequences become U+FFFD."""
        numbers = np.frombuffer(ids, dtype="<u4")
        sizes = self.lengths[numbers]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        flat = self.blob[np.arange(total) + np.repeat(self.begins[numbers] - (ends - sizes), sizes)]
        return flat.tobytes().decode("utf-8", errors="replace").encode("utf-8")


def _codec(path: str | None) -> Codec:
    def make() -> Codec:
        import public_tokenizers

        return Codec(path or vocabulary_path(VOCABULARY), public_tokenizers.PATTERN)

    return worker_store(f"byte_codec:{path}", make)


def _encode(path: str | None, digest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(path)
        for batch in batches:
            ids = codec.encode([x or "" for x in batch.column("text").to_pylist()])
            keep = [n for n in batch.schema.names if n != "text"]
            head = [batch.column(n) for n in keep]
            if digest:
                rows = [
                    (len(x) // 4, hashlib.sha256(x).hexdigest(), hashlib.sha256(codec.decode(x)).hexdigest())
                    for x in ids
                ]
                n, encoded, decoded = zip(*rows) if rows else ([], [], [])
                tail = [pa.array(n, pa.int64()), pa.array(encoded, pa.string()), pa.array(decoded, pa.string())]
                names = [*keep, "n_tokens", "ids_sha256", "decoded_sha256"]
            else:
                lists = [np.frombuffer(x, dtype="<u4").astype(np.int32) for x in ids]
                tail, names = [pa.array(lists, pa.list_(pa.int32()))], [*keep, "ids"]
            yield pa.RecordBatch.from_arrays([*head, *tail], names=names)

    return run


def encode(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """(doc_id, ids array<int>) of every row; a null text has no ids."""
    kind = dict(docs.dtypes)["doc_id"]
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_encode(vocabulary, False), f"doc_id {kind}, ids array<int>")


def decode(encoded: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """(doc_id, text) from (doc_id, ids array<int>); a null list is an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(vocabulary)
        for batch in batches:
            ids = batch.column("ids").to_pylist()
            texts = [codec.decode(np.array(x or [], dtype="<u4").tobytes()).decode("utf-8") for x in ids]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"]
            )

    kind = dict(encoded.dtypes)["doc_id"]
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, text string")


def digests(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): whole texts encoded and decoded again.

    Defined results: a null or empty text has no ids; repeated rows come back once each; an
    empty table gives an empty result; other columns are ignored.
    """
    kind = dict(docs.dtypes)["doc_id"]
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(
        _encode(vocabulary, True),
        f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string",
    )
