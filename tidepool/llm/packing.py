"""Packing: first-fit decreasing with a tournament tree of bin capacities, in random groups.

Texts become token ids by a public tokenizer, then an end id.  A document is cut into pieces of
at most ``SEQUENCE`` ids: all but the last are full sequences of their own.  The rest pieces are
dealt at random (round robin over rows sorted by hash, so a hot source or a group of copies
spreads evenly) and packed in independent groups of ``GROUP`` pieces: longest first, each into
the first sequence of the group with room, which a tournament tree over the capacities finds
in logarithmic time.  The padding is that of the last sequences of each group.

Token ids are computed once per distinct piece and worker and kept in a table that is emptied
beyond ``TABLE`` pieces; pieces are then encoded again.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm.bpe import Cache, Merges, encode_run, runs_of, vocabulary_path, worker_store
from tidepool.llm.common import WORD_SPLIT, materialize
from tidepool.llm.wordtable import PieceTable, word_spans
from tidepool.session import session_conf

SEQUENCE = 4096
END_ID = 2
GROUP = 4096
CACHE = 200_000
TABLE = 1_500_000
RUN_CHARS = 1 << 18  # a worker holds about 100 bytes of arrays for each
BATCH = {"maxRecordsPerBatch": "2000", "maxBytesPerBatch": str(4 << 20)}  # of Arrow: the texts of a worker
VOCABULARY = "word_bpe_49k.json"
END_OF_WORD = "</w>"
PIECES = "doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long"


class ChunkEncoder:
    """Ids of whole texts, as the tokenizer library gives them.

    Latin-1 texts are lower-cased, split by character class and merged in batches; the library
    itself encodes the chunks of all others and of those that hold an added token's string.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.merges = Merges(spec, END_OF_WORD)
        self.added = [t["content"] for t in spec["added_tokens"]]
        self.table, self.chunks = PieceTable(TABLE), Cache(CACHE)

    def _others(self, texts: list[str]) -> list[bytes]:
        """The library's ids, chunk by chunk: it never joins across white space."""

        def fill(chunks: list[str]) -> Iterator[bytes]:
            for a, b in runs_of(chunks, 1 << 16):
                for e in self.library.encode_batch_fast(chunks[a:b], add_special_tokens=False):
                    yield np.array(e.ids, dtype="<u4").tobytes()

        return self.chunks.joined([regex.split(WORD_SPLIT, x) for x in texts], fill)

    def encode(self, texts: list[str]) -> list[bytes]:
        return encode_run(
            texts, self.table, word_spans, self.merges.fill, True, self.added, self._others
        )


def _encoder(path: str | None) -> ChunkEncoder:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return ChunkEncoder(path or vocabulary_path(VOCABULARY))


def _tokenize(path: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_store(f"chunk_encoder:{path}", lambda: _encoder(path))
        end = np.array([END_ID], dtype="<u4").tobytes()
        for batch in batches:
            texts = [x or "" for x in batch.column("text").to_pylist()]
            keep = [n for n in batch.schema.names if n != "text"]
            for a, b in runs_of(texts, RUN_CHARS):
                row, start, length, crc, total = [], [], [], [], []
                for k, ids in enumerate(encoder.encode(texts[a:b]), a):
                    ids += end
                    n = len(ids) // 4
                    for at in range(0, n, SEQUENCE):
                        piece = ids[4 * at : 4 * (at + SEQUENCE)]
                        row.append(k)
                        start.append(at)
                        length.append(len(piece) // 4)
                        crc.append(zlib.crc32(piece))
                        total.append(n)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(n).take(pa.array(row, pa.int64())) for n in keep),
                        *(pa.array(x, pa.int64()) for x in (start, length, crc, total)),
                    ],
                    names=[*keep, "start", "length", "ids_crc32", "doc_tokens"],
                )

    return run


def first_fit_decreasing(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each item: longest first, each into the first bin with room.

    ``tree`` is a tournament of the bins' room: node k holds the larger of nodes 2k and 2k+1.
    """
    n = len(sizes)
    leaves = 1 << max(0, n - 1).bit_length()
    tree = [capacity] * (2 * leaves)
    bins, offsets = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for item in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[item])
        node = 1
        while node < leaves:
            node *= 2
            if tree[node] < size:
                node += 1
        bins[item], offsets[item] = node - leaves, capacity - tree[node]
        tree[node] -= size
        while node > 1:
            node //= 2
            larger = max(tree[2 * node], tree[2 * node + 1])
            if tree[node] == larger:
                break
            tree[node] = larger
    return bins, offsets


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    prefix = TaskContext.get().partitionId() << 33
    used = 0

    def group(table: pa.Table) -> pa.Table:
        nonlocal used
        length = table.column("length").to_numpy()
        full = length == SEQUENCE
        sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
        sequence[full] = used + np.arange(int(full.sum()))
        used += int(full.sum())
        if not full.all():
            sequence[~full], offset[~full] = first_fit_decreasing(length[~full], SEQUENCE)
            sequence[~full] += used
            used = int(sequence.max()) + 1
        return table.append_column("sequence_id", pa.array(sequence + prefix)).append_column(
            "offset", pa.array(offset)
        )

    waiting: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        waiting.append(batch)
        rows += len(batch)
        while rows >= GROUP:
            table = pa.Table.from_batches(waiting)
            yield from group(table.slice(0, GROUP)).combine_chunks().to_batches()
            waiting = table.slice(GROUP).to_batches()
            rows -= GROUP
    if rows:
        yield from group(pa.Table.from_batches(waiting)).combine_chunks().to_batches()


def pack(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Pieces of all documents and their places in sequences of at most ``SEQUENCE`` ids.

    Returns doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.  ``vocabulary``
    is the tokenizer file's path on the executors (default: the installed public one).  Defined
    results: a null or empty text is the end id alone; repeated rows are packed once each; ties
    in length keep their order in the group; an empty table gives an empty result; other columns
    are ignored.
    """
    kind = dict(docs.dtypes)["doc_id"]
    schema = PIECES.format(kind=kind)
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    with session_conf(docs.sparkSession, **{f"spark__sql__execution__arrow__{k}": v for k, v in BATCH.items()}):
        pieces = materialize(rows.mapInArrow(_tokenize(vocabulary), schema), "op3-pieces")
    tasks = max(1, -(-pieces.count() // (2 * GROUP)))
    return pieces.repartition(tasks).mapInArrow(_pack, f"{schema}, sequence_id long, offset long")
