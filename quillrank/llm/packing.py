"""Packing documents into windows of tokens, next to their lexical neighbours.

Documents are dealt by the rarest token they hold and cut into shards of bounded size. Each shard has a BM25
index over its token ids, with document frequencies and the mean length of the whole corpus. The first
document of a window is its seed: the index returns the unused documents nearest to it, and these
fill the window greedily. What does not fit goes on in the next window, so windows are always full; the
rest at the end of a task is cut into powers of two, so nothing is padded at all.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillrank.llm.encoding import BYTE_BPE, byte_encoder
from quillrank.llm.ids import id_or_mark, id_or_null
from quillrank.llm.worker import give_back, keep_only
from quillrank.storage import Scratch

WINDOW = 2048
SHARD_DOCS = 1024  # documents of an index
SHARD_IDS = 4 << 20  # and its ids, unless one document alone has more
K1, B = 1.2, 0.75
_WIDTH = 2
_DTYPE = "<u2"
_IDS = 1 << 16
_ROWS = 10_000


def _entries(documents: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, term, count) of every distinct token of every document, sorted; one sort for all of them."""
    sizes = [len(ids) for ids in documents]
    tagged = np.sort((np.repeat(np.arange(len(documents), dtype=np.uint32), sizes) << 16) | np.concatenate(documents))
    first = np.flatnonzero(np.diff(tagged, prepend=~tagged[0]))
    counts = np.diff(first, append=len(tagged))
    return (tagged[first] >> 16).astype(np.int64), (tagged[first] & (_IDS - 1)).astype(np.uint16), counts


def _tokenized(documents: DataFrame, end_id: int, vocabulary: str) -> DataFrame:
    """(key, doc_id, ids, df): a row per document; and a row per task with the documents per token id.

    The key is the rarest token of a document: of the highest id, because a vocabulary merges frequent ones first.
    """

    schema = pa.schema([("key", pa.int32()), ("doc_id", pa.int64()), ("ids", pa.binary()), ("df", pa.list_(pa.int64()))])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_only("encoder", "tokenizer")
        encoder = byte_encoder(vocabulary, _WIDTH)
        end = end_id.to_bytes(_WIDTH, "little")
        frequency = np.zeros(_IDS, dtype=np.int64)
        documents = total = 0
        for batch in batches:
            doc_ids, row = batch["doc_id"], 0
            for encoded in encoder.batches(batch["text"]):
                for at in range(0, len(encoded), SHARD_DOCS):
                    packed = [ids + end for ids in encoded[at : at + SHARD_DOCS]]
                    some = [np.frombuffer(ids, dtype=_DTYPE) for ids in packed]
                    of, terms, _ = _entries(some)
                    frequency += np.bincount(terms, minlength=_IDS)
                    total += sum(map(len, some))
                    keys = terms[np.flatnonzero(np.diff(of, append=len(some)))].astype(np.int32)
                    columns = [keys, doc_ids.slice(row, len(packed)), packed, [None] * len(packed)]
                    row += len(packed)
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
                    del packed, some, columns
                del encoded
            documents += row
            del batch, doc_ids
        if documents:
            counts = [*frequency.tolist(), documents, total]
            yield pa.RecordBatch.from_pylist([{"key": -1, "doc_id": 0, "ids": None, "df": counts}], schema)
        give_back()

    return documents.select(id_or_mark("doc_id"), "text").mapInArrow(
        rows, "key int, doc_id bigint, ids binary, df array<bigint>"
    )


def _corpus_counts(tokenized: DataFrame) -> np.ndarray:
    """Documents per token id, then all documents and all ids; 65,538 numbers, however large the corpus."""
    sums = (
        tokenized.where("df is not null").select(F.posexplode("df").alias("token", "n"))
        .where("n > 0").groupBy("token").agg(F.sum("n").alias("n")).collect()
    )
    counts = np.zeros(_IDS + 2)
    for row in sums:
        counts[row["token"]] = row["n"]
    return counts


class Shard:
    """A BM25 index of a few documents, and which of them are still unused."""

    def __init__(self, documents: list[np.ndarray], idf: np.ndarray, mean_length: float):
        docs, terms, tf = _entries(documents)
        sizes = np.bincount(docs, minlength=len(documents))
        lengths = np.array([len(ids) for ids in documents], dtype=np.float32)
        norm = K1 * (1 - B + B * lengths / mean_length)
        weights = (idf[terms] * tf * (K1 + 1) / (tf + norm[docs])).astype(np.float32)
        self._starts = np.concatenate(([0], np.cumsum(sizes)))
        self._terms, self._weights = terms, weights.astype(np.float64)  # products and sums need no casts then
        self.unused = np.ones(len(documents), dtype=bool)
        self._next = 0
        self._asked = np.zeros(_IDS)
        self._narrow()

    def _narrow(self) -> None:
        """Only the entries of unused documents are searched from now on."""
        self._searched = np.flatnonzero(self.unused)
        sizes = np.diff(self._starts)
        kept = np.repeat(self.unused, sizes)
        self._searched_terms, self._searched_weights = self._terms[kept].astype(np.intp), self._weights[kept]
        self._searched_starts = np.concatenate(([0], np.cumsum(sizes[self._searched])))[:-1]
        self._parts = np.empty(len(self._searched_terms))

    def take(self, document: int) -> int:
        self.unused[document] = False
        return document

    def first(self) -> int | None:
        """The first unused document; None if all are used."""
        while self._next < len(self.unused) and not self.unused[self._next]:
            self._next += 1
        return self._next if self._next < len(self.unused) else None

    def neighbours(self, seed: int) -> list[int]:
        """Unused documents that share a token with the seed, best first; equal scores in shard order.

        The seed asks with all its distinct tokens.
        """
        if 4 * np.count_nonzero(self.unused) <= 3 * len(self._searched):
            self._narrow()
        if not len(self._searched):
            return []
        terms = self._terms[self._starts[seed] : self._starts[seed + 1]]
        self._asked[terms] = 1
        self._asked.take(self._searched_terms, out=self._parts, mode="clip")  # in place; every term is in range
        self._asked[terms] = 0
        self._parts *= self._searched_weights
        scores = np.add.reduceat(self._parts, self._searched_starts)
        found = np.flatnonzero((scores > 0) & self.unused[self._searched])
        return self._searched[found[np.argsort(-scores[found], kind="stable")]].tolist()


class _Packer:
    """Lays documents one after the other and cuts the line into windows."""

    def __init__(self, window: int, first_sequence: int):
        self._window, self.sequence = window, first_sequence
        self._open: list[tuple[int, int, int, bytes]] = []  # pieces of the open window
        self.fill = 0

    def add(self, doc_id: int, ids: bytes) -> list[tuple]:
        """The finished pieces, if the document closes windows."""
        done, total, start = [], len(ids) // _WIDTH, 0
        while start < total:
            length = min(self._window - self.fill, total - start)
            self._open.append((doc_id, start, total, ids[start * _WIDTH : (start + length) * _WIDTH]))
            self.fill += length
            start += length
            if self.fill == self._window:
                done += self._closed(self._open)
                self._open, self.fill = [], 0
        return done

    def _closed(self, pieces: list[tuple[int, int, int, bytes]]) -> list[tuple]:
        offset, rows = 0, []
        for doc_id, start, total, ids in pieces:
            rows.append((doc_id, start, len(ids) // _WIDTH, total, self.sequence, offset, ids))
            offset += len(ids) // _WIDTH
        self.sequence += 1
        return rows

    def rest(self) -> list[tuple]:
        """The last, unfilled window as sequences whose lengths are powers of two."""
        rows, pieces = [], self._open[::-1]
        while self.fill:
            room = 1 << (self.fill.bit_length() - 1)
            self.fill -= room
            sequence = []
            while room:
                doc_id, start, total, ids = pieces.pop()
                length = min(room, len(ids) // _WIDTH)
                sequence.append((doc_id, start, total, ids[: length * _WIDTH]))
                if length < len(ids) // _WIDTH:
                    pieces.append((doc_id, start + length, total, ids[length * _WIDTH :]))
                room -= length
            rows += self._closed(sequence)
        self._open = []
        return rows


_COLUMNS = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]


def pack(
    documents: DataFrame,
    scratch: Scratch,
    end_id: int = 1,
    window: int = WINDOW,
    vocabulary: str = BYTE_BPE,
    summary: Callable[[bytes], int] | None = None,
) -> DataFrame:
    """Pieces of ``documents`` (doc_id, text) in sequences of at most ``window`` ids.

    Columns: doc_id, start (ids of the document before the piece), length, doc_tokens (all its ids,
    with the end id), sequence_id, offset (in the sequence), ids (packed in 16 bits). With ``summary``, a function
    of packed ids, its result comes as ``summary`` in their place. A null text is empty: its
    document is the end id. A null doc_id stays null. Repeated rows are packed each. Other columns
    are not read. No documents give no pieces. The pieces read from ``scratch``.

    The token store is read twice, for its counts and for the shuffle by (key, doc_id), which splits
    frequent keys; a task holds one shard.
    """
    tokenized = scratch.stored(_tokenized(documents, end_id, vocabulary))
    counts = _corpus_counts(tokenized)
    n_docs, n_ids = counts[_IDS], counts[_IDS + 1]
    idf = np.log1p((n_docs - counts[:_IDS] + 0.5) / (counts[:_IDS] + 0.5)).astype(np.float32)
    mean_length = n_ids / max(n_docs, 1)
    shared = documents.sparkSession.sparkContext.broadcast(idf)

    def packed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keep_only()
        packer = _Packer(window, TaskContext.get().partitionId() << 33)
        held: list[tuple[int, bytes]] = []
        size = 0

        def shown(rows: list[tuple]) -> Iterator[pd.DataFrame]:
            for at in range(0, len(rows), _ROWS):
                frame = pd.DataFrame(rows[at : at + _ROWS], columns=_COLUMNS)
                if summary:
                    frame["summary"] = [summary(ids) for ids in frame.pop("ids")]
                yield frame

        def shard_rows() -> list[tuple]:
            index = Shard([np.frombuffer(ids, dtype=_DTYPE) for _, ids in held], shared.value, mean_length)
            rows, ranked = [], None
            while (document := index.first()) is not None:
                if packer.fill and ranked:
                    document = ranked.pop()
                    if not index.unused[document]:
                        continue
                index.take(document)
                opens, window_before = not packer.fill or ranked is None, packer.sequence
                rows.extend(packer.add(*held[document]))
                if packer.fill and (opens or packer.sequence != window_before):
                    ranked = index.neighbours(document)[::-1]  # it is the first of the open window: its seed
            return rows

        for frame in frames:
            for doc_id, ids in zip(frame["doc_id"], frame["ids"], strict=True):
                held.append((doc_id, ids))
                size += len(ids) // _WIDTH
                if len(held) >= SHARD_DOCS or size >= SHARD_IDS:
                    rows, held, size = shard_rows(), [], 0
                    yield from shown(rows)
                    del rows
            del frame  # before the next one is read
        yield from shown((shard_rows() if held else []) + packer.rest())
        held = []
        give_back()

    ordered = (
        tokenized.where("ids is not null").select("key", "doc_id", "ids")
        .repartitionByRange("key", "doc_id").sortWithinPartitions("key", "doc_id", "ids")
    )
    pieces = ordered.mapInPandas(
        packed,
        "doc_id bigint, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, offset bigint, "
        + ("summary bigint" if summary else "ids binary"),
    )
    return pieces.withColumn("doc_id", id_or_null("doc_id"))
