"""Token files: flat unsigned ids plus 64-bit document offsets, made to be memory-mapped.

A store is a folder of slices. Slice ``s`` has one file in each of

- ``kind=ids/slice=s``: the ids of its documents, one after the other, each ending with the end id,
  as little-endian unsigned integers of 16 or 32 bits (16 if vocabulary and end id allow it);
- ``kind=offsets/slice=s``: little-endian 64-bit integers, where each of its documents starts,
  counted in ids from the start of the slice, and where the last one ends;
- ``kind=docs/slice=s``: little-endian 64-bit doc ids, in ascending order, and a closing zero.

Slices follow one another in the order of their names. ``bases`` tells how many ids the slices
before each slice hold: prefix sums over slices, so global starts are base plus offset.

Spark's own writer makes the files: one row is one file, whose last byte is the line separator, so
they are committed like any output, survive lost executors and go to any file system Spark knows.
"""

from collections.abc import Callable, Iterator
from urllib.parse import urlparse

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillrank.llm.encoding import BYTE_BPE, byte_encoder
from quillrank.llm.ids import id_or_mark, id_or_null
from quillrank.llm.worker import give_back, keep_only

SLICE_IDS = 4 << 20  # ids after which a file ends, at the next end of a document
_DOCS_A_ROW = 20_000


def id_width(vocabulary_size: int, end_id: int) -> int:
    """Bytes of an id: two if every id fits and the end id leaves the last byte of a file zero."""
    return 2 if vocabulary_size <= 1 << 16 and end_id < 256 else 4


def write_tokens(
    documents: DataFrame, folder: str, end_id: int, vocabulary: str = BYTE_BPE, width: int = 2, slice_ids: int = SLICE_IDS
) -> None:
    """Write ``documents`` (doc_id, text) as a store at ``folder``, in ascending doc_id order.

    One shuffle, by ranges of doc_id; each task then encodes its documents in order and ends a file
    every ``slice_ids`` ids, so a task holds one file, and the documents that are in it. A null text
    is empty: the document is its end id alone. Rows with a null doc_id come first, with the
    least 64-bit number as id; rows that share a doc_id are documents of their own, in the order of their texts. Other
    columns are not read. No documents give an empty store.
    """
    last_byte = end_id.to_bytes(width, "little")[-1:]
    if last_byte != b"\0":
        raise ValueError(f"end id {end_id} needs wider ids than {width} bytes")
    numbered = documents.select(id_or_mark("doc_id"), "text")
    ordered = numbered.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")

    def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_only("encoder", "tokenizer")
        encoder = byte_encoder(vocabulary, width)
        end = end_id.to_bytes(width, "little")
        part, number = TaskContext.get().partitionId(), 0
        ids, lengths, docs, held = [], [], [], 0

        def flushed() -> pa.RecordBatch:
            offsets = np.concatenate(([0], np.cumsum(lengths))).astype("<i8")
            files = {"ids": b"".join(ids), "offsets": offsets.tobytes(), "docs": np.array([*docs, 0], dtype="<i8").tobytes()}
            name = f"p{part:07d}n{number:06d}"
            return pa.RecordBatch.from_pylist([{"kind": kind, "slice": name, "content": content[:-1]} for kind, content in files.items()])

        for batch in batches:
            doc_ids = iter(batch["doc_id"].to_pylist())
            for encoded in encoder.batches(batch["text"]):
                for tokens in encoded:
                    tokens += end
                    ids.append(tokens)
                    lengths.append(len(tokens) // width)
                    docs.append(next(doc_ids))
                    held += lengths[-1]
                    if held >= slice_ids:
                        yield flushed()
                        ids, lengths, docs, held, number = [], [], [], 0, number + 1
        if docs:
            yield flushed()
        del ids, docs, lengths
        give_back()

    files = ordered.mapInArrow(slices, "kind string, slice string, content binary")
    (
        files.select("kind", "slice", F.col("content").cast("string").alias("value"))
        .write.partitionBy("kind", "slice")
        .option("lineSep", "\0")
        .text(folder)
    )


def _files(spark: SparkSession, folder: str, kind: str) -> DataFrame:
    """(slice, path, length) of all files of a kind; nothing is read. A store without files has none."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/kind={kind}")
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], "slice string, path string, length bigint, content binary")
    found = spark.read.format("binaryFile").load(f"{folder}/kind={kind}")
    return found.select(F.regexp_extract("path", "slice=([^/]+)/", 1).alias("slice"), "path", "length", "content")


def bases(spark: SparkSession, folder: str, width: int = 2) -> DataFrame:
    """(slice, path, n_ids, base): ids in the files before each file, from file lengths alone.

    The window holds one narrow row per file, not per document.
    """
    sizes = _files(spark, folder, "ids").select("slice", "path", (F.col("length") / width).cast("bigint").alias("n_ids"))
    before = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def read_tokens(
    spark: SparkSession, folder: str, width: int = 2, summary: Callable[[np.ndarray], int] | None = None
) -> DataFrame:
    """The documents of a store: (doc_id, start, n_tokens, ids, summary), ids packed as in the file.

    With ``summary``, a function of a document's ids, its result comes instead of the ids, which are then null. One
    row per file goes to the tasks, with its small index; the ids are memory-mapped if the store is
    on a shared mount (``file:``), else they come through Spark's reader.
    """
    mounted = urlparse(folder).scheme in ("", "file")
    index = _files(spark, folder, "offsets").select("slice", F.col("content").alias("offsets")).join(
        _files(spark, folder, "docs").select("slice", F.col("content").alias("docs")), "slice"
    )
    files = bases(spark, folder, width).join(index, "slice")
    if mounted:
        files = files.withColumn("content", F.lit(None).cast("binary"))
    else:
        files = files.join(_files(spark, folder, "ids").select("slice", "content"), "slice")
    files = files.repartition("slice")

    def documents(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples():
                if row.content is None:
                    ids = np.memmap(urlparse(row.path).path, dtype=f"<u{width}", mode="r")
                else:
                    ids = np.frombuffer(row.content, dtype=f"<u{width}")
                offsets = np.frombuffer(row.offsets, dtype="<i8")
                docs = np.frombuffer(row.docs, dtype="<i8")[:-1]
                for at in range(0, len(docs), _DOCS_A_ROW):
                    cuts = offsets[at : at + _DOCS_A_ROW + 1]
                    parts = [ids[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
                    yield pd.DataFrame({
                        "doc_id": docs[at : at + _DOCS_A_ROW],
                        "start": row.base + cuts[:-1],
                        "n_tokens": np.diff(cuts),
                        "ids": None if summary else [p.tobytes() for p in parts],
                        "summary": [summary(p) for p in parts] if summary else None,
                    })

    read = files.mapInPandas(documents, "doc_id bigint, start bigint, n_tokens bigint, ids binary, summary bigint")
    return read.withColumn("doc_id", id_or_null("doc_id"))
