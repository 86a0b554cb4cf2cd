"""Exact copies by cuckoo-filter indexes, one per shard of digests.

Texts stay where they are: rows travel as sha256 digest, id and count. Every map task first folds its own
rows in an index, so a text that fills a third of the table sends one row per task. Digests are then dealt by
hash; the task of a shard holds the index of its live digests, to which rows are inserted, and merged if they hit.
"""

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillrank.llm.cuckoo import CuckooIndex
from quillrank.llm.ids import NO_ID, id_or_mark
from quillrank.llm.worker import keep_only
from quillrank.storage import broadcast_if_small, checkpointed

LIVE = 500_000  # digests a folding index may hold before it is sent on and emptied
SHARD = 250_000  # folded rows of a shard; an index of as many digests takes about 100 MB
_DROPPED_ROWS, _DROPPED_BYTES = 500_000, 64
_FIELDS = "digest binary, keep_id bigint, copies bigint"


def digest(text: str = "text"):
    """The sha256 of a text's UTF-8 bytes; null counts as empty."""
    return F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256))


def _out(index: CuckooIndex) -> pd.DataFrame:
    rows = [(key, *value) for key, value in index.items()]
    return pd.DataFrame(rows, columns=["digest", "keep_id", "copies"])


def _folded(limit: int | None):
    """A task that merges rows of equal digests; a ``limit`` lets it send on what it has, to merge later."""

    def fold(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keep_only()
        index = CuckooIndex()
        for frame in frames:
            for key, keep, copies in zip(frame["digest"], frame["keep_id"], frame["copies"], strict=True):
                key, live = bytes(key), index.get(bytes(key))
                if live is not None:
                    keep, copies = max(keep, live[0]), copies + live[1]
                index.put(key, (keep, copies))
                if limit and len(index) >= limit:
                    yield _out(index)
                    index = CuckooIndex()
        yield _out(index)

    return fold


def live_digests(documents: DataFrame) -> DataFrame:
    """(digest, keep_id, copies): one row per distinct text; keep_id is the largest doc_id that has it.

    Shards follow from the count of folded rows, ``SHARD`` each, so the memory of a task does not depend on a setting.
    """
    rows = documents.select(digest().alias("digest"), id_or_mark("doc_id").alias("keep_id"), F.lit(1).cast("bigint").alias("copies"))
    folded = checkpointed(rows.mapInPandas(_folded(LIVE), _FIELDS))
    given = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shards = max(given, -(-folded.count() // SHARD))
    return folded.repartition(shards, "digest").mapInPandas(_folded(None), _FIELDS)


def updated(live: DataFrame, inserted: DataFrame, deleted: DataFrame) -> DataFrame:
    """``live`` (digest, keep_id, copies) after rows (digest, keep_id) were deleted, then others inserted.

    For an index that lives on between batches. Deleting takes one copy of a live digest; with the last copy the
    digest leaves the index. Deletions of digests that are not live change nothing. keep_id stays the largest id
    ever inserted while the digest lived. Rows with a null digest are ignored.
    """
    counted = lambda rows, sign: (
        rows.where("digest is not null").groupBy("digest")
        .agg(F.max("keep_id").alias("keep_id"), (F.count("*") * sign).alias("copies"))
    )
    changes = (
        live.select("digest", "keep_id", "copies", F.lit(0).alias("turn"))
        .union(counted(deleted, -1).withColumn("turn", F.lit(1)))
        .union(counted(inserted, 1).withColumn("turn", F.lit(2)))
    )

    def apply(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = CuckooIndex()
        for frame in frames:
            for row in frame.itertuples():
                key, live_value = bytes(row.digest), index.get(bytes(row.digest))
                keep = NO_ID if pd.isna(row.keep_id) else int(row.keep_id)
                if row.copies > 0:
                    before = live_value or (NO_ID, 0)
                    index.put(key, (max(keep, before[0]), row.copies + before[1]))
                elif live_value is not None:
                    if live_value[1] + row.copies <= 0:
                        index.delete(key)
                    else:
                        index.put(key, (live_value[0], live_value[1] + row.copies))
        yield _out(index)

    return changes.repartition("digest").sortWithinPartitions("digest", "turn").drop("turn").mapInPandas(apply, _FIELDS)


def exact_groups(documents: DataFrame) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) for every row of ``documents`` (doc_id, text).

    Texts are equal when their UTF-8 bytes are; null counts as empty. The largest doc_id of equal texts stays;
    rows that repeat both id and text stay or go together. A null doc_id is smaller than any; if a text has
    no other, its keep_id is null and its rows stay. Other columns are not read; no rows give no rows.
    """
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), digest().alias("digest"))
    found = rows.join(live_digests(documents), "digest")
    keep = F.when(F.col("keep_id") != NO_ID, F.col("keep_id"))
    return found.select(
        "doc_id",
        keep.alias("keep_id"),
        F.col("copies").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def without_copies(documents: DataFrame) -> DataFrame:
    """``documents`` without the rows whose text a larger doc_id has too; all columns stay as they are.

    The rows to drop are told by id and digest. They are broadcast if they are few enough; else the join shuffles.
    """
    groups = exact_groups(documents)
    dropped = checkpointed(groups.where("not kept").select(
        F.col("doc_id").alias("dropped_id"), F.unhex("text_sha256").alias("dropped_digest")
    ))
    few = broadcast_if_small(dropped, F.lit(_DROPPED_BYTES), _DROPPED_ROWS, _DROPPED_ROWS * _DROPPED_BYTES)
    same = documents["doc_id"].eqNullSafe(few["dropped_id"]) & (digest() == few["dropped_digest"])
    return documents.join(few, same, "left_anti")
