"""Hard negatives by exact integer scores: many inner products at once as products of wide integers.

Components become whole numbers. A block of candidates is packed per component into one wide integer, a field per candidate,
after a bias that makes every number positive. An anchor multiplies each of these integers once by its own biased component and adds the
products up: every field then holds the inner product of the anchor with one candidate, and no field runs over, because its width follows from the
largest numbers of both blocks. Taking the biases off again gives exact scores. Anchors meet all candidates block by block; only the best of
a block leave its task.
"""

import operator
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillrank.llm.ids import NO_ID, id_or_null
from quillrank.storage import Scratch

SCALE = 256
CANDIDATES = 4096  # rows of a block
ANCHORS = 256
_LONG = (1 << 63) - 1
_FAST = 1 << 45  # components below this size are whole after scaling, and in 64 bits


def quantised(vectors: list[bytes]) -> np.ndarray:
    """floor(256 x) of every component, a line per vector: in 64 bits, or as Python integers if they do not fit."""
    x = np.frombuffer(b"".join(vectors), dtype=np.float64).reshape(len(vectors), -1 if any(vectors) else 0)
    if not x.size or np.abs(x).max() < _FAST:
        return np.floor(x * SCALE).astype(np.int64)
    # So large a component is a whole number or gets one by the scaling.
    exact = [[int(v) * SCALE if abs(v) >= 1 << 53 else int(np.floor(v * SCALE)) for v in row] for row in x]
    return np.array(exact, dtype=object)


@dataclass
class Packed:
    """A block of candidates: per component one integer whose fields of ``width`` bits are the biased candidates."""

    wholes: list[int]
    width: int
    biases: list[int]
    sums: list[int]  # per candidate, of its biased components
    rows: int


def _bits(largest: int) -> int:
    """The field width that holds numbers up to ``largest``: 32, or a multiple of 64."""
    return 32 if largest < 1 << 32 else -(-largest.bit_length() // 64) * 64


def pack(candidates: np.ndarray, width: int) -> Packed:
    """``candidates`` has a line per candidate; ``width`` is that of the sums to come."""
    biases = [int(b) for b in candidates.min(axis=0)]
    biased = candidates - candidates.min(axis=0)
    size = width // 8
    wholes = []
    for column in biased.T:
        if width <= 64:
            packed = column.astype(f"<u{size}").tobytes()
        else:
            packed = b"".join(int(v).to_bytes(size, "little") for v in column)
        wholes.append(int.from_bytes(packed, "little"))
    return Packed(wholes, width, biases, biased.sum(axis=1), len(candidates))


def _unpacked(whole: int, width: int, rows: int) -> np.ndarray:
    data = whole.to_bytes(rows * width // 8, "little")
    if width <= 64:
        return np.frombuffer(data, dtype=f"<u{width // 8}")
    size = width // 8
    return np.array([int.from_bytes(data[at : at + size], "little") for at in range(0, len(data), size)], dtype=object)


def scores(anchors: np.ndarray, candidates: np.ndarray) -> Iterator[np.ndarray]:
    """For each anchor the inner products with all candidates: in 64 bits, or as Python integers if the numbers are large."""
    if not anchors.size or not candidates.size:
        yield from (np.zeros(len(candidates), dtype=np.int64) for _ in anchors)
        return
    low = int(anchors.min())
    largest = (int(anchors.max()) - low) * (int(candidates.max()) - int(candidates.min())) * candidates.shape[1]
    # Room for twice as much and a sign, so that biases come off in the same numbers.
    signed = 4 * candidates.shape[1] * int(max(abs(anchors).max(), 1)) * int(max(abs(candidates).max(), 1))
    block = pack(candidates, _bits(largest))
    numbers = np.int64 if block.width <= 64 and signed < _LONG else object
    sums = np.asarray(block.sums).astype(numbers)
    for anchor in anchors:
        own = [int(v) for v in anchor]
        whole = sum(map(operator.mul, (v - low for v in own), block.wholes))
        fields = _unpacked(whole, block.width, block.rows)
        # (v - low) (c - bias) summed, plus low (c - bias) summed, plus v bias summed, is v c summed.
        yield fields.astype(numbers) + low * sums + sum(map(operator.mul, own, block.biases))


def usable_rows(embeddings: DataFrame) -> DataFrame:
    """(row, vec_id, label, dim, vector) of the rows with a label and a vector of finite components only.

    A null vec_id becomes the mark of ``ids``; ``vector`` holds the components as doubles.
    """

    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = []
            for vec_id, label, values in zip(frame["vec_id"], frame["label"], frame["embedding"], strict=True):
                vector = np.array(values, dtype=np.float64)  # null components become NaN
                if np.isfinite(vector).all():
                    found.append((vec_id, label, len(vector), vector.tobytes()))
            yield pd.DataFrame(found, columns=["vec_id", "label", "dim", "vector"])

    given = embeddings.where("label is not null and embedding is not null").select(
        F.coalesce(F.col("vec_id").cast("bigint"), F.lit(NO_ID)).alias("vec_id"),
        F.col("label").cast("bigint").alias("label"), "embedding",
    )
    return given.mapInPandas(rows, "vec_id bigint, label bigint, dim int, vector binary").withColumn(
        "row", F.monotonically_increasing_id()
    )


def _in_blocks(rows: DataFrame, keys: list[str], block_rows: int, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """``rows`` with ``block``, about ``block_rows`` of them in each block of their keys; and the blocks of each key."""
    sizes = scratch.stored(
        rows.groupBy(keys).agg(F.ceil(F.count("*") / F.lit(block_rows)).cast("int").alias("blocks"))
    )
    return rows.join(sizes, keys).withColumn("block", F.pmod(F.xxhash64("row"), "blocks").cast("int")).drop("blocks"), sizes


def _units(anchors: DataFrame, candidates: DataFrame, keys: list[str], scratch: Scratch) -> DataFrame:
    """Anchors and candidates of equal keys, a unit (i, j) for each block of anchors and block of candidates."""
    anchors, anchor_blocks = _in_blocks(anchors, keys, ANCHORS, scratch)
    candidates, candidate_blocks = _in_blocks(candidates, keys, CANDIDATES, scratch)
    columns = [*keys, "i", "j", "asks", "row", "vec_id", *[c for c in ("label",) if c not in keys], "vector", "wanted"]

    def to_all(rows: DataFrame, others: DataFrame, own: str, other: str) -> DataFrame:
        met = rows.join(others, keys).withColumn(other, F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        return met.withColumnRenamed("block", own)

    return to_all(anchors.withColumn("asks", F.lit(True)), candidate_blocks, "i", "j").select(columns).union(
        to_all(candidates.withColumns({"asks": F.lit(False), "wanted": F.lit(None)}), anchor_blocks, "j", "i").select(columns)
    )


def _sides(frame: pd.DataFrame) -> tuple[pd.DataFrame, pd.DataFrame]:
    """Anchors, and candidates by (vec_id, row); the mark of a null id goes last."""
    asks = frame["asks"].to_numpy()
    candidates = frame[~asks]
    marks = candidates["vec_id"].to_numpy() == NO_ID
    return frame[asks], candidates.iloc[np.lexsort((candidates["row"], candidates["vec_id"], marks))]


def _first(rows: DataFrame, groups: list[str], count: int, ident: str) -> DataFrame:
    """The best ``count`` rows per group: scores descending, then ids ascending, null ids last."""
    order = Window.partitionBy(groups).orderBy(F.desc("score"), F.col(ident) == NO_ID, ident, "row")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)


def hard_negatives(
    embeddings: DataFrame,
    is_anchor: Column | str,
    scratch: Scratch,
    positives: int = 5,
    negatives: int = 10,
    band: tuple[int, int] = (30, 90),
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of ``embeddings`` (vec_id, label, embedding).

    A score is the inner product of the vectors, their components times 256 and cut down to whole numbers, exact. Anchors are the
    rows where ``is_anchor`` holds, an expression over vec_id; its positives the first ``positives`` other rows of its label, its negatives
    for a positive the first ``negatives`` rows of other labels whose score is ``band`` percent of the positive's, both ends
    included. Higher scores come first, equal ones by vec_id, null last. Rows without label or vector, or with a null or
    non-finite component, take no part. Vectors meet those of their own dimension only; empty ones score 0. Rows that repeat a vec_id are rows of
    their own, so an anchor may have its copy as positive. Scores over 64 bits raise an error. Other columns are not read; no rows give no rows.
    The result reads from ``scratch``.
    """
    rows = scratch.stored(usable_rows(embeddings))
    anchors = rows.where(is_anchor)

    def near(_: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        asking, others = _sides(frame)
        found = []
        ids, numbers = others["vec_id"].to_numpy(), others["row"].to_numpy()
        for row, own in zip(asking["row"], scores(quantised(list(asking["vector"])), quantised(list(others["vector"]))), strict=True):
            order = np.argsort(-own, kind="stable")[: positives + 1]
            order = order[numbers[order] != row][:positives]
            found += [(row, ids[k], numbers[k], _in_long(own[k])) for k in order]
        return pd.DataFrame(found, columns=["anchor", "positive_id", "row", "score"])

    same = _units(anchors.withColumn("wanted", F.lit(None).cast("array<bigint>")), rows, ["dim", "label"], scratch)
    nearest = same.groupBy("dim", "label", "i", "j").applyInPandas(near, "anchor bigint, positive_id bigint, row bigint, score bigint")
    best = scratch.stored(
        _first(nearest, ["anchor"], positives, "positive_id").select("anchor", "positive_id", F.col("score").alias("positive_score"), F.col("rank").alias("at"))
    )
    wanted = best.groupBy("anchor").agg(F.collect_set("positive_score").alias("wanted"))  # at most ``positives`` of them
    asking = anchors.join(wanted.withColumnRenamed("anchor", "row"), "row")
    least, most = band

    def apart(_: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        asking, others = _sides(frame)
        found = []
        ids, numbers, labels = (others[c].to_numpy() for c in ("vec_id", "row", "label"))
        lines = zip(asking["row"], asking["label"], asking["wanted"], scores(quantised(list(asking["vector"])), quantised(list(others["vector"]))), strict=True)
        for row, label, positive_scores, own in lines:
            order = np.argsort(-own, kind="stable")
            order = order[labels[order] != label]
            falling = -own[order]
            for positive in map(int, positive_scores):
                high, low = most * positive // 100, -(-least * positive // 100)
                start = np.searchsorted(falling, -high)
                end = np.searchsorted(falling, -low, side="right")
                found += [(row, positive, ids[k], numbers[k], _in_long(own[k])) for k in order[start : min(end, start + negatives)]]
        return pd.DataFrame(found, columns=["anchor", "positive_score", "negative_id", "row", "score"])

    different = _units(asking, rows, ["dim"], scratch)
    far = different.groupBy("dim", "i", "j").applyInPandas(
        apart, "anchor bigint, positive_score bigint, negative_id bigint, row bigint, score bigint"
    )
    chosen = _first(far, ["anchor", "positive_score"], negatives, "negative_id").select(
        "anchor", "positive_score", "rank", "negative_id", F.col("score").alias("negative_score")
    )
    named = anchors.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    return best.join(chosen, ["anchor", "positive_score"]).join(named, "anchor").select(
        "anchor_id", id_or_null("positive_id"), "rank", id_or_null("negative_id"), "positive_score", "negative_score"
    )


def _in_long(score) -> int:
    score = int(score)
    if not -_LONG <= score <= _LONG:
        raise ValueError("a score does not fit in 64 bits")
    return score
