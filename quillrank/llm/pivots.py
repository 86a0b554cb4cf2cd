"""Near copies of vectors by a pivot-permutation index.

Every vector is described by its nearest reference points, in order. An inverted list per pivot holds the
vectors that have it among these; vectors that share enough pivots are candidates, and their cosine is then
computed in double precision. The counts of shared pivots of a list are one product of 0/1 matrices, so no
pair leaves a task: tasks send, per vector, how many others it is linked with, and links enough to
keep every component together.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillrank.llm.graph import components
from quillrank.llm.ids import id_or_mark, id_or_null
from quillrank.storage import Scratch

NEAREST = 12  # pivots that describe a vector
SHARED = 3  # pivots that candidates share: at cosine 0.98 and 4,096 pivots less than one pair in 4,000 has fewer than four
VECTORS_A_PIVOT = 64
FEWEST_PIVOTS, MOST_PIVOTS = 64, 4096  # the index is fitted on this many distinct vectors at most, times ``_DRAWN``
_DRAWN = 2
BLOCK = 1024  # members of a list that are compared at a time
# Cosine over which two vectors are not both made pivots; the next one where too few are so far apart, as in a narrow cone.
_APART = (0.7, 0.8, 0.9, 0.95)
_PRODUCT_BYTES = 32 << 20  # of the products of vectors and pivots that are held at a time


def _described(embeddings: DataFrame) -> DataFrame:
    """(vec_id, label, dim, key, vector): key and vector are null for vectors that link with nothing."""

    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = []
            for vec_id, label, values in zip(frame["vec_id"], frame["label"], frame["embedding"], strict=True):
                vector = None if values is None or label is None else np.array(values, dtype=np.float64)
                if vector is None or not len(vector) or not np.isfinite(vector).all() or not vector.any():
                    found.append((vec_id, label, 0, None, None))
                    continue
                packed = vector.tobytes()
                name = hashlib.blake2b(f"{label}:".encode() + packed, digest_size=16).digest()
                found.append((vec_id, label, len(vector), name, packed))
            yield pd.DataFrame(found, columns=["vec_id", "label", "dim", "key", "vector"])

    label = F.col("label").cast("string").alias("label")
    return embeddings.select(id_or_mark("vec_id"), label, "embedding").mapInPandas(
        rows, "vec_id bigint, label string, dim int, key binary, vector binary"
    )


def _units(vectors) -> np.ndarray:
    stacked = np.frombuffer(b"".join(vectors), dtype=np.float64).reshape(len(vectors), -1)
    # Dividing by the largest component first keeps the squares of extreme values finite.
    stacked = stacked / np.abs(stacked).max(axis=1, keepdims=True)
    return stacked / np.linalg.norm(stacked, axis=1, keepdims=True)


def _spread_out(vectors: np.ndarray, wanted: int) -> np.ndarray:
    """Up to ``wanted`` of the vectors, as far apart as so many can be by the steps of ``_APART``."""
    nearest = np.full(len(vectors), -1.0)  # cosine with the nearest one chosen
    chosen: list[int] = []
    for apart in _APART:
        for i in range(len(vectors)):
            if len(chosen) < wanted and nearest[i] < apart:
                chosen.append(i)
                nearest = np.maximum(nearest, vectors @ vectors[i])
                nearest[i] = 1.0
    return vectors[chosen]


def fit_pivots(vectors: DataFrame) -> dict[int, np.ndarray]:
    """Reference points per dimension: vectors of a bounded sample that lie apart, filled up with random directions."""
    pivots = {}
    for row in vectors.groupBy("dim").agg(F.count("*").alias("n")).collect():
        dim = row["dim"]
        wanted = min(max(-(-row["n"] // VECTORS_A_PIVOT), FEWEST_PIVOTS), MOST_PIVOTS)
        # Keys are hashes, so the first ones are a random sample, and always the same.
        sample = vectors.where(F.col("dim") == dim).select("key", "vector").orderBy("key").limit(_DRAWN * wanted).collect()
        chosen = _spread_out(_units([r["vector"] for r in sample]), wanted)
        filled = np.random.default_rng(dim).standard_normal((wanted - len(chosen), dim))
        filled /= np.linalg.norm(filled, axis=1, keepdims=True)
        pivots[dim] = np.vstack([chosen, filled])
    return pivots


def nearest_pivots(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """The numbers of the nearest pivots of each unit vector, nearest first."""
    found, step = [], max(1, _PRODUCT_BYTES // (8 * len(pivots)))
    for at in range(0, len(vectors), step):
        away = -(vectors[at : at + step] @ pivots.T)
        some = np.argpartition(away, min(NEAREST, len(pivots)) - 1, axis=1)[:, :NEAREST]
        some.sort(axis=1)  # equal ones in their own order
        order = np.argsort(np.take_along_axis(away, some, axis=1), axis=1, kind="stable")
        found.append(np.take_along_axis(some, order, axis=1))
    return np.concatenate(found)


def _spanning(linked: np.ndarray) -> list[tuple[int, int]]:
    """Links that keep together what ``linked``, a symmetric matrix, does."""
    waiting, links = linked.any(axis=1), []
    while waiting.any():
        root = int(np.argmax(waiting))
        waiting[root] = False
        front = np.array([root])
        while len(front):
            front = np.flatnonzero(linked[front].any(axis=0) & waiting)
            waiting[front] = False
            links += [(root, int(i)) for i in front]
    return links


def _linked(a: pd.DataFrame, b: pd.DataFrame, pivot: int, pivots: int, cosine: float) -> np.ndarray:
    """Which of ``a`` are linked with which of ``b``, for pairs whose first shared pivot is this one."""

    def marked(frame: pd.DataFrame) -> np.ndarray:
        own = np.zeros((len(frame), pivots), dtype=np.float32)
        own[np.arange(len(frame))[:, None], np.frombuffer(b"".join(frame["nearest"]), dtype=np.int32).reshape(len(frame), -1)] = 1
        return own

    a_pivots, b_pivots = marked(a), marked(b)
    candidates = (a_pivots @ b_pivots.T >= min(SHARED, pivots)) & (a_pivots[:, :pivot] @ b_pivots[:, :pivot].T == 0)
    rows, columns = np.nonzero(candidates)
    found = np.zeros_like(candidates)
    if not len(rows):
        return found
    a_units, b_units = _units(a["vector"]), _units(b["vector"])
    for at in range(0, len(rows), 1 << 16):
        i, j = rows[at : at + (1 << 16)], columns[at : at + (1 << 16)]
        found[i, j] = np.einsum("ij,ij->i", a_units[i], b_units[j]) >= cosine
    return found


def nearest_links(embeddings: DataFrame, scratch: Scratch, cosine: float = 0.98) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``embeddings`` (vec_id, embedding, label).

    Two rows are linked if their labels are equal and not null, their vectors have one dimension, and the
    cosine in double precision is at least ``cosine``. Null, empty and zero vectors, and those with null, NaN or infinite
    components, link with nothing. Equal vectors of a label are one node with a count, so copies cost
    nothing, and they are linked. n_links counts other rows linked directly, component_id is the least
    vec_id that links reach, kept tells whether it is the row's own. Rows that repeat a vec_id are rows of their own. A
    null vec_id stays null and is larger than any in a component; alone it has a null component and is
    kept. Other columns are not read; no rows give no rows. The result reads from ``scratch``.

    Lists of over ``BLOCK`` members are compared block by block in tasks of their own, so none is too long.
    """
    rows = scratch.stored(_described(embeddings))
    nodes = scratch.stored(
        rows.where("key is not null").groupBy("key").agg(
            F.first("label").alias("label"), F.first("dim").alias("dim"), F.first("vector").alias("vector"),
            F.min(id_or_null("vec_id")).alias("least_id"), F.count("*").alias("copies"),
        )
    )
    pivots = fit_pivots(nodes)
    shared = embeddings.sparkSession.sparkContext.broadcast(pivots)

    def entries(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for dim, part in frame.groupby("dim"):
                nearest = nearest_pivots(_units(part["vector"]), shared.value[dim]).astype(np.int32)
                yield part.assign(nearest=[row.tobytes() for row in nearest], pivots=nearest.tolist())

    described = scratch.stored(nodes.select("key", "label", "dim", "vector", "copies").mapInPandas(
        entries, "key binary, label string, dim int, vector binary, copies bigint, nearest binary, pivots array<int>"
    ))
    home = ["label", "dim", "pivot"]
    lists = described.select("*", F.explode("pivots").alias("pivot")).drop("pivots")
    sizes = lists.groupBy(home).agg(F.count("*").alias("n")).where("n > 1")
    sizes = scratch.stored(sizes.withColumn("blocks", F.ceil(F.col("n") / F.lit(BLOCK)).cast("int")))
    # Block x meets block y in the unit (min, max): a member of block x goes to the units of x with all y.
    placed = lists.join(sizes.drop("n"), home).withColumn("block", F.pmod(F.xxhash64("key"), "blocks").cast("int"))
    units = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        *home, "key", "vector", "copies", "nearest", "block",
        F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
    )

    def compared(name: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        _, dim, pivot, i, j = name
        a, b = frame[frame["block"] == i], frame[frame["block"] == j]
        linked = _linked(a, b, pivot, len(shared.value[dim]), cosine)
        if i == j:
            np.fill_diagonal(linked, False)
            counts = [(a, linked @ b["copies"].to_numpy())]
            whole, both = linked, a
        else:
            counts = [(a, linked @ b["copies"].to_numpy()), (b, linked.T @ a["copies"].to_numpy())]
            whole = np.block([[np.zeros((len(a), len(a)), bool), linked], [linked.T, np.zeros((len(b), len(b)), bool)]])
            both = pd.concat([a, b])
        keys = both["key"].to_numpy()
        out = [pd.DataFrame({"a": part["key"], "b": None, "n": n})[n > 0] for part, n in counts]
        links = [(keys[x], keys[y], 0) for x, y in _spanning(whole)]
        return pd.concat([*out, pd.DataFrame(links, columns=["a", "b", "n"])])

    found = scratch.stored(
        units.groupBy(*home, "i", "j").applyInPandas(compared, "a binary, b binary, n bigint")
    )
    labels = components(found.where("b is not null").select("a", "b"), scratch)
    direct = found.where("b is null").groupBy("a").agg(F.sum("n").alias("direct")).withColumnRenamed("a", "key")
    named = nodes.select("key", "least_id", "copies").join(labels.toDF("key", "component"), "key", "left")
    named = named.join(direct, "key", "left").withColumn("component", F.coalesce("component", "key"))
    least = named.groupBy("component").agg(F.min("least_id").alias("component_id"))
    by_key = named.join(least, "component").select(
        "key", "component_id", (F.coalesce("direct", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    )
    result = rows.select(id_or_null("vec_id"), "key").join(by_key, "key", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.when(F.col("key").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"),
    )
    return result.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
