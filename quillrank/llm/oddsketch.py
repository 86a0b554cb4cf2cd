"""Near copies by MinHash, with odd sketches deciding which candidates are worth an exact check.

A text is the set of its five-word shingles. 128 MinHash samples of the set make 32 bands of four, whose equal
values make candidates; folded into a bitmap of parities, the samples make the odd sketch. The number
of bits in which two sketches differ tells how many samples differ, most precisely where sets are nearly
equal, so it drops nearly all candidates that are not. What is left is confirmed on the full sets.

Pairs are never formed within a band bucket. Every member first meets one member, the centre, which joins
nearly all of a group of copies. Buckets that still hold several components then compare what is not in
their largest component with all members, in blocks of bounded size, inside the task.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillrank.llm.graph import components
from quillrank.llm.ids import NO_ID, id_or_mark, id_or_null
from quillrank.llm.words import mixed, set_key, shingles, similar
from quillrank.llm.worker import give_back, keep_only
from quillrank.storage import Scratch, broadcast_if_small

SAMPLES, ROWS = 128, 4  # a pair at similarity 0.8 shares none of the 32 bands with a chance of 5e-8
BITS = 512  # of an odd sketch
SPREAD = 5  # standard deviations of the sketch distance that a linked pair may be off
BLOCK = 512  # members of a bucket that are compared at a time
_CHUNK = 4096  # shingles sampled at a time
_ROWS_AT_ONCE = 2_000  # what a task compares in one go, unless one unit has more
_NEEDED_ROWS, _NEEDED_BYTES = 1_000_000, 16 << 20

_MULTIPLIERS = np.random.default_rng(10).integers(0, 1 << 31, SAMPLES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def minima(hashes: np.ndarray) -> np.ndarray:
    """The MinHash samples of a set of 64-bit hashes, whose upper halves are permuted by odd factors."""
    upper = (hashes >> np.uint64(32)).astype(np.uint32)
    least = np.full(SAMPLES, np.iinfo(np.uint32).max, dtype=np.uint32)
    for at in range(0, len(upper), _CHUNK):
        np.minimum(least, (_MULTIPLIERS[:, None] * upper[None, at : at + _CHUNK]).min(axis=1), out=least)
    return least


def odd_sketch(samples: np.ndarray) -> bytes:
    """Bit i is the parity of the samples that fall on i."""
    places = mixed(samples.astype(np.uint64) | (np.arange(SAMPLES, dtype=np.uint64) << np.uint64(32))) % np.uint64(BITS)
    return np.packbits(np.bincount(places.astype(np.int64), minlength=BITS) & 1).tobytes()


def band_keys(samples: np.ndarray) -> np.ndarray:
    rows = samples.reshape(-1, ROWS).astype(np.uint64)
    keys = np.arange(1, len(rows) + 1, dtype=np.uint64)
    for i in range(ROWS):
        keys = mixed(keys ^ rows[:, i])
    return keys.view(np.int64)


def most_bits(percent: int) -> int:
    """Bits in which the sketches of a pair of the least similarity differ, and ``SPREAD`` deviations more."""
    unlike = 1 - percent / 100
    samples = SAMPLES * unlike
    flips = 2 * samples
    expected = BITS / 2 * (1 - (1 - 2 / BITS) ** flips)
    lost = flips**2 / (2 * BITS)
    variance = 4 * SAMPLES * unlike * (1 - unlike) + 4 * lost
    return int(np.ceil(expected + SPREAD * variance**0.5))


def _sketches(column) -> np.ndarray:
    return np.frombuffer(b"".join(column), dtype=np.uint64).reshape(-1, BITS // 64)


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).sum(axis=-1, dtype=np.int64)


def described(documents: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, key, sketch, bands): key names the shingle set; without words or id, key and the rest are null."""

    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keep_only("word_tables")
        for frame in frames:
            found, text = [], None
            for doc_id, text in zip(frame["doc_id"], frame["text"], strict=True):
                own = shingles(text)
                if len(own) and doc_id != NO_ID:
                    samples = minima(own)
                    found.append((doc_id, len(own), set_key(own), odd_sketch(samples), band_keys(samples)))
                else:
                    found.append((doc_id, len(own), None, None, None))
            del frame, text  # before the next one is read
            yield pd.DataFrame(found, columns=["doc_id", "n_shingles", "key", "sketch", "bands"])
        give_back()

    return documents.select(id_or_mark("doc_id"), "text").mapInPandas(
        rows, "doc_id bigint, n_shingles bigint, key binary, sketch binary, bands array<bigint>"
    )


def _whole_texts(documents: DataFrame, ids: DataFrame, keys: DataFrame) -> DataFrame:
    """(key, text): a text for each of ``keys``, taken from the rows whose doc_id is among ``ids``."""
    needed = broadcast_if_small(ids, F.lit(16), _NEEDED_ROWS, _NEEDED_BYTES)

    @F.pandas_udf(T.BinaryType())
    def named(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        keep_only("word_tables")
        for texts in batches:
            yield texts.map(lambda text: set_key(shingles(text)))
            del texts
        give_back()

    # Else the planner asks for keys that are not null before the first join: of every document, by a second worker in each task.
    named = named.asNondeterministic()
    rows = documents.select("doc_id", "text").join(needed, "doc_id", "left_semi")
    texts = rows.select(named("text").alias("key"), "text").join(keys, "key", "left_semi")
    return texts.groupBy("key").agg(F.min("text").alias("text"))


def _agree(percent: int):
    @F.pandas_udf(T.BooleanType())
    def agree(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        keep_only("word_tables")
        for a, b in batches:
            yield pd.Series([similar(shingles(x), shingles(y), percent) for x, y in zip(a, b, strict=True)], dtype=bool)
            del a, b
        give_back()

    return agree


def _close(percent: int):
    @F.pandas_udf(T.BooleanType())
    def close(a: pd.Series, b: pd.Series) -> pd.Series:
        if not len(a):
            return pd.Series([], dtype=bool)
        return pd.Series(_distance(_sketches(a), _sketches(b)) <= limit)

    limit = most_bits(percent)
    return close


def _whole_units(frames: Iterator[pd.DataFrame], names: list[str]) -> Iterator[pd.DataFrame]:
    """Rows sorted by ``names`` in frames that cut no unit, numbered in column ``unit``."""
    held: list[pd.DataFrame] = []
    for frame in _with_end(frames):
        if frame is not None and not len(frame):
            continue
        if held and (frame is None or sum(map(len, held)) >= _ROWS_AT_ONCE):
            rows = pd.concat(held, ignore_index=True)
            units = rows.groupby(names, sort=False).ngroup().to_numpy()
            cut = len(rows) if frame is None else int(np.searchsorted(units, units[-1]))
            if cut:
                yield rows[:cut].assign(unit=units[:cut])
            held = [rows[cut:]] if cut < len(rows) else []
        if frame is not None:
            held.append(frame)


def _with_end(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame | None]:
    yield from frames
    yield None


def _new_links(rows: pd.DataFrame, limit: int, percent: int) -> list[tuple[bytes, bytes]]:
    """Pairs of keys of a unit, a minor row and another, that are similar and join two components."""
    minor = rows["minor"].to_numpy()
    labels = pd.factorize(rows["label"])[0]
    parent = np.arange(labels.max() + 1)

    def find(label: int) -> int:
        while parent[label] != label:
            parent[label] = parent[parent[label]]
            label = parent[label]
        return label

    sketches, sizes = _sketches(rows["sketch"]), rows["n_shingles"].to_numpy()
    keys, sets = rows["key"].to_numpy(), rows["set"].to_numpy()
    others = np.flatnonzero(~minor)
    close = []
    for i in np.flatnonzero(minor):
        sized = np.minimum(sizes[i], sizes[others]) * 100 >= np.maximum(sizes[i], sizes[others]) * percent
        js = others[sized & (labels[others] != labels[i])]
        distance = _distance(sketches[i][None, :], sketches[js])
        near = distance <= limit
        close.append(np.stack([distance[near], np.full(near.sum(), i), js[near]], axis=1))
    links = []
    if not close:
        return links
    pairs = np.concatenate(close)
    for _, i, j in pairs[np.argsort(pairs[:, 0], kind="stable")].tolist():
        a, b = find(labels[i]), find(labels[j])
        if a != b and similar(np.frombuffer(sets[i], np.uint64), np.frombuffer(sets[j], np.uint64), percent):
            parent[max(a, b)] = min(a, b)
            links.append((keys[i], keys[j]))
    return links


class _Finder:
    """The steps of one search, on tables in scratch."""

    def __init__(self, documents: DataFrame, percent: int, scratch: Scratch):
        self._documents, self._percent, self._scratch = documents, percent, scratch
        self.rows = scratch.stored(described(documents))
        first = F.min(F.struct("doc_id", "n_shingles", "sketch", "bands")).alias("first")
        self.sets = scratch.stored(
            self.rows.where("key is not null").groupBy("key").agg(first).select("key", "first.*")
        )

    def _sized(self, a: str, b: str) -> Column:
        """Sets whose sizes differ more cannot be similar enough."""
        return F.least(a, b) * 100 >= F.greatest(a, b) * self._percent

    def _texts_of(self, keys: DataFrame) -> DataFrame:
        keys = self._scratch.stored(keys)
        ids = self._scratch.stored(self.sets.select("key", "doc_id").join(keys, "key").select("doc_id").distinct())
        return self._scratch.stored(_whole_texts(self._documents, ids, keys))

    def confirmed(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) of keys whose full sets are similar enough."""
        pairs = self._scratch.stored(pairs)
        texts = self._texts_of(
            pairs.select(F.col("a").alias("key")).union(pairs.select(F.col("b").alias("key"))).distinct()
        )
        both = pairs.join(texts.toDF("a", "a_text"), "a").join(texts.toDF("b", "b_text"), "b")
        return self._scratch.stored(both.where(_agree(self._percent)("a_text", "b_text")).select("a", "b"))

    def shared_buckets(self) -> DataFrame:
        """(band, key, centre): the members of all bands that two sets or more share."""
        members = self.sets.select("key", F.explode("bands").alias("band"))
        centres = members.groupBy("band").agg(F.count("*").alias("n"), F.min("key").alias("centre")).where("n > 1")
        return self._scratch.stored(members.join(centres.select("band", "centre"), "band"))

    def star_pairs(self, shared: DataFrame) -> DataFrame:
        pairs = shared.where("key <> centre").select(F.col("key").alias("a"), F.col("centre").alias("b")).distinct()
        own = self.sets.select("key", "n_shingles", "sketch")
        near = pairs.join(own.toDF("a", "a_n", "a_sketch"), "a").join(own.toDF("b", "b_n", "b_sketch"), "b")
        near = near.where(self._sized("a_n", "b_n"))
        return near.where(_close(self._percent)("a_sketch", "b_sketch")).select("a", "b")

    def open_links(self, shared: DataFrame, labels: DataFrame) -> DataFrame | None:
        """Links between different components of a bucket, enough to join what belongs together; None if no bucket has several.

        Centres are left out, they have met every member; buckets of the same members are looked at once. Close
        sketches are confirmed on the full sets inside the task, closest first, unless earlier links of the
        block already joined the two components. So a task sends fewer links than it has rows, however many pairs are close.
        """
        members = shared.where("key <> centre").select("band", "key")
        members = members.join(labels.toDF("key", "label"), "key", "left").withColumn("label", F.coalesce("label", "key"))
        own = F.xxhash64("key").cast("decimal(20,0)")
        parts = members.groupBy("band", "label").agg(F.count("*").alias("part"), F.sum(own).alias("name"))
        several = (
            parts.groupBy("band").agg(
                F.sum("part").alias("n"), F.max("part").alias("largest"), F.max_by("label", "part").alias("major"),
                F.count("*").alias("parts"), F.sum("name").alias("name"),
            )
            .where("parts > 1").groupBy("n", "parts", "name").agg(F.min(F.struct("band", "largest", "major")).alias("one"))
        )
        several = self._scratch.stored(several.select("n", "one.*"))
        if several.isEmpty():
            return None
        blocks = lambda count: F.ceil(count / F.lit(BLOCK)).cast("int")
        numbered = (
            members.join(several, "band")
            .withColumn("all_blocks", blocks(F.col("n")))
            .withColumn("minor_blocks", blocks(F.col("n") - F.col("largest")))
        )
        numbered = self._scratch.stored(numbered)
        texts = self._texts_of(numbered.select("key").distinct())

        @F.pandas_udf(T.BinaryType())
        def whole_set(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            keep_only("word_tables")
            for column in batches:
                yield column.map(lambda text: shingles(text).tobytes())
                del column
            give_back()

        sets = self.sets.select("key", "n_shingles", "sketch").join(texts.select("key", whole_set("text").alias("set")), "key")
        numbered = numbered.join(self._scratch.stored(sets), "key")
        block = lambda count: F.pmod(F.xxhash64("key"), F.col(count)).cast("int")
        every = lambda count: F.explode(F.sequence(F.lit(0), F.col(count) - 1))
        fields = ["band", "key", "label", "n_shingles", "sketch", "set"]
        minor = numbered.where("label <> major").select(
            *fields, block("minor_blocks").alias("i"), every("all_blocks").alias("j"), F.lit(True).alias("minor")
        )
        others = numbered.select(
            *fields, every("minor_blocks").alias("i"), block("all_blocks").alias("j"), F.lit(False).alias("minor")
        )
        limit, percent = most_bits(self._percent), self._percent

        def compared(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for units in _whole_units(frames, ["band", "i", "j"]):
                links = []
                for _, unit in units.groupby("unit", sort=False):
                    links += _new_links(unit, limit, percent)
                del units
                yield pd.DataFrame(links, columns=["a", "b"])
            give_back()

        units = minor.unionByName(others).repartition("band", "i", "j").sortWithinPartitions("band", "i", "j")
        return self._scratch.stored(units.mapInPandas(compared, "a binary, b binary"))

    def labels(self) -> DataFrame:
        """(node, component) of all sets that are linked with another."""
        shared = self.shared_buckets()
        links = self.confirmed(self.star_pairs(shared))
        labels = components(links, self._scratch)
        more = self.open_links(shared, labels)
        if more is None or more.isEmpty():
            return labels
        return components(links.union(more), self._scratch)


def near_groups(documents: DataFrame, scratch: Scratch, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``documents`` (doc_id, text).

    Texts are linked if 100 * intersection >= percent * union of their shingle sets: five words, A-Z in lower
    case, cut at ASCII white space; fewer words are one shingle. Texts without words (null, empty, white space) are linked with
    nothing. component_id is the least doc_id that links reach; kept tells whether it is the row's own. Rows
    that repeat a doc_id count as that document. A null doc_id is linked with nothing and kept. Other columns are
    not read; no rows give no rows. The result reads from ``scratch``.
    """
    finder = _Finder(documents, percent, scratch)
    labels = finder.labels()
    named = finder.sets.select("key", "doc_id").join(labels.toDF("key", "label"), "key", "left")
    named = scratch.stored(named.select("key", "doc_id", F.coalesce("label", "key").alias("label")))
    least = named.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    by_key = named.join(least, "label").select("key", "component_id")
    found = finder.rows.select("doc_id", "n_shingles", "key").join(by_key, "key", "left")
    found = found.select(
        id_or_null("doc_id"), "n_shingles", F.coalesce("component_id", id_or_null("doc_id")).alias("component_id")
    )
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
