"""How far the sources of a language differ in their terms, by a K-squared quadtree over the counts of groups and terms.

The matrix has a row per group (language and source) and a column per kept term, and is cut into blocks of terms, and of groups
if a language has many. A task holds one block as a quadtree: bits per level that tell which quadrants hold any count. Pairs of
groups walk the tree together: where both quadrants are all zero, each cell differs by the same, known from the groups' totals alone,
so nothing is visited and nothing sent; cells where at least one has a count are priced one by one.
"""

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillrank.llm.worker import keep_only
from quillrank.storage import Scratch

# A term is a run of ASCII letters and of characters beyond ASCII; only A-Z are lowered.
_TERM = re.compile(rb"[a-z\x80-\xff]+")
LEAST_DOCUMENTS = 30
SCALE, ADDED = 1_000_000_000, 5
TOP_TERMS = 50
_PIECE = 1 << 22  # bytes of a text searched at a time, a term more at most
_HELD = 500_000  # entries that a counting task holds before it sends them on
_TILE = 128  # groups of a block
_CELLS = 1 << 17  # counts of a block of terms, about
_FRONT = 1 << 20  # pairs of quadrants that a walk holds at a time
_WHOLE = "decimal(38,0)"


def terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in UTF-8, in order, a list per piece of it; pieces cut no term."""
    data, start = text.lower(), 0  # of bytes: lowers A-Z only
    while start < len(data):
        end = min(start + _PIECE, len(data))
        if end < len(data) and (rest := _TERM.match(data, end)):
            end = rest.end()
        yield _TERM.findall(data, start, end)
        start = end


def _as_text(found: list[bytes]) -> pa.Array:
    try:
        return pa.array(found, pa.binary()).cast(pa.string())
    except pa.ArrowInvalid:  # the text was no UTF-8
        return pa.array([term.decode("utf-8", "replace") for term in found])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, n, docs), summed over many documents of a task; and a row without term per group."""
    keep_only()
    groups: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    held = 0

    def out() -> Iterator[pa.RecordBatch]:
        for (lang, source), (counts, holding) in groups.items():
            found = list(counts)
            rows = len(found) + 1
            yield pa.RecordBatch.from_arrays(
                [
                    pa.repeat(pa.scalar(lang), rows), pa.repeat(pa.scalar(source), rows),
                    pa.concat_arrays([pa.nulls(1, pa.string()), _as_text(found)]),
                    pa.array([0, *counts.values()], pa.int64()), pa.array([0, *map(holding.__getitem__, found)], pa.int64()),
                ],
                names=["lang", "source", "term", "n", "docs"],
            )

    for batch in batches:
        named = zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), strict=True)
        for name, text in zip(named, batch.column("text").cast(pa.binary()), strict=True):
            if name not in groups:
                groups[name] = Counter(), Counter()
            counts, holding = groups[name]
            before, own = len(counts), set()
            for found in terms(text.as_py() or b""):
                counts.update(found)
                own.update(found)
            holding.update(own)
            held += len(counts) - before
            if held >= _HELD:
                yield from out()
                groups, held = {}, 0
    yield from out()


def term_counts(documents: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs) of all ``documents`` (text, lang, source); a group also has a row with a null term."""
    named = documents.select("text", *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")])
    counted = named.mapInArrow(_counted, "lang string, source string, term string, n bigint, docs bigint")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _price(count: Column, total: Column, size: Column) -> Column:
    """p of the contract: one more than the share of ``count`` plus 5 in billionths, cut to a whole number."""
    share = ((count.cast(_WHOLE) + ADDED) * SCALE).cast(_WHOLE)
    return (F.call_function("div", share, (total.cast(_WHOLE) + size.cast(_WHOLE) * ADDED).cast(_WHOLE)) + 1).cast("bigint")


class QuadTree:
    """A zero-or-not matrix as bits: level by level, four per quadrant that is not all zero, in Morton order.

    Side 2^height, for ``groups`` rows at least. Nodes of a level are the quadrants that are not all zero, numbered in
    that order; the rank of a set bit, the count of those before it, is the number of its quadrant in the level below.
    """

    def __init__(self, rows: np.ndarray, columns: np.ndarray, groups: int = 1):
        side = max(int(max(rows.max(initial=0), columns.max(initial=0))) + 1, groups)
        self.height = max(1, (side - 1).bit_length())
        codes = self.morton(rows, columns)
        self.order = np.argsort(codes, kind="stable")  # cells in the order of the leaves
        codes = codes[self.order]
        self.bits: list[np.ndarray] = []
        for depth in range(self.height, 0, -1):
            parents = np.unique(codes >> 2)
            bits = np.zeros(4 * len(parents), dtype=bool)
            bits[4 * np.searchsorted(parents, codes >> 2) + (codes & 3)] = True
            self.bits.insert(0, bits)
            codes = parents
        self._ranks = [np.cumsum(bits) - 1 for bits in self.bits]

    def morton(self, rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
        codes = np.zeros(len(rows), dtype=np.int64)
        for bit in range(self.height):
            codes |= ((columns >> bit) & 1).astype(np.int64) << (2 * bit)
            codes |= ((rows >> bit) & 1).astype(np.int64) << (2 * bit + 1)
        return codes

    def child(self, depth: int, at: np.ndarray, quadrant: np.ndarray) -> np.ndarray:
        """Numbers in level depth + 1 of one quadrant of each node; -1 for all-zero ones, and for those of -1."""
        place = 4 * np.maximum(at, 0) + quadrant
        return np.where((at >= 0) & self.bits[depth][place], self._ranks[depth][place], -1)


def pair_corrections(rows: np.ndarray, columns: np.ndarray, prices: np.ndarray, zero: np.ndarray, across: int | None = None):
    """For pairs a < b of groups: what their cells with a count add to the price of two all-zero rows.

    Cell i has ``prices[i]`` at (``rows[i]``, ``columns[i]``); all other cells of group g have ``zero[g]``. With ``across``, only pairs
    of a group below it with one from it on. Returns (a, b, sum); pairs without any count are left out.
    """
    groups = len(zero)
    tree = QuadTree(rows, columns, groups)
    leaves = prices[tree.order]
    sums = np.zeros(groups * groups)  # whole numbers below 2^53: a block has under 2^23 columns of 2^30 each
    met = np.zeros(groups * groups, dtype=bool)
    root = np.zeros(1, dtype=np.int64)
    # A front holds pairs of quadrants over the same columns: numbers of both in their level, and their rows of quadrants.
    waiting = [(0, root, root, root, root)]
    while waiting:
        depth, a, b, a_rows, b_rows = waiting.pop()
        if depth == tree.height:
            pair = a_rows * groups + b_rows
            own = np.where(a >= 0, leaves[a], zero[a_rows])
            other = np.where(b >= 0, leaves[b], zero[b_rows])
            added = np.abs(own - other) - np.abs(zero[a_rows] - zero[b_rows])
            sums += np.bincount(pair, weights=added, minlength=groups * groups)
            met[pair] = True
            continue
        if len(a) > _FRONT:
            half = len(a) // 2
            waiting += [(depth, *[x[cut] for x in (a, b, a_rows, b_rows)]) for cut in (slice(half), slice(half, None))]
            continue
        below = tree.height - depth - 1  # a quadrant of the next level has 2^below rows
        found = []
        for column in (0, 1):
            for i in (0, 1):
                for j in (0, 1):
                    next_a, next_b = tree.child(depth, a, np.int64(2 * i + column)), tree.child(depth, b, np.int64(2 * j + column))
                    x, y = 2 * a_rows + i, 2 * b_rows + j
                    # Some pair a < b of real groups, in both halves if asked for, and not zero against zero.
                    kept = ((next_a >= 0) | (next_b >= 0)) & ((y << below) < groups) & ((x < y) if not below else (x <= y))
                    if across is not None:
                        kept &= ((x << below) < across) & (((y + 1) << below) > across)
                    found.append((next_a[kept], next_b[kept], x[kept], y[kept]))
        front = [np.concatenate(parts) for parts in zip(*found, strict=True)]
        if len(front[0]):
            waiting.append((depth + 1, *front))
    pairs = np.flatnonzero(met)
    return pairs // groups, pairs % groups, sums[pairs].astype(np.int64)


def _block(frame: pd.DataFrame, same_tile: bool) -> pd.DataFrame:
    """The corrections of the pairs of one block; rows without term only bring the zero price of a group."""
    empty = frame["term"].isna().to_numpy()
    groups = frame[empty].sort_values("number", kind="stable")
    cells = frame[~empty]
    if not len(cells):
        return pd.DataFrame({"a": [], "b": [], "added": []}).astype("int64")
    numbers = groups["number"].to_numpy(np.int64)
    rows = np.searchsorted(numbers, cells["number"].to_numpy(np.int64))
    columns, _ = pd.factorize(cells["term"])
    # Columns that the same groups have stand together, which makes large quadrants of one kind.
    present = np.zeros((columns.max() + 1, len(numbers)), dtype=np.uint8)
    present[columns, rows] = 1
    packed = np.packbits(present, axis=1)
    place = np.empty(len(packed), dtype=np.int64)
    place[np.lexsort(packed.T[::-1])] = np.arange(len(packed))
    across = None if same_tile else int(np.searchsorted(groups["tile"].to_numpy(), groups["tile"].max()))
    a, b, added = pair_corrections(
        rows, place[columns], cells["price"].to_numpy(np.int64), groups["price"].to_numpy(np.int64), across
    )
    return pd.DataFrame({"a": numbers[a], "b": numbers[b], "added": added})


def audit(
    documents: DataFrame, scratch: Scratch, least_documents: int = LEAST_DOCUMENTS, top_terms: int = TOP_TERMS
) -> DataFrame:
    """(lang, source, part, item, value, rank) for every group of lang and source of ``documents`` (text, lang, source).

    A lang keeps the terms that at least ``least_documents`` of its rows have. p of a kept term in a group, or in the
    whole lang, is 1 + floor(10^9 (count + 5) / (N + 5 V)), with N the counts of all V kept terms there. Part ``pair``: item is another
    source of the lang, value the sum over kept terms of how far the two p are apart, 0 without kept terms. Part ``term``: item is a kept term that the
    group has and whose p is above the lang's, value by how much, the first ``top_terms`` only. Ranks start at 1 in every group and part, values
    descending, items ascending by UTF-8 bytes. Null text, lang and source count as empty ones; a group whose texts are empty is a
    group. Repeated rows count each. Other columns are not read; no rows give no rows. All arithmetic is in whole numbers. The
    result reads from ``scratch``.
    """
    counts = scratch.stored(term_counts(documents))
    cells = counts.where("term is not null")
    terms_of = scratch.stored(
        cells.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
        .where(F.col("docs") >= least_documents).drop("docs")
    )
    kept = scratch.stored(cells.drop("docs").join(terms_of, ["lang", "term"]))
    langs = terms_of.groupBy("lang").agg(F.sum("lang_n").alias("lang_total"), F.count("*").alias("size"))
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    sources = counts.where("term is null").select("lang", "source")
    groups = sources.join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
    zero = lambda name: F.coalesce(F.col(name), F.lit(0).cast("bigint")).alias(name)
    number = (F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1).cast("int").alias("number")
    groups = groups.select("lang", "source", number, zero("total"), zero("size"), zero("lang_total"))
    price = F.when(F.col("size") > 0, _price(F.lit(0), F.col("total"), F.nullif(F.col("size"), F.lit(0))))
    groups = scratch.stored(
        groups.withColumn("zero_price", F.coalesce(price, F.lit(0).cast("bigint")))
        .withColumn("tile", F.call_function("div", F.col("number"), F.lit(_TILE)).cast("int"))
    )
    priced = scratch.stored(kept.join(groups, ["lang", "source"]).select(
        "lang", "source", "number", "tile", "term",
        _price(F.col("n"), F.col("total"), F.col("size")).alias("price"),
        _price(F.col("lang_n"), F.col("lang_total"), F.col("size")).alias("lang_price"),
    ))
    return _pairs(groups, priced, scratch).unionByName(_own_terms(priced, top_terms))


def _ranked(rows: DataFrame, part: str) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.select(
        "lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank")
    )


def _own_terms(priced: DataFrame, top_terms: int) -> DataFrame:
    above = priced.where("price > lang_price").select(
        "lang", "source", F.col("term").alias("item"), (F.col("price") - F.col("lang_price")).alias("value")
    )
    return _ranked(above, "term").where(F.col("rank") <= top_terms)


def _pairs(groups: DataFrame, priced: DataFrame, scratch: Scratch) -> DataFrame:
    """The ``pair`` part: zero rows against zero rows from the groups alone, corrections from the blocks."""
    shape = scratch.stored(
        priced.groupBy("lang").agg(F.ceil(F.count("*") / F.lit(_CELLS)).cast("int").alias("blocks"))
        .join(groups.groupBy("lang").agg((F.max("tile") + 1).alias("tiles")), "lang")
    )

    def in_units(rows: DataFrame) -> DataFrame:
        # A tile of groups meets every tile: its rows go to all units (i, j) that hold it.
        other = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other")
        spread = rows.select("*", other)
        return spread.withColumns({"i": F.least("tile", "other"), "j": F.greatest("tile", "other")}).select(
            "lang", "block", "i", "j", "tile", "number", "term", "price"
        )

    cells = priced.join(shape, "lang").withColumn("block", F.pmod(F.xxhash64("term"), "blocks").cast("int"))
    zeros = groups.join(shape, "lang").select(
        "lang", "tile", "number", "tiles", F.lit(None).cast("string").alias("term"), F.col("zero_price").alias("price"),
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
    )
    units = in_units(cells).unionByName(in_units(zeros))

    def corrected(name: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        lang, _, i, j = name
        return _block(frame, same_tile=i == j).assign(lang=lang)

    found = scratch.stored(
        units.groupBy("lang", "block", "i", "j").applyInPandas(corrected, "a bigint, b bigint, added bigint, lang string")
        .groupBy("lang", "a", "b").agg(F.sum("added").alias("added"))
    )
    own = groups.select("lang", "source", F.col("number").cast("bigint").alias("a"), F.col("zero_price").alias("own_zero"), "size")
    others = groups.select("lang", F.col("source").alias("item"), F.col("number").cast("bigint").alias("b"), F.col("zero_price").alias("other_zero"))
    both = found.unionByName(found.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "added"))
    pairs = own.join(others, "lang").where("a <> b").join(both, ["lang", "a", "b"], "left")
    value = F.col("size") * F.abs(F.col("own_zero") - F.col("other_zero")) + F.coalesce("added", F.lit(0))
    return _ranked(pairs.select("lang", "source", "item", value.cast("bigint").alias("value")), "pair")
