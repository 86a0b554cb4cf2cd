"""Quality of documents: random-indexing word vectors, pooled, and a two-layer network with calibrated probabilities.

Every word has a sparse random index vector, which follows from its hash. The vector of a word is the sum of
the index vectors of the words around it in all documents. Words that make up less than one in ``OWN_VECTOR`` of all words
share vectors by hash. A document is the mean and spread of its words' vectors, and how far neighbouring words are
the same. A small network in numpy, fitted on a sample of the labels, tells the probability of
a good document from these; its logits are divided by a temperature fitted on rows it was not trained on.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillrank.llm.words import mixed, segments, span_hashes, tables
from quillrank.llm.worker import give_back, keep_only
from quillrank.storage import Scratch

SAMPLE = 12_000  # labelled documents that the model is fitted on, at most: the ones of least hash of their id
FOLDS = 5  # rows whose crc32 of the id is divisible by this are held out
DIM = 32  # of word vectors
OWN_VECTOR = 1_000_000  # words that are at least one in so many have a vector of their own, so as many words at most
WORDS = 1 << 14  # vectors that the rarer words share by hash; as many kinds of index vectors
NONZERO = 4  # entries of an index vector
WINDOW = 2  # words to either side that count as context
HIDDEN = 24
EPOCHS = 150
REJECT_BELOW = 0.3
_TASKS = 12
_CHUNK = 1 << 17  # words whose contexts are summed at a time
_SUMMED = 1 << 25  # words after which a task sends its sums on: no 32-bit sum can run over before
_HELD = 1 << 20  # words that are counted at a time
_PART = 10_000  # rows of sums in a frame


def held_out(name: str = "doc_id"):
    """Whether a row takes no part in learning."""
    return F.crc32(F.col(name).cast("string").cast("binary")) % FOLDS == 0


def _spans() -> np.ndarray:
    """0 for white space, 1 for ASCII marks, which are words of their own each, 2 for other bytes."""
    kinds = np.full(256, 2, dtype=np.int8)
    kinds[[b for b in range(33, 127) if not chr(b).isalnum()]] = 1
    kinds[tables().white == 1] = 0
    return kinds


def words(text: str | None) -> np.ndarray:
    """A hash per word, with case: runs of letters and digits, and single marks."""
    kinds, found = _spans(), []
    for piece in segments((text or "").encode("utf-8", "surrogatepass")):
        data = np.frombuffer(piece, dtype=np.uint8)
        kind = kinds[data]
        before = np.concatenate(([0], kind[:-1])) if len(kind) else kind
        after = np.concatenate((kind[1:], [0])) if len(kind) else kind
        starts = np.flatnonzero((kind == 1) | ((kind == 2) & (before != 2)))
        ends = np.flatnonzero((kind == 1) | ((kind == 2) & (after != 2))) + 1
        found.append(span_hashes(data, starts, ends, tables().as_is))
    return np.concatenate(found)


def index_entries() -> tuple[np.ndarray, np.ndarray]:
    """The sparse vector of every word number: places and signs of its entries."""
    numbers = np.arange(WORDS, dtype=np.uint64)[:, None]
    drawn = mixed(numbers * np.uint64(NONZERO) + np.arange(1, NONZERO + 1, dtype=np.uint64))
    return (drawn % np.uint64(DIM)).astype(np.int64), np.where(drawn >> np.uint64(63), 1, -1)


def _row_of(hashes: np.ndarray, own: np.ndarray) -> np.ndarray:
    """The number of the vector of each word: those in ``own``, sorted hashes, come after the shared ones."""
    shared = (hashes % np.uint64(WORDS)).astype(np.int64)
    if not len(own):
        return shared
    at = np.minimum(np.searchsorted(own, hashes), len(own) - 1)
    return np.where(own[at] == hashes, WORDS + at, shared)


def _index_table() -> np.ndarray:
    """The index vectors, one per line."""
    places, signs = index_entries()
    table = np.zeros((WORDS, DIM), dtype=np.int8)
    for i in range(NONZERO):
        np.add.at(table, (np.arange(WORDS), places[:, i]), signs[:, i])
    return table


def _summed(texts: Iterator[str | None], own: np.ndarray) -> Iterator[np.ndarray]:
    """For every vector the sum of the index vectors around its words, a line each, over stretches of the texts.

    The vectors that words share come first, then those of the words in ``own``, sorted hashes. The array is the same each time,
    emptied for the next stretch.
    """
    table = _index_table()
    sums = np.zeros((WORDS + len(own), DIM), dtype=np.int32)
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = total = 0

    def add() -> None:
        hashes = np.concatenate([h for h, _ in held])
        order = np.argsort(hashes)
        ordered = hashes[order]
        first = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
        found = np.add.reduceat(np.concatenate([c for _, c in held])[order], first, axis=0, dtype=np.int32)
        np.add.at(sums, _row_of(ordered[first], own), found)

    for text in texts:
        hashes = words(text)
        for at in range(0, len(hashes), _CHUNK):
            # With the words on either side of the chunk, which are context but have none here.
            start, end = max(at - WINDOW, 0), min(at + _CHUNK + WINDOW, len(hashes))
            index = table[(hashes[start:end] % np.uint64(WORDS)).astype(np.int64)]
            around = np.zeros_like(index)
            for away in range(1, WINDOW + 1):
                around[away:] += index[:-away]
                around[:-away] += index[away:]
            part = slice(at, at + _CHUNK)
            held.append((hashes[part], around[at - start : at - start + _CHUNK]))
            size += len(held[-1][0])
            if size >= _CHUNK:
                add()
                total += size
                held, size = [], 0
                if total >= _SUMMED:
                    yield sums
                    sums[:] = 0
                    total = 0
    if held:
        add()
    yield sums


def context_sums(texts: Iterator[str | None], own: np.ndarray | None = None) -> np.ndarray:
    """The sums over all texts as one row of whole numbers; see ``_summed``."""
    own = np.zeros(0, dtype=np.uint64) if own is None else own
    return sum(sums.astype(np.int64) for sums in _summed(texts, own)).reshape(-1)


def _texts(frames: Iterator[pd.DataFrame]) -> Iterator[str | None]:
    """All texts of a task; a frame is let go before the next one is read."""
    for frame in frames:
        texts = frame["text"].tolist()
        del frame
        yield from texts
        del texts


def _word_counts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(word, n) of the words of all texts, each word once per about ``_HELD`` words."""
    keep_only("word_tables")
    held, size = [], 0

    def counted() -> pd.DataFrame:
        found, n = np.unique(np.concatenate(held), return_counts=True)
        return pd.DataFrame({"word": found.view(np.int64), "n": n})

    for text in _texts(frames):
        held.append(words(text))
        size += len(held[-1])
        if size >= _HELD:
            yield counted()
            held, size = [], 0
    if size:
        yield counted()
    held = []
    give_back()


@dataclass
class Vectors:
    own: np.ndarray  # sorted hashes of the words with a vector of their own
    rows: np.ndarray  # the vectors: first the shared ones, then those of ``own``


def word_vectors(documents: DataFrame, scratch: Scratch) -> Vectors:
    """The vectors of the words of all ``documents``; the driver gets those alone, at most ``OWN_VECTOR + WORDS``."""
    counts = scratch.stored(
        documents.select("text").mapInPandas(_word_counts, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    )
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    # Packed where they are, because a frame of them as Python numbers would be far larger.
    packed = counts.where(F.col("n") * OWN_VECTOR >= total).select("word").mapInPandas(
        lambda frames: (pd.DataFrame({"words": [f["word"].to_numpy(np.int64).tobytes()]}) for f in frames), "words binary"
    ).collect()
    own = np.sort(np.frombuffer(b"".join(r["words"] for r in packed), dtype=np.uint64))
    shared = documents.sparkSession.sparkContext.broadcast(own)
    names = [f"s{i}" for i in range(DIM)]

    def contexts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keep_only("word_tables")
        for sums in _summed(_texts(frames), shared.value):
            met = np.flatnonzero(sums.any(axis=1))
            for at in range(0, len(met), _PART):
                part = met[at : at + _PART]
                yield pd.DataFrame(sums[part].astype(np.int64), columns=names).assign(row=part)
        del sums
        give_back()

    def unit(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            sums = frame[names].to_numpy(np.float32)
            sums /= np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1)
            yield pd.DataFrame({"at": [frame["row"].to_numpy(np.int64).tobytes()], "vectors": [sums.tobytes()]})

    # Whole numbers, so the order of the tasks does not matter.
    summed = documents.select("text").mapInPandas(contexts, ", ".join(f"{n} bigint" for n in names) + ", row bigint")
    summed = summed.groupBy("row").agg(*[F.sum(n).alias(n) for n in names])
    rows = np.zeros((WORDS + len(own), DIM), dtype=np.float32)
    for part in summed.mapInPandas(unit, "at binary, vectors binary").collect():
        rows[np.frombuffer(part["at"], dtype=np.int64)] = np.frombuffer(part["vectors"], dtype=np.float32).reshape(-1, DIM)
    shared.destroy()
    return Vectors(own, rows)


def pooled(text: str | None, vectors: Vectors) -> np.ndarray:
    """The features of a document; an empty one has zeros only."""
    hashes = words(text)
    if not len(hashes):
        return np.zeros(2 * DIM + 2, dtype=np.float32)
    distinct, counts = np.unique(hashes, return_counts=True)
    share = (counts / len(hashes)).astype(np.float32)
    own = vectors.rows[_row_of(distinct, vectors.own)]
    mean = share @ own
    spread = np.sqrt(np.maximum(share @ own**2 - mean**2, 0))
    repeated = np.mean(hashes[1:] == hashes[:-1]) if len(hashes) > 1 else 0.0
    return np.concatenate((mean, spread, [repeated, len(distinct) / len(hashes)])).astype(np.float32)


@dataclass
class Model:
    vectors: Vectors
    center: np.ndarray
    scale: np.ndarray
    layers: list[np.ndarray]  # weights and biases of both layers; empty if there was one class only
    temperature: float
    prior: float

    def probabilities(self, features: np.ndarray) -> np.ndarray:
        if not self.layers:
            return np.full(len(features), self.prior)
        return _sigmoid(_logits(self.layers, (features - self.center) / self.scale)[1] / self.temperature)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def _logits(layers: list[np.ndarray], x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    w1, b1, w2, b2 = layers
    hidden = np.tanh(x @ w1 + b1)
    return hidden, (hidden @ w2 + b2)[:, 0]


def _trained(x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    """Two layers by Adam on the log loss, both classes weighing the same; always the same for the same rows."""
    rng = np.random.default_rng(5)
    layers = [
        rng.normal(0, x.shape[1] ** -0.5, (x.shape[1], HIDDEN)), np.zeros(HIDDEN),
        rng.normal(0, HIDDEN**-0.5, (HIDDEN, 1)), np.zeros(1),
    ]
    first, second = [np.zeros_like(w) for w in layers], [np.zeros_like(w) for w in layers]
    weight = np.where(y == 1, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9))
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(x))
        for at in range(0, len(x), 512):
            rows = order[at : at + 512]
            hidden, logit = _logits(layers, x[rows])
            error = ((_sigmoid(logit) - y[rows]) * weight[rows] / len(rows))[:, None]
            back = error @ layers[2].T * (1 - hidden**2)
            gradients = [x[rows].T @ back, back.sum(0), hidden.T @ error, error.sum(0)]
            step += 1
            for k, gradient in enumerate(gradients):
                gradient = gradient + 1e-4 * layers[k]
                first[k] = 0.9 * first[k] + 0.1 * gradient
                second[k] = 0.999 * second[k] + 0.001 * gradient**2
                rate = 0.003 * (1 - 0.999**step) ** 0.5 / (1 - 0.9**step)
                layers[k] = layers[k] - rate * first[k] / (np.sqrt(second[k]) + 1e-8)
    return layers


def _temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The divisor of logits with the least log loss."""
    grid = np.geomspace(0.5, 8, 61)
    loss = [-np.mean(np.log(np.where(y == 1, _sigmoid(logits / t), _sigmoid(-logits / t)) + 1e-12)) for t in grid]
    return float(grid[int(np.argmin(loss))])


def _sample(documents: DataFrame, labels: DataFrame, size: int) -> DataFrame:
    """(doc_id, text, quality) of at most ``size`` labelled rows outside the held-out fold."""
    usable = labels.where("doc_id is not null and quality in (0, 1)").where(~held_out())
    chosen = (
        usable.groupBy("doc_id").agg(F.min("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(size)
    )
    return documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")


def fit(documents: DataFrame, labels: DataFrame, scratch: Scratch, size: int = SAMPLE) -> Model:
    """A model from ``documents`` (doc_id, text) and ``labels`` (doc_id, quality).

    Word vectors come from all ``documents``. The network learns from at most ``size`` labelled documents; the driver
    holds their features, ``size`` times 66 numbers. Without rows of both classes the model is the share of class 1, or one half.
    """
    sample = scratch.stored(_sample(documents, labels, size).repartition(_TASKS))
    vectors = word_vectors(documents, scratch)
    shared = documents.sparkSession.sparkContext.broadcast(vectors)

    def features(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = [pooled(text, shared.value).tobytes() for text in frame["text"]]
            yield pd.DataFrame({"doc_id": frame["doc_id"], "quality": frame["quality"], "features": found})

    rows = sample.select("doc_id", "text", F.col("quality").cast("int").alias("quality")).mapInPandas(
        features, "doc_id bigint, quality int, features binary"
    ).toPandas()
    shared.destroy()  # the model brings the vectors again, once, for all that is scored with it
    rows = rows.sort_values(["doc_id", "features"], kind="stable")
    y = rows["quality"].to_numpy(dtype=np.float64)
    if len(set(y)) < 2:
        return Model(vectors, np.zeros(0), np.zeros(0), [], 1.0, float(y.mean()) if len(y) else 0.5)
    x = np.frombuffer(b"".join(rows["features"]), dtype=np.float32).reshape(len(rows), -1).astype(np.float64)
    center, scale = x.mean(0), np.maximum(x.std(0), 1e-6)
    x = (x - center) / scale
    kept_back = np.arange(len(x)) % 5 == 4
    if len(set(y[~kept_back])) < 2:
        kept_back[:] = False
    layers = _trained(x[~kept_back], y[~kept_back])
    at = kept_back if kept_back.any() else ~kept_back
    return Model(vectors, center, scale, layers, _temperature(_logits(layers, x[at])[1], y[at]), float(y.mean()))


def score_of(text: str, model: Model) -> Column:
    """The probability of quality 1 of a text column, from whole texts alone; null counts as empty."""
    shared = SparkSession.getActiveSession().sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        keep_only("word_tables")
        for texts in batches:
            features = [pooled(text, shared.value.vectors) for text in texts]
            del texts
            yield pd.Series(shared.value.probabilities(np.stack(features)) if features else [], dtype=float)
        give_back()

    return score(text)


def scored(documents: DataFrame, model: Model) -> DataFrame:
    """``documents`` with ``score``, in place of a column of that name; other columns stay, without shuffle."""
    return documents.withColumn("score", score_of("text", model))
