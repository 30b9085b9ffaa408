"""Language identification by sparse multinomial logistic regression on character n-grams.

Text is lower-cased and everything but letters becomes one blank.  Its n-grams of one to
three characters are hashed into ``BUCKETS`` numbers and weighted by TF-IDF with document
frequencies of all training documents.  Weights are trained with follow-the-regularised-leader and
elastic-net penalties (the first penalty makes them sparse), on a bounded sample: at most
``PER_LANGUAGE`` documents of each language, those with the least hash of their doc_id.  A
fifth of that sample is kept out of training and fits one temperature, by which all scores
are calibrated.

Only text and lang of the training documents (``learns_from``) are ever learned from; a prediction sees
the text alone.  The sample streams through one task in a fixed order, so the model does
not depend on the cluster.  The model has BUCKETS rows and a column per language.

Defined results.  A text that is null or has no letter is ``und`` with score 0, and so is every text when
there is nothing to learn from.  Equal scores go to the language that sorts first.  A row
with a null doc_id is not learned from.  Every row gives one row; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edupipe.llm.common import small_batches, worker_state
from edupipe.session import materialise

BUCKETS = 1 << 15
PER_LANGUAGE = 1500       # documents of a language that the classifier is fitted on: the bound of the sample
EPOCHS = 3
CALIBRATE = 5             # one document of so many is kept for the temperature
RATE, SMOOTH = 0.5, 1.0   # learning rate and its smoothing
L1, L2 = 2e-4, 1e-4
FOLDS = 5
UNDETERMINED = "und"
LEAST_SCORE = 0.4         # a lower score is no decision for ``with_language``
SEGMENT = 1 << 20


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether crc32 of the doc_id as text leaves no remainder by ``FOLDS``; null ids are not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def learns_from() -> Column:
    return F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out()


def _letters() -> np.ndarray:
    """Which code points are letters."""
    state = worker_state("language_id")
    if "letters" not in state:
        state["letters"] = np.fromiter((chr(o).isalpha() for o in range(0x110000)), np.bool_, 0x110000)
    return state["letters"]


def gram_counts(text: str) -> np.ndarray | None:
    """How often each bucket's n-grams occur; nothing when there is no letter."""
    letters, total = _letters(), np.zeros(BUCKETS, np.int64)
    found = False
    for at in range(0, len(text), SEGMENT):
        # a very long text is read in segments; a word at their edge counts as two words
        points = np.frombuffer(text[at : at + SEGMENT].lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        kept = np.concatenate([[32], np.where(letters[points], points, 32), [32]])
        found = found or bool((kept != 32).any())
        c = kept[np.concatenate([[True], (kept[1:] != 32) | (kept[:-1] != 32)])].astype(np.uint64)
        one = c * np.uint64(0x9E3779B97F4A7C15)
        two = (one[:-1] ^ (one[:-1] >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + c[1:]
        three = (two[:-1] ^ (two[:-1] >> np.uint64(31))) * np.uint64(0x94D049BB133111EB) + c[2:]
        for grams in (one, two * np.uint64(0x9E3779B97F4A7C15), three * np.uint64(0x9E3779B97F4A7C15)):
            total += np.bincount((grams >> np.uint64(49)).astype(np.int64), minlength=BUCKETS)
    return total if found else None


def features(counts: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and their TF-IDF weights, of length one together."""
    at = np.flatnonzero(counts)
    weights = (1 + np.log(counts[at])) * idf[at]
    return at, weights / np.sqrt((weights * weights).sum())


def _document_frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found, documents = np.zeros(BUCKETS, np.int64), 0
    for batch in batches:
        for text in batch.column(0):
            counts = gram_counts(text.as_py())
            if counts is not None:
                found += counts > 0
                documents += 1
    at = np.flatnonzero(found)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.append(at, -1), pa.int64()), pa.array(np.append(found[at], documents), pa.int64())], names=["bucket", "n"]
    )


class Learner:
    """Follow the regularised leader, one column of weights for each language."""

    def __init__(self, n_languages: int) -> None:
        self.z = np.zeros((BUCKETS + 1, n_languages))  # the last row is the bias
        self.n = np.zeros((BUCKETS + 1, n_languages))

    def weights(self, at: np.ndarray | slice) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        dense = -(z - np.sign(z) * L1) / ((SMOOTH + np.sqrt(n)) / RATE + L2)
        return np.where(np.abs(z) <= L1, 0.0, dense)

    def learn(self, at: np.ndarray, values: np.ndarray, language: int) -> None:
        at, values = np.append(at, BUCKETS), np.append(values, 1.0)
        weights = self.weights(at)
        wrong = softmax(values @ weights)
        wrong[language] -= 1
        gradient = values[:, None] * wrong[None, :]
        more = self.n[at] + gradient * gradient
        self.z[at] += gradient - (np.sqrt(more) - np.sqrt(self.n[at])) / RATE * weights
        self.n[at] = more


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def temperature(logits: np.ndarray, truth: np.ndarray) -> float:
    """The temperature with the least log loss, by golden section over its logarithm."""
    if not len(truth):
        return 1.0

    def loss(log_t: float) -> float:
        p = softmax(logits / np.exp(log_t))[np.arange(len(truth)), truth]
        return float(-np.log(np.maximum(p, 1e-300)).mean())

    low, high, ratio = -1.0, 4.0, (5**0.5 - 1) / 2  # separable data would drive it to zero
    for _ in range(60):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def _train(idf: Broadcast, languages: list[str]):
    """The model from a stream of (epoch, order, lang, text) in order; the last epoch is for calibration."""
    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights_of = idf.value
        learner, number = Learner(len(languages)), {name: i for i, name in enumerate(languages)}
        logits, truth, final = [], [], None
        for batch in batches:
            epochs, names = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            for epoch, name, text in zip(epochs, names, batch.column(3)):
                counts = gram_counts(text.as_py())
                if counts is None:
                    continue
                at, values = features(counts, weights_of)
                if epoch < EPOCHS:
                    learner.learn(at, values, number[name])
                    continue
                final = learner.weights(slice(None)) if final is None else final
                logits.append(values @ final[at] + final[BUCKETS])
                truth.append(number[name])
        final = learner.weights(slice(None)) if final is None else final
        heat = temperature(np.array(logits), np.array(truth, np.int64)) if truth else 1.0
        used = np.flatnonzero((final != 0).any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(used, -1), pa.int64()), pa.array([*final[used].tolist(), [heat]], pa.list_(pa.float64()))],
            names=["bucket", "weights"],
        )

    return train


class Model:
    def __init__(self, languages: list[str], idf: np.ndarray, weights: np.ndarray, heat: float) -> None:
        self.languages, self.idf, self.weights, self.heat = languages, idf, weights, heat

    def parts(self) -> tuple[list[str], np.ndarray, np.ndarray, float]:
        return self.languages, self.idf, self.weights, self.heat

    def predict(self, text: str | None) -> tuple[str, float]:
        counts = gram_counts(text) if text and self.languages else None
        if counts is None:
            return UNDETERMINED, 0.0
        at, values = features(counts, self.idf)
        scores = softmax((values @ self.weights[at] + self.weights[BUCKETS]) / self.heat)
        best = int(scores.argmax())
        return self.languages[best], float(min(1.0, scores[best]))


def _least_hashes(ids: DataFrame) -> DataFrame:
    """Rows (doc_id, lang, order) among which are the ``PER_LANGUAGE`` least of every language.

    A language's rows are cut at the hash below which a little more than that many are expected, so that
    the task that ranks a language gets about as many however many documents it has.  Where
    too few are below it (ids that repeat), the cut is raised.
    """
    sizes = materialise(ids.groupBy("lang").agg(F.count("*").alias("n")), "languages")
    wanted = PER_LANGUAGE + 8 * int(PER_LANGUAGE**0.5) + 64
    while True:
        bound = F.least(F.lit(1.0), F.lit(float(wanted)) / F.col("n"))
        share = F.col("order") / F.lit(2.0**64) + F.lit(0.5)  # of all hashes, those below this one
        found = ids.join(F.broadcast(sizes), "lang").where((share <= bound) | (bound == 1.0))  # a row per language
        enough = found.groupBy("lang").agg(F.count("*").alias("k")).join(sizes, "lang", "right")
        few = enough.where(F.coalesce("k", F.lit(0)) < F.least(F.col("n"), F.lit(PER_LANGUAGE)))
        if few.isEmpty():
            return found.drop("n")
        wanted *= 4


def fit(docs: DataFrame) -> Model:
    """Learn from the training documents among (doc_id, text, lang)."""
    context = docs.sparkSession.sparkContext
    known = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).where(learns_from())
    counted = known.select("text").mapInArrow(_document_frequencies, "bucket long, n long")
    table = counted.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()  # BUCKETS + 1 rows at most
    at, n = table.column("bucket").to_numpy(), table.column("n").to_numpy()
    documents = int(n[at < 0].sum())
    frequency = np.zeros(BUCKETS)
    frequency[at[at >= 0]] = n[at >= 0]
    idf = np.log((1 + documents) / (1 + frequency)) + 1

    # which documents: by a hash of the id, without their texts; then those few texts
    order = F.xxhash64("doc_id")
    least = Window.partitionBy("lang").orderBy("order", "doc_id")
    chosen = _least_hashes(known.select("doc_id", "lang", order.alias("order"))).withColumn("rank", F.row_number().over(least))
    chosen = chosen.where(F.col("rank") <= PER_LANGUAGE).select("doc_id", "lang").distinct()
    texts = known.join(F.broadcast(chosen), ["doc_id", "lang"]).withColumn("order", order)  # PER_LANGUAGE ids per language
    texts = texts.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy("order", "doc_id", F.xxhash64("text"))))
    texts = materialise(texts.where(F.col("rank") <= PER_LANGUAGE), "language-sample")
    languages = sorted(r["lang"] for r in texts.select("lang").distinct().collect())
    if not languages:
        return Model([], idf, np.zeros((BUCKETS + 1, 0)), 1.0)
    kept = F.pmod("order", F.lit(CALIBRATE)) == 0
    train = texts.where(~kept | (F.col("rank") <= 2)).withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(EPOCHS - 1))))
    stream = train.unionByName(texts.where(kept).withColumn("epoch", F.lit(EPOCHS)))
    # a bounded sample, read in one order by one task
    ordered = stream.select("epoch", F.xxhash64("order", "epoch").alias("order"), "lang", "text").repartition(1).sortWithinPartitions("epoch", "order", "lang", "text")
    found = ordered.mapInArrow(_train(context.broadcast(idf), languages), "bucket long, weights array<double>").toArrow()
    weights, heat = np.zeros((BUCKETS + 1, len(languages))), 1.0
    for bucket, row in zip(found.column("bucket").to_pylist(), found.column("weights").to_pylist()):
        if bucket < 0:
            heat = row[0]
        else:
            weights[bucket] = row
    return Model(languages, idf, weights, heat)


def identify(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """Each row of ``docs`` as (row, held_out, lang_pred, score)."""
    # plain data: a broadcast is pickled by name, and executors need not know this module
    shared = small_batches(docs).sparkSession.sparkContext.broadcast((model or fit(docs)).parts())

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learned = Model(*shared.value)
        for batch in batches:
            row = batch.column("row")
            found = [learned.predict(t.as_py()) for t in row.field(row.type.get_field_index("text"))]
            yield pa.RecordBatch.from_arrays(
                [row, batch.column("held_out"), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                names=["row", "held_out", "lang_pred", "score"],
            )

    kind = T.StructType([
        T.StructField("row", docs.schema), T.StructField("held_out", T.BooleanType()),
        T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
    ])
    return docs.select(F.struct("*").alias("row"), held_out().alias("held_out")).mapInArrow(predict, kind)


def with_language(docs: DataFrame, least_score: float = LEAST_SCORE) -> DataFrame:
    """The rows of ``docs`` whose language is determined with at least ``least_score``."""
    found = identify(docs).where((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= least_score))
    return found.select("row.*")
