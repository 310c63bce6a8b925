"""Language identification by averaged hashed subword embeddings and a linear softmax.

A text's features are its byte n-grams (lower-cased, every run of other characters
read as one blank), hashed to buckets. The model averages the buckets' embeddings
and puts a softmax over languages on top. It is trained in numpy by stochastic
gradient descent on a bounded sample of labelled documents; part of the sample is
held back to set the temperature and the rejection threshold. Prediction runs over
whole texts in tasks; since all is linear before the softmax, tasks use the product
of embeddings and weights.

Defined results: null texts and texts without a letter get `und`, score 0 and are
rejected; without labelled documents every text does; a null id is not held out;
an empty table gives no rows. A document is rejected for either of two reasons:

- it is undecided between learned languages: the way of its calibrated probability from
  an even answer (0) to certainty (1) is below the threshold, which all but
  `REJECT_SHARE` of the right answers reach and which is `HIGHEST_THRESHOLD` at most;
- it is foreign to the answer's language: its n-grams are rarer in it than those of all
  but `REJECT_SHARE` of the right answers, by the mean of their logarithmic frequencies,
  whose spread depends on the text's length. The softmax alone is sure of random
  letters, too. A language with fewer than `LEAST_HELD` right answers in the held-back
  part has no measure of its own texts, and nothing is rejected as foreign to it.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloader.llm.base import column, in_tasks, slices

UNKNOWN = "und"
#: Labelled documents the model is fitted on, at most. Every language gives some, the rarest
#: ones left out only if there are more languages than documents.
SAMPLE_DOCUMENTS = 3072
BUCKETS = 1 << 14
DIMENSIONS = 16
ORDERS = (2, 3, 4)
EPOCHS = 4
RATE = 0.5
LONGEST_STEP = 8.0
#: Share of the sample for temperature and threshold.
CALIBRATION = 0.25
#: Of rightly labelled documents so many may be rejected.
REJECT_SHARE = 0.0005
#: An answer this far from an even one is decided, however sure the right answers are.
HIGHEST_THRESHOLD = 0.35
#: Right answers by which a language's own texts are measured, at least.
LEAST_HELD = 20
#: Lowest share of them by which rarer ones are told.
TAIL = 0.1
#: Different hashes that pick the sample.
HASHES = 1 << 62
_AT_ONCE = 1 << 20
_LETTER = re.compile(r"[^\W\d_]")
_OTHER = re.compile(rb"[\x00-\x40\x5b-\x60\x7b-\x7f]+")


def normal(text: str) -> bytes:
    """Lower-case UTF-8 with one blank for every run of ASCII characters that are no letters."""
    return b" " + _OTHER.sub(b" ", text.lower().encode("utf-8", "replace")) + b" "


def grams(data: bytes) -> np.ndarray:
    """The bucket of every n-gram, of each order in turn."""
    codes = np.frombuffer(data, np.uint8).astype(np.uint32)
    hashed, found = codes * np.uint32(0x9E3779B1), []
    for order in range(2, max(ORDERS) + 1):
        if len(codes) < order:
            break
        hashed = (hashed[:-1] ^ (hashed[:-1] >> np.uint32(15))) * np.uint32(0x85EBCA6B) + codes[order - 1 :] * np.uint32(0xC2B2AE35)
        if order in ORDERS:
            found.append(((hashed ^ (hashed >> np.uint32(13))) & np.uint32(BUCKETS - 1)).astype(np.int32))
    return np.concatenate(found) if found else np.zeros(0, np.int32)


def counts(text: str) -> np.ndarray:
    """How often each bucket occurs in the whole text."""
    data, total = normal(text), np.zeros(BUCKETS, np.int64)
    for at in range(0, len(data), _AT_ONCE):
        part = data[at : at + _AT_ONCE + max(ORDERS) - 1]
        if at and len(part) < max(ORDERS):
            break
        total += np.bincount(grams(part), minlength=BUCKETS)
    return total


@dataclass
class Model:
    languages: list[str]
    embeddings: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.0
    #: Logarithmic frequency of each bucket in each language, and by language its mean
    #: over a text, the variance between texts, and that of a single n-gram.
    usual: np.ndarray | None = None
    spread: np.ndarray | None = None
    least_familiar: float = -np.inf

    def table(self) -> np.ndarray:
        """What one n-gram of each bucket adds to the languages' scores, and then to their familiarity."""
        return np.ascontiguousarray(np.hstack([self.embeddings @ self.weights, self.usual]).astype(np.float32))

    def familiarity(self, means: np.ndarray, grams: np.ndarray, answers: np.ndarray) -> np.ndarray:
        """How far texts lie from the mean of their answer's language, in deviations of texts of their length."""
        middle, between, single = self.spread[answers].T
        return (means - middle) / np.sqrt(between + single / np.maximum(grams, 1))


def _softmax(scores: np.ndarray) -> np.ndarray:
    raised = np.exp(scores - scores.max(axis=-1, keepdims=True))
    return raised / raised.sum(axis=-1, keepdims=True)


def train(samples: list[tuple[str, np.ndarray, np.ndarray]], seed: int = 7) -> Model | None:
    """Fit on `(language, buckets, counts)`; None without samples."""
    languages = sorted({language for language, _, _ in samples})
    if not languages:
        return None
    draw = np.random.default_rng(seed)
    number = {language: i for i, language in enumerate(languages)}
    data = [(number[x], at.astype(np.int64), (n / n.sum()).astype(np.float32)) for x, at, n in samples if n.sum() > 0]
    lengths = np.array([n.sum() for _, _, n in samples if n.sum() > 0])
    order = draw.permutation(len(data))
    held = order[: int(len(data) * CALIBRATION)]
    fitted = order[len(held) :]
    embeddings = draw.uniform(-1, 1, (BUCKETS, DIMENSIONS)).astype(np.float32) / DIMENSIONS
    weights = np.zeros((DIMENSIONS, len(languages)), np.float32)
    bias = np.zeros(len(languages), np.float32)
    steps, done = max(1, EPOCHS * len(fitted)), 0
    for _ in range(EPOCHS):
        for which in draw.permutation(fitted):
            label, at, share = data[which]
            rate = RATE * (1 - done / steps)
            done += 1
            hidden = share @ embeddings[at]
            error = _softmax(hidden @ weights + bias)
            error[label] -= 1
            back = weights @ error
            weights -= rate * np.outer(hidden, error)
            bias -= rate * error
            # The buckets of one text are distinct. The shares are small, so their
            # step is scaled by the number of buckets, within a bound: texts that repeat
            # a few n-grams would make the fit diverge.
            embeddings[at] -= rate * np.minimum(len(at) * share, LONGEST_STEP)[:, None] * back
    seen = np.full((BUCKETS, len(languages)), 0.5)
    for which in fitted:
        label, at, share = data[which]
        seen[at, label] += share * lengths[which]
    usual = np.log(seen / seen.sum(axis=0) * BUCKETS)
    model = Model(languages, embeddings, weights, bias, usual=usual, spread=np.tile([0.0, np.inf, 0.0], (len(languages), 1)))
    if len(held):
        scores = np.array([data[i][2] @ embeddings[data[i][1]] for i in held]) @ weights + bias
        labels = np.array([data[i][0] for i in held])
        right = _calibrate(model, scores, labels)
        _measure(model, [(*data[i], lengths[i]) for i in held[right]])
    return model


def _decided(sure: np.ndarray) -> np.ndarray:
    """Where the best answer lies between an even one, 0, and certainty, 1."""
    even = 1 / sure.shape[-1]
    return (sure.max(axis=-1) - even) / (1 - even) if even < 1 else np.ones(sure.shape[:-1])


def _calibrate(model: Model, scores: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """The temperature with the least log loss, and the threshold nearly all right answers reach; which are right."""
    rows = np.arange(len(labels))

    def loss(temperature: float) -> float:
        return float(-np.log(_softmax(scores / temperature)[rows, labels] + 1e-12).mean())

    model.temperature = min(np.geomspace(0.25, 8, 41).tolist(), key=loss)
    sure = _softmax(scores / model.temperature)
    right = sure.argmax(axis=1) == labels
    if right.any():
        model.threshold = min(float(np.quantile(_decided(sure)[right], REJECT_SHARE)), HIGHEST_THRESHOLD)
    return right


def _measure(model: Model, held: list[tuple[int, np.ndarray, np.ndarray, float]]) -> None:
    """How familiar the texts of each language are, by `(label, buckets, shares, n-grams)` of right answers."""
    labels, grams = np.array([x[0] for x in held], np.int64), np.array([x[3] for x in held])
    means = np.array([share @ model.usual[at, label] for label, at, share, _ in held])
    squares = np.array([share @ model.usual[at, label] ** 2 for label, at, share, _ in held])
    measured = np.zeros(len(held), bool)
    for label in range(len(model.languages)):
        of = labels == label
        if of.sum() < LEAST_HELD:
            continue
        measured |= of
        single = float(np.mean(squares[of] - means[of] ** 2))
        middle = float(np.median(means[of]))
        between = float(np.mean((means[of] - middle) ** 2 - single / grams[of]))
        model.spread[label] = middle, max(between, 1e-3), single
    if measured.any():
        model.least_familiar = _low(model.familiarity(means, grams, labels)[measured], REJECT_SHARE)


def _low(values: np.ndarray, share: float) -> float:
    """A quantile that may lie beyond a small sample: the lowest `TAIL` of it is carried on as an exponential tail."""
    edge = float(np.quantile(values, TAIL))
    beyond = edge - values[values <= edge]
    return min(float(np.quantile(values, share)), edge - float(beyond.mean()) * float(np.log(TAIL / share)))


def shares(sizes: dict[str, int], most: int) -> dict[str, int]:
    """How many documents of each language are learned from: all of a small one, and what that leaves to the larger ones."""
    left, made = most, {}
    for i, (language, n) in enumerate(sorted(sizes.items(), key=lambda x: (x[1], x[0]))):
        made[language] = min(n, left // (len(sizes) - i))
        left -= made[language]
    return made


def _smallest(keyed: DataFrame, sizes: dict[str, int], wanted: dict[str, int]) -> dict[tuple[str, int], int]:
    """The rows of each language with its smallest hashes, as many as wanted: how many of each `lang, hashed`.

    Only hashes below a cut of the language's own are looked at, somewhat more than
    wanted. Where repeated rows leave fewer, the cut is raised.
    """
    cuts = {x: min(1.0, (1.3 * n + 40) / sizes[x]) for x, n in wanted.items() if n}
    made: dict[tuple[str, int], int] = {}
    while cuts:
        found: dict[str, list[tuple[int, int]]] = {x: [] for x in cuts}
        for row in keyed.where(F.col("hashed") < _cut(cuts)).groupBy("lang", "hashed").agg(F.count(F.lit(1)).alias("n")).collect():
            found[row.lang].append((row.hashed, row.n))
        raised = {}
        for language, rows in found.items():
            left = wanted[language]
            if sum(n for _, n in rows) < left and cuts[language] < 1:
                raised[language] = min(1.0, 8 * cuts[language])
                continue
            for hashed, n in sorted(rows):
                if left:
                    made[language, hashed] = min(n, left)
                    left -= made[language, hashed]
        cuts = raised
    return made


def _cut(cuts: dict[str, float]) -> Column:
    return _by_language({x: int(share * HASHES) for x, share in cuts.items()})


def _by_language(numbers: dict[str, int]) -> Column:
    """A language's number, null for others; there may be thousands."""
    return F.try_element_at(F.from_json(F.lit(json.dumps(numbers)), "map<string,long>"), F.col("lang"))


def sample(labelled: DataFrame, most: int = SAMPLE_DOCUMENTS) -> list[tuple[str, np.ndarray, np.ndarray]]:
    """Features of at most `most` documents of `doc_id, text, lang`, as evenly over languages as they allow.

    Which ones is settled by a hash within each language, so that no language's share
    depends on the others' sizes, and only their features come to the driver.
    """
    named = labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(most)
    sizes = {row.lang: row.n for row in named.collect()}
    if not sizes:
        return []
    keyed = labelled.withColumn("hashed", F.pmod(F.xxhash64("doc_id", "text"), F.lit(HASHES)))
    taken = _smallest(keyed.select("lang", "hashed"), sizes, shares(sizes, most))
    last: dict[str, int] = {}
    for language, place in taken:
        last[language] = max(last.get(language, 0), place + 1)
    below = _by_language(last)
    # Repeated rows have equal features, which are counted once and taken as often.
    chosen = keyed.select("lang", "hashed", "text").where(F.col("hashed") < below).dropDuplicates(["lang", "hashed"])

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            made = [counts(text or "") for text in batch.column("text").to_pylist()]
            yield pa.record_batch(
                [
                    batch.column("lang"), batch.column("hashed"),
                    pa.array([np.flatnonzero(x).astype("<u2").tobytes() for x in made], pa.binary()),
                    pa.array([x[x > 0].astype("<f4").tobytes() for x in made], pa.binary()),
                ],
                ["lang", "hashed", "buckets", "counts"],
            )

    rows = in_tasks(chosen, features, "lang string, hashed long, buckets binary, counts binary").collect()
    made = []
    for x in sorted(rows, key=lambda x: (x.hashed, x.lang)):
        features_of = (x.lang, np.frombuffer(x.buckets, "<u2"), np.frombuffer(x.counts, "<f4"))
        made += [features_of] * taken.get((x.lang, x.hashed), 0)
    return made


def predict(docs: DataFrame, model: Model | None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """`doc_id, lang_pred, score, rejected` per document. The model has a fixed size."""
    frame = docs.select(column(id_column).cast("long").alias("doc_id"), column(text_column).cast("string").alias("text"))
    shared = frame.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        scorer = Scorer(known) if known else None
        for batch in slices(batches):
            made = [scorer(text) if scorer and text and _LETTER.search(text) else (UNKNOWN, 0.0, True) for text in batch.column("text").to_pylist()]
            names, scores, rejected = zip(*made)
            yield pa.record_batch(
                [batch.column("doc_id"), pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())],
                ["doc_id", "lang_pred", "score", "rejected"],
            )

    return in_tasks(frame, work, "doc_id long, lang_pred string, score double, rejected boolean")


class Scorer:
    """Predictions with one model."""

    def __init__(self, model: Model):
        self.model, self.table = model, model.table()

    def __call__(self, text: str) -> tuple[str, float, bool]:
        data, model = normal(text), self.model
        total, seen = np.zeros(self.table.shape[1]), 0
        for at in range(0, len(data), _AT_ONCE):
            part = data[at : at + _AT_ONCE + max(ORDERS) - 1]
            if at and len(part) < max(ORDERS):
                break
            found = grams(part)
            if len(found) > BUCKETS:
                total += np.bincount(found, minlength=BUCKETS) @ self.table
            else:
                total += self.table[found].sum(axis=0, dtype=np.float64)
            seen += len(found)
        means, known = total / max(seen, 1), len(model.languages)
        sure = _softmax((means[:known] + model.bias) / model.temperature)
        best = int(sure.argmax())
        familiar = model.familiarity(means[known + best], np.float64(seen), best)
        return model.languages[best], float(sure[best]), bool(_decided(sure) < model.threshold or familiar < model.least_familiar)


def held_out(doc_id: Column) -> Column:
    """Documents that are never learned from: every fourth one by the checksum of its id."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def fit(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "lang") -> Model | None:
    """A model of the documents that are labelled and not held out."""
    labelled = docs.select(
        column(id_column).cast("long").alias("doc_id"), column(text_column).cast("string").alias("text"),
        column(label_column).cast("string").alias("lang"),
    ).where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    return train(sample(labelled))


def identify(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "lang") -> DataFrame:
    """Fit on the labelled documents and predict all: `doc_id, held_out, lang_pred, score, rejected`."""
    found = predict(docs, fit(docs, id_column, text_column, label_column), id_column, text_column)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")


def keep_known(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "lang") -> DataFrame:
    """`docs` without rejected documents, all columns as they are.

    The model goes through every row where it lies, so there is no join by id.
    """
    model = fit(docs, id_column, text_column, label_column)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    # Other columns pass through as they are, whatever their names.
    names = [f"c{i}" for i in range(len(docs.columns))]
    at = docs.columns.index(text_column)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        scorer = Scorer(known) if known else None
        for batch in slices(batches):
            texts = batch.column(at).to_pylist()
            fits = [bool(scorer and text and _LETTER.search(text)) and not scorer(text)[2] for text in texts]
            yield batch.filter(pa.array(fits, pa.bool_()))

    plain = docs.select(*[column(old).alias(name) for old, name in zip(docs.columns, names)])
    kept = in_tasks(plain, work, plain.schema)
    return kept.select(*[F.col(name).alias(old) for old, name in zip(docs.columns, names)])
