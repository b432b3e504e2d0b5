"""Operator 6: a quality classifier by co-training.

Two views of a document: its text (character and word statistics, hashed
character pairs) and its metadata (source, language, declared length). Each view
has a logistic regression. In every round each view labels the unlabelled documents
that it is most sure of, all of them, and those labels train the *other* view: tasks
send the slope and curvature of the loss over their documents, and the labels of a class together
weigh a share of the given labels at most. Both views are calibrated on labelled
documents kept apart, and a last small regression on the calibrated log-odds combines
them. A document is rejected above the score that at most ``FALSE_ALARMS`` of
all good documents kept apart exceed.

The regressions on given labels, and the calibrations, are fitted on bounded samples
(``LABELLED`` labelled documents, those whose id has the least hash); pseudo-labels, the
limit and the scores cover all documents. Weights are rounded at each step, so that the
order in which tasks are summed leaves no trace.

NULL text is an empty one, NULL metadata a value of its own. NULL labels are
ignored; of several labels the worst counts; of several rows with a labelled id, the
one of least text digest is learned from. With labels of one class only, or none kept
apart, nothing is rejected. Repeated rows are judged alike. Very long texts take no more than
some numbers for each of their bytes. An empty table gives an empty result.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medclaims.llm.common import hash_sample, scratch, scratch_scope

LABELLED = 8000
ROUNDS = 3
# steps over all documents in a round
STEPS = 3
# how sure a view must be of a label
CONFIDENT = 0.97
# what a class's pseudo-labels together weigh at most, in given labels
PSEUDO_SHARE = 0.5
FALSE_ALARMS = 0.002
# tasks that add up what the others send
_SUM_TASKS = 16
# steps of log-odds that the limit is told by
_BINS_PER_UNIT = 1000
# rows whose matrices are made at once
_STEP = 4096

_PAIRS, _SOURCES, _LANGS, _SIZES = 128, 64, 16, 16
_KINDS = np.zeros(256, np.int64)
for _kind, _bytes in enumerate((b"#*$%&|<>", b"!?", b".,;:", b"0123456789", b" \t\n\v\f\r", bytes(range(65, 91)), bytes(range(97, 123)), bytes(range(128, 256)))):
    _KINDS[list(_bytes)] = _kind + 1
VIEW_COLUMNS = ["text", "lang", "source", "n_chars"]


def text_view(text: str | None) -> np.ndarray:
    """Statistics and hashed byte pairs of a whole text."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    codes = np.frombuffer(raw, np.uint8).astype(np.int64)
    words = raw.split()
    n, some = len(words), max(len(words), 1)
    lengths = np.fromiter(map(len, words), float, n) if n else np.zeros(1)
    lines = [line for line in raw.split(b"\n") if line.strip()]
    pairs = np.bincount(((codes[:-1] * 256 + codes[1:]) * 2654435761 >> 15) % _PAIRS, minlength=_PAIRS)
    stats = [
        np.log1p(n), np.log1p(len(raw)), lengths.mean(), lengths.std(),
        len(set(words)) / some, sum(a == b for a, b in zip(words, words[1:])) / some,
        (len(lines) - len(set(lines))) / max(len(lines), 1), len(lines) / some,
        *np.sqrt(np.bincount(_KINDS[codes], minlength=9) / max(len(raw), 1)),
    ]
    return np.concatenate([stats, np.sqrt(pairs / max(len(raw), 1))])


def _hashed(value, buckets: int) -> int:
    return 0 if value is None else 1 + xxhash.xxh3_64_intdigest(str(value)) % (buckets - 1)


def metadata_view(lang: str | None, source: str | None, n_chars: float | None) -> np.ndarray:
    """One of each: source, language and size class, hashed; and the log size."""
    known = n_chars is not None and n_chars == n_chars and n_chars >= 0
    size = float(np.log1p(n_chars)) if known else 0.0
    view = np.zeros(_SOURCES + _LANGS + _SIZES + 1)
    view[_hashed(source, _SOURCES)] = 1
    view[_SOURCES + _hashed(lang, _LANGS)] = 1
    view[_SOURCES + _LANGS + (min(int(size), _SIZES - 2) + 1 if known else 0)] = 1
    view[-1] = size
    return view


def views(frame: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    rows = [[None if value is pd.NA or value != value else value for value in row] for row in frame[VIEW_COLUMNS].itertuples(index=False)]
    return (
        np.array([text_view(row[0]) for row in rows], np.float64),
        np.array([metadata_view(*row[1:]) for row in rows], np.float64),
    )


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Regression:
    """Logistic regression on standardised features, by damped Newton steps."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 12) -> "Regression":
        mean, scale = x.mean(0), np.maximum(x.std(0), 1e-6)
        z = np.column_stack([(x - mean) / scale, np.ones(len(x))])
        weights, penalty = np.zeros(z.shape[1]), np.full(z.shape[1], ridge)
        penalty[-1] = 1e-6
        for _ in range(steps):
            p = _sigmoid(z @ weights)
            slope = z.T @ (p - y) + penalty * weights
            curve = (z * (p * (1 - p) + 1e-6)[:, None]).T @ z + np.diag(penalty)
            weights = weights - np.linalg.solve(curve, slope)
        return cls(mean, scale, weights)

    def standardised(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([np.clip((x - self.mean) / self.scale, -20, 20), np.ones(len(x))])

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        return self.standardised(x) @ self.weights

    def sums(self, x: np.ndarray, label: int) -> np.ndarray:
        """Number, slope and curvature, in one row, of documents that are all of one label.

        The curvature is its upper bound, a quarter, so that a step never goes too far.
        """
        z = self.standardised(x)
        return np.concatenate([[len(x)], z.T @ (_sigmoid(z @ self.weights) - label), (z.T @ z).reshape(-1) / 4])

    def stepped(self, sums: list[tuple[float, np.ndarray]], ridge: float = 1.0) -> "Regression":
        """After one step on weighted sums; each lowers the loss."""
        n = len(self.weights)
        penalty = np.full(n, ridge)
        penalty[-1] = 1e-6
        slope, curve = penalty * self.weights, np.diag(penalty)
        for weight, row in sums:
            slope, curve = slope + weight * row[1 : n + 1], curve + weight * row[n + 1 :].reshape(n, n)
        return Regression(self.mean, self.scale, np.round(self.weights - np.linalg.solve(curve, slope), 6))


Views = tuple[np.ndarray, np.ndarray]
Pair = tuple[Regression, Regression]


@dataclass
class Model:
    """The views' regressions, their calibrations, how they combine, and the limit in log-odds."""

    views: Pair
    calibrations: Pair
    combined: Regression
    limit: float

    def odds(self, data: Views) -> np.ndarray:
        """Log-odds of bad of both views and combined, a column each."""
        odds = calibrated(self.views, self.calibrations, data)
        return np.column_stack([odds, self.combined.log_odds(odds)])

    def verdicts(self, frame: pd.DataFrame) -> pd.DataFrame:
        odds = self.odds(views(frame)) if len(frame) else np.empty((0, 3))
        found = pd.DataFrame(_sigmoid(odds), columns=["text_score", "metadata_score", "bad_score"])
        return found.assign(rejected=odds[:, 2] > self.limit)


def calibrated(models: Pair, calibrations: Pair, data: Views) -> np.ndarray:
    return np.column_stack(
        [c.log_odds(m.log_odds(x)[:, None]) for m, c, x in zip(models, calibrations, data)]
    )


def _matrices(batch: pa.RecordBatch | pa.Table) -> Views:
    """The two views of stored rows."""
    return tuple(
        np.frombuffer(b"".join(blobs), "<f4").reshape(len(blobs), -1).astype(np.float64)
        for blobs in (batch.column(c).to_pylist() for c in ("text_view", "metadata_view"))
    )


def sure(labeller: Regression, x: np.ndarray) -> list[np.ndarray]:
    """Which documents are surely of label 0, and which of label 1."""
    p = _sigmoid(labeller.log_odds(x))
    return [p <= 1 - CONFIDENT, p >= CONFIDENT]


def _pseudo_sums(labellers: Pair, models: Pair):
    """(place, sums): for each view and label, the sums over what the *other* view is sure of."""
    def pseudo_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [0.0] * 4
        place = 0
        for batch in batches:
            place = place or hash(batch.column("text_view")[0].as_py()) if batch.num_rows else place
            for first in range(0, batch.num_rows, _STEP):
                data = _matrices(batch.slice(first, _STEP))
                for view in (0, 1):
                    for label, chosen in enumerate(sure(labellers[1 - view], data[1 - view])):
                        if chosen.any():
                            totals[2 * view + label] = totals[2 * view + label] + models[view].sums(data[view][chosen], label)
        yield _sent(place, totals)

    return pseudo_sums


def _sent(place: int, totals: list) -> pa.RecordBatch:
    blobs = [np.asarray(t, np.float64).tobytes() if np.ndim(t) else b"" for t in totals]
    return pa.RecordBatch.from_arrays(
        [pa.array([place % _SUM_TASKS], pa.int32()), pa.array([blobs], pa.list_(pa.binary()))], ["place", "sums"]
    )


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals, some = [0.0] * 4, False
    for batch in batches:
        for blobs in batch.column("sums").to_pylist():
            some = True
            totals = [t + np.frombuffer(b) if b else t for t, b in zip(totals, blobs)]
    if some:
        yield _sent(0, totals)


def pseudo_sums(unlabelled: DataFrame, labellers: Pair, models: Pair) -> list[np.ndarray | None]:
    """Sums by view and label over all documents; added up in two levels."""
    kind = "place int, sums array<binary>"
    sent = unlabelled.select("text_view", "metadata_view").mapInArrow(_pseudo_sums(labellers, models), kind)
    rows = sent.repartition(_SUM_TASKS, "place").mapInArrow(_added, kind).collect()
    totals: list[np.ndarray | None] = [None] * 4
    for row in rows:
        for i, blob in enumerate(row.sums):
            if blob:
                totals[i] = np.frombuffer(blob) + (0 if totals[i] is None else totals[i])
    return totals


def co_train(data: Views, y: np.ndarray, unlabelled: DataFrame) -> tuple[Pair, list[int]]:
    """Both views' regressions after the rounds, and how many pseudo-labels each was last given.

    ``data`` and ``y`` are the labelled documents, ``unlabelled`` has the stored views of all others.
    """
    models = tuple(Regression.fit(x, y) for x in data)
    gained = [0, 0]
    for _ in range(ROUNDS):
        labellers = models
        for _ in range(STEPS):
            totals = pseudo_sums(unlabelled, labellers, models)
            stepped = []
            for view in (0, 1):
                sums = []
                for label in (0, 1):
                    own = data[view][y == label]
                    sums.append((1.0, models[view].sums(own, label)))
                    pseudo = totals[2 * view + label]
                    if pseudo is not None:
                        sums.append((min(1.0, PSEUDO_SHARE * len(own) / pseudo[0]), pseudo))
                stepped.append(models[view].stepped(sums))
            models = tuple(stepped)
        gained = [int(sum(t[0] for t in totals[2 * v : 2 * v + 2] if t is not None)) for v in (0, 1)]
    return models, gained


def _stored_views(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first in range(0, batch.num_rows, _STEP):
            some = batch.slice(first, _STEP)
            text, metadata = views(some.select(VIEW_COLUMNS).to_pandas())
            digests = [xxhash.xxh3_128_digest((t or "").encode("utf-8", "surrogatepass")) for t in some.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [some.column("doc_id"), pa.array(digests, pa.binary()),
                 *[pa.array([row.tobytes() for row in x.astype("<f4")], pa.binary()) for x in (text, metadata)]],
                ["doc_id", "digest", "text_view", "metadata_view"],
            )


def stored_views(docs: DataFrame, known: DataFrame) -> DataFrame:
    """(doc_id, digest, text_view, metadata_view, bad) of all documents; stored.

    Documents without an id have no label, and are dealt out in the join.
    """
    kind = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, digest binary, text_view binary, metadata_view binary"
    rows = docs.select("doc_id", *VIEW_COLUMNS).mapInArrow(_stored_views, kind)
    dealt = F.when(F.col("doc_id").isNull(), F.pmod(F.xxhash64("digest"), F.lit(512))).otherwise(0)
    labels = known.select(F.col("doc_id").alias("known_id"), "bad", F.pmod(F.xxhash64("doc_id"), F.lit(1)).alias("zero"))
    on = (F.col("doc_id") == F.col("known_id")) & (F.col("dealt") == F.col("zero"))
    return scratch(rows.withColumn("dealt", dealt).join(labels, on, "left").drop("known_id", "dealt", "zero"), "views")


def _fetched(rows: DataFrame) -> tuple[Views, np.ndarray]:
    """A bounded sample of labelled documents, in order of their ids' hashes."""
    table = hash_sample(rows, ["doc_id"], LABELLED).toArrow()
    if not table.num_rows:
        return (np.empty((0, 0)), np.empty((0, 0))), np.empty(0, int)
    return _matrices(table), table.column("bad").to_numpy()


def _limit(apart: DataFrame, model: Model) -> float:
    """The log-odds that at most ``FALSE_ALARMS`` of the good documents exceed, from all of them."""
    def bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                odds = np.clip(model.odds(_matrices(batch))[:, 2], -30, 30)
                yield pa.RecordBatch.from_arrays([pa.array(np.ceil(odds * _BINS_PER_UNIT).astype(np.int32))], ["bin"])

    good = apart.where("bad = 0").select("text_view", "metadata_view")
    counts = {r.bin: r["count"] for r in good.mapInArrow(bins, "bin int").groupBy("bin").count().collect()}
    above, edge = 0, 30 * _BINS_PER_UNIT + 1
    for bin_ in sorted(counts, reverse=True):
        edge = bin_
        above += counts[bin_]
        if above > FALSE_ALARMS * sum(counts.values()):
            break
    return max(0.0, edge / _BINS_PER_UNIT)


def train(docs: DataFrame, labels: DataFrame) -> Model | None:
    """Every third labelled id, by hash, is kept apart for the calibrations and the limit."""
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(
        F.max(F.when(F.col("quality") == 0, 1).otherwise(0)).alias("bad")
    )
    with scratch_scope(docs.sparkSession):
        stored = stored_views(docs, known)
        first = F.min(F.struct("digest", "text_view", "metadata_view")).alias("first")
        labelled = stored.where("bad IS NOT NULL").groupBy("doc_id").agg(first, F.max("bad").alias("bad"))
        labelled = scratch(labelled.select("doc_id", "bad", "first.text_view", "first.metadata_view"), "labelled")
        is_apart = F.pmod(F.xxhash64(F.lit("apart"), "doc_id"), F.lit(3)) == 2
        data, y = _fetched(labelled.where(~is_apart))
        held, target = _fetched(labelled.where(is_apart))
        if len(set(y)) < 2 or len(set(target)) < 2:
            return None
        models, _ = co_train(data, y, stored.where("bad IS NULL"))
        calibrations = tuple(Regression.fit(m.log_odds(x)[:, None], target) for m, x in zip(models, held))
        combined = Regression.fit(calibrated(models, calibrations, held), target)
        model = Model(models, calibrations, combined, 0.0)
        model.limit = _limit(labelled.where(is_apart), model)
        return model


def verdict(model: Model | None) -> Column:
    """A struct of the scores and ``rejected``, from the view columns of a row."""
    if model is None:
        none = F.lit(None).cast("double")
        return F.struct(none.alias("text_score"), none.alias("metadata_score"), none.alias("bad_score"), F.lit(False).alias("rejected"))

    @F.pandas_udf("text_score double, metadata_score double, bad_score double, rejected boolean")
    def judge(text: pd.Series, lang: pd.Series, source: pd.Series, n_chars: pd.Series) -> pd.DataFrame:
        return model.verdicts(pd.DataFrame(dict(zip(VIEW_COLUMNS, (text, lang, source, n_chars)))))

    return judge(*VIEW_COLUMNS)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Scores and verdict of every document."""
    return docs.select("doc_id", verdict(train(docs, labels)).alias("verdict")).select("doc_id", "verdict.*")


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not rejected, with all their columns."""
    return docs.where(~verdict(train(docs, labels))["rejected"])
