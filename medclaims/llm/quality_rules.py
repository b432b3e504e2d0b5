"""Operator 4: quality rules with an isolation forest on rule statistics.

Counts are taken over the whole text. Two base rules fail a document outright.
An isolation forest on rates made of the counts gives every document an
anomaly score from its mean path length over random splits; documents above a
threshold are dropped. The forest is grown on documents labelled good that pass
the base rules, so that junk does not pass for ordinary; its splits are drawn
from the ranges of all documents that pass, so that what good ones never have
can be told. The threshold is calibrated on all labelled rows: of those above
which lie at most ``FALSE_ALARMS`` of the good ones, the one that drops most bad ones.

NULL text has no words and fails, as does an empty one. Without labelled good
rows only the base rules decide. NULL labels are ignored; of several labels of
one document the worst counts. Repeated rows are judged alike; a very long text is counted
whole by one task. An empty table
gives an empty result; other columns are never looked at.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medclaims.llm.common import byte_texts, covered, hash_sample, rolling, scratch, word_hashes

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\v\f\r"
REPEAT_WORDS = 5
LEAST_WORDS = 10
MOST_REPEATED_PERCENT = 20

# the forest is fitted on a bounded sample of the good documents, the rows of least hash
SAMPLE_ROWS = 8192
TREES = 100
TREE_ROWS = 256
SEED = 17
FALSE_ALARMS = 0.002
_BINS = 4000

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def counts_of(text: bytes) -> tuple[int, ...]:
    """The five counts of a text, in the order of ``COUNTS``."""
    words = text.split()
    decoded = text.decode()
    grams = rolling(word_hashes(words), REPEAT_WORDS)
    repeats = 0
    if len(grams):
        _, which, times = np.unique(grams, return_inverse=True, return_counts=True)
        repeats = int(covered(np.flatnonzero(times[which] > 1), REPEAT_WORDS, len(words)).sum())
    lines = [line for line in text.split(b"\n") if line.strip()]
    return (
        len(words),
        len(decoded) - sum(map(decoded.count, SPACES)),
        sum(map(decoded.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeats,
    )


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = np.array([counts_of(text) for text in byte_texts(batch.column("text"))], np.int64).reshape(-1, 5)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *[pa.array(column.copy()) for column in rows.T]], ["doc_id", *COUNTS]
        )


def statistics(docs: DataFrame) -> DataFrame:
    """The five counts and the base verdict of every document."""
    columns = ", ".join(f"{name} long" for name in COUNTS)
    return docs.select("doc_id", "text").mapInArrow(_count, f"doc_id long, {columns}").withColumn(
        "base_failed",
        (F.col("n_words") < LEAST_WORDS)
        | (F.col("n_repeat_words") * 100 > F.col("n_words") * MOST_REPEATED_PERCENT),
    )


def rates(counts: np.ndarray) -> np.ndarray:
    """What the forest splits on, from rows of counts."""
    words, chars, symbols, lines, repeats = counts.astype(float).T
    some = np.maximum(words, 1)
    return np.log1p(
        np.stack([chars / some, 1000 * symbols / np.maximum(chars, 1), 10 * lines / some, 10 * repeats / some], axis=1)
    )


def _mean_path(n: np.ndarray | float) -> np.ndarray:
    """Expected depth of an unsuccessful search among n rows."""
    n = np.maximum(n, 1.0)
    harmonic = np.log(np.maximum(n - 1, 1)) + np.euler_gamma
    return np.where(n > 2, 2 * harmonic - 2 * (n - 1) / n, np.where(n == 2, 1.0, 0.0))


@dataclass
class Forest:
    """Trees as arrays by node: what to split on, where, and the children; a leaf
    has feature -1 and its path length as ``at``."""

    feature: np.ndarray
    at: np.ndarray
    child: np.ndarray
    tree_rows: int

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """2 ** (-mean path / expected path): near 1 is anomalous, below 0.5 is ordinary."""
        total = np.zeros(len(rows))
        every = np.arange(len(rows))
        for feature, at, child in zip(self.feature, self.at, self.child):
            node = np.zeros(len(rows), np.int64)
            while len(inner := every[feature[node] >= 0]):
                here = node[inner]
                right = rows[inner, feature[here]] >= at[here]
                node[inner] = child[here] + right
            total += at[node]
        return 2.0 ** (-total / len(self.feature) / float(_mean_path(float(self.tree_rows))))


def grow(
    rows: np.ndarray, trees: int = TREES, tree_rows: int = TREE_ROWS, seed: int = SEED, span: np.ndarray | None = None
) -> Forest:
    """An isolation forest: each tree splits a few rows at random until alone.

    Splits are drawn from ``span`` (least and greatest of each feature, those of
    the rows if not given), not from what the rows of a node happen to have.
    """
    random = np.random.default_rng(seed)
    tree_rows = min(tree_rows, len(rows))
    most_depth = int(np.ceil(np.log2(max(tree_rows, 2))))
    nodes = 2 ** (most_depth + 1)
    forest = Forest(np.full((trees, nodes), -1), np.zeros((trees, nodes)), np.zeros((trees, nodes), np.int64), tree_rows)
    span = np.stack([rows.min(0), rows.max(0)]) if span is None else span
    for tree in range(trees):
        todo = [(0, rows[random.choice(len(rows), tree_rows, replace=False)], 0, *span)]
        used = 1
        while todo:
            node, some, depth, low, high = todo.pop()
            varied = np.flatnonzero(high > low)
            if depth == most_depth or len(some) < 2 or not len(varied):
                forest.at[tree, node] = depth + _mean_path(float(len(some)))
                continue
            feature = random.choice(varied)
            at = random.uniform(low[feature], high[feature])
            if at <= low[feature]:
                at = high[feature]
            right = some[:, feature] >= at
            below, above = high.copy(), low.copy()
            below[feature] = above[feature] = at
            forest.feature[tree, node], forest.at[tree, node], forest.child[tree, node] = feature, at, used
            todo += [(used, some[~right], depth + 1, low, below), (used + 1, some[right], depth + 1, above, high)]
            used += 2
    return forest


def _score(forest: Forest):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = np.stack([batch.column(name).to_numpy() for name in COUNTS], axis=1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(forest.scores(rates(counts)))], [*batch.schema.names, "anomaly"]
            )

    return score


def worst_labels(labels: DataFrame) -> DataFrame:
    """One label a document, the worst."""
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
    return known.groupBy("doc_id").agg(F.min("quality").alias("quality"))


def best_edge(good: dict[int, int], bad: dict[int, int], false_alarms: float = FALSE_ALARMS) -> int:
    """The bin from which on to drop: at most that share of the good go, as many bad
    ones as then can, and no more good ones than that takes."""
    allowed, edge, caught = false_alarms * sum(good.values()), _BINS + 1, 0
    lost = found = 0
    for bin_ in range(_BINS, -1, -1):
        lost, found = lost + good.get(bin_, 0), found + bad.get(bin_, 0)
        if lost > allowed:
            break
        # without labelled bad rows the lowest edge is taken
        if found > caught or not bad:
            edge, caught = bin_, found
    return edge


def threshold(scored: DataFrame, labels: DataFrame, false_alarms: float = FALSE_ALARMS) -> float:
    """The score from which documents are dropped, from all labelled ones that pass the base rules."""
    known = scored.where(~F.col("base_failed")).join(worst_labels(labels).where("quality IN (0, 1)"), "doc_id")
    # one row per label and bin
    bins = {0: {}, 1: {}}
    for row in known.groupBy("quality", F.floor(F.col("anomaly") * _BINS).cast("int").alias("bin")).count().collect():
        bins[row["quality"]][row["bin"]] = row["count"]
    return best_edge(bins[1], bins[0], false_alarms) / _BINS if bins[1] else 2.0


def _sample(rows: DataFrame) -> np.ndarray:
    """Counts of the rows of least hash; repeated rows count once."""
    key = ["doc_id", *COUNTS]
    return hash_sample(rows.select(*key).distinct(), key, SAMPLE_ROWS).select(*COUNTS).toPandas().to_numpy(np.int64).reshape(-1, len(COUNTS))


def _span(rows: DataFrame) -> np.ndarray:
    """Least and greatest of each rate over all the rows."""

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = rates(np.stack([batch.column(name).to_numpy() for name in COUNTS], axis=1))
                columns = [pa.array(end) for end in (*found.min(0)[:, None], *found.max(0)[:, None])]
                yield pa.RecordBatch.from_arrays(columns, names)

    n = rates(np.zeros((1, len(COUNTS)), np.int64)).shape[1]
    names = [f"{end}{i}" for end in ("low", "high") for i in range(n)]
    found = rows.select(*COUNTS).mapInArrow(ends, ", ".join(f"{name} double" for name in names))
    return np.array(found.agg(*[(F.min if name[0] == "l" else F.max)(name) for name in names]).first()).reshape(2, n)


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Counts, base verdict, anomaly score and verdict of every document."""
    stats = scratch(statistics(docs), "rule_statistics")
    passed = stats.where(~F.col("base_failed"))
    sample = _sample(passed.join(worst_labels(labels).where("quality = 1"), "doc_id"))
    if not len(sample):
        # only the base rules decide then; the score is against all that pass them
        sample = _sample(passed)
    if not len(sample):
        return stats.select("*", F.lit(0.0).alias("anomaly"), F.lit(False).alias("kept"))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in stats.schema.fields)
    forest = grow(rates(sample), span=_span(passed))
    scored = scratch(stats.mapInArrow(_score(forest), f"{schema}, anomaly double"), "anomalies")
    limit = threshold(scored, labels)
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("anomaly") < limit))
