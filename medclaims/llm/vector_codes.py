"""Operator 11: product codes of vectors, the nearest entries found by equal-average search.

Components become whole numbers ``floor(256 * x)``. A vector's ``parts`` equal parts are
coded each by the nearest entry of that part's codebook (squared Euclidean distance, ties
to the lower entry). Codebooks begin with the parts of the vectors of least ``vec_id``; a
round assigns every part and moves each entry to the floor of its parts' mean.

A part's entries are sorted by the sum of their components. The search begins at the
part's own sum and goes outward, always to the nearer sum: a squared gap of sums is at
most the dimension times the squared distance, so the search ends when the squared gap
over the dimension strictly exceeds the best distance, and no entry that is nearer, or
as near with a lower index, is left out. All arithmetic is in whole numbers.

A round moves one row of sums for each task and entry; the driver holds the
codebooks only (entries x length numbers).

Vectors that are NULL or hold NULL or non-finite components are dropped, as are those
whose length is not a positive multiple of ``parts``. The length is that of the least
remaining id (the shorter one of an id of two lengths); vectors of other lengths
are dropped, too. Of several rows with one of the least ids, the least vector is an
entry; rows with a NULL id are coded but are no first entries. Repeated rows each count.
Fewer ids than entries make a smaller codebook; with none, or no rows, the result is
empty. A component of ``2**23 / length`` or more could overflow the sums and is an error.
Other columns are never looked at.
"""

import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medclaims.llm.common import scratch

SCALE = 256
PARTS = 16
ENTRIES = 64
ROUNDS = 2
# tasks that thin out the candidates for the first entries before they are sorted
_THINNING = 64
# vectors that are searched at once
_STEP = 4096
_FAR = 1 << 62


def _whole(parts: int):
    """Usable vectors as little-endian 32-bit whole numbers."""
    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column("embedding").cast(pa.list_(pa.float64()))
            lengths = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            flat = pc.fill_null(vectors.flatten(), float("nan")).to_numpy(zero_copy_only=False)
            ends = np.cumsum(lengths)
            unusable = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
            usable = (unusable[ends] == unusable[ends - lengths]) & (lengths > 0) & (lengths % parts == 0)
            scaled = np.floor(np.where(np.isfinite(flat), flat, 0) * SCALE)
            if (np.abs(scaled) >= np.repeat((1 << 31) // np.maximum(lengths, 1), lengths))[np.repeat(usable, lengths)].any():
                raise ValueError("a component is too large: sums of squares could overflow")
            scaled = scaled.astype("<i4")
            places = np.flatnonzero(usable)
            blobs = [scaled[ends[i] - lengths[i] : ends[i]].tobytes() for i in places]
            kept = batch.take(pa.array(places))
            yield pa.RecordBatch.from_arrays(
                [kept.column("vec_id"), kept.column("label"), pa.array(lengths[places], pa.int32()), pa.array(blobs, pa.binary())],
                ["vec_id", "label", "length", "vector"],
            )

    return whole


def whole_vectors(embeddings: DataFrame, parts: int = PARTS) -> DataFrame:
    """(vec_id, label, length, vector) of the usable rows of one length; stored."""
    schema = embeddings.schema
    kinds = ", ".join(f"{c} {schema[c].dataType.simpleString()}" for c in ("vec_id", "label"))
    chosen = embeddings.select("vec_id", "label", "embedding")
    vectors = scratch(chosen.mapInArrow(_whole(parts), f"{kinds}, length int, vector binary"), "vectors")
    first = vectors.where("vec_id IS NOT NULL").agg(F.min(F.struct("vec_id", "length")).alias("first")).first().first
    return vectors.where(F.col("length") == (first.length if first else 0))


def _least(n: int):
    """The least ``n`` ids of a task, each with its least vector."""
    def least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[object, tuple[int, ...]] = {}
        kind = None
        for batch in batches:
            kind = batch.schema.field("vec_id").type
            for vec_id, blob in zip(batch.column("vec_id").to_pylist(), batch.column("vector").to_pylist()):
                vector = tuple(np.frombuffer(blob, "<i4").tolist())
                held[vec_id] = min(vector, held.get(vec_id, vector))
            held = {i: held[i] for i in heapq.nsmallest(n, held)}
        if held:
            blobs = [np.array(v, "<i4").tobytes() for v in held.values()]
            yield pa.RecordBatch.from_arrays([pa.array(list(held), kind), pa.array(blobs, pa.binary())], ["vec_id", "vector"])

    return least


def first_codebooks(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES) -> np.ndarray:
    """(part, entry, position): the parts of the vectors of least ids, in order."""
    known = vectors.where("vec_id IS NOT NULL").select("vec_id", "vector")
    few = known.mapInArrow(_least(entries), known.schema)
    # the ids of one task never outgrow a fixed number of tasks' least ones
    fewer = few.repartition(_THINNING, "vec_id").mapInArrow(_least(entries), known.schema)
    rows = fewer.orderBy("vec_id").limit(entries).collect()
    whole = [np.frombuffer(row.vector, "<i4").astype(np.int64) for row in rows]
    return np.array([v.reshape(parts, -1) for v in whole]).transpose(1, 0, 2) if whole else np.empty((parts, 0, 0), np.int64)


class EqualAverageSearch:
    """Codebooks (part, entry, position) sorted by the sums of their entries."""

    def __init__(self, books: np.ndarray):
        self.books = books
        sums = books.sum(2)
        self.order = np.argsort(sums, axis=1, kind="stable")
        self.sums = np.take_along_axis(sums, self.order, 1)
        self.sorted = np.take_along_axis(books, self.order[:, :, None], 1)
        self.looked_at = 0

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry and squared distance of every part of (n, part, position) vectors."""
        parts, entries, size = self.books.shape
        n = len(vectors)
        x, part = vectors.reshape(-1, size), np.tile(np.arange(parts), n)
        own = x.sum(1)
        starts = [np.searchsorted(self.sums[p], own[p::parts]) for p in range(parts)]
        right = np.stack(starts, 1).reshape(-1)
        left = right - 1
        best, entry = np.full(len(x), _FAR // size), np.full(len(x), entries)
        at = np.arange(len(x))  # parts still searched; x .. right are theirs
        while len(at):
            below = np.where(left >= 0, own - self.sums[part, np.maximum(left, 0)], _FAR)
            above = np.where(right < entries, self.sums[part, np.minimum(right, entries - 1)] - own, _FAR)
            gap = np.minimum(below, above)
            near = np.minimum(gap, 1 << 31)  # no gap but the missing one is as wide
            on = (gap < _FAR) & (near * near <= best[at] * size)
            at, x, part, own, left, right, lower = (a[on] for a in (at, x, part, own, left, right, below <= above))
            place = np.where(lower, left, right)
            distance = ((x - self.sorted[part, place]) ** 2).sum(1)
            found = self.order[part, place]
            better = (distance < best[at]) | ((distance == best[at]) & (found < entry[at]))
            best[at[better]], entry[at[better]] = distance[better], found[better]
            left, right = left - lower, right + ~lower
            self.looked_at += len(at)
        return entry.reshape(n, parts), best.reshape(n, parts)


def _matrix(column: pa.Array, parts: int) -> np.ndarray:
    blobs = column.to_pylist()
    return np.frombuffer(b"".join(blobs), "<i4").astype(np.int64).reshape(len(blobs), parts, -1)


def _steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, _STEP):
            yield batch.slice(at, _STEP)


def _sums(books: np.ndarray):
    """(part, entry, n, sums): the parts of a task that each entry is nearest to."""
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = EqualAverageSearch(books)
        parts, entries, size = books.shape
        counts, totals = np.zeros(parts * entries, np.int64), np.zeros((parts * entries, size), np.int64)
        for batch in _steps(batches):
            vectors = _matrix(batch.column("vector"), parts)
            keys = (search.nearest(vectors)[0] + np.arange(parts) * entries).reshape(-1)
            counts += np.bincount(keys, minlength=len(counts))
            np.add.at(totals, keys, vectors.reshape(-1, size))
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used // entries, pa.int32()), pa.array(used % entries, pa.int32()), pa.array(counts[used], pa.int64()),
             pa.array(totals[used].tolist(), pa.list_(pa.int64()))],
            ["part", "entry", "n", "sums"],
        )

    return sums


def train(vectors: DataFrame, books: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """The codebooks after ``rounds`` rounds over all vectors."""
    size = books.shape[2]
    for _ in range(rounds):
        sent = vectors.select("vector").mapInArrow(_sums(books), "part int, entry int, n long, sums array<long>")
        totals = [F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(size)]
        books = books.copy()
        for part, entry, n, *sums in sent.groupBy("part", "entry").agg(F.sum("n"), *totals).collect():
            books[part, entry] = [total // n for total in sums]
    return books


def _codes(books: np.ndarray):
    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = EqualAverageSearch(books)
        for batch in _steps(batches):
            entry, distance = search.nearest(_matrix(batch.column("vector"), books.shape[0]))
            hexes = [row.tobytes().hex() for row in entry.astype(np.uint8)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array(hexes, pa.string()), pa.array(distance.sum(1), pa.int64())],
                ["vec_id", "label", "code", "error"],
            )

    return codes


def encode(
    embeddings: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, label, code, error) of every usable vector, stored, and the codebooks."""
    if not 0 < entries <= 256:
        raise ValueError("an entry is written as two hexadecimal digits")
    vectors = whole_vectors(embeddings, parts)
    kinds = [vectors.schema[c] for c in ("vec_id", "label")]
    schema = ", ".join([f"{k.name} {k.dataType.simpleString()}" for k in kinds] + ["code string", "error long"])
    books = first_codebooks(vectors, parts, entries)
    if books.shape[1]:
        books = train(vectors, books, rounds)
    else:
        vectors = vectors.limit(0)
    return scratch(vectors.mapInArrow(_codes(books), schema), "codes"), books


def books_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def code_vectors(
    embeddings: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
) -> DataFrame:
    """Code, error and the error of its label for every usable vector, and a digest of the codebooks."""
    codes, books = encode(embeddings, parts, entries, rounds)
    errors = codes.groupBy(F.col("label").alias("same")).agg(F.sum("error").alias("label_error"))
    joined = codes.join(errors, F.col("label").eqNullSafe(F.col("same")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256"))
