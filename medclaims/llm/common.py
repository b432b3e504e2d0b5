"""Helpers the corpus operators share: scratch tables, words and rolling hashes.

A word is ``[^\\x20\\x09-\\x0D]+``, which is what ``bytes.split()`` finds.
"""

import uuid
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medclaims.operators.keys import with_surrogate_key
from medclaims.sources.shared_dir import shared_dir
from medclaims.sources.tables import TableStore

WORD_PATTERN = r"[^\x20\x09-\x0D]+"

# odd, so that powers have inverses modulo 2^64
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


def share_package(spark) -> None:
    """Let Python workers look for this package where the driver found it, too."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))


def llm_store(spark) -> TableStore:
    """Tables of this application in the folder all executors share."""
    return TableStore(spark, f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/llm")


# paths written in each open scope, innermost last
_scopes: list[list[str]] = []


@contextmanager
def scratch_scope(spark) -> Iterator[None]:
    """What is written by ``scratch`` inside goes away at the end."""
    _scopes.append([])
    try:
        yield
    finally:
        store = llm_store(spark)
        for path in _scopes.pop():
            store.remove_path(path)


def _note(paths: Iterable[str]) -> None:
    if _scopes:
        _scopes[-1].extend(paths)


def scratch(df: DataFrame, label: str) -> DataFrame:
    """Write an intermediate result to the shared folder and read it back.

    It is then computed once, has a known size and outlives any executor.
    """
    path = f"{llm_store(df.sparkSession).root}/{label}-{uuid.uuid4().hex}"
    _note([path])
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, name: str, order_by) -> DataFrame:
    """``name`` = 1..n in ``order_by`` order, by range partitions and their sizes."""
    store = llm_store(df.sparkSession)
    result = with_surrogate_key(df, name, order_by, store)
    _note(store.scratch_paths())
    return result


def hash_sample(rows: DataFrame, key: Sequence[str], most: int) -> DataFrame:
    """``most`` rows at most, those whose ``key`` has the least hash, whatever their order.

    Only rows under a cut, set by the exact number of rows so that twice as many lie
    under it as are wanted, are brought together. ``key`` should tell rows apart.
    """
    total = rows.count()
    place = F.xxhash64(*key)
    if total > 2 * most:
        rows = rows.where(place < -(1 << 63) + (1 << 64) * 2 * most // total)
    return rows.orderBy(place, *key).limit(most)


def with_rows(docs: DataFrame, label: str) -> DataFrame:
    """The rows stored as (row, doc): ``doc`` holds all columns, whatever their
    names, and ``row`` tells even repeated rows apart."""
    return scratch(docs.select(F.monotonically_increasing_id().alias("row"), F.struct("*").alias("doc")), label)


def byte_texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; NULL becomes empty."""
    return [text or b"" for text in column.cast(pa.binary()).to_pylist()]


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose bits all depend on all bits."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    powers = np.full(n, base, np.uint64)
    powers[:1] = 1
    return np.multiply.accumulate(powers)


def rolling(hashes: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of each run of ``n`` words; empty if there are fewer."""
    if len(hashes) < n:
        return np.empty(0, np.uint64)
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * _powers(_BASE, len(hashes)), out=sums[1:])
    return mixed((sums[n:] - sums[:-n]) * _powers(_BASE_INVERSE, len(hashes) - n + 1))


def covered(starts: np.ndarray, width: int, n: int) -> np.ndarray:
    """Which of ``n`` words lie in a window of ``width`` words at one of ``starts``."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + width, -1)
    return np.cumsum(steps[:-1]) > 0


def groups(batches: Iterable[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables that hold whole runs of equal keys of a sorted partition.

    Runs are bundled, so that many small ones cost one call.
    """
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        changes = np.flatnonzero(keys[1:] != keys[:-1])
        if held[0].column(key)[0].as_py() == keys[-1]:
            continue  # one run so far
        cut = int(changes[-1]) + 1 if len(changes) else 0
        yield pa.Table.from_batches([*held[:-1], batch.slice(0, cut)])
        held = [batch.slice(cut)]
    if held:
        yield pa.Table.from_batches(held)
