"""Operator 1: substring dedup by relative Lempel-Ziv parsing.

A document is factored against the whole corpus as its reference. A factor counts
if it is at least ``WINDOW`` words long, that is if each window of it occurs elsewhere
too; all its words are removed, first occurrences included.

1. The reference is indexed by blocks: in each window, the run of ``SEED`` words with
   the least hash stands for it, so equal windows have equal seeds. Seeds that occur
   once are the end of their windows; only blocks around repeated seeds go on.
2. Each window at a repeated seed is a phrase that starts at its own word. Phrases are compared
   exactly by 64-bit hashes among those that share a longer run of words around the
   seed: the run left of the seed for windows that lie mostly left of it, right for the others.
3. Per document, phrases found elsewhere are parsed greedily into factors. Since
   every window start is looked up, those across the boundary of two factors are checked as well.

Both exchanges first compare the documents that a task holds. What repeats there
is known, and only one witness of it is sent on, so that a passage in very many documents
reaches a task once for each batch of documents rather than once for each document.

NULL and empty texts have no words. Repeated rows are occurrences of their own, so
windows of a repeated document go in all of them; rows are told apart by ``doc_id`` and text.
Texts shorter than a window are left alone; a very long one is
held whole by a task, some numbers for each of its words. Other columns are never looked at, and an empty
table gives an empty result.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from medclaims.llm.common import byte_texts, groups, mixed, rolling, scratch, word_hashes

WINDOW = 35
SEED = 18
# words that a task compares at once before it sends anything
_WORDS_AT_ONCE = 1 << 20


def seeds(hashes: np.ndarray, window: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Seed position of every window, and (position, hash) of each seed in use."""
    runs = rolling(hashes, seed)
    n, span = len(hashes) - window + 1, window - seed + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
    views = np.lib.stride_tricks.sliding_window_view(runs, span)
    at = np.arange(n) + views.argmin(1)
    used = np.unique(at)
    return at, used, runs[used]


def _row_key(doc_id, text: bytes) -> int:
    """Tells rows apart: a hash of id and text."""
    return xxhash.xxh3_64_intdigest(text, seed=0 if doc_id is None else (doc_id + 1) & 0xFFFFFFFFFFFFFFFF)


def _signed(values: np.ndarray) -> np.ndarray:
    return values.astype(np.uint64).view(np.int64)


def _send_seeds(window: int, seed: int):
    schema = pa.schema([("key", pa.int64()), ("row", pa.int64()), ("at", pa.int32()), ("known", pa.bool_())])

    def emit(parts: list[tuple[int, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        row = np.repeat(np.array([p[0] for p in parts], np.uint64), [len(p[1]) for p in parts])
        at, key = (np.concatenate([p[i] for p in parts]) for i in (1, 2))
        values, first, which, times = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
        known = times[which] > 1
        # a known row needs no company: any key will do
        key = np.where(known, mixed(row + at.astype(np.uint64)), key)
        witness = values[times > 1]
        return pa.RecordBatch.from_arrays([
            pa.array(_signed(np.concatenate([key, witness]))),
            pa.array(np.concatenate([_signed(row), np.zeros(len(witness), np.int64)])),
            pa.array(np.concatenate([at, np.full(len(witness), -1)]).astype(np.int32)),
            pa.array(np.concatenate([known, np.zeros(len(witness), bool)])),
        ], schema=schema)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, total = [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), byte_texts(batch.column("text"))):
                _, at, key = seeds(word_hashes(text.split()), window, seed)
                if len(at):
                    parts.append((_row_key(doc_id, text), at, key))
                    total += len(at)
                if total >= _WORDS_AT_ONCE // 4:
                    yield emit(parts)
                    parts, total = [], 0
        if parts:
            yield emit(parts)

    return send


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with their key and compressed text, for the joins."""
    squeeze = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        texts, ids = byte_texts(batch.column("text")), batch.column("doc_id")
        yield pa.RecordBatch.from_arrays([
            ids, pa.array(_signed(np.array([_row_key(i, t) for i, t in zip(ids.to_pylist(), texts)], np.uint64))),
            pa.array([squeeze.compress(text) for text in texts], pa.binary()),
        ], ["doc_id", "row", "packed"])


def _unpack(column: pa.Array) -> Iterator[bytes]:
    open_ = zstandard.ZstdDecompressor()
    return (open_.decompress(packed) for packed in column.to_pylist())


PHRASES = "key long, row long, start int, phrases array<long>, known long"


def _phrase_runs(text: bytes, at: list[int], window: int, seed: int):
    """Keys, first starts, sizes and phrases of the runs at the given seeds.

    A seed's windows are neighbours. Those that start far left of it all hold the
    words before it, the others those after it, which makes their keys.
    """
    left_by = (window - seed + 1) // 2
    hashes = word_hashes(text.split())
    seed_of, _, _ = seeds(hashes, window, seed)
    start = np.flatnonzero(np.isin(seed_of, at))
    place = seed_of[start]
    around = np.where(start > place - left_by, place, place - left_by)
    first = np.ones(len(start), bool)
    first[1:] = (np.diff(start) != 1) | (np.diff(place) != 0) | (np.diff(around) != 0)
    begins = np.flatnonzero(first)
    sizes = np.diff(np.append(begins, len(start)))
    return rolling(hashes, seed + left_by)[around[begins]], start[begins], sizes, rolling(hashes, window)[start]


def _send_phrases(window: int, seed: int):
    """Runs of phrases at repeated seeds. ``known`` has a bit for each phrase that
    this task met twice; runs that have only such, with witnesses elsewhere, meet no others."""

    def emit(parts: list[tuple]) -> pa.RecordBatch:
        key, start, sizes, phrase = (np.concatenate([p[i] for p in parts]) for i in range(1, 5))
        row = np.repeat(np.array([p[0] for p in parts], np.uint64), [len(p[1]) for p in parts])
        run = np.repeat(np.arange(len(sizes)), sizes)
        place = np.arange(len(phrase)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        _, first, which, times = np.unique(phrase, return_index=True, return_inverse=True, return_counts=True)
        many = times[which] > 1
        alone = ~many
        alone[first] = True
        known = np.bincount(run, many * (1 << place), len(sizes)).astype(np.int64)
        idle = np.bincount(run, alone, len(sizes)) == 0
        key = np.where(idle, mixed(row + start.astype(np.uint64)), key)
        sent = np.where(idle, 0, sizes)
        offsets = np.append(0, np.cumsum(sent)).astype(np.int32)
        return pa.RecordBatch.from_arrays([
            pa.array(_signed(key)), pa.array(_signed(row)), pa.array(start.astype(np.int32)),
            pa.ListArray.from_arrays(pa.array(offsets), pa.array(_signed(phrase[~idle[run]]))), pa.array(known),
        ], ["key", "row", "start", "phrases", "known"])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, total = [], 0
        for batch in batches:
            texts = _unpack(batch.column("packed"))
            for row, text, at in zip(batch.column("row").to_pylist(), texts, batch.column("ats").to_pylist()):
                runs = _phrase_runs(text, at, window, seed)
                parts.append((row & 0xFFFFFFFFFFFFFFFF, *runs))
                total += len(runs[3])
                if total >= _WORDS_AT_ONCE // 2:
                    yield emit(parts)
                    parts, total = [], 0
        if parts:
            yield emit(parts)

    return send


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Which phrases of runs with one key occur twice; a bit for each."""
    for table in groups(batches, "key"):
        table = table.combine_chunks()
        lists = table.column("phrases").combine_chunks()
        sizes = np.diff(lists.offsets.to_numpy())
        phrase = lists.flatten().to_numpy()
        key = np.repeat(table.column("key").to_numpy(), sizes)
        order = np.lexsort((phrase, key))
        same = (phrase[order][1:] == phrase[order][:-1]) & (key[order][1:] == key[order][:-1])
        twice = np.zeros(len(phrase), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        run = np.repeat(np.arange(len(sizes)), sizes)
        place = np.arange(len(phrase)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        bits = np.bincount(run, twice * (1 << place), len(sizes)).astype(np.int64) | table.column("known").to_numpy()
        some = bits != 0
        yield pa.RecordBatch.from_arrays(
            [pa.array(table.column(c).to_numpy()[some]) for c in ("row", "start")] + [pa.array(bits[some])],
            ["row", "start", "bits"],
        )


def factors(starts: np.ndarray, window: int) -> list[tuple[int, int]]:
    """Greedy parse: spans [first, end) of words, from the sorted window starts found elsewhere."""
    found: list[list[int]] = []
    for start in starts.tolist():
        if found and start <= found[-1][1]:
            found[-1][1] = start + window
        else:
            found.append([start, start + window])
    return [tuple(span) for span in found]


RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string, spans array<struct<first_word:int,end_word:int>>"


def _found_starts(found: pa.ListArray) -> list[np.ndarray]:
    """Sorted window starts of each document, from its (start, bits)."""
    runs = found.flatten()
    start, bits = runs.field("start").to_numpy(), runs.field("bits").to_numpy()
    run, place = np.nonzero((bits[:, None] >> np.arange(max(1, int(bits.max(initial=0)).bit_length()))) & 1)
    sizes = pc.fill_null(pc.list_value_length(found), 0).to_numpy()
    of_doc = np.repeat(np.arange(len(sizes)), sizes)[run]
    return [np.unique(some) for some in np.split(start[run] + place, np.searchsorted(of_doc, np.arange(1, len(sizes))))]


def _cut(window: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = []
            for text, starts in zip(_unpack(batch.column("packed")), _found_starts(batch.column("found"))):
                words = text.split()
                spans = factors(starts, window)
                kept, end = [], 0
                for first, last in spans:
                    kept += words[end:first]
                    end = last
                kept += words[end:]
                rows.append((len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest(),
                             [{"first_word": a, "end_word": b} for a, b in spans]))
            columns = list(zip(*rows))
            span = pa.list_(pa.struct([("first_word", pa.int32()), ("end_word", pa.int32())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()),
                 pa.array(columns[2]), pa.array(columns[3], span)],
                ["doc_id", "n_words", "n_removed", "kept_sha256", "spans"],
            )

    return cut


def repeated_seeds(docs: DataFrame, window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """(row, ats): positions of the seeds that occur more than once."""
    sent = docs.select("doc_id", "text").mapInArrow(_send_seeds(window, seed), "key long, row long, at int, known boolean")
    # rows of a key are few: a task sends each key once
    met = sent.withColumn("times", F.count("*").over(Window.partitionBy("key")))
    return met.where("(known OR times > 1) AND at >= 0").groupBy("row").agg(F.collect_set("at").alias("ats"))


def remove_repeats(docs: DataFrame, window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """Counts, a digest of the kept words, and the removed spans of every document."""
    if not 0 < seed <= window < seed + 50:
        raise ValueError("a run of phrases would not fit its bits")
    packed = docs.select("doc_id", "text").mapInArrow(_pack, "doc_id long, row long, packed binary")
    ats = scratch(repeated_seeds(docs, window, seed), "seeds")
    phrases = packed.select("row", "packed").join(ats, "row").mapInArrow(_send_phrases(window, seed), PHRASES)
    met = phrases.repartition("key").sortWithinPartitions("key").mapInArrow(_meet, "row long, start int, bits long")
    found = scratch(met.groupBy("row").agg(F.collect_set(F.struct("start", "bits")).alias("found")), "found")
    return packed.join(found, "row", "left").select("doc_id", "packed", "found").mapInArrow(_cut(window), RESULT)
