"""Operator 8: best-fit packing by exact-complement hashing.

Documents become token ids and an end id; longer ones are cut. Which lengths
share a sequence is planned on the histogram of lengths, which has as many
entries as a sequence has tokens, whatever the corpus size. Sums of single
lengths, pairs and triples are indexed once; from long to short, each length's gap is
looked up there, under availability counts, and a combination that fills it
exactly is used as often as its counts allow. What finds no complement goes
through best fit, longest first, again on counts.

Pieces are numbered within their length by range partitions, and each number
falls into one slot of the plan, so a hot length is spread over tasks.

NULL text is an empty document, one end id long; a very long one is held whole by a task while it is cut. Repeated rows are packed once
each. An empty table gives an empty result; other columns are never looked at.
"""

import os
import re
import zlib
from array import array
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from medclaims.llm.common import byte_texts, numbered, scratch

CAPACITY = 2048
TOKENIZER = "word_bpe_49k.json"
END = b"\0\0\0\0"
# words whose ids a worker remembers, twice this many at most
CACHED_WORDS = 250_000
# bytes; longer words are encoded each time
_LONGEST_CACHED = 48
_DOCS_AT_ONCE = 256
# small Latin-1 letters, which no step before the merges changes
_PLAIN = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+")
_PLAIN_ENDS = {bytes([c]) for c in b"abcdefghijklmnopqrstuvwxyz0123456789"}

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


class _Known(dict):
    """Word -> ids as little-endian bytes; a word that is not there is encoded when it is asked for.

    Holds ``CACHED_WORDS`` words, and as many ``older`` ones that go unless they are met again.
    A very long word is not kept, and one with an end mark only if it was met without.
    """

    def __init__(self, encode: Callable[[bytes], bytes]):
        self.encode, self.older = encode, {}

    def __missing__(self, word: bytes) -> bytes:
        if word[-1:] in (b".", b",") and word[-2:-1] in _PLAIN_ENDS:
            stem = word[:-1]
            if stem not in self:
                return self[stem] + self[word[-1:]]
            ids = self[stem] + self[word[-1:]]
        else:
            ids = self.older.get(word) or self.encode(word)
        if len(word) <= _LONGEST_CACHED:
            if len(self) >= CACHED_WORDS:
                self.older = dict(self)
                self.clear()
            self[word] = ids
        return ids


class WordEncoder:
    """Ids of texts as little-endian bytes, word by word.

    The tokenizer lower-cases, and splits at white space and between letters and
    marks before it merges. So the ids of a text are those of its words in order, and a full stop or
    comma that ends a word is a word of its own. A word of small letters only
    goes straight to the merges, in the letters that stand for its bytes there.
    Frequent words are looked up; those not met for ``CACHED_WORDS`` other ones are forgotten.
    Each Python worker has its own, beside an executor's heap, so it is bounded in words and in their length.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        byte_level = ByteLevel(add_prefix_space=False, use_regex=False)
        self.letters = {b: byte_level.pre_tokenize_str(bytes([0xC3, b]).decode())[0][0][1] for b in range(0x80, 0xC0)}
        self.known = _Known(self._encoded)

    def _encoded(self, word: bytes) -> bytes:
        if word.isalpha() and word.islower():  # ASCII letters stand for themselves
            ids = [token.id for token in self.model.tokenize(word.decode())]
        elif _PLAIN.fullmatch(word):
            ids = [token.id for token in self.model.tokenize(word.decode("latin-1").translate(self.letters))]
        else:
            ids = self.tokenizer.encode_batch_fast([word.decode()], add_special_tokens=False)[0].ids
        return array("I", ids).tobytes()

    def encode(self, texts: list[bytes]) -> Iterator[bytes]:
        for text in texts:
            # a special token is found by its exact letters
            words = (text if b"<|" in text else text.lower()).split()
            yield b"".join(map(self.known.__getitem__, words))


_encoders: dict[str, WordEncoder] = {}


def _encoder(path: str) -> WordEncoder:
    """One for all tasks of a Python worker."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def _cut(path: str, capacity: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path)
        for batch in batches:
            rows = []
            for first in range(0, batch.num_rows, _DOCS_AT_ONCE):
                some = batch.slice(first, _DOCS_AT_ONCE)
                for doc_id, ids in zip(some.column("doc_id").to_pylist(), encoder.encode(byte_texts(some.column("text")))):
                    ids += END
                    for piece, start in enumerate(range(0, len(ids), 4 * capacity)):
                        part = ids[start : start + 4 * capacity]
                        rows.append((doc_id, piece, start // 4, len(part) // 4, zlib.crc32(part)))
            if rows:
                types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                columns = [pa.array(column, kind) for column, kind in zip(zip(*rows), types)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "start", "length", "ids_crc32"])

    return cut


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """Every piece of every document."""
    return docs.select("doc_id", "text").mapInArrow(_cut(tokenizer_path, capacity), PIECES)


class SumIndex:
    """Which one, two or three lengths make up a sum: built once, used up by look-up.

    ``pairs[total]`` are the shorter lengths of the pairs of that sum, the shortest
    first; a triple is its longest length and a pair of what remains. Counts only
    fall, so what was passed over for want of a length never comes back, and each sum keeps
    its place among its pairs and among its triples.
    """

    def __init__(self, left: np.ndarray):
        self.left = left
        have = np.flatnonzero(left).astype(np.int32)
        # the shorter length is half the sum at most
        halves = [have[: np.searchsorted(have, total // 2, "right")] for total in range(len(left))]
        self.pairs = [low[left[total - low] > 0] for total, low in enumerate(halves)]
        self.longest = [have[have < total][::-1] for total in range(len(left))]
        self.at_pair, self.at_triple = [0] * len(left), [0] * len(left)

    def _has(self, *lengths: int) -> bool:
        return all(self.left[length] >= lengths.count(length) for length in lengths)

    def pair(self, total: int) -> tuple[int, ...]:
        """Two available lengths of that sum, the longer one as long as can be."""
        pairs = self.pairs[total]
        while self.at_pair[total] < len(pairs):
            low = int(pairs[self.at_pair[total]])
            if self._has(low, total - low):
                return (total - low, low)
            self.at_pair[total] += 1
        return ()

    def triple(self, total: int) -> tuple[int, ...]:
        """Three available lengths of that sum, the longest as long as can be."""
        longest = self.longest[total]
        while self.at_triple[total] < len(longest):
            first = int(longest[self.at_triple[total]])
            if first * 3 < total:
                break
            if self.left[first]:
                for low in self.pairs[total - first].tolist():
                    if self._has(first, total - first - low, low):
                        return (first, total - first - low, low)
            self.at_triple[total] += 1
        return ()

    def complement(self, gap: int) -> tuple[int, ...]:
        """One, two or three available lengths that sum to the gap."""
        return (gap,) if self.left[gap] else self.pair(gap) or self.triple(gap)


def plan(counts: Mapping[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a sequence, how many such sequences) that use up the counts."""
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    sums = SumIndex(left)
    done: list[tuple[tuple[int, ...], int]] = []
    rest: list[tuple[int, int]] = []
    for length in range(capacity, 0, -1):
        while left[length]:
            left[length] -= 1
            others = sums.complement(capacity - length) if length < capacity else ()
            left[length] += 1
            if length < capacity and not others:
                rest.append((length, int(left[length])))
                left[length] = 0
                continue
            lengths, uses = np.unique((length, *others), return_counts=True)
            times = int((left[lengths] // uses).min())
            left[lengths] -= uses * times
            done.append(((length, *others), times))
    return done + _best_fit(rest, capacity)


def _best_fit(rest: list[tuple[int, int]], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Longest first, each into the fullest open sequences that still take it."""
    gaps: list[int] = []
    open_: dict[int, list[tuple[tuple[int, ...], int]]] = {}

    def put(lengths: tuple[int, ...], times: int) -> None:
        gap = capacity - sum(lengths)
        if gap not in open_:
            insort(gaps, gap)
            open_[gap] = []
        open_[gap].append((lengths, times))

    for length, n in rest:
        while n:
            at = bisect_left(gaps, length)
            if at == len(gaps):
                fit = capacity // length
                if n >= fit:
                    put((length,) * fit, n // fit)
                if n % fit:
                    put((length,) * (n % fit), 1)
                break
            gap = gaps[at]
            lengths, times = open_[gap].pop()
            fit = gap // length
            used = min(times, n // fit)
            if used:
                put(lengths + (length,) * fit, used)
                n -= used * fit
                if used < times:
                    open_.setdefault(gap, []).append((lengths, times - used))
            else:
                put(lengths + (length,) * n, 1)
                n = 0
                if times > 1:
                    open_.setdefault(gap, []).append((lengths, times - 1))
            if not open_[gap]:
                del open_[gap]
                gaps.remove(gap)
    return [entry for entries in open_.values() for entry in entries]


def slots(patterns: list[tuple[tuple[int, ...], int]], counts: Mapping[int, int]) -> np.ndarray:
    """Rows (first number, first sequence, offset) in order of piece numbers from 0.

    Pieces are numbered by length; each pattern takes a run of each of its lengths.
    """
    lengths = sorted(counts)
    ends = np.cumsum([counts[length] for length in lengths])
    free = {length: int(end) - counts[length] for length, end in zip(lengths, ends)}
    rows, sequence = [], 0
    for pattern, times in patterns:
        offset = 0
        for length in pattern:
            rows.append((free[length], sequence, offset))
            free[length] += times
            offset += length
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 3)


def _place(table: np.ndarray):
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number = batch.column("number").to_numpy() - 1
            first, sequence, offset = table[np.searchsorted(table[:, 0], number, "right") - 1].T
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")],
                 pa.array(sequence + number - first), pa.array(np.ascontiguousarray(offset))],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    return place


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """Every piece with its sequence and its place there."""
    cut = scratch(pieces(docs, tokenizer_path, capacity), "pieces")
    # at most `capacity` rows
    counts = {row["length"]: row["count"] for row in cut.groupBy("length").count().collect()}
    table = slots(plan(counts, capacity), counts)
    rows = numbered(cut, "number", ["length", "doc_id", "piece", "ids_crc32", "start"])
    return rows.mapInArrow(_place(table), f"{PIECES}, sequence_id long, offset long")
