"""Operator 13: benchmark decontamination by Wu-Manber search over words.

A word is ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z. A test item
gives a window at each of its words that has ``width - 1`` words after it; an item
of fewer words, but not none, is one window. Windows of one length share a search:
a shift table says, for the last words of a position, how far the next possible
end of a window is, so most positions are never looked at; where the shift is
nothing, the bucket of those last words, told apart by the window's first words,
names the windows to compare directly.

Windows are dealt into blocks of bounded size, an item's neighbouring windows
together, and every document is searched for every block. Windows of the same items
form a class; a document keeps the classes it holds, and items are listed once
for each distinct set of classes, so that neither a window of very many items nor
a set of very many documents multiplies rows.

NULL and empty texts have no words. Repeated rows are documents of their own.
Repeated items count once, by ``item_id``; an item without an id is searched for and
makes words hits, but is not listed. Very long texts are cut into pieces of words
that overlap by a window. Without documents the result is empty, without items
nothing is hit. Other columns are never looked at.
"""

import hashlib
from collections.abc import Iterable, Iterator
from functools import cached_property

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medclaims.llm.common import byte_texts, scratch

WIDTH = 10
# words that a shift is looked up by
BLOCK = 3
# a search holds windows of about so many bytes
SEARCH_BYTES = 8 << 20
# an item's windows are dealt out in runs of so many
_RUN = 4096
# a text is cut into words in pieces of so many bytes
_PIECE = 1 << 20

_LOWERED = bytes(c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in range(256)).lower()
NOTHING = hashlib.sha256(b"").hexdigest()


def word_pieces(text: bytes, size: int = _PIECE) -> Iterator[list[bytes]]:
    """The words of a text, a piece of it at a time; no word is cut."""
    at = 0
    while at < len(text):
        end = at + size
        while end < len(text) and _LOWERED[text[end]] != 0x20:
            end += 1
        yield text[at:end].translate(_LOWERED).split()
        at = end


class Search:
    """Wu-Manber tables for windows of one length, given as (joined words, class)."""

    def __init__(self, length: int, windows: Iterable[tuple[bytes, int]]):
        self.length = length
        self.block = min(BLOCK, length)
        self.farthest = length - self.block + 1
        self.shift: dict[bytes, int] = {}
        self.buckets: dict[tuple[bytes, bytes], list[tuple[bytes, int]]] = {}
        for window, kind in windows:
            words = window.split(b" ")
            blocks = [b" ".join(words[i : i + self.block]) for i in range(self.farthest)]
            for before, block in enumerate(reversed(blocks)):
                self.shift[block] = min(before, self.shift.get(block, self.farthest))
            self.buckets.setdefault((blocks[-1], blocks[0]), []).append((window, kind))

    def find(self, words: list[bytes]) -> Iterator[tuple[int, int]]:
        """(first word, class) of every occurrence."""
        length, block, join = self.length, self.block, b" ".join
        shift, buckets, farthest = self.shift.get, self.buckets.get, self.farthest
        end = length
        while end <= len(words):
            last = join(words[end - block : end])
            step = shift(last, farthest)
            if step:
                end += step
                continue
            first = end - length
            for window, kind in buckets((last, join(words[first : first + block])), ()):
                if window == join(words[first:end]):
                    yield first, kind
            end += 1


class SearchBlock:
    """Windows as (joined words, length, class); a worker builds their searches once."""

    def __init__(self, windows: list[tuple[bytes, int, int]]):
        self.windows = windows

    @cached_property
    def searches(self) -> list[Search]:
        """One for each length."""
        of_length: dict[int, list[tuple[bytes, int]]] = {}
        for window, length, kind in self.windows:
            of_length.setdefault(length, []).append((window, kind))
        return [Search(length, of_length[length]) for length in sorted(of_length)]


def _merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    merged: list[tuple[int, int]] = []
    for first, end in sorted(runs):
        if merged and first <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(end, merged[-1][1]))
        else:
            merged.append((first, end))
    return merged


def search_text(text: bytes, tables: list[Search], piece: int = _PIECE) -> tuple[int, list[tuple[int, int]], list[int]]:
    """Number of words, runs of hit words as (first, end), classes met."""
    overlap = max((t.length for t in tables), default=1) - 1
    n, tail, runs, kinds = 0, [], [], set()
    for words in word_pieces(text, piece):
        for table in tables:
            before = tail[len(tail) - table.length + 1 :] if len(tail) >= table.length else tail
            for first, kind in table.find(before + words if before else words):
                runs.append((n - len(before) + first, n - len(before) + first + table.length))
                kinds.add(kind)
        runs = _merged(runs)
        n += len(words)
        tail = (tail + words)[-overlap:] if overlap else []
    return n, runs, sorted(kinds)


_RUN_TYPE = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))


def _scan(block: Broadcast):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = block.value.searches
        for batch in batches:
            found = [search_text(text, tables) for text in byte_texts(batch.column("text"))]
            n, runs, kinds = zip(*found) if found else ((), (), ())
            spans = [[{"first": a, "end": b} for a, b in run] for run in runs]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(spans, _RUN_TYPE),
                 pa.array(kinds, pa.list_(pa.int64()))],
                ["row", "doc_id", "n_words", "hits", "kinds"],
            )

    return scan


def _windows_of(width: int):
    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch.column("item").to_pylist(), byte_texts(batch.column("text"))):
                words = [word for piece in word_pieces(text) for word in piece]
                if not words:
                    continue
                length = min(width, len(words))
                text_id = hashlib.md5(text).hexdigest()
                for at in range(0, len(words) - length + 1, _RUN):
                    some = [b" ".join(words[i : i + length]) for i in range(at, min(at + _RUN, len(words) - length + 1))]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([item] * len(some), pa.string()), pa.array([f"{text_id}:{at}"] * len(some)),
                         pa.array(some, pa.binary()), pa.array([length] * len(some), pa.int32())],
                        ["item", "run", "window", "length"],
                    )

    return windows


def item_windows(benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """(item, run, window, length, kind): ``kind`` is equal for windows of the same items."""
    windows = scratch(
        benchmark.select(F.col("item_id").cast("string").alias("item"), "text")
        .mapInArrow(_windows_of(width), "item string, run string, window binary, length int").distinct(),
        "windows",
    )
    hashed = F.xxhash64("item")
    of_window = (
        windows.select(F.col("window").alias("same"), "item").distinct().groupBy("same")
        .agg(F.count("item").alias("n"), F.bit_xor(hashed).alias("a"), F.sum(hashed.cast("decimal(20,0)")).alias("b"))
        .select("same", F.xxhash64("n", "a", "b").alias("kind"))
    )
    return scratch(windows.join(of_window, F.col("window") == F.col("same")).drop("same"), "kinds")


def _search_blocks(windows: DataFrame, search_bytes: int) -> Iterator[SearchBlock]:
    """The distinct windows, in blocks that the driver hands to all tasks one by one."""
    size = windows.agg(F.sum(F.octet_length("window") + 64)).first()[0] or 0
    n = max(1, -(-size // search_bytes))
    dealt = windows.withColumn("part", F.pmod(F.xxhash64("run"), F.lit(n)))
    for part in range(n):
        rows = dealt.where(F.col("part") == part).select("window", "length", "kind").distinct().collect()
        yield SearchBlock([(bytes(r.window), r.length, r.kind) for r in rows])


def hits(docs: DataFrame, windows: DataFrame, search_bytes: int = SEARCH_BYTES) -> DataFrame:
    """(row, doc_id, n_words, hits, kinds) of every document; stored."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    schema = f"row long, doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_words long, " \
             "hits array<struct<first:long,end:long>>, kinds array<long>"
    blocks = [docs.sparkSession.sparkContext.broadcast(b) for b in _search_blocks(windows, search_bytes)]
    if len(blocks) == 1:
        return scratch(rows.mapInArrow(_scan(blocks[0]), schema), "hits")
    rows = scratch(rows, "documents")
    found = None
    for block in blocks:
        some = scratch(rows.mapInArrow(_scan(block), schema), "hits")
        found = some if found is None else found.unionByName(some)
    together = found.groupBy("row").agg(
        F.any_value("doc_id").alias("doc_id"), F.any_value("n_words").alias("n_words"),
        F.flatten(F.collect_list("hits")).alias("hits"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("kinds")))).alias("kinds"),
    )
    return scratch(together, "hits")


# words in any of the runs, which may overlap
_N_HIT = """aggregate(array_sort(hits), struct(0L AS n, 0L AS upto),
    (s, h) -> struct(s.n + greatest(0L, h.end - greatest(h.first, s.upto)) AS n, greatest(s.upto, h.end) AS upto),
    s -> s.n)"""


def contamination(
    docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, search_bytes: int = SEARCH_BYTES
) -> DataFrame:
    """Counts of words and hits, the items met, and the runs of hit words of every document."""
    windows = item_windows(benchmark, width)
    listed = F.md5(F.array_join(F.col("kinds").cast("array<string>"), ","))
    found = hits(docs, windows, search_bytes).withColumn("set", listed).withColumn("n_hit", F.expr(_N_HIT))
    some = found.where("n_hit > 0")
    of_kind = windows.where("item IS NOT NULL").select("kind", "item").distinct()
    sets = some.groupBy("set").agg(F.any_value("kinds").alias("kinds")).select("set", F.explode("kinds").alias("kind"))
    items = F.array_sort(F.collect_list("item"))
    of_set = (
        sets.join(of_kind, "kind").select("set", "item").distinct().groupBy("set")
        .agg(F.count("*").alias("n_items"), F.sha2(F.array_join(items, ","), 256).alias("items_sha256"))
    )
    of_set = scratch(of_set, "sets")
    result = ["doc_id", "n_words", "n_hit", F.coalesce("n_items", F.lit(0)).alias("n_items"),
              F.coalesce("items_sha256", F.lit(NOTHING)).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"), "hits"]
    clean = found.where("n_hit = 0").withColumns({"n_items": F.lit(0).cast("long"), "items_sha256": F.lit(NOTHING)})
    return some.join(of_set, "set", "left").select(*result).unionByName(clean.select(*result))
