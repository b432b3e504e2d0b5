"""Operator 12: group spelling variants by a dictionary of trie-node pairs.

Runs of ``[A-Za-z\\u00C0-\\u00FF]+`` are lower-cased (A-Z only). Where 97 divides the
crc32 of ``<doc_id>:<run>``, the run loses one code point; the words are the
distinct results of at least ``least_length`` code points and ``least_count``
occurrences. Two words are near if they differ by exactly one inserted, deleted
or replaced code point. A word's form is its near word of largest count (ties: the
least word), if that count is at least twice its own; its root ends the chain of forms.

The nodes of the trie of all words are numbered, and those of the trie of all
reversed words. A word cut at a place is a pair (prefix node, suffix node). One that
skips the code point at a place is such a pair, too: words that share it and
their length are near by a replacement, and a word whose cut it equals is near by a
deletion. Pairs stand for texts one to one, so neighbours are exact and need no
further comparison. No pair has more skipping words than there are letters.

The tries are numbered over sorted words: a word adds the nodes below what it shares
with the word before. Chunks of the sorted words are worked on apart; what a chunk
leaves to the next (numbers used, nodes of its last word as a few runs) is one short
row, and those rows are put in line before the nodes are given out.

NULL and empty texts have no runs. Rows with a NULL ``doc_id`` lose no code points.
Repeated rows count again. Very long texts are read piece by piece, and long words
cost no more than their length. Without words the result is empty. Other columns are
never looked at.
"""

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from os.path import commonprefix

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medclaims.llm.common import numbered, scratch

LEAST_LENGTH = 5
LEAST_COUNT = 3
# one occurrence in so many loses a code point
EVERY = 97
# sorted words that are numbered together
CHUNK = 1 << 16
_RUN = re.compile("[A-Za-zÀ-ÿ]+")
# Latin-1 with A-Z lowered and all but letters blank
_LETTERS = bytes(c if chr(c).isascii() and chr(c).isalpha() or c >= 0xC0 else 0x20 for c in range(256)).lower()
# characters of a text that are split at once; words a task counts before it sends them
_PIECE = 1 << 20
_HELD = 1 << 19


def run_pieces(text: str, size: int = _PIECE) -> Iterator[list[bytes]]:
    """The lower-cased runs of a text in Latin-1, a piece of it at a time; no run is cut."""
    at = 0
    while at < len(text):
        end = at + size
        inside = _RUN.match(text, end)
        end = inside.end() if inside else end
        # what Latin-1 lacks becomes a question mark, which is no letter either
        yield text[at:end].encode("latin-1", "replace").translate(_LETTERS).split()
        at = end


def _altered(run: bytes, prefix: int) -> bytes:
    digest = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), prefix)
    if digest % EVERY:
        return run
    at = digest % len(run)
    return run[:at] + run[at + 1 :]


def _count(least_length: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[bytes, int] = {}

        def sent() -> pa.RecordBatch:
            words = pa.array([word.decode("latin-1") for word in counts], pa.string())
            return pa.RecordBatch.from_arrays([words, pa.array(list(counts.values()), pa.int64())], ["word", "n"])

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                prefix = None if doc_id is None else zlib.crc32(f"{doc_id}:".encode())
                for runs in run_pieces(text or ""):
                    for run, n in Counter(runs).items():
                        if len(run) < least_length:
                            continue
                        word = run if prefix is None else _altered(run, prefix)
                        counts[word] = counts.get(word, 0) + n
                    if len(counts) > _HELD:
                        yield sent()
                        counts = {}
        yield sent()

    return count


def count_words(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """(id, word, n): the words, numbered in code-point order; stored."""
    counts = docs.select("doc_id", "text").mapInArrow(_count(least_length), "word string, n long")
    words = counts.where(F.length("word") >= least_length).groupBy("word").agg(F.sum("n").alias("n"))
    return scratch(numbered(words.where(F.col("n") >= least_count), "id", ["word"]), "words")


Steps = list[tuple[int, int]]  # (depth, node): from that depth on, nodes count up from that one


class TrieLine:
    """Numbers the nodes of sorted, distinct words in one go over them.

    ``steps`` are the nodes on the way to the last word, ``number`` the next free
    one, ``low`` the least that a word shared with the word before it.
    """

    def __init__(self, steps: Steps, number: int):
        self.steps, self.number, self.low = list(steps), number, None

    def add(self, word: str, before: str) -> None:
        shared = len(commonprefix((word, before)))
        while self.steps and self.steps[-1][0] > shared:
            self.steps.pop()
        self.steps.append((shared + 1, self.number))
        self.number += len(word) - shared
        self.low = shared if self.low is None else min(self.low, shared)

    def nodes(self, length: int) -> list[int]:
        """Nodes of the last word's prefixes, from the empty one (0) on."""
        found = [0]
        for (depth, node), (end, _) in zip(self.steps, [*self.steps[1:], (length + 1, 0)]):
            found.extend(range(node, node + end - depth))
        return found


def _sorted_words(chunk: pa.Table) -> tuple[list[int], list[str]]:
    chunk = chunk.sort_by("rank")
    return chunk.column("rank").to_pylist(), chunk.column("word").to_pylist()


def _summary(size: int):
    def summary(key: tuple[pa.Scalar, ...], chunk: pa.Table) -> pa.Table:
        number, (ranks, words) = key[0].as_py(), _sorted_words(chunk)
        line, before = TrieLine([], 0), ""
        for rank, word in zip(ranks, words):
            if rank // size == number:
                line.add(word, before)
            before = word
        steps = [{"depth": d, "node": n} for d, n in line.steps]
        return pa.table([pa.array([number], pa.int64()), pa.array([line.low], pa.int32()), pa.array([line.number], pa.int64()),
                         pa.array([steps], _STEPS)], names=["chunk", "low", "n", "steps"])

    return summary


_STEPS = pa.list_(pa.struct([("depth", pa.int32()), ("node", pa.int64())]))


def _in_line(summaries: list) -> dict[int, tuple[Steps, int]]:
    """Steps and next free node that each chunk begins with."""
    begins, steps, number = {}, [], 1
    for row in sorted(summaries, key=lambda r: r.chunk):
        begins[row.chunk] = (steps, number)
        steps = [s for s in steps if s[0] <= row.low] + [(s.depth, s.node + number) for s in row.steps]
        number += row.n
    return begins


def _nodes(size: int, begins: dict[int, tuple[Steps, int]]):
    def nodes(key: tuple[pa.Scalar, ...], chunk: pa.Table) -> pa.Table:
        number, (ranks, words) = key[0].as_py(), _sorted_words(chunk)
        line, before, ids, found = TrieLine(*begins.get(number, ([], 0))), "", [], []
        own = dict(zip(chunk.column("rank").to_pylist(), chunk.column("id").to_pylist()))
        for rank, word in zip(ranks, words):
            if rank // size == number:
                line.add(word, before)
                ids.append(own[rank])
                found.append(line.nodes(len(word)))
            before = word
        return pa.table([pa.array(ids, pa.int64()), pa.array(found, pa.list_(pa.int64()))], names=["id", "nodes"])

    return nodes


def trie_nodes(words: DataFrame, size: int = CHUNK) -> DataFrame:
    """(id, nodes): for each word of (id, rank, word), numbered by ``rank`` in sorted order,
    the nodes of its prefixes, from the empty one on."""
    chunk = F.expr(f"rank div {size}")
    last = F.col("rank") % size == size - 1  # the next chunk's first word is compared with it
    chunks = F.when(last, F.array(chunk, chunk + 1)).otherwise(F.array(chunk))
    dealt = words.select("id", "rank", "word", F.explode(chunks).alias("chunk"))
    own = "chunk long, low int, n long, steps array<struct<depth:int,node:long>>"
    summaries = dealt.groupBy("chunk").applyInArrow(_summary(size), own).where("low IS NOT NULL").collect()
    begins = _in_line(summaries)
    return dealt.groupBy("chunk").applyInArrow(_nodes(size, begins), "id long, nodes array<long>")


# the letter that a word skips is the last of a run of equal ones, so that no two places leave the same
_PAIRS = """concat(
    transform(sequence(0, size(f) - 1), i -> struct(f[i] AS p, r[size(f) - 1 - i] AS s, true AS whole, true AS last)),
    transform(sequence(0, size(f) - 2), i -> struct(f[i] AS p, r[size(f) - 2 - i] AS s, false AS whole,
                                                   i = size(f) - 2 OR get(c, i) <> get(c, i + 1) AS last)))"""

# skipping words in order of preference; the one whole word a pair can have
_SKIPS = "sort_array(collect_list(CASE WHEN NOT whole THEN struct(n, -id AS id, last) END), false)"
_WHOLE = "max(CASE WHEN whole THEN struct(n, -id AS id) END)"
_BEST = """array_max(filter(array(
    CASE WHEN size(skips) > 1 THEN struct(skips[if(k = 0, 1, 0)].n AS n, skips[if(k = 0, 1, 0)].id AS id) END,
    CASE WHEN me.last THEN whole END), x -> x IS NOT NULL))"""
_NEAR_SKIPS = f"transform(skips, (me, k) -> struct(-me.id AS id, size(skips) - 1 + int(me.last AND whole IS NOT NULL) AS n_near, {_BEST} AS best))"
_NEAR_WHOLE = """transform(filter(array(whole), x -> x IS NOT NULL), x -> struct(-x.id AS id,
    size(filter(skips, y -> y.last)) AS n_near,
    get(transform(slice(filter(skips, y -> y.last), 1, 1), y -> struct(y.n AS n, y.id AS id)), 0) AS best))"""


def near_words(words: DataFrame, size: int = CHUNK) -> DataFrame:
    """(id, n_near, best): words that have near ones; ``best`` is (n, -id) of the preferred one."""
    forward = trie_nodes(words.select("id", F.col("id").alias("rank"), "word"), size)
    turned = numbered(words.select("id", F.reverse("word").alias("word")), "rank", ["word"])
    backward = trie_nodes(scratch(turned, "turned"), size)
    nodes = words.join(forward.withColumnRenamed("nodes", "f"), "id").join(backward.withColumnRenamed("nodes", "r"), "id")
    pairs = nodes.withColumn("c", F.split("word", "")).select("id", "n", F.inline(F.expr(_PAIRS)))
    met = pairs.groupBy("p", "s").agg(F.expr(_SKIPS).alias("skips"), F.expr(_WHOLE).alias("whole"))
    met = met.where("size(skips) + int(whole IS NOT NULL) > 1")
    near = met.select(F.inline(F.expr(f"concat({_NEAR_SKIPS}, {_NEAR_WHOLE})"))).where("n_near > 0")
    return near.groupBy("id").agg(F.sum("n_near").alias("n_near"), F.max("best").alias("best"))


def _roots(forms: DataFrame) -> DataFrame:
    """(id, root) of words with a form. A form has twice the count at least, so chains
    are short, and each round halves what is left of them."""
    links = scratch(forms.where("form IS NOT NULL").select("id", F.col("form").alias("root")), "roots")
    while True:
        ahead = links.select(F.col("id").alias("root"), F.col("root").alias("next"))
        links = scratch(
            links.join(ahead, "root", "left")
            .select("id", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots"
        )
        if links.where("moved").isEmpty():
            return links.select("id", "root")


def spelling_forms(docs: DataFrame, size: int = CHUNK) -> DataFrame:
    """Every word with its count, its number of near words, its form and its root."""
    words = count_words(docs)
    form = F.when(F.expr("best.n >= 2 * n"), F.col("best"))
    forms = words.join(near_words(words, size), "id", "left").withColumn("best", form)
    forms = scratch(
        forms.select("id", "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.expr("-best.id").alias("form"),
                     F.col("best.n").alias("form_n")), "forms"
    )

    def named(column: str) -> DataFrame:
        return words.select(F.col("id").alias(f"{column}_id"), F.col("word").alias(column))

    led = forms.where("form IS NOT NULL").withColumnRenamed("form", "form_id")
    led = led.join(_roots(forms).withColumnRenamed("root", "root_id"), "id")
    led = led.join(named("form"), "form_id").join(named("root"), "root_id")
    alone = forms.where("form IS NULL").withColumns({"form": F.lit(None).cast("string"), "root": F.col("word")})
    columns = ["word", "n", "n_near", "form", "form_n", "root"]
    return led.select(*columns).unionByName(alone.select(*columns))
