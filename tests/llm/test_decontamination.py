"""Operator 13 against brute force: short items, overlaps, repeats, blocks and hard rows."""

import hashlib
import random
import re

import pyarrow as pa
import pytest

from medclaims.llm import decontamination
from tests.llm.test_operators import LOWER, collected, frame, prose, rows, same

ITEMS = pa.schema([("item_id", pa.int64()), ("text", pa.string()), ("row", pa.string()), ("window", pa.int32())])
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def items(table):
    passages = [(1, table[7][1]), (2, "One!"), (3, None), (4, ""), (5, "... --"), (None, "a-b c D"), (7, table[5][1][200:900]),
                (8, "nothing of the kind is ever said in any one of them"), (10, "all RIGHTS"), (2, "x"), (9, table[7][1]),
                (11, "é" * 3000), (12, " ".join(["x"] * 12))]
    return passages + [passages[0]]


def brute(table, given, width=10):
    windows = {}
    for item, text in given:
        w = words(text)
        n = min(width, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add(item)
    lengths = {len(w) for w in windows}
    result = []
    for doc_id, text, *_ in table:
        w, hit, met = words(text), set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    hit.update(range(i, i + n))
                    met |= windows[tuple(w[i : i + n])]
        listed = ",".join(sorted(str(x) for x in met if x is not None))
        result.append((doc_id, len(w), len(hit), len(met - {None}), hashlib.sha256(listed.encode()).hexdigest(), bool(hit)))
    return result


def benchmark(spark, given):
    ids, texts = (list(c) for c in zip(*given)) if given else ([], [])
    return spark.createDataFrame(pa.table([pa.array(ids, pa.int64()), pa.array(texts, pa.string()),
                                           pa.array(["x"] * len(ids), pa.string()), pa.array([1] * len(ids), pa.int32())], schema=ITEMS))


@pytest.mark.parametrize("width,search_bytes", [(10, 8 << 20), (4, 4000)])
def test_counts_and_items(spark, width, search_bytes):
    table = rows()
    given = items(table)
    found = decontamination.contamination(frame(spark, table).repartition(3), benchmark(spark, given), width, search_bytes)
    expected = brute(table, given, width)
    assert any(n_hit and n_items > 1 for _, _, n_hit, n_items, *_ in expected)
    same(collected(found.drop("hits")), expected)


@pytest.mark.parametrize("table,given", [([], [(1, "a")]), ([(1, "a b", None, None, 3)], []), ([(1, None, None, None, 0)], [(None, None)])])
def test_empty_tables(spark, table, given):
    found = decontamination.contamination(frame(spark, table), benchmark(spark, given))
    same(collected(found.drop("hits")), brute(table, given))


def test_a_search_finds_every_occurrence_across_pieces():
    rng = random.Random(5)
    text = " ".join(rng.choice(["a", "b", "c1", "é"]) for _ in range(4000)).encode()
    w = text.split()
    windows = sorted({(b" ".join(w[i : i + n]), n, i) for n in (1, 2, 5, 9) for i in range(7, 4000, 391)})
    whole = decontamination.search_text(text, decontamination.SearchBlock(windows).searches)
    for piece in (1, 7, 100, 1000):
        assert decontamination.search_text(text, decontamination.SearchBlock(windows).searches, piece) == whole
    hit, kinds = set(), set()
    for window, n, kind in windows:
        for i in range(len(w) - n + 1):
            if w[i : i + n] == window.split():
                hit.update(range(i, i + n))
                kinds.add(kind)
    assert sum(b - a for a, b in whole[1]) == len(hit) and whole[2] == sorted(kinds)


def test_unlike_windows_shift_the_search_far():
    search = decontamination.Search(10, [(prose(10, 1).encode(), 1)])
    assert search.farthest == 8 and len(search.shift) == 8
    looked_up = []
    search.shift = type("Counting", (dict,), {"get": lambda self, k, d: looked_up.append(k) or dict.get(self, k, d)})(search.shift)
    assert not list(search.find(prose(8000, 2, 9999).encode().split()))
    assert len(looked_up) <= 1000


def test_items_of_a_hot_window_are_listed_once_per_set(spark):
    given = [(i, "the very same ten words in each and every item") for i in range(300)]
    table = [(i, "Before. The very same ten words in each and every item! After", None, None, 0) for i in range(200)]
    docs = frame(spark, table)
    found = decontamination.contamination(docs, benchmark(spark, given))
    same(collected(found.drop("hits")), brute(table, given))
    windows = decontamination.item_windows(benchmark(spark, given))
    assert windows.select("kind").distinct().count() == 1
