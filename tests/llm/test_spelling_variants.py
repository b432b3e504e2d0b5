"""Operator 12 against brute force, its tries against prefixes."""

import random
import re
import zlib
from collections import Counter
from itertools import groupby

import pyarrow as pa
import pytest

from medclaims.llm import spelling_variants
from medclaims.llm.common import scratch
from tests.llm.test_operators import LOWER, collected, frame, same

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def table():
    rng = random.Random(3)
    stems = ["spelling", "colour", "Üngewöhn", "aabbbcc", "aaaaa", "abcde", "running", "été×÷", "mississippi"]

    def variant(word):
        for _ in range(rng.randrange(3)):
            i, c = rng.randrange(len(word)), rng.choice("abcé")
            word = rng.choice([word[:i] + word[i + 1 :], word[:i] + c + word[i:], word[:i] + c + word[i + 1 :]]) or "a"
        return word

    texts = [None, "", "12 34", "abcd" * 5000 + " word", "Straße STRASSE Straße strasse"] + ["x" * 700] * 3
    texts += [" ".join(variant(rng.choice(stems)) for _ in range(rng.randrange(1, 120))) for _ in range(90)]
    ids = [*range(len(texts) - 2), None, None]
    return [(i, t, None, None, 0) for i, t in zip(ids, texts)] + [(7, texts[20], "en", "a", 1)] * 3


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else (a[i + 1 :] == b[i:] if len(a) > len(b) else a[i:] == b[i + 1 :])


def brute(rows):
    counts = Counter()
    for doc_id, text, *_ in rows:
        for run in RUN.findall(text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{doc_id}:{run}".encode())
            if doc_id is not None and h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    form, n_near = {}, {}
    for w, n in words.items():
        found = sorted((-words[x], x) for x in words if near(w, x))
        n_near[w] = len(found)
        form[w] = found[0][1] if found and -found[0][0] >= 2 * n else None
    result = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        result.append((w, n, n_near[w], form[w], words.get(form[w]), root))
    return result


@pytest.mark.parametrize("size", [spelling_variants.CHUNK, 5])
def test_forms_and_roots(spark, size):
    rows = table()
    expected = brute(rows)
    assert len({r[5] for r in expected if r[5] not in (r[0], r[3])}) > 1  # chains of several forms
    same(collected(spelling_variants.spelling_forms(frame(spark, rows).repartition(3), size)), expected)


@pytest.mark.parametrize("rows", [[], [(1, None, None, None, 0)], [(None, "alone alone alone", None, None, 0)]])
def test_few_rows(spark, rows):
    same(collected(spelling_variants.spelling_forms(frame(spark, rows))), brute(rows))


@pytest.mark.parametrize("size", [1, 4, 1000])
def test_trie_nodes_stand_for_prefixes(spark, size):
    rng = random.Random(size)
    words = sorted({"".join(rng.choice("abé") for _ in range(rng.randrange(1, 9))) for _ in range(150)})
    given = scratch(spark.createDataFrame(pa.table({"id": list(range(len(words))), "rank": list(range(1, len(words) + 1)), "word": words})), "given")
    node_of = {}
    for row in spelling_variants.trie_nodes(given, size).collect():
        word = words[row.id]
        assert len(row.nodes) == len(word) + 1
        for i, node in enumerate(row.nodes):
            assert node_of.setdefault(word[:i], node) == node
    assert sorted(node_of.values()) == list(range(len(node_of)))  # one number for each prefix, no gaps


def test_pieces_cut_no_run():
    text = "".join(random.Random(1).choice("aÉé.B ¼ÿŁ日×") for _ in range(900)) + "z" * 300
    for size in (1, 3, 100):
        found = [r.decode("latin-1") for runs in spelling_variants.run_pieces(text, size) for r in runs]
        assert found == [r.translate(LOWER) for r in RUN.findall(text)]


def test_a_pair_holds_each_letter_once(spark):
    """All words of one skipped place: every word is near every other, without a row for each two."""
    letters = [chr(c) for c in [*range(97, 123), *range(0xE0, 0x100)]]
    rows = [(i, f"wor{c}ds " * (3 + i), None, None, 0) for i, c in enumerate(letters)]
    found = {r.word: r for r in spelling_variants.spelling_forms(frame(spark, rows)).collect()}
    expected = {r[0]: r for r in brute(rows)}
    assert found.keys() == expected.keys()
    assert {w: tuple(r) for w, r in found.items()} == expected
    sizes = [len(list(g)) for _, g in groupby(sorted(r.n_near for r in found.values()))]
    assert max(sizes) >= len(letters) - 3
