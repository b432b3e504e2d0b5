"""Operator 2: language identification of mixed-language text.

Character trigrams of the training texts give each language a table of log
probabilities. A word's score in a language is the sum over its trigrams. The
scripts of its letters (Unicode ranges) narrow the candidates to languages
that were seen in that script. A Viterbi pass over the words, with a penalty for
each switch, labels spans; the language of most letters is the document's, and
the share of its letters the score.

NULL text, or one without letters, is ``und`` with score 0. Training rows with NULL
text or language teach nothing; if nothing was learned all is ``und``. Ties go
to the first language by name. Repeated rows are labelled alike. A very long text is held
whole by a task, one number for each of its letters and languages. An empty table gives an
empty result; other columns are never looked at. The driver holds one table of ``BUCKETS``
numbers for each language, so the values of ``lang`` are taken to be few.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 15
SWITCH_PENALTY = 12.0
# a language is a candidate for scripts that hold at least this share of its letters
LEAST_SCRIPT_SHARE = 0.01
_CHARS_AT_ONCE = 1 << 20
_SPACES = [0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]

# First and last code points of Unicode blocks by script.
SCRIPTS = [
    ("latin", 0x0041, 0x024F),
    ("greek", 0x0370, 0x03FF),
    ("cyrillic", 0x0400, 0x052F),
    ("armenian", 0x0530, 0x058F),
    ("hebrew", 0x0590, 0x05FF),
    ("arabic", 0x0600, 0x077F),
    ("devanagari", 0x0900, 0x097F),
    ("bengali", 0x0980, 0x09FF),
    ("tamil", 0x0B80, 0x0BFF),
    ("thai", 0x0E00, 0x0E7F),
    ("georgian", 0x10A0, 0x10FF),
    ("hangul", 0x1100, 0x11FF),
    ("latin", 0x1E00, 0x1EFF),
    ("kana", 0x3040, 0x30FF),
    ("han", 0x3400, 0x9FFF),
    ("hangul", 0xAC00, 0xD7AF),
]
SCRIPT_NAMES = ["other", *dict.fromkeys(name for name, _, _ in SCRIPTS)]

_letter_scripts: list[np.ndarray] = []


def letter_scripts() -> np.ndarray:
    """By code point: 0 if it is no letter, else 1 + the number of its script."""
    if not _letter_scripts:
        letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
        scripts = np.ones(0x110000, np.uint8)
        for name, first, last in SCRIPTS:
            scripts[first : last + 1] = 1 + SCRIPT_NAMES.index(name)
        _letter_scripts.append(np.where(letters, scripts, 0).astype(np.uint8))
    return _letter_scripts[0]


@dataclass
class Chars:
    """Texts as one row of code points: which are in words, and the trigram of each."""

    scripts: np.ndarray
    buckets: np.ndarray
    in_word: np.ndarray
    word_starts: np.ndarray
    docs: np.ndarray


def read_chars(texts: list[str]) -> Chars:
    lowered = [text.lower() for text in texts]
    codes = np.frombuffer("".join(f" {text}" for text in lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
    in_word = ~np.isin(codes, _SPACES)
    folded = np.where(in_word, codes, 32).astype(np.uint64)
    after = np.append(folded[1:], np.uint64(32))
    before = np.append(np.uint64(32), folded[:-1])
    mixed = (before * np.uint64(0x9E3779B97F4A7C15) + folded) * np.uint64(0xBF58476D1CE4E5B9) + after
    buckets = (mixed * np.uint64(0x94D049BB133111EB)) >> np.uint64(64 - 15)
    starts = np.flatnonzero(in_word & ~np.append(False, in_word[:-1]))
    firsts = np.cumsum([0, *[len(text) + 1 for text in lowered]])
    return Chars(letter_scripts()[codes], buckets.astype(np.int64), in_word, starts, firsts)


def chunks(texts: list[str | None]) -> Iterator[slice]:
    """Runs of texts of about a million characters."""
    first, total = 0, 0
    for i, text in enumerate(texts):
        total += len(text or "")
        if total >= _CHARS_AT_ONCE:
            yield slice(first, i + 1)
            first, total = i + 1, 0
    yield slice(first, len(texts))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, np.ndarray] = {}
    size = BUCKETS + len(SCRIPT_NAMES)
    for batch in batches:
        texts, langs = batch.column("text").to_pylist(), batch.column("lang").to_pylist()
        for some in chunks(texts):
            for lang in set(langs[some]):
                chars = read_chars([t for t, own in zip(texts[some], langs[some]) if own == lang])
                found = np.bincount(chars.buckets[chars.in_word], minlength=BUCKETS)
                scripts = np.bincount(chars.scripts[chars.scripts > 0] - 1, minlength=len(SCRIPT_NAMES))
                counts[lang] = counts.get(lang, np.zeros(size, np.int64)) + np.concatenate([found, scripts])
    for lang, found in counts.items():
        used = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(used)), pa.array(used), pa.array(found[used])], ["lang", "bucket", "n"]
        )


@dataclass
class Model:
    langs: list[str]
    #: by bucket and language
    log_p: np.ndarray
    #: by 1 + script and language; row 0 is for words without letters
    allowed: np.ndarray


def learn(training: DataFrame) -> Model:
    """From all rows of (text, lang). What reaches the driver is bounded by the
    number of languages and buckets."""
    usable = training.where(F.col("text").isNotNull() & F.col("lang").isNotNull()).select("text", "lang")
    rows = usable.mapInArrow(_count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    found = rows.toPandas()
    langs = sorted(found["lang"].unique())
    counts = np.zeros((BUCKETS + len(SCRIPT_NAMES), len(langs)))
    counts[found["bucket"].to_numpy(np.int64), [langs.index(lang) for lang in found["lang"]]] = found["n"]
    grams, scripts = counts[:BUCKETS] + 0.5, counts[BUCKETS:]
    allowed = np.ones((len(scripts) + 1, len(langs)), bool)
    allowed[1:] = scripts >= LEAST_SCRIPT_SHARE * np.maximum(scripts.sum(0), 1)
    allowed[~allowed.any(1)] = True
    return Model(langs, np.log(grams / grams.sum(0)).astype(np.float32), allowed)


def viterbi(scores: np.ndarray, docs: np.ndarray, penalty: float = SWITCH_PENALTY) -> np.ndarray:
    """The best label of every word; document i has words docs[i] to docs[i + 1].

    All documents move on together, word by word, so Python's steps are as many
    as the longest document has words.
    """
    lengths = np.diff(docs)
    order = np.argsort(-lengths, kind="stable")
    starts, lengths = docs[:-1][order], lengths[order]
    longest = int(lengths[0]) if len(lengths) else 0
    active = np.searchsorted(-lengths, -np.arange(longest), "left")
    back = np.empty(scores.shape, np.uint16)
    own = np.arange(scores.shape[1], dtype=np.uint16)
    best = np.zeros((len(lengths), scores.shape[1]), np.float32)
    for t, n in enumerate(active):
        at, now = starts[:n] + t, best[:n]
        top = now.argmax(1)
        switched = now[np.arange(n), top][:, None] - np.float32(penalty)
        stay = now >= switched
        back[at] = np.where(stay, own, top[:, None])
        best[:n] = np.where(stay, now, switched) + scores[at]
    labels = np.zeros(len(scores), np.uint16)
    label = best.argmax(1)
    for t in range(longest - 1, -1, -1):
        n = active[t]
        at = starts[:n] + t
        labels[at] = label[:n]
        label[:n] = back[at, label[:n]]
    return labels


def word_scores(chars: Chars, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """By word: the score in each language, and the number of letters."""
    if not len(chars.word_starts):
        return np.empty((0, len(model.langs)), np.float32), np.empty(0, np.int64)
    letters = np.add.reduceat((chars.scripts > 0).astype(np.int64), chars.word_starts)
    script = np.maximum.reduceat(chars.scripts, chars.word_starts)
    grams = model.log_p[chars.buckets]
    grams[~chars.in_word] = 0
    scores = np.add.reduceat(grams, chars.word_starts)
    scores[letters == 0] = 0
    scores[~model.allowed[script]] -= np.float32(1e6)
    return scores, letters


def _label(model: Model):
    languages = np.array([*model.langs, "und"], dtype=object)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            parts, sizes = [], []
            for some in chunks(texts):
                chars = read_chars([text or "" for text in texts[some]])
                parts.append(word_scores(chars, model))
                sizes.append(np.diff(np.searchsorted(chars.word_starts, chars.docs)))
            docs = np.append(0, np.cumsum(np.concatenate(sizes)))
            labels = viterbi(np.concatenate([p[0] for p in parts]), docs)
            letters = np.concatenate([p[1] for p in parts])
            of_doc = np.repeat(np.arange(len(texts)), np.diff(docs))
            share = np.zeros((len(texts), len(model.langs)))
            np.add.at(share, (of_doc, labels), letters)
            total, top = share.sum(1), share.argmax(1)
            first = np.ones(len(labels), bool)
            first[1:] = (labels[1:] != labels[:-1]) | (of_doc[1:] != of_doc[:-1])
            begins = np.flatnonzero(first)
            ends = np.append(begins[1:], len(labels))
            spans = pa.StructArray.from_arrays(
                [pa.array((begins - docs[of_doc[begins]]).astype(np.int32)),
                 pa.array((ends - docs[of_doc[begins]]).astype(np.int32)),
                 pa.array(languages[labels[begins]], pa.string())],
                ["first_word", "end_word", "lang"],
            )
            offsets = np.searchsorted(of_doc[begins], np.arange(len(texts) + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(name) for name in ("doc_id", "held_out")],
                 pa.array(languages[np.where(total > 0, top, -1)], pa.string()),
                 pa.array(share.max(1) / np.maximum(total, 1)),
                 pa.ListArray.from_arrays(pa.array(offsets), spans)],
                ["doc_id", "held_out", "lang_pred", "score", "spans"],
            )

    return label


def held_out(doc_id) -> F.Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def label_documents(docs: DataFrame) -> DataFrame:
    """Learn from the documents that are not held out, then label all, with spans."""
    rows = docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out"))
    model = learn(docs.where(~held_out(F.col("doc_id"))))
    if not model.langs:
        return rows.select(
            "doc_id", "held_out", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"),
            F.array().cast("array<struct<first_word:int,end_word:int,lang:string>>").alias("spans"),
        )
    schema = "doc_id long, held_out boolean, lang_pred string, score double, " \
        "spans array<struct<first_word:int,end_word:int,lang:string>>"
    return rows.mapInArrow(_label(model), schema)
