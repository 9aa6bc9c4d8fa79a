"""Language of words and texts by a linear-chain conditional random field.

Every word of a text is labelled with a language. A word's features are its byte n-grams (2 to 4 bytes of the
lower-cased word between blanks, so the first and last ones are its affixes) and the word itself as an
entry of the lexicon, all hashed into ``2**BITS`` weights per language. Transitions between the languages of
neighbouring words are learned too; forward-backward gives each word's distribution over languages.

Learning: a bounded sample of labelled texts, at most ``SAMPLE_DOCS`` per language by the order of a hash and
``SAMPLE_CHARS`` characters of each from a hashed place. Their words are cut into spans and mixed into
sequences that switch languages, since whole texts hardly do; log-likelihood is climbed by Adam on the driver.

Prediction covers every word of every text. ``lang_pred`` has the largest sum of word probabilities, ``score`` is
its mean over the words; ties go to the first language by name.

Defined cases: a null text or one without a letter is ``und`` with score 0; without labelled texts all are.
Words without letters weigh nothing themselves. Rows are judged one by one, so repeated rows, null ids and
further columns make no difference. Memory follows the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from floorlens.llm.words import Memo, strings, text_batches, words_of
from floorlens.session import size_batches

BITS = 16
SAMPLE_DOCS = 300
SAMPLE_CHARS = 1500
SPAN = 12
SPANS = 6
ROUNDS = 40
STEP = 0.1
STRETCH_BYTES = 2 << 20
CELLS = 1 << 17
NEW_WORDS = 1 << 14
UNKNOWN = "und"


@dataclass
class Field:
    languages: list[str]
    weights: np.ndarray  # by feature and language
    transitions: np.ndarray  # from, to
    start: np.ndarray


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Features of words: their number per word, and the features of all words in a row.

    A word without letters has none. Features of a word follow no order.
    """
    if not words:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    data = np.frombuffer(b" " + " ".join(words).lower().encode() + b" ", np.uint8).astype(np.uint64)
    blank = data == 32
    word = np.cumsum(blank) - 1  # of each byte; a blank belongs to the word after it
    starts = np.flatnonzero(blank)[:-1]
    index = np.arange(len(data)) - starts[np.minimum(word, len(starts) - 1)]
    powers = np.cumprod(np.full(int(index.max()) + 2, 0x100000001B3, np.uint64))
    whole = np.add.reduceat(data * powers[index], starts)
    letter = ((data >= 97) & (data <= 122)) | (data >= 128)
    lettered = np.add.reduceat(letter, starts) > 0
    owners, hashes = [np.arange(len(starts))], [whole * np.uint64(0x9E3779B97F4A7C15)]
    for n, mix in ((2, 0xC2B2AE3D27D4EB4F), (3, 0x165667B19E3779F9), (4, 0x27D4EB2F165667C5)):
        # n bytes up to here, from the blank before the word to the blank after it at most
        at = np.flatnonzero((index >= n - 1) & ~blank)
        value = sum(data[at - j] << np.uint64(8 * j) for j in range(n))
        ends = np.flatnonzero(blank)[1:]
        own = ends - starts >= n - 1
        value_end = sum(data[ends[own] - j] << np.uint64(8 * j) for j in range(n))
        owners += [word[at], np.flatnonzero(own)]
        hashes += [value * np.uint64(mix), value_end * np.uint64(mix)]
    owner, value = np.concatenate(owners), np.concatenate(hashes)
    value = ((value ^ (value >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - BITS)
    kept = lettered[owner]
    owner, value = owner[kept], value[kept].astype(np.int64)
    order = np.argsort(owner, kind="stable")
    return np.bincount(owner, minlength=len(starts)), value[order]


def emissions(sizes: np.ndarray, values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Score of each word by language; features of a word weigh 1 / sqrt(their number)."""
    out = np.zeros((len(sizes), weights.shape[1]))
    some = sizes > 0
    if some.any():
        starts = (np.cumsum(sizes) - sizes)[some]
        for k in range(weights.shape[1]):
            out[some, k] = np.add.reduceat(weights[values, k], starts) / np.sqrt(sizes[some])
    return out


def forward_backward(scores: np.ndarray, lengths: np.ndarray, field: Field) -> tuple[np.ndarray, np.ndarray]:
    """Distribution of each word over languages, and expected transitions.

    ``scores``: place, text, language; texts are in falling order of length. Words beyond a text's end get 0.
    """
    places, texts, kinds = scores.shape
    step = np.exp(field.transitions - field.transitions.max())
    local = np.exp(scores - scores.max(axis=2, keepdims=True))
    open_ = np.searchsorted(-lengths, -np.arange(places), side="left")  # texts longer than the place
    ahead = np.zeros_like(local)
    now = local[0] * np.exp(field.start - field.start.max())
    ahead[0] = now / now.sum(axis=1, keepdims=True)
    for t in range(1, places):
        n = open_[t]
        now = (ahead[t - 1, :n] @ step) * local[t, :n]
        ahead[t, :n] = now / now.sum(axis=1, keepdims=True)
    out, moves = np.zeros_like(local), np.zeros((kinds, kinds))
    back = np.ones((texts, kinds))
    for t in range(places - 1, -1, -1):
        n = open_[t]
        now = ahead[t, :n] * back[:n]
        out[t, :n] = now / now.sum(axis=1, keepdims=True)
        if t:
            later = local[t, :n] * back[:n]
            pair = (later @ step.T) * ahead[t - 1, :n]
            moves += step * (ahead[t - 1, :n].T @ (later / pair.sum(axis=1, keepdims=True)))
            later = later @ step.T
            back[:n] = later / later.sum(axis=1, keepdims=True)
    return out, moves


def sample(docs: DataFrame, training: Column, text: str, label: str, key: str) -> list[tuple[str, int, str]]:
    """At most ``SAMPLE_DOCS`` stretches of text per language, as (language, hash, text).

    The lowest hashes of a language are taken. Only rows below a hash that leaves about twice as many, by the
    language's number of rows, are shuffled, so no task gathers more as the input or its partitions grow.
    """
    rows = docs.where(training & F.col(label).isNotNull() & F.col(text).isNotNull()).select(
        F.col(label).alias("label"), F.xxhash64(F.coalesce(F.col(key).cast("string"), text), F.lit(7)).alias("mark"), F.col(text).alias("body")
    )
    limits = []
    for name, n, least in rows.groupBy("label").agg(F.count("*"), F.min("mark")).collect():
        share = min(2 * SAMPLE_DOCS * 2**64 // n, 2**64 - 1)
        limits += [F.lit(name), F.lit(max(least, share - 2**63))]
    if not limits:
        return []
    rows = rows.where(F.col("mark") <= F.create_map(*limits)[F.col("label")])
    place = F.pmod("mark", F.greatest(F.length("body") - SAMPLE_CHARS, F.lit(1))) + 1
    rows = rows.select("label", "mark", F.substring("body", place.cast("int"), F.lit(SAMPLE_CHARS)).alias("body"))
    first = F.row_number().over(Window.partitionBy("label").orderBy("mark", "body"))
    found = rows.withColumn("rank", first).where(F.col("rank") <= SAMPLE_DOCS).collect()
    return sorted((r["label"], r["mark"], r["body"]) for r in found)


def train(rows: list[tuple[str, int, str]]) -> Field:
    """Fit weights and transitions to labelled stretches of text."""
    languages = sorted({r[0] for r in rows})
    kinds = len(languages)
    field = Field(languages, np.zeros((1 << BITS, kinds), np.float64), np.zeros((kinds, kinds)), np.zeros(kinds))
    offsets, codes, names = words_of(pa.array([r[2] for r in rows], pa.string()), lower=True)
    spans = [
        (languages.index(label), codes[i : min(i + SPAN, high)])
        for (label, *_), low, high in zip(rows, offsets.tolist(), offsets[1:].tolist()) for i in range(low, high, SPAN)
    ]
    if not spans:
        return Field([], field.weights[:, :0], field.transitions[:0, :0], field.start[:0])
    draw = np.random.default_rng(5)
    mixed = [spans[i] for i in draw.permutation(len(spans))]
    sequences = [mixed[i : i + SPANS] for i in range(0, len(mixed), SPANS)]
    sequences = sorted(
        ((np.concatenate([w for _, w in s]), np.concatenate([np.full(len(w), k) for k, w in s])) for s in sequences),
        key=lambda s: -len(s[0]),
    )
    lengths = np.array([len(s[0]) for s in sequences])
    words, truth = np.zeros((lengths[0], len(sequences)), np.int64), np.full((lengths[0], len(sequences)), -1)
    for i, (own, labels) in enumerate(sequences):
        words[: len(own), i], truth[: len(own), i] = own, labels
    inside = truth >= 0
    onehot = (truth[..., None] == np.arange(kinds)).astype(float)
    met = np.zeros((kinds, kinds))
    both = inside[1:] & inside[:-1]
    np.add.at(met, (truth[:-1][both], truth[1:][both]), 1)
    sizes, values = features(strings(names))
    scale = np.repeat(1 / np.sqrt(np.maximum(sizes, 1)), sizes)
    total = inside.sum()
    memory = {name: [0.0, 0.0] for name in ("weights", "transitions", "start")}
    for turn in range(1, ROUNDS + 1):
        table = emissions(sizes, values, field.weights)
        found, moves = forward_backward(table[words], lengths, field)
        miss = (onehot - found) * inside[..., None]
        slopes = {"transitions": (met - moves) / total, "start": miss[0].sum(axis=0) / total}
        by_feature = np.zeros_like(field.weights)
        for k in range(kinds):
            by_word = np.bincount(words[inside], miss[..., k][inside], len(sizes))
            by_feature[:, k] = np.bincount(values, np.repeat(by_word, sizes) * scale, 1 << BITS)
        slopes["weights"] = by_feature / total - 1e-6 * field.weights
        for name, slope in slopes.items():
            first, second = memory[name]
            first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope**2
            memory[name] = [first, second]
            change = STEP * (first / (1 - 0.9**turn)) / (np.sqrt(second / (1 - 0.99**turn)) + 1e-8)
            setattr(field, name, getattr(field, name) + change)
    return field


def fit(docs: DataFrame, training: Column, text: str = "text", label: str = "lang", key: str = "doc_id") -> Field:
    """Learn from the labelled texts for which ``training`` holds."""
    return train(sample(docs, training, text, label, key))


def shares(texts: pa.Array, field: Field, memo: Memo) -> np.ndarray:
    """Mean distribution of each text's words over languages; zeros for a text without words."""
    offsets, codes, names = words_of(texts, lower=True)
    places = memo.places(strings(names))
    table = memo.values[memo.starts[places]]
    lengths = np.diff(offsets)
    out = np.zeros((len(lengths), len(field.languages)))
    order = np.argsort(-lengths, kind="stable")
    order = order[lengths[order] > 0]
    at = 0
    while at < len(order):
        longest = int(lengths[order[at]])
        part = order[at : at + max(1, CELLS // longest)]
        at += len(part)
        own = lengths[part]
        grid = np.zeros((longest, len(part), len(field.languages)), np.float32)
        rows = np.arange(longest)[:, None] < own
        spots = np.where(rows, offsets[:-1][part] + np.arange(longest)[:, None], 0)
        grid[rows] = table[codes[spots[rows]]]
        found, _ = forward_backward(grid, own, field)
        out[part] = found.sum(axis=0, dtype=np.float64) / own[:, None]
    return out


def judge(batches: Iterator[pa.RecordBatch], column: str, field: Field) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    """The batches in stretches, with the language, score and shares of each text in ``column``."""

    def make(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        # Some words at a time: features of a word are many times as large as the word.
        runs = [words[i : i + NEW_WORDS] for i in range(0, max(len(words), 1), NEW_WORDS)]
        return np.ones(len(words), np.int64), np.concatenate([emissions(*features(r), field.weights).astype(np.float32) for r in runs])

    memo = Memo(make)
    for batch in batches:
        for part in text_batches(batch, column, STRETCH_BYTES):
            texts = part.column(column)
            known = pc.match_substring_regex(texts, r"\p{L}").to_numpy(zero_copy_only=False)
            if field.languages:
                found = shares(texts, field, memo)
                best = found.argmax(axis=1)
                names = np.where(known, np.array(field.languages, object)[best], UNKNOWN)
                scores = np.where(known, np.minimum(found[np.arange(len(best)), best], 1.0), 0.0)
            else:
                found = np.zeros((len(texts), 0))
                names, scores = np.full(len(texts), UNKNOWN, object), np.zeros(len(texts))
            yield part, names, scores, found


def predict(docs: DataFrame, field: Field, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, ``lang_pred``, ``score`` and ``shares`` (of words, by the field's languages in order)."""
    size_batches(docs.sparkSession)
    rows = docs.select(F.col(key), F.col(text).alias("body"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, names, scores, found in judge(batches, "body", field):
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(len(names) + 1, dtype=np.int32) * found.shape[1]), pa.array(found.ravel())
            )
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(names, pa.string()), pa.array(scores), lists], [key, "lang_pred", "score", "shares"]
            )

    schema = T.StructType([rows.schema[key], *T.StructType.fromDDL("lang_pred string, score double, shares array<double>")])
    return rows.mapInArrow(run, schema)


def accept(docs: DataFrame, least: float = 0.35, text: str = "text", label: str = "lang", key: str = "doc_id") -> DataFrame:
    """The rows whose language is known with a score of ``least`` at least, with the columns they came with.

    ``text`` is one of these columns, so each text goes to the worker and back once.
    """
    field = fit(docs, F.lit(True), text, label, key)
    size_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, names, scores, _ in judge(batches, text, field):
            yield part.filter(pa.array((names != UNKNOWN) & (scores >= least)))

    return docs.mapInArrow(run, docs.schema)
