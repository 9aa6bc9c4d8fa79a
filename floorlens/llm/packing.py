"""Token sequences of bounded length, packed by Karmarkar-Karp differencing.

Documents become ids and an end id. Full windows are cut off a document first; what remains is cut into
parts of at most ``part`` ids. Blocks of consecutive remainders are dealt into windows by multiway
differencing: the two partial partitions of largest imbalance are merged, the large sums of one onto the
small sums of the other, until one partition is left. Its windows are nearly equal; while the largest
exceeds the capacity, the window count rises by one.

Each task packs the rows it reads in blocks of ``BLOCK`` remainders: nothing is shuffled or gathered, and
memory is bounded by a block. A block leaves less than two windows of padding.

Defined cases: a null or empty text is its end id alone; repeated rows are packed as often as they occur;
null ids stay null; an empty table gives no rows; further columns are not read. A very long text is
coded in stretches of its words' own cache and yields its full windows at once.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, count
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from floorlens.llm.words import Memo, strings, text_batches, words_of

CAPACITY = 2048
PART = 512
BLOCK = 1024
END_ID = 1
BORDER = "<|endoftext|>"
CACHED = 400_000
STRETCH_BYTES = 1 << 20
#: Lower-case Latin letters, then ASCII marks but the apostrophe: the tokenizer's rules leave such a word as it is and cut it there.
PLAIN = re.compile(r"([a-zß-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
RULES = [
    {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": SPLIT}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ]},
]


def byte_letters() -> dict[int, int]:
    """The character that stands for each byte in a byte-level vocabulary: itself if it prints, else one from 256 on."""
    prints = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = count(256)
    return {b: b if b in prints else next(others) for b in range(256)}


class WordIds:
    """Ids of words by a public tokenizer that drops white space; results are kept by word.

    White space always ends a token and yields none, so the ids of a text are those of its words. A-Z are
    lower-cased before the look-up, as the tokenizer itself does. Plain words go to the tokenizer's model, letters and
    marks apart, if its rules are ``RULES``. Others are coded many at a time with a special token between them; words
    that could hold one are coded alone.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.border = self.tokenizer.token_to_id(BORDER)
        self.rules = [json.loads(p.__getstate__()) if p else None for p in (self.tokenizer.normalizer, self.tokenizer.pre_tokenizer)]
        self.model, self.letters = self.tokenizer.model, byte_letters()
        self.marks = lru_cache(1 << 12)(self._piece)
        self.memo = Memo(self._make, CACHED)

    def _piece(self, piece: str) -> list[int]:
        """Ids of a piece that the tokenizer's rules leave whole."""
        if not piece.isascii():
            piece = piece.encode().decode("latin-1").translate(self.letters)
        return [t.id for t in self.model.tokenize(piece)] if piece else []

    def _make(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Sizes and joined ids of the words."""
        known, parts, rest = self.rules == RULES, [], []
        for i, word in enumerate(words):
            found = PLAIN.fullmatch(word) if known else None
            if found and "<|" not in word:
                letters, marks = found.groups()
                parts.append(self._piece(letters) + self.marks(marks))
            else:
                parts.append([])
                rest.append(i)
        if rest:
            sizes, values = self._others([words[i] for i in rest])
            for i, own in zip(rest, np.split(values, np.cumsum(sizes)[:-1])):
                parts[i] = own.tolist()
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        return sizes, np.fromiter(chain.from_iterable(parts), np.int32, int(sizes.sum()))

    def _others(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Sizes and joined ids of words that need all of the tokenizer's rules."""
        own = [i for i, w in enumerate(words) if "<|" in w]
        rest = [w for w in words if "<|" not in w] if own else words
        lines = [BORDER.join(["", *rest[i : i + 64]]) for i in range(0, len(rest), 64)]
        # A few lines at a time: an encoding is many times as large as its ids.
        ids = [
            np.array(e.ids, np.int32) for i in range(0, len(lines), 128)
            for e in self.tokenizer.encode_batch_fast(lines[i : i + 128], add_special_tokens=False)
        ]
        flat = np.concatenate([np.empty(0, np.int32), *ids])
        starts = np.flatnonzero(flat == self.border)
        sizes = np.diff(np.append(starts, len(flat))) - 1
        values = flat[flat != self.border]
        if own:
            runs = iter(np.split(values, np.cumsum(sizes)[:-1]))
            alone = {i: np.array(self.tokenizer.encode(words[i], add_special_tokens=False).ids, np.int32) for i in own}
            parts = [alone[i] if i in alone else next(runs) for i in range(len(words))]
            sizes, values = np.array([len(p) for p in parts]), np.concatenate(parts)
        return sizes, values

    def encode(self, texts: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """Offsets per text and the ids of all texts, each followed by ``end``."""
        offsets, codes, names = words_of(texts, lower=True)
        ends, ids = self.memo.runs(self.memo.places(strings(names))[codes])
        bounds = np.concatenate([[0], ends])[offsets]
        return bounds + np.arange(len(bounds)), np.insert(ids, bounds[1:], end)


def differencing(sizes: list[int], windows: int) -> list[list[int]]:
    """Deal items into windows of nearly equal sums: for each window, the places of its items."""
    heap = [(-size, i, [(size, [i])]) for i, size in enumerate(sizes)]
    if windows == 1:
        return [list(range(len(sizes)))]
    heapq.heapify(heap)
    serial = len(heap)
    while len(heap) > 1:
        one, two = heapq.heappop(heap)[2], heapq.heappop(heap)[2]
        # Both are in falling order of sums; windows that hold nothing yet are left out.
        shared = len(one) + len(two) - windows
        if shared <= 0:
            merged = one + two
        else:
            kept, other = len(one) - shared, two[::-1]
            both = [(a + b, x + y) for (a, x), (b, y) in zip(one[kept:], other)]
            merged = one[:kept] + both + other[shared:]
        merged.sort(key=itemgetter(0), reverse=True)
        low = merged[-1][0] if len(merged) == windows else 0
        heapq.heappush(heap, (low - merged[0][0], serial, merged))
        serial += 1
    return [places for _, places in heap[0][2]]


def pack(sizes: list[int], capacity: int) -> list[list[int]]:
    """Windows of at most ``capacity`` over items of at most ``capacity``; their number rises until all fit."""
    windows = max(1, -(-sum(sizes) // capacity))
    while True:
        dealt = differencing(sizes, windows)
        if max(sum(sizes[i] for i in w) for w in dealt) <= capacity:
            return dealt
        windows += 1


def _windows(pieces: list[tuple], capacity: int, serial: Iterator[int]) -> Iterator[tuple]:
    """Rows of a block of pieces ``(key, start, ids, doc_tokens)`` with their sequence and offset."""
    for window in pack([len(p[2]) for p in pieces], capacity):
        sequence, offset = next(serial), 0
        for i in window:
            key, start, ids, whole = pieces[i]
            yield key, start, len(ids), ids.tobytes(), whole, sequence, offset
            offset += len(ids)


def packed(
    docs: DataFrame, path: str, key: str = "doc_id", text: str = "text",
    capacity: int = CAPACITY, part: int = PART, block: int = BLOCK, end: int = END_ID,
) -> DataFrame:
    """Per piece: key, ``start``, ``length``, ``ids`` (little-endian 32-bit), ``doc_tokens``, ``sequence_id``, ``offset``.

    Sequences are numbered within the task, below the task's own number.
    """
    rows = docs.select(F.col(key), F.col(text).alias("body"))
    kind = rows.schema[key].dataType.simpleString()
    names = [key, "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    schema = f"`{key}` {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordIds(path)
        serial = count(TaskContext.get().partitionId() << 32)
        types, waiting = None, []

        def rows_of(out: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

        for batch in batches:
            types = [batch.schema.field(0).type, *[pa.int64()] * 2, pa.binary(), *[pa.int64()] * 3]
            for stretch in text_batches(batch, "body", STRETCH_BYTES):
                offsets, ids = words.encode(stretch.column("body"), end)
                ids, out = ids.astype("<u4"), []
                for name, low, high in zip(stretch.column(0).to_pylist(), offsets.tolist(), offsets[1:].tolist()):
                    whole, start = high - low, 0
                    for start in range(0, whole - capacity + 1, capacity):
                        out.append((name, start, capacity, ids[low + start : low + start + capacity].tobytes(), whole, next(serial), 0))
                    for start in range(whole - whole % capacity, whole, part):
                        waiting.append((name, start, ids[low + start : min(low + start + part, high)].copy(), whole))
                while len(waiting) >= block:
                    out.extend(_windows(waiting[:block], capacity, serial))
                    del waiting[:block]
                if out:
                    yield rows_of(out)
        if waiting:
            yield rows_of(list(_windows(waiting, capacity, serial)))

    return rows.mapInArrow(run, schema)
