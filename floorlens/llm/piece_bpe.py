"""SentencePiece encoding by a score-ordered agenda of adjacent symbol pairs.

A merge-type vocabulary joins, again and again, the adjacent pair of symbols whose joined string has the best
score, the leftmost one on a tie. The candidates wait in an agenda ordered by score and place; a candidate one of
whose symbols has been joined meanwhile is stale and passed over, a join offers the pairs with its two neighbours. Characters
outside the vocabulary become their UTF-8 bytes.

A blank is written as the mark U+2581, and one is put before the text. No joined string has the mark behind
another character, so no join crosses the border before a run of marks, nor a pair of characters that no piece holds: a text is
cut there, each distinct part goes through the agenda once for each worker (``words.Memo``), and each distinct segment
is checked against the sentencepiece library in the same Arrow batch. A difference, or a vocabulary of another kind, is an error. Decoding is that of
the library.

Defined cases: a null text counts as empty; an empty text has the begin and end ids alone and decodes to
nothing; a mark in the text is a blank, as for the library. Rows are coded one by one, so repeated rows, null ids and further
columns make no difference. Memory follows the longest text: 4 MB of text are coded at a time.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2

from floorlens.llm.words import Memo, coded, gather, stretches, strings, text_batches

MODEL = "piece_bpe_32k.model"
MARK = "▁"
IDS = 1 << 19
SEGMENTS, PARTS = 200_000, 600_000
#: An entry of the agenda is one number: the place of the score above, the symbol's place below.
PLACES = 40
LAST = (1 << PLACES) - 1
SEGMENT = re.compile(" +[^ ]*")
LETTER = r"[^\W\d_]"


class Pieces:
    """The merge order and ids of a public vocabulary, and its library as a check."""

    def __init__(self, path: str):
        with open(path, "rb") as data:
            model = sentencepiece_model_pb2.ModelProto.FromString(data.read())
        normal, byte = model.SentencePiece.NORMAL, model.SentencePiece.BYTE
        kinds = {p.type for p in model.pieces} - {normal, byte, model.SentencePiece.CONTROL, model.SentencePiece.UNKNOWN}
        spec = model.normalizer_spec
        if model.trainer_spec.model_type != model.trainer_spec.BPE or kinds or not model.trainer_spec.byte_fallback:
            raise ValueError(f"{path} is no plain merge-type vocabulary with bytes for unknown characters")
        if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not (spec.add_dummy_prefix and spec.escape_whitespaces):
            raise ValueError(f"{path} changes texts in another way than by marks for blanks")
        self.ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type == normal}
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError(f"{path} joins across words")
        scores = sorted({p.score for p in model.pieces if p.type == normal}, reverse=True)
        place = {score: i for i, score in enumerate(scores)}
        self.order = {p.piece: place[p.score] for p in model.pieces if p.type == normal and len(p.piece) > 1}
        self.bytes = [next(i for i, p in enumerate(model.pieces) if p.type == byte and p.piece == f"<0x{b:02X}>") for b in range(256)]
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
        self.begin, self.end = self.library.bos_id(), self.library.eos_id()
        self.cut = self._cuts()
        self.memo, self.parts = Memo(self._learn, SEGMENTS), Memo(self._merge, PARTS)

    def _cuts(self) -> re.Pattern:
        """Matches where no piece crosses: behind a letter before a sign that follows no letter within any
        piece, and behind a sign that is in no longer piece at all."""
        inner = {p[i : i + 2] for p in self.order for i in range(len(p) - 1)}
        behind = {b for a, b in inner if re.match(LETTER, a)}
        signs = [c for c in map(chr, range(128)) if not c.isalnum() and c not in " _"]
        stops = "".join(re.escape(c) for c in signs if c not in behind)
        alone = "".join(re.escape(c) for c in signs if c not in set("".join(inner)))
        found = [f"(?<={LETTER})(?=[{stops}])"] * bool(stops) + [f"(?<=[{alone}])"] * bool(alone)
        return re.compile("|".join(found) or r"(?!)")

    def merge(self, segment: str) -> list[int]:
        """Ids of one segment, blanks written as marks."""
        rank, symbols = self.order.get, list(segment)
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        # The score's place of the pair that now begins at each symbol; an entry of the agenda that tells another is stale.
        pending = [rank(a + b, -1) for a, b in zip(symbols, symbols[1:])]
        pending.append(-1)
        agenda = [place << PLACES | i for i, place in enumerate(pending) if place >= 0]
        heapify(agenda)
        while agenda:
            entry = heappop(agenda)
            i = entry & LAST
            if pending[i] != entry >> PLACES:
                continue
            j = after[i]
            joined = symbols[i] + symbols[j]
            symbols[i], symbols[j], pending[j] = joined, None, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                pending[i] = place = rank(joined + symbols[k], -1)
                if place >= 0:
                    heappush(agenda, place << PLACES | i)
            else:
                pending[i] = -1
            h = before[i]
            if h >= 0:
                pending[h] = place = rank(symbols[h] + joined, -1)
                if place >= 0:
                    heappush(agenda, place << PLACES | h)
        out: list[int] = []
        i, known = 0, self.ids.get
        while i < n:
            own = known(symbols[i])
            if own is None:
                out.extend([self.bytes[b] for b in symbols[i].encode()])
            else:
                out.append(own)
            i = after[i]
        return out

    def _merge(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [self.merge(p.replace(" ", MARK)) for p in parts]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return sizes, np.fromiter(chain.from_iterable(found), np.int32, int(sizes.sum()))

    def _learn(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Sizes and joined ids of new segments, each checked against the library."""
        cut = [list(filter(None, self.cut.split(s))) for s in segments]
        ends, ids = self.parts.runs(self.parts.places(list(chain.from_iterable(cut))))
        bounds = np.concatenate([[0], ends])[np.cumsum([0, *map(len, cut)])]
        theirs = self.library.encode([s[1:] for s in segments], num_threads=1)
        # The library puts no mark before an empty text, so a lone blank has no counterpart there.
        known = [t if s != " " else self.merge(MARK) for s, t in zip(segments, theirs)]
        sizes = np.diff(bounds)
        if list(map(len, known)) != sizes.tolist() or not np.array_equal(np.fromiter(chain.from_iterable(known), np.int32), ids):
            off = next(s for s, t, a, b in zip(segments, known, bounds, bounds[1:]) if ids[a:b].tolist() != t)
            raise RuntimeError(f"the agenda and the library differ at {off!r}")
        return sizes, ids

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Offsets per text and the ids of all texts, with begin and end.

        Texts with single blanks between other characters are cut by Arrow; the others by an expression.
        """
        texts = pc.replace_substring(texts, MARK, " ")
        odd = pc.match_substring_regex(texts, "^ | $|  ").to_numpy(zero_copy_only=False)
        offsets, codes, names = coded(pc.split_pattern(pc.if_else(pa.array(odd), "", texts), " "))
        segments = [" " + n for n in strings(names)]
        if odd.any():
            cut = [SEGMENT.findall(" " + t) for t in texts.filter(pa.array(odd)).to_pylist()]
            counts = np.zeros(len(odd), np.int64)
            counts[odd] = [len(c) for c in cut]
            more = np.arange(int(counts.sum())) + len(segments)
            segments += chain.from_iterable(cut)
            codes = np.insert(codes.astype(np.int64), np.repeat(offsets[:-1], counts), more)
            offsets = offsets + np.concatenate([[0], np.cumsum(counts)])
        ends, ids = self.memo.runs(self.memo.places(segments)[codes])
        inner = np.concatenate([[0], ends])[offsets]
        sizes = np.diff(inner) + 2
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        out = np.empty(int(bounds[-1]), np.int32)
        out[bounds[:-1]], out[bounds[1:] - 1] = self.begin, self.end
        out[gather(bounds[:-1] + 1, sizes - 2)] = ids
        return bounds, out


_LOADED: dict[str, Pieces] = {}


def vocabulary(path: str) -> Pieces:
    """The vocabulary of a file, loaded once per Python worker."""
    if path not in _LOADED:
        _LOADED[path] = Pieces(path)
    return _LOADED[path]


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key and ``ids``: the token ids of the whole text with begin and end, as little-endian 32-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = vocabulary(path)
        for batch in batches:
            for part in text_batches(batch, "body"):
                bounds, ids = table.encode(part.column("body"))
                data = pa.Array.from_buffers(
                    pa.large_binary(), part.num_rows, [None, pa.py_buffer(bounds * 4), pa.py_buffer(ids.astype("<u4"))]
                )
                yield pa.RecordBatch.from_arrays([part.column(0), data.cast(pa.binary())], [key, "ids"])

    rows = docs.select(F.col(key), F.col(text).alias("body"))
    kind = rows.schema[key].dataType.simpleString()
    return rows.mapInArrow(run, f"`{key}` {kind}, ids binary")


def decode(rows: DataFrame, path: str, key: str = "doc_id") -> DataFrame:
    """Key, ``ids`` and ``decoded``, the library's text for the ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = sentencepiece.SentencePieceProcessor(model_file=path)
        for whole in batches:
            sizes = pc.fill_null(pc.binary_length(whole.column(1)), 0).to_numpy(zero_copy_only=False) // 4
            for start, stop in stretches(sizes, IDS):
                batch = whole.slice(start, stop - start)
                ids = [np.frombuffer(b or b"", "<u4").tolist() for b in batch.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(library.decode(ids, num_threads=1), pa.string())], [key, "ids", "decoded"])

    rows = rows.select(key, "ids")
    kind = rows.schema[key].dataType.simpleString()
    return rows.mapInArrow(run, f"`{key}` {kind}, ids binary, decoded string")
