"""Byte-level BPE over padded matrices.

A text is cut by the public split pattern; each distinct piece is merged once per stretch. Pieces are
put into matrices by length, one row per piece, padded. Each round every row merges its leftmost pair
of lowest rank; the rank of a pair is found in a hash table of all pairs whose joined bytes are a
token. Rows without a further merge leave the matrix. A piece that is a token itself is that token.

Pieces beyond ``LONGEST`` bytes would need as many rounds as bytes over a wide row; they are merged one by
one with a heap, in the same order of merges and so to the same ids.

Defined cases: a null text counts as empty; an empty text has no ids and decodes to no bytes. Rows are
coded one by one, so repeated rows, null ids and further columns make no difference. Memory follows
the longest text: 4 MB of text are coded at a time.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from floorlens.llm.words import Memo, coded, gather, stretches, strings, text_batches

RANKS = "byte_bpe_multi_50k.tiktoken"
LONGEST = 256
CELLS = 1 << 20
IDS = 1 << 19
CACHED = 200_000
NONE = np.int32(2**31 - 1)
#: White space as the split pattern means it, the Unicode property.
SPACE = r"\t-\r \x85\xa0  -     　"
RE2_SPACE = r"\t-\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"


class Vocabulary:
    """Ranks of a public vocabulary and the hash table of its pairs."""

    def __init__(self, path: str, pattern: str = public_tokenizers.PATTERN):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        by_id = sorted((rank, token) for token, rank in self.ranks.items())
        if [rank for rank, _ in by_id] != list(range(len(by_id))):
            raise ValueError("ranks must be 0, 1, 2, ...")
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        pairs = [
            (self.ranks[t[:i]], self.ranks[t[i:]], rank)
            for t, rank in self.ranks.items() for i in range(1, len(t)) if t[:i] in self.ranks and t[i:] in self.ranks
        ]
        left, right, rank = np.array(pairs, np.int64).T
        self._fill((left << 32) | right, rank.astype(np.int32))
        self.split = regex.compile(pattern.replace(r"[^\s\p{L}", f"[^{SPACE}\\p{{L}}").replace(r"\s", f"[{SPACE}]").replace(r"\S", f"[^{SPACE}]"))
        self.memo = Memo(self._learn, CACHED)

    def _fill(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Open addressing with linear probing at a load of a quarter at most."""
        self.bits = int(4 * len(keys)).bit_length()
        size = 1 << self.bits
        self.keys, self.values = np.full(size + 64, -1, np.int64), np.full(size + 64, NONE, np.int32)
        places, left = self._hash(keys), np.arange(len(keys))
        self.probes = 0
        while len(left):
            self.probes += 1
            spot = places[left] + self.probes - 1
            free = self.keys[spot] == -1
            spots, first = np.unique(spot[free], return_index=True)
            taken = left[free][first]
            self.keys[spots], self.values[spots] = keys[taken], values[taken]
            left = np.setdiff1d(left, taken, assume_unique=True)

    def _hash(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, ``NONE`` where joining gives no token; ids of -1 are padding."""
        keys = (left.astype(np.int64) << 32) | right.astype(np.int64)
        place, out = self._hash(keys), np.full(keys.shape, NONE, np.int32)
        flat, spots, found = keys.ravel(), place.ravel(), out.ravel()
        left = np.arange(len(flat))
        for probe in range(self.probes):
            at = spots[left] + probe
            there = self.keys[at]
            hit = there == flat[left]
            found[left[hit]] = self.values[at[hit]]
            left = left[~hit & (there != -1)]
            if not len(left):
                break
        return np.where((right < 0) | (out == NONE), NONE, out) if keys.size else out

    def merge(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Sizes of the pieces in ids, and the ids of all of them in a row."""
        whole = np.fromiter((self.ranks.get(p, -1) for p in pieces), np.int64, len(pieces))
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        starts = np.cumsum(lengths) - lengths
        codes = self.byte_ids[np.frombuffer(b"".join(pieces), np.uint8)]
        sizes = (whole >= 0).astype(np.int64)
        found = [(np.flatnonzero(whole >= 0), whole[whole >= 0].astype(np.int32))]
        for i in np.flatnonzero((whole < 0) & (lengths > LONGEST)).tolist():
            ids = self._merge_long(pieces[i])
            sizes[i] = len(ids)
            found.append((np.array([i]), ids))
        low = 0
        for width in (4, 8, 16, 32, 64, 128, LONGEST):
            members = np.flatnonzero((whole < 0) & (lengths > low) & (lengths <= width))
            low = width
            for at in range(0, len(members), CELLS // width):
                part = members[at : at + CELLS // width]
                grid = np.full((len(part), width), -1, np.int32)
                grid[np.arange(width) < lengths[part, None]] = codes[gather(starts[part], lengths[part])]
                done = self._merge_matrix(grid)
                sizes[part] = (done >= 0).sum(axis=1)
                found.append((part, done[done >= 0]))
        out = np.empty(int(sizes.sum()), np.int32)
        places = np.cumsum(sizes) - sizes
        for members, ids in found:
            out[gather(places[members], sizes[members])] = ids
        return sizes, out

    def _merge_matrix(self, ids: np.ndarray) -> np.ndarray:
        """Merged rows, padded with -1."""
        width = ids.shape[1]
        done, rows = ids.copy(), np.arange(len(ids))
        ranks = self.pair_ranks(ids[:, :-1], ids[:, 1:])
        columns = np.arange(width)
        while True:
            at = ranks.argmin(axis=1)
            best = ranks[np.arange(len(rows)), at]
            going = best != NONE
            if not going.all():
                done[rows[~going]] = ids[~going]
                rows, ids, ranks, at, best = rows[going], ids[going], ranks[going], at[going], best[going]
            if not len(rows):
                return done
            own = np.arange(len(rows))
            ids[own, at] = best
            source = np.minimum(columns + (columns > at[:, None]), width - 1)
            ids = np.take_along_axis(ids, source, 1)
            ids[:, -1] = -1
            ranks = np.take_along_axis(ranks, source[:, :-1].clip(max=width - 2), 1)
            ranks[:, -1] = NONE
            last = np.minimum(at, width - 2)
            ranks[own, last] = np.where(at + 1 < width, self.pair_ranks(ids[own, at], ids[own, np.minimum(at + 1, width - 1)]), NONE)
            inner = at > 0
            before = at[inner] - 1
            ranks[own[inner], before] = self.pair_ranks(ids[own[inner], before], ids[own[inner], at[inner]])

    def _merge_long(self, piece: bytes) -> np.ndarray:
        """The same merges by a heap over a linked list."""
        ids = self.byte_ids[np.frombuffer(piece, np.uint8)].tolist()
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        texts: list[bytes | None] = [piece[i : i + 1] for i in range(len(ids))]
        heap: list[tuple[int, int, bytes, bytes]] = []

        def offer(i: int) -> None:
            j = after[i]
            if j < len(ids) and (rank := self.ranks.get(texts[i] + texts[j])) is not None:
                heapq.heappush(heap, (rank, i, texts[i], texts[j]))

        for i in range(len(ids) - 1):
            offer(i)
        while heap:
            rank, i, one, two = heapq.heappop(heap)
            j = after[i]
            if texts[i] != one or j >= len(ids) or texts[j] != two:
                continue
            texts[i], texts[j], ids[i], after[i] = one + two, None, rank, after[j]
            if after[i] < len(ids):
                before[after[i]] = i
            if before[i] >= 0:
                offer(before[i])
            offer(i)
        return np.array([ids[i] for i in range(len(ids)) if texts[i] is not None], np.int32)

    def _parts(self, piece: str) -> list[str]:
        """Matches of the pattern; a blank and letters are one, with or without a stop or comma after them."""
        if piece[:1] == " ":
            if piece[1:].isalpha():
                return [piece]
            if piece[-1] in ".,!" and piece[1:-1].isalpha():
                return [piece[:-1], piece[-1]]
        return self.split.findall(piece)

    def _learn(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of new pieces; each is cut by the pattern first, its parts are merged together."""
        parts = list(map(self._parts, pieces))
        distinct = list(dict.fromkeys(chain.from_iterable(parts)))
        place = {p: i for i, p in enumerate(distinct)}
        sizes, table = self.merge([p.encode() for p in distinct])
        used = np.fromiter(map(place.__getitem__, chain.from_iterable(parts)), np.int64)
        counts = np.array([len(own) for own in parts], np.int64)
        ends = np.concatenate([[0], np.cumsum(sizes[used])])
        bounds = ends[np.concatenate([[0], np.cumsum(counts)])]
        return np.diff(bounds), table[gather((np.cumsum(sizes) - sizes)[used], sizes[used])]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Offsets per text and the ids of all texts.

        At a single blank between other characters the pattern always starts a new match, so texts without
        other white space next to a blank are cut at blanks, and each distinct piece is coded once. Other
        texts are one piece each.
        """
        odd = pc.match_substring_regex(texts, f"^ | $| [{RE2_SPACE}]|[{RE2_SPACE}] ").to_numpy(zero_copy_only=False)
        offsets, codes, names = coded(pc.split_pattern(pc.if_else(pa.array(odd), "", texts), " "))
        names = strings(names)
        # A piece at the start of its text has no blank before it.
        heads = offsets[:-1][offsets[1:] > offsets[:-1]]
        first, where = np.unique(codes[heads], return_inverse=True)
        codes = codes.astype(np.int64)
        codes[heads] = len(names) + where
        rest = texts.filter(pa.array(odd)).to_pylist()
        pieces = [" " + n for n in names] + [names[i] for i in first.tolist()]
        codes = np.insert(codes, offsets[:-1][odd], len(pieces) + np.arange(len(rest)))
        offsets = offsets + np.concatenate([[0], np.cumsum(odd)])
        ends, ids = self.memo.runs(self.memo.places(pieces + rest)[codes])
        return np.concatenate([[0], ends])[offsets], ids.astype(np.int32)


class Tokens:
    """Bytes of the tokens of a vocabulary by id."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            tokens = [token for _, token in sorted((int(b), base64.b64decode(a)) for a, b in map(bytes.split, lines))]
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.lengths = np.array([len(t) for t in tokens])
        self.starts = np.cumsum(self.lengths) - self.lengths

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Offsets per row and the bytes of all rows."""
        lengths = self.lengths[ids]
        return np.concatenate([[0], np.cumsum(lengths)])[offsets], self.bytes[gather(self.starts[ids], lengths)]


_LOADED: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    """The vocabulary of a file, loaded once per Python worker."""
    if path not in _LOADED:
        _LOADED[path] = Vocabulary(path)
    return _LOADED[path]


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key and ``ids``, the token ids of the whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = vocabulary(path)
        for batch in batches:
            for part in text_batches(batch, "body"):
                offsets, ids = table.encode(part.column("body"))
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([part.column(0), lists], [key, "ids"])

    rows = docs.select(F.col(key), F.col(text).alias("body"))
    kind = rows.schema[key].dataType.simpleString()
    return rows.mapInArrow(run, f"`{key}` {kind}, ids array<int>")


def decode(rows: DataFrame, path: str, key: str = "doc_id") -> DataFrame:
    """Key, ``ids`` and ``decoded``, the bytes the ids stand for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Tokens(path)
        for whole in batches:
            sizes = pc.fill_null(pc.list_value_length(whole.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            for start, stop in stretches(sizes, IDS):
                batch = whole.slice(start, stop - start)
                offsets = np.concatenate([[0], np.cumsum(sizes[start:stop])])
                ends, data = table.decode(batch.column(1).flatten().to_numpy(), offsets)
                decoded = pa.Array.from_buffers(
                    pa.large_binary(), len(batch), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data)]
                )
                yield pa.RecordBatch.from_arrays([*batch.columns, decoded.cast(pa.binary())], [key, "ids", "decoded"])

    rows = rows.select(key, "ids")
    kind = rows.schema[key].dataType.simpleString()
    return rows.mapInArrow(run, f"`{key}` {kind}, ids array<int>, decoded binary")


def ids_text(ids: Column) -> Column:
    """Decimal ids joined by commas."""
    return F.array_join(ids.cast("array<string>"), ",")
