"""Prediction by partial matching over byte contexts.

A text is the sequence of its words and one end token. It is coded byte by byte: its words, each with a closing
blank, then one more blank as the end; a blank stands before the first word. The context of a byte are the up to
``ORDER`` bytes before it in the whole text, so contexts reach over blanks into the words before, and the order of
the words counts.

Probabilities are those of method D with exclusion: in a context seen T times with q distinct symbols, a symbol
seen c times has (2c - 1) / 2T and escape q / 2T; after an escape, the symbols of the longer context no longer
count in the shorter one. Contexts never seen are skipped. Below order 0, the bytes not seen at all are
equally likely. The model is pretrained: fitted on the training texts, then fixed.

A node of the trie and a symbol after it are one number, the byte string. Texts go into blocks, and a block's distinct
tokens and strings are counted where its texts are read. They travel as packed binaries, dealt by hash into buckets of
about ``ENTRIES``, never as a row each; buckets add up the counts of all blocks. The distinct strings are
grouped by the last three bytes of their contexts, which hold all that the orders above two need; the counts of the orders up to
two are at most 2^24 numbers by the width of three bytes, and go to all groups. The lengths found go back to
the buckets, from there to the blocks, which add them up along their texts. Nothing else of corpus size reaches the driver or a broadcast. Small partitions of the input are read
together, as far as all cores have work, because larger blocks hold fewer strings in all.

Defined cases: a null text counts as empty and has the end token alone; without training texts all counts
are 0 and bytes are equally likely; repeated rows count as often as they occur; ids may be null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from floorlens.llm.words import text_batches, words_of
from floorlens.session import pin, unpin

ORDER = 6
BLOCK_BYTES = 24 << 20
#: Places whose byte strings are held at once.
WINDOW = 1 << 19
#: Strings that wait until they are added up.
WAITING = 1 << 21
#: Tokens and strings of all blocks in a bucket, and distinct strings in a group, on average.
ENTRIES = 1 << 21
GROUP = 200_000


def _serial() -> Iterator[int]:
    at = TaskContext.get().partitionId() << 32
    while True:
        yield at
        at += 1


def packed(values: np.ndarray) -> bytes:
    """Numbers of eight bytes as a binary, equal bytes side by side."""
    return pa.compress(values.view(np.uint8).reshape(-1, 8).T.tobytes(), codec="zstd", asbytes=True)


def unpacked(data: bytes, size: int, kind: type = np.int64) -> np.ndarray:
    flat = np.frombuffer(pa.decompress(data, decompressed_size=8 * size, codec="zstd"), np.uint8)
    return np.ascontiguousarray(flat.reshape(8, size).T).view(kind).ravel()


def packed_lines(lines: pa.Array) -> bytes:
    data = b"".join(lines.cast(pa.binary()).to_pylist())
    return pa.Codec("zstd", compression_level=4).compress(data, asbytes=True)


def unpacked_lines(data: bytes, sizes: np.ndarray) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    whole = pa.decompress(data, decompressed_size=int(ends[-1]), codec="zstd")
    return pa.StringArray.from_buffers(len(sizes), pa.py_buffer(ends), whole)


def packed_strings(strings: np.ndarray) -> bytes:
    """Ascending strings, by their differences."""
    return packed(np.diff(strings, prepend=np.int64(0)))


def unpacked_strings(data: bytes, size: int) -> np.ndarray:
    return np.cumsum(unpacked(data, size))


def packed_tokens(tokens: list[bytes]) -> bytes:
    """One token at least, none with a blank."""
    joined = b" ".join(tokens)
    return len(joined).to_bytes(8, "little") + pa.compress(joined, codec="zstd", asbytes=True)


def unpacked_tokens(data: bytes) -> list[bytes]:
    size = int.from_bytes(data[:8], "little")
    return pa.decompress(data[8:], decompressed_size=size, codec="zstd", asbytes=True).split(b" ") if size else [b""]


def added_up(tokens: pa.Array | pa.ChunkedArray, counts: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """Distinct tokens and the sums of their counts."""
    table = pa.table({"piece": tokens, "n": counts}).group_by("piece").aggregate([("n", "sum")])
    return table.column("piece").combine_chunks(), table.column("n_sum").to_numpy()


def bucket_of(strings: np.ndarray, bits: int) -> np.ndarray:
    """The first ``bits`` bits of a mixed string."""
    if not bits:
        return np.zeros(len(strings), np.int64)
    return (strings.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - bits)).astype(np.int64)


def bucket_of_tokens(tokens: list[bytes], bits: int) -> np.ndarray:
    whole = pd.util.hash_array(np.array([t.decode() for t in tokens], object), categorize=False)
    return bucket_of(whole.view(np.int64), bits)


def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct strings, ascending, and the sums of their counts; the list is emptied, so that nothing is held twice."""
    strings, counts = (np.concatenate([p[k] for p in parts]) for k in (0, 1))
    parts.clear()
    if not len(strings):
        return strings, counts
    order = np.argsort(strings)
    strings = strings[order]
    counts = counts[order]
    del order
    first = np.flatnonzero(np.append(True, strings[1:] != strings[:-1]))
    counts = np.add.reduceat(counts, first)
    return strings[first], counts


def lines_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, pa.Array]:
    """Each text as it is coded, from the blank before it to its end; and its words as ``words_of`` gives them."""
    offsets, codes, words = words_of(texts, lower=True)
    lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), words.take(pa.array(codes)))
    close = pc.if_else(pc.equal(pc.list_value_length(lists), 0), "", " ")
    return pc.binary_join_element_wise(" ", pc.binary_join(lists, " "), close, " ", ""), offsets, codes, words


def windows(lines: pa.Array, width: int = WINDOW) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The coded places of all lines, some at a time: the line of each, and its byte string.

    A string is one number: the context, then the byte, below a leading 1.
    """
    sizes = pc.binary_length(lines).to_numpy(zero_copy_only=False).astype(np.int64)
    data = np.frombuffer(b"".join(lines.cast(pa.binary()).to_pylist()), np.uint8)
    starts = np.cumsum(sizes) - sizes
    for at in range(0, len(data), width):
        stop = min(at + width, len(data))
        low, high = np.searchsorted(starts, [at, stop])
        near = starts[max(0, np.searchsorted(starts, at - ORDER)) : high]
        depth = np.full(stop - at, ORDER)
        for k in range(ORDER - 1, -1, -1):  # of two lines close by, the later one counts
            own = near + k - at
            depth[own[(own >= 0) & (own < stop - at)]] = k
        back = min(ORDER, at)
        wide = np.concatenate([np.zeros(ORDER - back, np.int64), data[at - back : stop].astype(np.int64)])
        out = wide[ORDER:].copy()
        for j in range(1, ORDER + 1):
            out |= wide[ORDER - j : len(wide) - j] << (8 * j)
        top = np.int64(1) << (8 * (depth + 1))
        out = (out & (top - 1)) | top
        edges = np.concatenate([[at], starts[low:high], [stop]])
        line = np.repeat(np.arange(low - 1, high), np.diff(edges))
        coded = depth > 0
        yield line[coded], out[coded]


class Strings:
    """Distinct byte strings of lines and how often training lines hold them."""

    def __init__(self):
        self.whole, self.held, self.waiting = (np.empty(0, np.int64), np.empty(0, np.int64)), [], 0

    def add(self, lines: pa.Array, train: np.ndarray, width: int = WINDOW) -> None:
        for line, strings in windows(lines, width):
            marked = np.sort(strings << 1 | train[line])
            strings = marked >> 1
            first = np.flatnonzero(np.append(True, strings[1:] != strings[:-1]))
            self.join(strings[first], np.add.reduceat(marked & 1, first))

    def join(self, strings: np.ndarray, counts: np.ndarray) -> None:
        self.held.append((strings, counts))
        self.waiting += len(strings)
        if self.waiting > max(len(self.whole[0]), WAITING):
            self.all()

    def all(self) -> tuple[np.ndarray, np.ndarray]:
        parts = [self.whole, *self.held]
        self.whole, self.held, self.waiting = None, [], 0
        self.whole = merged(parts)
        return self.whole


def coded_texts(docs: DataFrame, training: Column, key: str, text: str, limit: int) -> DataFrame:
    """Rows by block: its texts' ids by place, their lines in stretches with their sizes as counts, one row of its
    distinct tokens, and one of its byte strings, both with training counts."""
    rows = docs.select(F.col(key).alias("item"), F.coalesce(training, F.lit(False)).alias("train"), F.col(text).alias("body"))
    kind = rows.schema["item"].dataType.simpleString()
    names = ["block", "place", "item", "train", "lines", "n", "tokens", "strings", "counts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        serial, held, met_strings, size, kinds = _serial(), [], Strings(), 0, None

        def row(many: int, block: int, **given: pa.Array) -> pa.RecordBatch:
            columns = [given[c] if c in given else pa.nulls(many, t) for c, t in zip(names[1:], kinds)]
            return pa.RecordBatch.from_arrays([pa.array(np.full(many, block)), *columns], names)

        def block_of(block: int) -> Iterator[pa.RecordBatch]:
            pieces, numbers = added_up(pa.chunked_array([h[4] for h in held]), np.concatenate([h[5] for h in held]))
            order = pc.sort_indices(pieces).to_numpy()
            pieces, numbers = pieces.take(pa.array(order)).to_pylist(), numbers[order]
            yield row(
                1, block, n=pa.array([len(pieces)]), tokens=pa.array([packed_tokens(pieces)], pa.binary()),
                counts=pa.array([packed(numbers)], pa.binary()),
            )
            place = 0
            for item, train, lines, sizes, _, _ in held:
                many = len(sizes)
                yield row(many, block, place=pa.array(np.arange(place, place + many)), item=item, train=train)
                yield row(
                    1, block, place=pa.array([place]), n=pa.array([many]), lines=pa.array([lines], pa.binary()),
                    counts=pa.array([packed(sizes)], pa.binary()),
                )
                place += many
            strings, numbers = met_strings.all()
            yield row(
                1, block, n=pa.array([len(strings)]), strings=pa.array([packed_strings(strings)], pa.binary()),
                counts=pa.array([packed(numbers)], pa.binary()),
            )

        for batch in batches:
            kinds = [pa.int64(), batch.schema.field("item").type, pa.bool_(), pa.binary(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
            for part in text_batches(batch, "body"):
                line, offsets, codes, words = lines_of(part.column("body"))
                train = part.column("train").to_numpy(zero_copy_only=False)
                met = np.bincount(codes[np.repeat(train, np.diff(offsets))], minlength=len(words))
                words = pa.concat_arrays([words.cast(pa.binary()), pa.array([b""])])
                sizes = pc.binary_length(line).to_numpy(zero_copy_only=False).astype(np.int64)
                held.append((part.column("item"), part.column("train"), packed_lines(line), sizes, words, np.append(met, train.sum())))
                met_strings.add(line, train)
                size += int(sizes.sum())
                if size >= limit:
                    yield from block_of(next(serial))
                    held, met_strings, size = [], Strings(), 0
        if held:
            yield from block_of(next(serial))

    return rows.mapInArrow(
        run, f"block long, place long, item {kind}, train boolean, lines binary, n long, tokens binary, strings binary, counts binary"
    )


def cut(bucket: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The buckets met, and the places of each in the order given."""
    order = np.argsort(bucket, kind="stable")
    own, starts = np.unique(bucket[order], return_index=True)
    return own, np.split(order, starts[1:])


def dealt(blobs: DataFrame, bits: int) -> DataFrame:
    """The tokens and strings of each block by bucket: ``bucket``, ``block``, ``n``, ``tokens`` or ``strings``, ``counts``."""
    names = ["bucket", "block", "n", "tokens", "strings", "counts"]  # a block's lines are not among the blobs
    binaries = lambda values: pa.array(values, pa.binary())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, n, tokens, strings, counts in zip(*(batch.column(c).to_pylist() for c in names[1:])):
                counts = unpacked(counts, n)
                if tokens is None:
                    strings = unpacked_strings(strings, n)
                    own, parts = cut(bucket_of(strings, bits))
                else:
                    tokens = unpacked_tokens(tokens)
                    own, parts = cut(bucket_of_tokens(tokens, bits))
                for at in range(0, len(own), 64):
                    some = parts[at : at + 64]
                    none = pa.nulls(len(some), pa.binary())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(own[at : at + 64]), pa.array(np.full(len(some), block)), pa.array([len(p) for p in some], pa.int64()),
                         none if tokens is None else binaries([packed_tokens([tokens[i] for i in p.tolist()]) for p in some]),
                         none if strings is None else binaries([packed_strings(strings[p]) for p in some]),
                         binaries([packed(counts[p]) for p in some])], names)

    return blobs.select(names[1:]).mapInArrow(
        run, "bucket long, block long, n long, tokens binary, strings binary, counts binary"
    )


def token_counts(parts: DataFrame) -> DataFrame:
    """For the tokens of each block and bucket their counts over all blocks: ``of``, ``bucket``, ``n``, ``counts``; and
    in one row of a bucket how many tokens the training texts hold (``met``) and how many different ones (``kinds``)."""

    def run(own: pa.Table) -> pa.Table:
        sizes, given = own.column("n").to_pylist(), [unpacked_tokens(t) for t in own.column("tokens").to_pylist()]
        every = pa.chunked_array([pa.array(t, pa.binary()) for t in given]).combine_chunks().dictionary_encode()
        codes = every.indices.to_numpy()
        counts = np.concatenate([unpacked(c, n) for c, n in zip(own.column("counts").to_pylist(), sizes)])
        sums = np.bincount(codes, counts, len(every.dictionary)).astype(np.int64)
        whole = [packed(part) for part in np.split(sums[codes], np.cumsum(sizes)[:-1])]
        once = lambda value: pa.array([int(value)] + [0] * (len(sizes) - 1), pa.int64())
        return pa.table({
            "of": own.column("block"), "bucket": own.column("bucket"), "n": own.column("n"), "counts": pa.array(whole, pa.binary()),
            "met": once(sums.sum()), "kinds": once((sums > 0).sum()),
        })

    return parts.select("bucket", "block", "n", "tokens", "counts").where("tokens IS NOT NULL").groupBy("bucket").applyInArrow(
        run, "of long, bucket long, n long, counts binary, met long, kinds long"
    )


def counted(parts: DataFrame) -> DataFrame:
    """``piece`` (byte string) and its training count ``n`` over all blocks."""

    def run(group: pa.Table) -> pa.Table:
        met = Strings()
        for n, strings, counts in zip(*(group.column(c).to_pylist() for c in ("n", "strings", "counts"))):
            met.join(unpacked_strings(strings, n), unpacked(counts, n))
        whole = met.all()
        return pa.table({"piece": whole[0], "n": whole[1]})

    return parts.select("bucket", "n", "strings", "counts").where("strings IS NOT NULL").groupBy("bucket").applyInArrow(
        run, "piece long, n long"
    )


class Low:
    """Counts of the orders up to two, from the strings cut to their last three bytes."""

    def __init__(self, strings: np.ndarray, counts: np.ndarray):
        self.one = np.zeros((256, 256), np.int64)
        np.add.at(self.one, (strings >> 8 & 0xFF, strings & 0xFF), counts)
        self.none = self.one.sum(axis=0)
        self.one_total, self.one_kinds = self.one.sum(axis=1), (self.one > 0).sum(axis=1)
        self.one_hidden = ((self.one > 0) * self.none).sum(axis=1)
        deep = strings >= 1 << 24
        self.strings, self.two = merged([(strings[deep] & 0xFFFFFF, counts[deep])])
        self.contexts, where = np.unique(self.strings >> 8, return_inverse=True)
        sums = lambda values: np.bincount(where, values, len(self.contexts)).astype(np.int64)
        self.total, self.kinds = sums(self.two), sums(self.two > 0)
        self.hidden = sums(self.one[self.strings >> 8 & 0xFF, self.strings & 0xFF])


def _found(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The value of each wanted key, 0 where there is none; the keys ascend."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], 0)


def levels(strings: np.ndarray, counts: np.ndarray, low: Low) -> np.ndarray:
    """log10 of the probability of each byte string; of contexts with the same last three bytes, all strings are given."""
    length = np.zeros(len(strings), np.int64)
    for j in range(1, ORDER + 2):
        length += strings >= np.int64(1) << (8 * j)
    length -= 1  # bytes of the context
    symbol = strings & 0xFF
    context = (strings ^ (np.int64(1) << (8 * (length + 1)))) >> 8
    n = len(strings)
    seen, total, kinds, hidden = {}, {}, {}, {}  # by order: count of the symbol, of all symbols, and distinct symbols
    after = context & 0xFF
    seen[0], total[0] = low.none[symbol], np.full(n, low.none.sum())
    kinds[0] = np.full(n, (low.none > 0).sum())
    seen[1], total[1], kinds[1] = low.one[after, symbol], low.one_total[after], low.one_kinds[after]
    hidden[1] = low.one_hidden[after]  # count, one order lower, of the symbols this context has seen
    two, deep = context & 0xFFFF, length >= 2
    seen[2] = np.where(deep, _found(low.strings, low.two, two << 8 | symbol), 0)
    for values, found in ((total, low.total), (kinds, low.kinds), (hidden, low.hidden)):
        values[2] = np.where(deep, _found(low.contexts, found, two), 0)
    for j in range(3, ORDER + 1):
        own = np.flatnonzero(length >= j)
        keys = ((context[own] & ((np.int64(1) << (8 * j)) - 1)) << 8) | symbol[own]
        distinct, where = np.unique(keys, return_inverse=True)
        sums = np.bincount(where, counts[own], len(distinct)).astype(np.int64)
        group, inside = np.unique(distinct >> 8, return_inverse=True)
        first = np.empty(len(distinct), np.int64)
        first[where] = own
        for values in (seen, total, kinds, hidden):
            values[j] = np.zeros(n, np.int64)
        seen[j][own] = sums[where]
        per_context = ((total, sums), (kinds, sums > 0), (hidden, np.where(sums > 0, seen[j - 1][first], 0)))
        for values, given in per_context:
            values[j][own] = np.bincount(inside, given, len(group)).astype(np.int64)[inside][where]

    out, going = np.zeros(n), np.ones(n, bool)
    out_total, out_kinds = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for j in range(ORDER, -1, -1):
        use = going & (total[j] > 0)
        left = kinds[j] - out_kinds
        base = 2 * (total[j] - out_total).astype(float)
        hit = use & (seen[j] > 0)
        out[hit] += np.log10((2 * seen[j][hit] - 1) / base[hit])
        escaped = use & ~hit & (left > 0)
        out[escaped] += np.log10(left[escaped] / base[escaped])
        going &= ~hit
        if j:
            out_total = np.where(use, hidden[j], out_total)
            out_kinds = np.where(use, kinds[j], out_kinds)
    out[going] -= np.log10(max(256 - (low.none > 0).sum(), 1))
    return out


def string_lengths(strings: DataFrame, bits: int) -> DataFrame:
    """Byte strings and log10 of their probability, from the training counts: ``bucket``, ``n``, ``strings``, ``values``."""
    short = F.when(F.col("piece") >= 1 << 24, F.expr("piece & 16777215 | 16777216")).otherwise(F.col("piece"))
    held = strings.where("n > 0").groupBy(short.alias("piece")).agg(F.sum("n").alias("n")).toPandas()
    low = Low(held["piece"].to_numpy(np.int64), held["n"].to_numpy(np.int64))
    groups = max(1, -(-strings.count() // GROUP))

    def run(group: pa.Table) -> pa.Table:
        pieces, counts = merged([(group.column("piece").to_numpy(), group.column("n").to_numpy())])
        values = levels(pieces, counts, low)
        own, parts = cut(bucket_of(pieces, bits))
        return pa.table({
            "bucket": own, "n": pa.array([len(p) for p in parts], pa.int64()),
            "strings": pa.array([packed_strings(pieces[p]) for p in parts], pa.binary()),
            "values": pa.array([packed(values[p]) for p in parts], pa.binary()),
        })

    tail = F.xxhash64(F.expr("shiftright(piece, 8) & 16777215"))
    return strings.select("piece", "n", F.pmod(tail, F.lit(groups)).alias("tail")).groupBy("tail").applyInArrow(
        run, "bucket long, n long, strings binary, values binary"
    )


def lengths_by_block(parts: DataFrame, found: DataFrame) -> DataFrame:
    """For the strings of each block and bucket, in their order, the values: ``of``, ``bucket``, ``n``, ``values``."""

    def run(own: pa.Table, known: pa.Table) -> pa.Table:
        rows = list(zip(*(known.column(c).to_pylist() for c in ("n", "strings", "values"))))
        pieces, values = merged([(unpacked_strings(strings, n), unpacked(data, n, np.float64)) for n, strings, data in rows])
        given = zip(own.column("n").to_pylist(), own.column("strings").to_pylist())
        out = [packed(values[np.searchsorted(pieces, unpacked_strings(data, n))]) for n, data in given]
        return pa.table({
            "of": own.column("block"), "bucket": own.column("bucket"), "n": own.column("n"), "values": pa.array(out, pa.binary())
        })

    rows = parts.select("bucket", "block", "n", "strings").where("strings IS NOT NULL")
    return rows.groupBy("bucket").cogroup(found.groupBy("bucket")).applyInArrow(
        run, "of long, bucket long, n long, values binary"
    )


def in_place(bucket: np.ndarray, given: pa.Table, column: str, kind: type = np.int64) -> np.ndarray:
    """The numbers that came back by bucket, each at its place among the block's own."""
    out = np.zeros(len(bucket), kind)
    own, parts = cut(bucket)
    places = dict(zip(own.tolist(), parts))
    for k, n, data in zip(*(given.column(c).to_pylist() for c in ("bucket", "n", column))):
        if data is not None:
            out[places[k]] = unpacked(data, n, kind)
    return out


def scored(docs: DataFrame, training: Column, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, ``training``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score``.

    ``base_score`` is the smoothed unigram score of the tokens, ``score`` the log10 probability by the model.
    """
    size = docs.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()[0]
    docs = docs.coalesce(max(docs.sparkSession.sparkContext.defaultParallelism, -(-size // BLOCK_BYTES)))
    coded = pin(coded_texts(docs, training, key, text, BLOCK_BYTES))
    blobs = coded.where("tokens IS NOT NULL OR strings IS NOT NULL")
    entries = blobs.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    bits = max(0, -(-entries // ENTRIES) - 1).bit_length()
    parts = dealt(blobs, bits)
    tokens = pin(token_counts(parts))
    total, kinds = tokens.agg(F.coalesce(F.sum("met"), F.lit(0)), F.coalesce(F.sum("kinds"), F.lit(0))).first()
    strings = pin(counted(parts))
    found = pin(string_lengths(strings, bits))
    unpin(strings)
    known = lengths_by_block(parts, found).unionByName(tokens.select("of", "bucket", "n", "counts"), allowMissingColumns=True)
    kind = coded.schema["item"].dataType.simpleString()

    def run(rows: pa.Table, given: pa.Table) -> pa.Table:
        blobs = rows.filter(pc.is_valid(rows.column("n"))).sort_by("place").select(["n", "lines", "tokens", "strings", "counts"]).to_pylist()
        rows = rows.filter(pc.is_valid(rows.column("train"))).select(["place", "item", "train"]).sort_by("place")
        tokens = next(unpacked_tokens(b["tokens"]) for b in blobs if b["tokens"] is not None)
        strings = next(unpacked_strings(b["strings"], b["n"]) for b in blobs if b["strings"] is not None)
        values = in_place(bucket_of(strings, bits), given, "values", np.float64)
        counts = in_place(bucket_of_tokens(tokens, bits), given, "counts")
        pieces = pa.array(tokens, pa.binary())
        base = np.log10((counts + 0.1) / (total + 0.1 * (kinds + 1)))
        end = pc.index_in(pa.scalar(b"", pa.binary()), value_set=pieces).as_py()
        out = {k: [] for k in ("n_tokens", "n_known", "base_score", "score")}
        for blob in blobs:
            if blob["lines"] is None:
                continue
            many = blob["n"]
            lines = unpacked_lines(blob["lines"], unpacked(blob["counts"], many))
            offsets, codes, own = words_of(lines)
            places = pc.index_in(own.cast(pa.binary()), value_set=pieces).to_numpy(zero_copy_only=False).astype(np.int64)[codes]
            row = np.repeat(np.arange(many), np.diff(offsets))
            out["n_tokens"].append(np.diff(offsets) + 1)
            out["n_known"].append(np.bincount(row[counts[places] > 0], minlength=many) + int(counts[end] > 0))
            out["base_score"].append(np.bincount(row, base[places], many) + base[end])
            score = np.zeros(many)
            for line, met in windows(lines):
                distinct, where = np.unique(met, return_inverse=True)
                score += np.bincount(line, values[np.searchsorted(strings, distinct)][where], many)
            out["score"].append(score)
        sums = {k: np.concatenate(v) for k, v in out.items()}
        return pa.table({
            key: rows.column("item"), "training": rows.column("train"), "n_tokens": sums["n_tokens"].astype(np.int64),
            "n_known": sums["n_known"].astype(np.int64), "train_tokens": np.full(len(rows), total),
            "base_score": sums["base_score"], "score": sums["score"],
        })

    return (
        coded.select("block", "place", "item", "train", "lines", "n", "tokens", "strings", "counts").groupBy("block")
        .cogroup(known.groupBy("of"))
        .applyInArrow(
            run,
            f"`{key}` {kind}, training boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
        )
    )
