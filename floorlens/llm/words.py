"""Words of whole texts, by Arrow kernels.

A word is a run of bytes other than the ASCII white space ``[\\x20\\x09-\\x0D]``. Texts are handled in
stretches of bounded size (a longer text is a stretch of its own), so memory follows the longest
text and not the batch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

STRETCH_BYTES = 4 << 20


def stretches(sizes: np.ndarray, limit: int = STRETCH_BYTES) -> Iterator[tuple[int, int]]:
    """Cut rows of the given sizes into runs ``[start, stop)`` of at most ``limit``, one row at least."""
    start, total = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if i > start and total + size > limit:
            yield start, i
            start, total = i, 0
        total += size
    if len(sizes):
        yield start, len(sizes)


def text_batches(batch: pa.RecordBatch, column: str = "text", limit: int = STRETCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in stretches, with null texts made empty."""
    at = batch.schema.get_field_index(column)
    texts = pc.fill_null(batch.column(at), "")
    batch = batch.set_column(at, column, texts)
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False)
    for start, stop in stretches(sizes, limit):
        yield batch.slice(start, stop - start)


def coded(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Offsets per row, one code per non-empty piece, and the distinct pieces the codes name."""
    pieces = lists.flatten()
    offsets = lists.offsets.to_numpy().astype(np.int64)
    offsets -= offsets[0]
    full = pc.greater(pc.binary_length(pieces), 0).to_numpy(zero_copy_only=False)
    if not full.all():
        offsets = np.concatenate([[0], np.cumsum(full)])[offsets]
        pieces = pieces.filter(pa.array(full))
    encoded = pieces.dictionary_encode()
    return offsets, encoded.indices.to_numpy(), encoded.dictionary


def words_of(texts: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """``coded`` words of each text; ``lower`` turns A-Z to a-z first."""
    return coded(pc.ascii_split_whitespace(pc.ascii_lower(texts) if lower else texts))


def gather(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions of the concatenated runs ``[start, start + length)``."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def strings(pieces: pa.Array) -> list[str]:
    """Pieces without blanks as Python strings, by one join and one split."""
    if not len(pieces):
        return []
    whole = pa.ListArray.from_arrays(pa.array([0, len(pieces)], pa.int32()), pieces)
    return pc.binary_join(whole, " ")[0].as_py().split(" ")


class Memo:
    """Runs of values by piece, kept over the stretches of one worker.

    ``make`` gives the sizes and the joined values of new pieces. Beyond ``limit`` pieces all are forgotten
    and made again as they are met, so memory is bounded and results stay the same.
    """

    def __init__(self, make: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], limit: int = 200_000):
        self.make, self.limit = make, limit
        self._clear()

    def _clear(self) -> None:
        self.place: dict[str, int] = {}
        self.sizes, self.starts, self.values = np.empty(0, np.int64), np.empty(0, np.int64), None

    def places(self, pieces: list[str]) -> np.ndarray:
        """Place of each piece in ``sizes`` and ``starts``."""
        if len(self.place) > self.limit:
            self._clear()
        found = list(map(self.place.get, pieces))
        missing = [i for i, at in enumerate(found) if at is None]
        if missing or self.values is None:
            fresh = list(dict.fromkeys([pieces[i] for i in missing]))
            sizes, values = self.make(fresh)
            self.place.update(zip(fresh, range(len(self.place), len(self.place) + len(fresh))))
            total = 0 if self.values is None else len(self.values)
            self.starts = np.concatenate([self.starts, total + np.cumsum(sizes) - sizes])
            self.sizes = np.concatenate([self.sizes, sizes])
            self.values = values if self.values is None else np.concatenate([self.values, values])
            for i in missing:
                found[i] = self.place[pieces[i]]
        return np.array(found, np.int64)

    def runs(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ends of the runs at the given places, and their joined values."""
        lengths = self.sizes[places]
        return np.cumsum(lengths), self.values[gather(self.starts[places], lengths)]
