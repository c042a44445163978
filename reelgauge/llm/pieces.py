"""Arrays over the bytes of an Arrow column of texts: cutting into pieces, distinct pieces, ids of pieces."""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are handled at once; one longer text is handled alone.
AT_ONCE = 4 << 20


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, one after the other, and where each begins and the last ends. Null is empty."""
    texts = pc.fill_null(column, "").cast(pa.large_binary())
    _, edges, data = texts.buffers()
    edges = np.frombuffer(edges, np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[edges[0] : edges[-1]], edges - edges[0]


def portions(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows with about AT_ONCE bytes of text."""
    edges = text_bytes(batch.column(column))[1]
    begin = 0
    while begin < batch.num_rows:
        end = max(begin + 1, int(np.searchsorted(edges, edges[begin] + AT_ONCE, side="right")) - 1)
        yield batch.slice(begin, end - begin)
        begin = end


def distinct(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """Codes of the pieces data[starts[i] : starts[i + 1]], and the distinct pieces by code."""
    if not len(starts):
        return np.zeros(0, np.int64), []
    edges = np.append(starts, len(data)).astype(np.int64)
    pieces = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(edges), pa.py_buffer(np.ascontiguousarray(data))])
    coded = pieces.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary.to_pylist()


def per_text(starts: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """How many pieces begin in each text."""
    return np.diff(np.searchsorted(starts, edges))


def spread(pool: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The slices pool[start : start + length] one after the other."""
    end = np.cumsum(length)
    return pool[np.repeat(start - (end - length), length) + np.arange(int(end[-1]) if len(end) else 0)]


class IdStore:
    """Ids of known pieces, in flat arrays; it forgets everything when ``limit`` pieces are known."""

    def __init__(self, limit: int):
        self.limit = limit
        self.forget()

    def forget(self) -> None:
        self.slot: dict[bytes, int] = {}
        self.begin, self.flat = array("q", [0]), array("I")

    def room_for(self, n: int) -> bool:
        """Whether nothing had to be forgotten to take n more."""
        if len(self.slot) + n <= self.limit or not self.slot:
            return True
        self.forget()
        return False

    def add_all(self, pieces: list[bytes], ids: np.ndarray, lengths: np.ndarray) -> None:
        """Distinct new pieces with their ids, one after the other."""
        at = len(self.begin) - 1
        self.slot.update(zip(pieces, range(at, at + len(pieces)), strict=True))
        self.begin.frombytes((len(self.flat) + np.cumsum(lengths)).astype(np.int64).tobytes())
        self.flat.frombytes(ids.astype(np.uint32).tobytes())

    def find(self, pieces: list[bytes]) -> np.ndarray:
        """The pieces' places, -1 where unknown."""
        return np.fromiter(map(self.slot.get, pieces, repeat(-1)), np.int64, len(pieces))

    def slices(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(pool, start, length) of the pieces' ids."""
        return self.slices_at(np.fromiter(map(self.slot.__getitem__, pieces), np.int64, len(pieces)))

    def slices_at(self, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The same for the pieces at these places."""
        begin, pool = np.array(self.begin, np.int64), np.array(self.flat, np.uint32)
        return pool, begin[slots], begin[slots + 1] - begin[slots]
