"""Words of an Arrow string column as offsets into its UTF-8 bytes, without a Python object per word."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
#: A word byte of the licence scan: ASCII letters and digits, and every byte of a non-ASCII character.
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x41, 0x5B), *range(0x80, 0x100)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

SLICE_BYTES = 4 << 20


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The column's bytes and ``len + 1`` offsets into them; null is empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    buffer = column.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, name: str, most: int = SLICE_BYTES):
    """The batch cut into runs of rows whose texts take about ``most`` bytes; a longer text gets a run of its own."""
    n = len(batch)
    if not n:
        return
    _, offsets = utf8(batch.column(name))
    begin = 0
    while begin < n:
        end = int(np.searchsorted(offsets, offsets[begin] + most, "right")) - 1
        end = min(max(end, begin + 1), n)
        yield batch.slice(begin, end - begin)
        begin = end


def starts(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Positions where a run of True begins; every row begins anew."""
    if not len(mask):
        return np.zeros(0, np.int64)
    begins = mask.copy()
    begins[1:] &= ~mask[:-1]
    first = offsets[:-1][offsets[:-1] < offsets[1:]]
    begins[first] = mask[first]
    return np.flatnonzero(begins)


def units(data: np.ndarray, offsets: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """Cut the bytes at the positions ``begins`` and at row starts.

    Returns the number in the dictionary of every unit, the dictionary, and for every row the index of its first unit
    (``len + 1`` values).
    """
    cut = np.zeros(len(data), bool)
    cut[begins] = True
    cut[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
    cuts = np.flatnonzero(cut)
    per_row = np.searchsorted(cuts, offsets)
    ends = np.append(cuts, len(data)).astype(np.int64)
    if not len(cuts):
        return np.zeros(0, np.int32), [], per_row
    array = pa.Array.from_buffers(pa.large_binary(), len(cuts), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(data))])
    coded = array.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False), coded.dictionary.to_numpy(zero_copy_only=False).tolist(), per_row


def gather(parts: np.ndarray, begin: np.ndarray, length: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Concatenate ``parts[begin[w] : begin[w] + length[w]]`` for every w of ``which``; also the ends of the pieces."""
    sizes = length[which]
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    index = np.arange(total, dtype=np.int64)
    index += np.repeat(begin[which] - (ends - sizes), sizes)
    return parts[index], ends


def column(df_batch: pa.RecordBatch, name: str) -> pa.Array:
    return df_batch.column(df_batch.schema.get_field_index(name))


class Memo:
    """Remembers about ``most`` to twice as many results; those not asked for lately go first."""

    def __init__(self, most: int = 150_000):
        self.most, self.young, self.old = most, {}, {}

    def get(self, keys, make, distinct: bool = False) -> dict:
        """A mapping that holds all ``keys``; ``make(list of keys)`` gives the results that are not remembered.
        ``distinct``: no key comes twice."""
        if len(self.young) > self.most:
            self.young, self.old = {}, self.young
        young, old, new = self.young, self.old, []
        for k in keys if distinct else set(keys):
            if k not in young:
                if k in old:
                    young[k] = old[k]
                else:
                    new.append(k)
        for at in range(0, len(new), 20_000):
            part = new[at : at + 20_000]
            young.update(zip(part, make(part), strict=True))
        return young


_held: dict = {}


def held(owner: str, key, make):
    """What a worker keeps between tasks, made once; an operator's first call lets go of what another one kept."""
    if _held.get("owner") != owner:
        _held.clear()
        _held["owner"] = owner
    if key not in _held:
        _held[key] = make()
    return _held[key]


def let_go() -> None:
    """For tasks that need nothing of what a worker keeps."""
    _held.clear()
