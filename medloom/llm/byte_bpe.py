"""Byte-level BPE through a sentencepiece model that is serialised from the ranks, and its inverse."""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
import regex

from medloom.llm.textcols import WHITE, Memo, held, starts, units, utf8

#: Unicode white space, as the splitting pattern means it (the control characters 1C to 1F are none).
SPACES = r"\t-\r \x85\xa0  -     　"
ODD_SPACE = regex.compile(r"[\x85\xa0  -     　]")


def byte_letters() -> list[str]:
    """A visible character for every byte: printable Latin-1 stands for itself, the others follow from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = [""] * 256
    for b in plain:
        letters[b] = chr(b)
    rest = [b for b in range(256) if not letters[b]]
    for k, b in enumerate(rest):
        letters[b] = chr(0x100 + k)
    return letters


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes([*out, n])


def _field(number: int, kind: int, value: bytes) -> bytes:
    return _varint(number << 3 | kind) + (_varint(len(value)) + value if kind == 2 else value)


def serialise(pieces: list[bytes]) -> bytes:
    """A sentencepiece BPE model: piece k is ``pieces[k]`` in byte letters with score -k, normalisation is the identity."""
    letters = byte_letters()
    out = []
    for rank, piece in enumerate(pieces):
        text = "".join(letters[b] for b in piece).encode()
        out.append(_field(1, 2, _field(1, 2, text) + _field(2, 5, np.float32(-rank).tobytes()) + _field(3, 0, _varint(1))))
    out.append(_field(1, 2, _field(1, 2, b"<unk>") + _field(2, 5, np.float32(0).tobytes()) + _field(3, 0, _varint(2))))
    trainer = _field(3, 0, _varint(2)) + _field(4, 0, _varint(len(pieces) + 1)) + _field(40, 0, _varint(len(pieces)))
    trainer += b"".join(_field(k, 0, _varint((1 << 64) - 1)) for k in (41, 42, 43))
    normaliser = _field(1, 2, b"identity") + b"".join(_field(k, 0, _varint(0)) for k in (3, 4, 5))
    return b"".join(out) + _field(2, 2, trainer) + _field(3, 2, normaliser)


class ByteBpe:
    """Encodes each match of ``pattern`` by itself; ``ranks_path`` is a file of base64 pieces and ranks."""

    def __init__(self, ranks_path: str, pattern: str):
        import sentencepiece

        with open(ranks_path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.pieces = [b""] * (max(self.ranks.values()) + 1)
        for piece, rank in self.ranks.items():
            self.pieces[rank] = piece
        if any(not p for p in self.pieces):
            raise ValueError("the ranks have gaps")
        self.model = sentencepiece.SentencePieceProcessor(model_proto=serialise(self.pieces))
        self.letters = dict(enumerate(byte_letters()))
        own = pattern.replace(r"[^\s", f"[^{SPACES}").replace(r"\S", f"[^{SPACES}]").replace(r"\s", f"[{SPACES}]")
        self.pattern = regex.compile(own)
        self.memo = Memo()
        self.table = np.frombuffer(b"".join(self.pieces), np.uint8)
        self.length = np.fromiter(map(len, self.pieces), np.int64, len(self.pieces))
        self.begin = np.cumsum(self.length) - self.length

    def _pieces(self, tokens: list[bytes]) -> list[list[int]]:
        """Ids of pre-tokens: a whole piece is one id, the others go through the sentencepiece model."""
        out = [[self.ranks[t]] if t in self.ranks else None for t in tokens]
        rest = [i for i, x in enumerate(out) if x is None]
        if rest:
            for i, ids in zip(rest, self.model.encode([tokens[i].decode("latin-1").translate(self.letters) for i in rest], num_threads=1), strict=True):
                out[i] = ids
        return out

    def _texts(self, texts: list[str]) -> list[bytes]:
        tokens, ends = [], []
        for t in texts:
            tokens += [m.encode() for m in self.pattern.findall(t)]
            ends.append(len(tokens))
        unique = {t: k for k, t in enumerate(dict.fromkeys(tokens))}
        coded = [np.array(x, np.uint32).tobytes() for x in self._pieces(list(unique))]
        return [b"".join(coded[unique[t]] for t in tokens[a:b]) for a, b in zip([0, *ends], ends, strict=False)]

    def encode(self, texts: pa.Array) -> list[bytes]:
        """Every text's ids as little-endian unsigned 32-bit integers.

        A text is cut before each run of ASCII white space that follows another character: no match of the pattern
        crosses such a place, so the cut pieces are encoded apart, each distinct one once.  Texts with other white
        space are split by the pattern as a whole.
        """
        data, offsets = utf8(texts)
        which, cut, per_row = units(data, offsets, starts(WHITE[data], offsets))
        known = self.memo.get(cut, lambda new: self._texts([u.decode() for u in new]))
        found = np.array([known[u] for u in cut], object)
        out = [b"".join(found[which[a:b]].tolist()) for a, b in zip(per_row[:-1].tolist(), per_row[1:].tolist(), strict=True)]
        if ((data[:-1] == 0xC2) & ((data[1:] == 0x85) | (data[1:] == 0xA0)) | (data[:-1] == 0xE1) & (data[1:] == 0x9A) | (data[:-1] == 0xE2) & ((data[1:] == 0x80) | (data[1:] == 0x81)) | (data[:-1] == 0xE3) & (data[1:] == 0x80)).any():
            for i, t in enumerate(texts.to_pylist()):
                if t and ODD_SPACE.search(t):
                    out[i] = self._texts([t])[0]
        return out

    def decode(self, ids: bytes) -> bytes:
        """The bytes of all pieces, one after the other."""
        which = np.frombuffer(ids, "<u4")
        length = self.length[which]
        ends = np.cumsum(length)
        index = np.arange(int(ends[-1]) if len(ends) else 0, dtype=np.int64)
        index += np.repeat(self.begin[which] - (ends - length), length)
        return self.table[index].tobytes()


def model(ranks_path: str, pattern: str) -> ByteBpe:
    return held("bytes", (ranks_path, pattern), lambda: ByteBpe(ranks_path, pattern))


def encode_documents(docs, ranks_path: str, pattern: str, keep: tuple[str, ...] = ("doc_id",), text: str = "text"):
    """``keep`` columns, ids (binary, little-endian unsigned 32-bit) and n_tokens; a null text has no ids."""
    return _map(docs, ranks_path, pattern, keep, text, "ids binary, n_tokens bigint", lambda m, t: (x := m.encode(t), [len(i) // 4 for i in x]))


def decode_documents(coded, ranks_path: str, pattern: str, keep: tuple[str, ...] = ("doc_id",), ids: str = "ids"):
    """``keep`` columns and text: the decoded bytes, with U+FFFD where they are no UTF-8."""
    return _map(coded, ranks_path, pattern, keep, ids, "text string", lambda m, t: ([m.decode(i.as_py() or b"").decode("utf-8", "replace") for i in t],), as_text=False)


def round_trip(docs, ranks_path: str, pattern: str, keep: tuple[str, ...] = ("doc_id",), text: str = "text"):
    """``keep`` columns, n_tokens, ids_sha256 and decoded_sha256: documents encoded, then decoded from those ids, in one
    pass.  A null text is empty, rows that repeat have equal digests; nothing is shuffled, and a batch of texts is all that a task holds."""
    from hashlib import sha256

    def both(m, texts):
        ids = m.encode(texts)
        return [len(i) // 4 for i in ids], [sha256(i).hexdigest() for i in ids], [sha256(m.decode(i)).hexdigest() for i in ids]

    return _map(docs, ranks_path, pattern, keep, text, "n_tokens bigint, ids_sha256 string, decoded_sha256 string", both)


def _map(df, ranks_path, pattern, keep, name, fields, work, as_text=True):
    from pyspark.sql import functions as F

    from medloom.llm.shared import fresh, text_batches
    from medloom.llm.textcols import column, slices

    text_batches(df.sparkSession)
    own = fresh(df, "whole_text")
    source = df.select(*keep, F.col(name).cast("string").alias(own) if as_text else F.col(name).alias(own))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1]), fields])
    names = [x.split()[0] for x in fields.split(", ")]

    def run(batches):
        coder = model(ranks_path, pattern)
        for batch in batches:
            for piece in slices(batch, own, 2 << 20) if as_text else [batch]:
                done = work(coder, column(piece, own))
                yield pa.RecordBatch.from_arrays([*(column(piece, k) for k in keep), *(pa.array(x) for x in done)], names=[*keep, *names])

    return source.mapInArrow(run, schema)
