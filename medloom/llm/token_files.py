"""Token ids in fixed-width bit-packed files, written in document order and read back.

File format, little-endian throughout:

* ``MLTB`` and one byte, the width w in bits (the least that holds the vocabulary);
* the payload: blocks of ``BLOCK`` ids, each id in w consecutive bits, least significant bit first, each block padded
  to a whole byte and the last one shorter;
* the index: byte offset of every block (int64), first token of every document and their total (int64), document ids
  (int64), and one byte per document that is 1 where the id is null;
* five int64: width, block length, number of tokens, of documents and of blocks.

A token's block is ``i // BLOCK`` and its bit ``i % BLOCK * w`` there, so any range of tokens is read with two seeks,
and a block is unpacked by one numpy expression.
"""

from __future__ import annotations

import os
import re
import uuid
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from medloom.llm.byte_bpe import byte_letters
from medloom.llm.shared import new_path, partitions, store, text_batches
from medloom.llm.textcols import LOWER, WHITE, Memo, column, gather, held, let_go, slices, starts, units, utf8

BLOCK = 1 << 16
#: Documents that a reader hands on at a time.
READ_ROWS = 2_000
#: Text of one file at most, about.
FILE_BYTES = 64 << 20
#: Texts that are encoded together, in bytes: what is derived from them takes some forty times that.
SLICE = 1 << 20
MAGIC = b"MLTB"


def width_of(vocabulary: int) -> int:
    """Bits that hold ids 0 to ``vocabulary`` - 1."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    if width in (8, 16, 32):
        return ids.astype(f"<u{width // 8}").tobytes()
    raw = np.ascontiguousarray(ids.astype("<u4")).view(np.uint8).reshape(-1, 4)
    return np.packbits(np.unpackbits(raw, axis=1, bitorder="little")[:, :width].reshape(-1), bitorder="little").tobytes()


def unpack(raw: bytes, width: int, n: int) -> np.ndarray:
    if width in (8, 16, 32):
        return np.frombuffer(raw, f"<u{width // 8}", n).astype(np.uint32)
    bits = np.unpackbits(np.frombuffer(raw, np.uint8), count=n * width, bitorder="little").reshape(n, width)
    full = np.zeros((n, 32), np.uint8)
    full[:, :width] = bits
    return np.packbits(full, axis=1, bitorder="little").view("<u4").reshape(-1)


class Writer:
    """Writes one file; nothing but the index and a part of a block is held in memory."""

    def __init__(self, uri: str, width: int):
        self.files, self.path = fs.FileSystem.from_uri(uri)
        self.own = f"{self.path}.{uuid.uuid4().hex}.tmp"
        self.out = self.files.open_output_stream(self.own)
        self.out.write(MAGIC + bytes([width]))
        self.width, self.at, self.left, self.n = width, len(MAGIC) + 1, np.zeros(0, np.uint32), 0
        self.blocks, self.first, self.ids, self.null = [], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, bool)]

    def _block(self, ids: np.ndarray) -> None:
        raw = pack(ids, self.width)
        self.blocks.append(self.at)
        self.at += len(raw)
        self.out.write(raw)

    def add(self, doc_ids: pa.Array, ids: np.ndarray, ends: np.ndarray) -> None:
        """``ends``: where each document's tokens end in ``ids``."""
        self.first.append(self.n + np.concatenate([[0], ends[:-1]]).astype(np.int64)[: len(ends)])
        self.ids.append(pc.fill_null(doc_ids, 0).to_numpy(zero_copy_only=False).astype(np.int64))
        self.null.append(doc_ids.is_null().to_numpy(zero_copy_only=False))
        self.n += len(ids)
        self.left = np.concatenate([self.left, ids])
        whole = len(self.left) // BLOCK * BLOCK
        for at in range(0, whole, BLOCK):
            self._block(self.left[at : at + BLOCK])
        self.left = self.left[whole:]

    def close(self) -> None:
        if len(self.left):
            self._block(self.left)
        ids, null = np.concatenate(self.ids), np.concatenate(self.null)
        first = np.append(np.concatenate(self.first), self.n)
        self.out.write(np.array(self.blocks, "<i8").tobytes() + first.astype("<i8").tobytes())
        self.out.write(ids.astype("<i8").tobytes() + null.astype(np.uint8).tobytes())
        self.out.write(np.array([self.width, BLOCK, self.n, len(ids), len(self.blocks)], "<i8").tobytes())
        self.out.close()
        self.files.move(self.own, self.path)


class Reader:
    """Random access to one file."""

    def __init__(self, uri: str):
        files, path = fs.FileSystem.from_uri(uri)
        self.file = files.open_input_file(path)
        size = self.file.size()
        self.width, self.block, self.n, docs, blocks = np.frombuffer(self.file.read_at(40, size - 40), "<i8").tolist()
        index = 8 * blocks + 8 * (docs + 1) + 9 * docs
        raw = self.file.read_at(index, size - 40 - index)
        self.blocks = np.frombuffer(raw, "<i8", blocks)
        self.first = np.frombuffer(raw, "<i8", docs + 1, 8 * blocks)
        ids = np.frombuffer(raw, "<i8", docs, 8 * (blocks + docs + 1))
        null = np.frombuffer(raw, np.uint8, docs, 8 * (blocks + docs + 1) + 8 * docs)
        self.ids = pa.array(ids, mask=null.astype(bool))
        self.payload_end = size - 40 - index

    def tokens(self, begin: int, end: int) -> np.ndarray:
        """Tokens ``begin`` to ``end`` - 1 of the file."""
        if end <= begin:
            return np.zeros(0, np.uint32)
        a, b = begin // self.block, (end - 1) // self.block
        out = []
        for k in range(a, b + 1):
            stop = int(self.blocks[k + 1]) if k + 1 < len(self.blocks) else self.payload_end
            n = min(self.block, self.n - k * self.block)
            out.append(unpack(self.file.read_at(stop - int(self.blocks[k]), int(self.blocks[k])), self.width, n))
        return np.concatenate(out)[begin - a * self.block : end - a * self.block]

    def document(self, i: int) -> np.ndarray:
        return self.tokens(int(self.first[i]), int(self.first[i + 1]))

    def documents(self):
        """The tokens of every document in turn, reading each block once."""
        from_block, held = -1, np.zeros(0, np.uint32)
        for i in range(len(self.ids)):
            begin, end = int(self.first[i]), int(self.first[i + 1])
            if begin == end:
                yield held[:0]
                continue
            a, b = begin // self.block, (end - 1) // self.block
            if a == b:
                if a != from_block:
                    from_block, held = a, self.tokens(a * self.block, min(self.n, (a + 1) * self.block))
                yield held[begin - a * self.block : end - a * self.block]
            else:
                found = self.tokens(begin, min(self.n, (b + 1) * self.block))
                from_block, held = b, found[b * self.block - begin :]
                yield found[: end - begin]


#: Kinds of bytes in texts: white, letter (ASCII, and the two bytes of Latin-1 letters), digit, mark, and what only the
#: library's own steps may cut (apostrophes begin contractions, "<" special tokens).
_KIND = np.full(256, 4, np.uint8)
_KIND[WHITE] = 0
_KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B), 0xC3, *range(0x80, 0xC0)]] = 1
_KIND[0x30:0x3A] = 2
_KIND[[x for x in range(0x21, 0x7F) if not chr(x).isalnum() and chr(x) not in "'<"]] = 3
_KIND[[0x97, 0xB7]] = 4  # the second bytes of the multiplication and division signs
#: Lower case, also of the second byte of Latin-1 letters.
_SMALL = LOWER.copy()
_SMALL[0x80:0x9F] += 0x20
#: A run of lower-case letters of these.
_LETTERS = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+\Z")


class WordCoder:
    """Encodes batches through a tokenizer that lower-cases, drops white space and never joins across it.

    Words of ASCII and Latin-1 letters, digits and marks are put in lower case and cut where the kind changes, as the
    tokenizer does; other words stay whole.  Each distinct piece is encoded once and remembered for a while: runs of
    letters go to the library's model, the others through all of its steps.
    """

    def __init__(self, path: str, end_id: int | None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.letters = dict(enumerate(byte_letters()))
        self.end_id, self.memo = end_id, Memo(80_000)

    def _make(self, words: list[bytes]) -> list[bytes]:
        model, letters = self.tokenizer.model, self.letters
        spelt = [w.decode("latin-1").translate(letters) if _LETTERS.match(w) else None for w in words]
        rest = iter(self.tokenizer.encode_batch_fast([w.decode() for w, s in zip(words, spelt, strict=True) if s is None], add_special_tokens=False))
        return [array("I", [t.id for t in model.tokenize(s)] if s is not None else next(rest).ids).tobytes() for s in spelt]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and where each text's ids (with the end id) end."""
        data, offsets = utf8(texts)
        kind = _KIND[data]
        solid = kind > 0
        begins = starts(solid, offsets)
        whole = np.zeros(len(begins), bool)
        whole[np.searchsorted(begins, np.flatnonzero(kind == 4), "right") - 1] = True
        odd = np.flatnonzero(whole)
        change = solid.copy()
        change[:1] = False
        change[1:] &= kind[1:] != kind[:-1]
        change[begins] = False
        change = np.flatnonzero(change)
        change = change[~whole[np.searchsorted(begins, change, "right") - 1]] if len(begins) else change
        cut = np.zeros(len(data), bool)
        cut[begins] = cut[change] = True
        small = _SMALL[data]
        if len(odd):  # their bytes stay as they are
            ends = np.append(begins[1:], len(data))[odd]
            as_is = np.zeros(len(data) + 1, np.int8)
            as_is[begins[odd]] += 1
            as_is[ends] -= 1
            as_is = np.cumsum(as_is[:-1], dtype=np.int8).view(bool)
            small[as_is] = data[as_is]
        before = np.concatenate([[0], np.cumsum(solid)])
        which, words, per_row = units(small[solid], before[offsets], before[np.flatnonzero(cut)])
        known = self.memo.get(words, self._make, distinct=True)
        found = [known[w] for w in words]
        length = np.fromiter(map(len, found), np.int64, len(found)) // 4
        parts = np.frombuffer(b"".join(found), np.uint32)
        begin = np.cumsum(length) - length
        sizes = length[which] if len(which) else np.zeros(0, np.int64)
        total = np.concatenate([[0], np.cumsum(sizes)])
        ends = total[per_row[1:]]
        ids = gather(parts, begin, length, which)[0] if len(which) else np.zeros(0, np.uint32)
        if self.end_id is None:
            return ids, ends
        return np.insert(ids, ends, self.end_id).astype(np.uint32), ends + np.arange(1, len(ends) + 1)


def coder(path: str, end_id: int | None) -> WordCoder:
    return held("words", (path, end_id), lambda: WordCoder(path, end_id))


def write_token_files(docs: DataFrame, tokenizer: str, folder: str, vocabulary: int, end_id: int | None = 1, id_col: str = "doc_id", text: str = "text", files: int | None = None) -> DataFrame:
    """Write the ids of all documents under ``folder`` in ascending ``id_col`` order; returns the list of files.

    Range partitions of the ids become files, numbered in order: as many as there are shuffle partitions, and more where
    a file would take more than ``FILE_BYTES`` of text.  A task that is run again writes under another name
    and only the attempt that Spark commits is listed, so a lost executor leaves no wrong entry.  The list has part
    (int), path, n_docs and n_tokens (long).  Null texts are empty documents, null ids come first, rows that repeat an
    id are ordered by their text's hash; an empty table gives an empty list.
    ``folder`` is a URI that all executors reach (file://, hdfs:// or another that pyarrow opens).
    """
    text_batches(docs.sparkSession)
    n = files or max(partitions(docs.sparkSession), -(-(docs.agg(F.sum(F.octet_length(F.col(text).cast("string")))).first()[0] or 0) // FILE_BYTES))
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text).cast("string").alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    ordered = rows.repartitionByRange(n, F.col("id").asc_nulls_first(), F.col("tie")).sortWithinPartitions(F.col("id").asc_nulls_first(), "tie")
    width = width_of(vocabulary)
    where, base = fs.FileSystem.from_uri(folder)
    where.create_dir(base, recursive=True)

    def run(batches):
        made, part = None, TaskContext.get().partitionId()
        uri = f"{folder}/part-{part:06d}-{uuid.uuid4().hex}.bin"
        encoder = coder(tokenizer, end_id)
        docs_n = 0
        for batch in batches:
            for piece in slices(batch, "text", SLICE):
                made = made or Writer(uri, width)
                ids, ends = encoder.encode(column(piece, "text"))
                made.add(column(piece, "id"), ids, ends)
                docs_n += len(piece)
        if made:
            made.close()
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "path": [uri], "n_docs": pa.array([docs_n], pa.int64()), "n_tokens": pa.array([made.n], pa.int64())})

    return store(ordered.mapInArrow(run, "part int, path string, n_docs bigint, n_tokens bigint"), "files")


def read_token_files(listed: DataFrame, digest, fields: str, id_col: str = "doc_id") -> DataFrame:
    """One row per document of the listed files: ``id_col``, start (ids of all documents before it), n_tokens, and what
    ``digest(ids)`` returns for the columns ``fields``.  The running sum is over the list of files alone."""
    before = F.sum("n_tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    placed = listed.withColumn("before", F.coalesce(before, F.lit(0))).repartition(partitions(listed.sparkSession), "part")
    schema = f"`{id_col}` bigint, start bigint, n_tokens bigint, {fields}"
    names = [x.split()[0] for x in fields.split(",")]

    def run(batches):
        let_go()
        for batch in batches:
            for uri, start in zip(batch.column("path").to_pylist(), batch.column("before").to_pylist(), strict=True):
                reader, out = Reader(uri), []
                for i, ids in enumerate(reader.documents()):
                    out.append((len(ids), *digest(ids)))
                    if len(out) == READ_ROWS or i + 1 == len(reader.ids):
                        at = slice(i + 1 - len(out), i + 1)
                        yield pa.RecordBatch.from_arrays([reader.ids[at], pa.array(start + reader.first[at]), *map(pa.array, zip(*out, strict=True))], names=[id_col, "start", "n_tokens", *names])
                        out = []

    return placed.mapInArrow(run, schema)


def files_folder(docs: DataFrame) -> str:
    return new_path(docs.sparkSession, "tokens")
