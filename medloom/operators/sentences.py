"""Chunks of whole sentences: boundaries by rules on words, greedy packing, overlap in whole sentences."""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words with a full stop that end no sentence, in lower case.
ABBREVIATIONS = (
    "al.", "approx.", "ca.", "cf.", "dr.", "e.g.", "eq.", "etc.", "fig.", "figs.", "i.e.", "inc.", "jr.", "mr.", "mrs.", "ms.", "no.", "nos.", "pp.", "prof.", "ref.", "refs.", "resp.", "sr.", "st.", "vol.", "vs.",
    "bzw.", "d.h.", "evtl.", "ggf.", "nr.", "usw.", "z.b.",
)
#: What ends a sentence: a full stop or another mark, and quotes or brackets that it closes.
CLOSING = r"[.!?…]+[\"'”’»)\]]*$"
#: Quotes and brackets that open.
QUOTES = r"^[\"'“‘«(\[]+"
#: What a sentence begins with, behind those: a capital or a digit.
OPENING = r"^[\"'“‘«(\[]*[\p{Lu}0-9]"
#: A single letter with a full stop is an initial; opening quotes and brackets don't count.
INITIAL = r"^[\"'“‘«(\[]*\p{L}\.$"


_CLOSING, _INITIAL, _QUOTES = (re.compile(p) for p in (CLOSING, INITIAL.replace(r"\p{L}", r"[^\W\d_]"), QUOTES))
#: What a word that closes a sentence ends with.
_LAST = frozenset(".!?…\"'”’»)]")
_SPACE = re.compile(r"[^ \t\n\x0b\f\r]+")


def _opens(word: str) -> bool:
    """Whether a sentence may begin with the word."""
    bare = _QUOTES.sub("", word)
    return bare[:1].isupper() or bare[:1] in tuple("0123456789")


def ends(words: list[str]) -> list[int]:
    """Places (from 0) of the words that end a sentence; the last word does."""
    out, last = [], len(words) - 1
    for i, w in enumerate(words):
        if i == last:
            out.append(i)
        elif w[-1] in _LAST and _CLOSING.search(w) and _opens(words[i + 1]) and _QUOTES.sub("", w).lower() not in ABBREVIATIONS and not _INITIAL.fullmatch(w):
            out.append(i)
    return out


def packed(closed: list[int], size: int, overlap: int) -> list[tuple[int, int]]:
    """First and last word of each chunk, from the places of sentence ends.

    A chunk takes whole sentences as long as it has at most ``size`` words; a longer sentence is a chunk of its own.  The
    next one begins with as many of its last sentences as have at most ``overlap`` words and leave room for a new one."""
    out, first, at = [], 0, 0
    while at < len(closed):
        # the last end that keeps the chunk within its size, the next one at least
        upto = max(at, bisect_right(closed, first + size - 1) - 1)
        last = closed[upto]
        out.append((first, last))
        at = upto + 1
        if at < len(closed):
            # sentences begin behind ends: the first end that leaves few enough words behind it
            back = bisect_left(closed, max(first, last - overlap, closed[at] - size))
            first = min(closed[back], last) + 1
    return out


def chunked(rows: DataFrame, text: str, keep: list[str], size: int, overlap: int) -> DataFrame:
    """``keep``, position (from 0) and chunk of every chunk of a text column, words with single spaces between them; a text
    without words has none."""
    name = "__text"
    own = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches):
        for batch in batches:
            for at in range(0, len(batch), 64):
                piece = batch.slice(at, 64)
                which, position, texts = [], [], []
                for i, t in enumerate(piece.column(piece.schema.get_field_index(name)).to_pylist()):
                    words = _SPACE.findall(t or "")
                    for k, (a, b) in enumerate(packed(ends(words), size, overlap)):
                        which.append(i)
                        position.append(k)
                        texts.append(" ".join(words[a : b + 1]))
                at_row = pa.array(which, pa.int64())
                yield pa.RecordBatch.from_arrays([*(piece.column(piece.schema.get_field_index(c)).take(at_row) for c in keep), pa.array(position, pa.int32()), pa.array(texts, pa.string())], names=[*keep, "position", "chunk"])

    return rows.select(*keep, F.col(text).cast("string").alias(name)).mapInArrow(run, f"{own}, position int, chunk string")
