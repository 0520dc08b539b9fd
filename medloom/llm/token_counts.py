"""Token counts under a unigram vocabulary: one dynamic programme over a trie of distinct pre-tokens."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medloom.llm.shared import fresh, text_batches
from medloom.llm.textcols import WHITE, Memo, column, held, slices, starts, units, utf8

#: What stands before every pre-token.
MARK = "▁"


def piece_scores(path: str) -> dict[str, float]:
    """Scores for the pieces of a sentencepiece vocabulary file: logarithms of Zipf's law by rank."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    total = math.log(sum(1 / (k + 10) for k in range(len(pieces))))
    return {p: -math.log(k + 10) - total for k, p in enumerate(pieces)}


class UnigramCounter:
    """Tokens of the best segmentation: the greatest sum of scores, and of those the fewest tokens.

    A character that no piece covers alone is one token per UTF-8 byte, each at ``floor`` below the least score.
    """

    def __init__(self, scores: dict[str, float], floor: float = 10.0):
        self.unknown = min(scores.values(), default=0.0) - floor
        # pieces by their characters from the last to the first: what ends at a place is found in one walk
        self.root: dict = {}
        for piece, score in scores.items():
            node = self.root
            for ch in reversed(piece):
                node = node.setdefault(ch, {})
            node[""] = score
        self.memo = Memo(80_000)

    def sorted_counts(self, words: list[str]) -> list[int]:
        """Counts of words in ascending order.

        They are paths of a trie, walked depth first: a word shares the forward scores of its common prefix with the
        word before it, and only the nodes behind that prefix are computed, each once; the end of a word gives its
        count.
        """
        out, score, count, before = [], [0.0], [0], ""
        root, unknown = self.root, self.unknown
        for word in words:
            shared, most = 0, min(len(word), len(before))
            while shared < most and word[shared] == before[shared]:
                shared += 1
            del score[shared + 1 :], count[shared + 1 :]
            for end in range(shared, len(word)):
                best, tokens, node, begin = None, 0, root, end
                while begin >= 0 and (node := node.get(word[begin])) is not None:
                    if "" in node:
                        s, n = score[begin] + node[""], count[begin] + 1
                        if best is None or s > best or s == best and n < tokens:
                            best, tokens = s, n
                    begin -= 1
                if "" not in root.get(word[end], ()):
                    size = len(word[end].encode("utf-8", "surrogatepass"))
                    s, n = score[end] + unknown * size, count[end] + size
                    if best is None or s > best or s == best and n < tokens:
                        best, tokens = s, n
                score.append(best)
                count.append(tokens)
            out.append(count[-1])
            before = word
        return out

    def counts(self, words: list[bytes]) -> list[int]:
        """Token counts of distinct words."""
        text = [MARK + w.decode() for w in words]
        order = sorted(range(len(text)), key=text.__getitem__)
        out = [0] * len(words)
        for i, n in zip(order, self.sorted_counts([text[i] for i in order]), strict=True):
            out[i] = n
        return out

    def batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Pre-tokens and tokens of every text; pre-tokens are what ASCII white space separates."""
        data, offsets = utf8(texts)
        solid = ~WHITE[data]
        before = np.concatenate([[0], np.cumsum(solid)])
        which, words, per_row = units(data[solid], before[offsets], before[starts(solid, offsets)])
        known = self.memo.get(words, self.counts, distinct=True)
        each = np.fromiter((known[w] for w in words), np.int64, len(words))
        tokens = np.concatenate([[0], np.cumsum(each[which])]) if len(which) else np.zeros(1, np.int64)
        return np.diff(per_row).astype(np.int64), np.diff(tokens[per_row])


def token_counts(docs: DataFrame, pieces: str, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """``keep`` columns, n_words and n_tokens (long) of the whole text under the unigram scores of the vocabulary file.

    Distinct pre-tokens of a run of texts go through the trie together and are remembered for the next ones (a bounded
    number); nothing is shuffled.  A null, empty or blank text has none of either; rows that repeat have equal counts.
    """
    text_batches(docs.sparkSession)
    whole = fresh(docs, "whole_text")
    source = docs.select(*keep, F.col(text).cast("string").alias(whole))
    own = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1])

    def run(batches):
        counter = held("pieces", pieces, lambda: UnigramCounter(piece_scores(pieces)))
        for batch in batches:
            for piece in slices(batch, whole, 2 << 20):
                words, tokens = counter.batch(column(piece, whole))
                yield pa.RecordBatch.from_arrays([*(column(piece, k) for k in keep), pa.array(words), pa.array(tokens)], names=[*keep, "n_words", "n_tokens"])

    return source.mapInArrow(run, f"{own}, n_words bigint, n_tokens bigint")
