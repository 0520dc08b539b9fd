"""Licence scan: ordered signature rules behind a keyword filter; overlapping detections are resolved by priority."""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from itertools import accumulate

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medloom.llm.license_rules import BASE, Rule, rules
from medloom.llm.shared import fresh, text_batches
from medloom.llm.textcols import ALNUM, LOWER, column, held, slices, starts, utf8

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


class Scanner:
    """Finds base phrases and rule detections in the words of a text."""

    def __init__(self, found: list[Rule] | None = None, base=BASE):
        self.rules, self.base = rules() if found is None else found, base
        # the longest word of a rule's keywords, where a word begins, lets a text through (as does the longest word of
        # a base phrase); every keyword is then looked for in the joined words
        self.gate = ahocorasick.Automaton()
        for word in {max((w for k in r.keywords for w in k.split()), key=len) for r in self.rules} | {max(p, key=len) for _, p in base}:
            self.gate.add_word(word, len(word))
        self.gate.make_automaton()

    def texts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Which rows hold a gate word; ``data`` is in lower case."""
        at = np.array([(i, n) for i, n in self.gate.iter(data.tobytes().decode("latin-1"))], np.int64).reshape(-1, 2)
        begins, ends = at[:, 0] - at[:, 1] + 1, at[:, 0] + 1
        row = np.searchsorted(offsets, begins, "right") - 1
        fits = (ends <= offsets[row + 1]) & ((begins == offsets[row]) | ~ALNUM[data[begins - 1]])
        hit = np.zeros(len(offsets) - 1, bool)
        hit[row[fits]] = True
        return hit

    def scan(self, text: bytes) -> tuple[list[tuple[str, int]], list[tuple[str, int, int, float]]]:
        """Base places (label, first word) and detections (label, first word, last word + 1, confidence) of a text in
        lower case.  A detection whose words lie within those of a stronger one is suppressed."""
        words = WORD.findall(text)
        places = []
        for label, phrase in self.base:
            want = [w.encode() for w in phrase]
            at, last = -1, len(words) - len(want)
            while True:
                try:
                    at = words.index(want[0], at + 1)
                except ValueError:
                    break
                if at <= last and words[at : at + len(want)] == want:
                    places.append((label, at))
        joined = b" ".join(words).decode("latin-1")
        begins = [0, *accumulate(len(w) + 1 for w in words)]
        seen: dict[str, bool] = {}
        kept: list[tuple[str, int, int, float]] = []
        reach: list[tuple[int, int]] = []  # kept intervals that no other kept one contains, by start and so by end
        for rule in self.rules:
            if all(seen[k] if k in seen else seen.setdefault(k, k in joined) for k in rule.keywords):
                for m in rule.pattern.finditer(joined):
                    a, b = bisect_right(begins, m.start()) - 1, bisect_left(begins, m.end())
                    i = bisect_right(reach, (a, len(words) + 1))
                    if i and reach[i - 1][1] >= b:
                        continue
                    kept.append((rule.label, a, b, rule.confidence))
                    j = bisect_left(reach, (a, 0))
                    while j < len(reach) and reach[j][1] <= b:
                        reach.pop(j)
                    reach.insert(j, (a, b))
        return places, sorted(kept, key=lambda x: (x[1], x[2], x[0]))


def license_scan(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """``keep`` columns and, of the whole text: n_words, places (base phrases: label, word), found (detections after
    suppression: label, begin, end, confidence; in words), and score, 1 - the product of 1 - confidence over the
    distinct labels' best detections (0 without any).

    A null or empty text has no words; rows that repeat are scanned alike.  One pass, no shuffle; a text without a gate
    word costs one automaton step a byte.
    """
    text_batches(docs.sparkSession)
    whole = fresh(docs, "whole_text")
    source = docs.select(*keep, F.col(text).cast("string").alias(whole))
    own = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1])
    places_t = pa.list_(pa.struct([("label", pa.string()), ("word", pa.int64())]))
    found_t = pa.list_(pa.struct([("label", pa.string()), ("begin", pa.int64()), ("end", pa.int64()), ("confidence", pa.float64())]))

    def run(batches):
        scanner = held("licences", "scanner", Scanner)
        for batch in batches:
            for piece in slices(batch, whole, 1 << 20):
                data, offsets = utf8(column(piece, whole))
                n_words = np.diff(np.searchsorted(starts(ALNUM[data], offsets), offsets))
                lower = LOWER[data]
                hit = scanner.texts(lower, offsets)
                places, found, score = [[] for _ in hit], [[] for _ in hit], np.zeros(len(hit))
                for i in np.flatnonzero(hit).tolist():
                    p, d = scanner.scan(lower[offsets[i] : offsets[i + 1]].tobytes())
                    places[i] = [{"label": x, "word": w} for x, w in sorted(p, key=lambda x: x[1])]
                    found[i] = [{"label": x, "begin": a, "end": b, "confidence": c} for x, a, b, c in d]
                    best: dict[str, float] = {}
                    for x, _, _, c in d:
                        best[x] = max(c, best.get(x, 0))
                    for x, _ in p:
                        best.setdefault(x, 0.6)
                    score[i] = 1 - np.prod([1 - c for _, c in sorted(best.items())]) if best else 0
                yield pa.RecordBatch.from_arrays(
                    [*(column(piece, k) for k in keep), pa.array(n_words, pa.int64()), pa.array(places, places_t), pa.array(found, found_t), pa.array(np.round(score, 9))],
                    names=[*keep, "n_words", "places", "found", "score"],
                )

    return source.mapInArrow(run, f"{own}, n_words bigint, places array<struct<label:string,word:bigint>>, found array<struct<label:string,begin:bigint,end:bigint,confidence:double>>, score double")
