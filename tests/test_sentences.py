"""Sentence boundaries, and chunks of whole sentences against a plain version."""

import random
import re

import pytest
from medloom.operators import sentences as S


def split(text):
    words = (text or "").split()
    at = [0, *[e + 1 for e in S.ends(words)]]
    assert at[-1] == len(words)
    return [" ".join(words[a:b]) for a, b in zip(at, at[1:], strict=False)]


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("", []), ("   \n ", []), (None, []), ("no stop at all", ["no stop at all"]), ("One. Two! Three? four", ["One.", "Two!", "Three? four"]),
        ("It was 3.5 mg. Then 4.", ["It was 3.5 mg.", "Then 4."]), ("See Fig. 3 and Dr. Who (cf. Smith et al. 2019). End.", ["See Fig. 3 and Dr. Who (cf. Smith et al. 2019).", "End."]),
        ("J. Doe and (K. Roe) came. He left.", ["J. Doe and (K. Roe) came.", "He left."]), ('He said "Stop." Then "(Go!)" Élan vital… Ünd', ['He said "Stop."', 'Then "(Go!)"', "Élan vital…", "Ünd"]),
        ("at p < 0.05. 12 patients", ["at p < 0.05.", "12 patients"]), ("ends lower. case goes on. (E.g. this) Yes.", ["ends lower. case goes on.", "(E.g. this) Yes."]), ("What?! Really.", ["What?!", "Really."]),
    ],
)
def test_boundaries(text, want):
    assert split(text) == want


def plain(lengths, size, overlap):
    """Chunks as lists of sentences, from the lengths of sentences."""
    out, at = [], 0
    while at < len(lengths):
        end = at + 1
        while end < len(lengths) and sum(lengths[at : end + 1]) <= size:
            end += 1
        out.append((at, end))
        if end == len(lengths):
            break
        back = end
        while back - 1 > at and sum(lengths[back - 1 : end]) <= overlap and sum(lengths[back - 1 : end + 1]) <= size:
            back -= 1
        at = back
    return out


@pytest.mark.parametrize(("size", "overlap"), [(10, 3), (10, 0), (25, 10), (3, 2), (1000, 50)])
def test_chunks_against_a_plain_version(spark, size, overlap):
    rng = random.Random(size)
    texts = [" ".join(" ".join(["Wa" + "x" * rng.randrange(3)] * (rng.randrange(1, 9) if rng.random() < 0.9 else 40)) + "." for _ in range(n)) for n in (1, 2, 5, 40, 120)]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(90, None), (91, " ")], "i int, t string")
    rows = S.chunked(rows, "t", ["i"], size, overlap)
    got = {}
    for r in sorted(rows.collect()):
        got.setdefault(r["i"], []).append(r["chunk"])
    for i, t in enumerate(texts):
        listed = re.findall(r"[^.]+\.", t)
        lengths = [len(s.split()) for s in listed]
        spans = plain(lengths, size, overlap)
        assert got[i] == [" ".join(" ".join(listed[a:b]).split()) for a, b in spans]
        assert all(len(c.split()) <= size or b - a == 1 for c, (a, b) in zip(got[i], spans, strict=True))
        assert {k for a, b in spans for k in range(a, b)} == set(range(len(listed)))
    assert not {90, 91} & got.keys()
