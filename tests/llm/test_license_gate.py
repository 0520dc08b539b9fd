"""No pattern is shut out by the keywords of its own rule."""

import random
import re
from re import _parser

import numpy as np

from medloom.llm import license_scan
from medloom.llm.license_rules import FAMILIES, rules


def sample(tree, rng):
    """A text that the parsed pattern matches."""
    out = ""
    for op, arg in tree:
        name = str(op)
        if name == "LITERAL":
            out += chr(arg)
        elif name == "SUBPATTERN":
            out += sample(arg[3], rng)
        elif name == "BRANCH":
            out += sample(rng.choice(arg[1]), rng)
        elif name in ("MAX_REPEAT", "MIN_REPEAT"):
            out += "".join(sample(arg[2], rng) for _ in range(rng.choice([arg[0], min(arg[1], arg[0] + 1)])))
        elif name == "IN":
            kind, x = arg[0]
            out += {"LITERAL": lambda: chr(x), "RANGE": lambda: chr(x[0]), "CATEGORY": lambda: "1", "NEGATE": lambda: "x"}[str(kind)]()
        elif name == "NOT_LITERAL":
            out += "x"
        elif name not in ("AT", "ASSERT_NOT"):
            raise ValueError(name)
    return out


def gate_passes(text):
    data = np.frombuffer(text.encode(), np.uint8)
    return bool(license_scan.Scanner().texts(data, np.array([0, len(data)]))[0])


def test_every_pattern_passes_its_own_gate():
    rng, scanner = random.Random(1), license_scan.Scanner()
    for rule in rules():
        if "either version" in rule.pattern.pattern:
            continue  # these words do not name a licence: the keyword does
        for _ in range(12):
            text = sample(_parser.parse(rule.pattern.pattern), rng)
            assert rule.pattern.search(text), (rule, text)
            assert all(k in text for k in rule.keywords), (rule, text)
            data = np.frombuffer(text.encode(), np.uint8)
            assert scanner.texts(data, np.array([0, len(data)]))[0], (rule, text)


def test_spdx_lines_and_short_names():
    scanner = license_scan.Scanner()
    for text, label in [("spdx-license-identifier: epl-2.0", "epl-2.0"), ("spdx-license-identifier: bsl-1.0", "bsl-1.0"), ("mplv2.0", "mpl-2.0"), ("lgpl2.1", "lgpl-2.1")]:
        assert gate_passes(text) and label in [d[0] for d in scanner.scan(text.encode())[1]]


def plain_scan(text):
    """Every rule on every text, each detection against all stronger ones."""
    words = re.findall(rb"[0-9a-z\x80-\xff]+", text)
    joined = b" ".join(words).decode("latin-1")
    kept = []
    for rule in rules():
        if all(k in joined for k in rule.keywords):
            for m in rule.pattern.finditer(joined):
                a, b = joined[: m.start()].count(" "), joined[: m.end()].count(" ") + 1
                if not any(c <= a and b <= d for _, c, d, _ in kept):
                    kept.append((rule.label, a, b, rule.confidence))
    return sorted(kept, key=lambda x: (x[1], x[2], x[0]))


def test_scan_against_all_rules_on_all_texts():
    rng, scanner, every = random.Random(4), license_scan.Scanner(), rules()
    noise = "the of and code file work under cc by sa gpl mit bsd 2 0 version license all rights reserved é".split()
    for _ in range(400):
        parts = [sample(_parser.parse(rng.choice(every).pattern.pattern), rng) if rng.random() < 0.4 else rng.choice(noise) for _ in range(rng.randint(1, 12))]
        text = " ".join(parts).encode()
        assert scanner.scan(text)[1] == plain_scan(text), text
        if plain_scan(text):
            assert gate_passes(text.decode())


def test_words_bound_a_match_and_versions_have_one_name():
    found = lambda t: {x[0] for x in license_scan.Scanner().scan(t.encode())[1]}
    assert found("égpl 3") == set() and found("gpl 3é") == set()
    assert found("gpl 2 0") == found("gpl 2") == found("gplv2") == {"gpl-2.0"}
    assert found("cc by 4") == found("cc-by 4.0") == {"cc-by-4.0"}
    assert found("no rights reserved") == {"no-rights-reserved"} and found("some rights reserved") == {"some-rights-reserved"}
    assert found("all rights reserved") == {"reserved"}


def test_hundreds_of_patterns_are_written_by_hand():
    assert len({p for *_, patterns in FAMILIES for p in patterns}) >= 240
