"""Each operator against a plain version of what it computes, and on the rows that break things."""

import hashlib
import random
import re
import unicodedata
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from medloom.llm import ann, byte_bpe, embedding_dedup, license_scan, line_dedup, mixing, near_docs, queries, simhash, token_counts, token_files, toxicity
from medloom.llm.components import components
from medloom.llm.textcols import utf8

SMALL = "/root/testdata/sf0.001"
ODD = [
    (1, "plain words here and a few more of them", "a"), (2, None, "a"), (3, "", None), (4, " \n\t ", "b"), (None, "no id at all", "b"),
    (5, "x" * 30_000, "c"), (6, "wörter und 日本語 🙂     ß", "c"), (7, "same text twice", "d"), (7, "same text twice", "d"), (8, "same text twice", None),
    (9, "a\x1cb \x85 c's 'S 12 ٣", "e"), (10, "line one is here today\nline one is here today\n\nline 2", "e"),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(*r, "k", 1.0, "t") for r in ODD], "doc_id bigint, text string, source string, __key string, score double, fp string")


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], "doc_id bigint, text string, source string")


def union_find(links, nodes):
    up = {n: n for n in nodes}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        up[max(top(a), top(b))] = min(top(a), top(b))
    return {n: top(n) for n in nodes}


def test_components_of_chains_stars_and_cycles(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 200)] + [(2000, 2001), (2001, 2002), (2002, 2000), (5, 5), (None, 3)]
    links += [(rng.randrange(3000, 3200), rng.randrange(3000, 3200)) for _ in range(120)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "u bigint, v bigint")).collect()}
    real = [(a, b) for a, b in links if a is not None and a != b]
    want = union_find(real, {x for p in real for x in p})
    assert got.keys() == want.keys()
    assert len({(got[n], want[n]) for n in got}) == len(set(got.values())) == len(set(want.values()))
    assert components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


# 1 ---------------------------------------------------------------------------------------------------------------


def vectors():
    rng = np.random.default_rng(3)
    base = rng.normal(size=(60, 24))
    near = [base[i % 5] + rng.normal(size=24) * 0.12 for i in range(80)]
    rows = [(i, v.tolist()) for i, v in enumerate([*base, *near])]
    rows += [(500 + i, base[0].tolist()) for i in range(30)] + [(600, (base[1] * 7).tolist()), (None, base[2].tolist())]
    rows += [(700, None), (701, []), (702, [0.0] * 24), (703, [float("nan")] * 24), (704, [None, *[1.0] * 23]), (705, [float("inf"), *[1.0] * 23]), (706, [1.0, 0.0]), (707, [2.0, 0.0]), (708, (base[3] * 1e-200).tolist())]
    return rows


def test_embedding_groups_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "TILE", 16)
    rows = vectors()
    got = embedding_dedup.embedding_groups(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")).collect()
    assert len(got) == len(rows)
    good = [(i, np.array(v)) for i, v in rows if v and None not in v and np.isfinite(v).all() and np.any(v)]
    unit = [(i, v / np.abs(v).max() / np.linalg.norm(v / np.abs(v).max())) for i, v in good]
    links = [(a, b) for a in range(len(unit)) for b in range(a) if len(unit[a][1]) == len(unit[b][1]) and unit[a][1] @ unit[b][1] >= 0.9]
    groups = union_find(links, range(len(unit)))
    degree = Counter(x for p in links for x in p)
    want = Counter()
    for k, (i, _) in enumerate(unit):
        least = min((unit[m][0] for m in groups if groups[m] == groups[k] and unit[m][0] is not None), default=None)
        want[i, degree[k], least, i == least] += 1
    for i, v in rows:
        if not (v and None not in v and np.isfinite(v).all() and np.any(v)):
            want[i, 0, i, True] += 1
    assert Counter((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in got) == want
    assert embedding_dedup.embedding_groups(spark.createDataFrame([], "vec_id bigint, embedding array<float>")).count() == 0


def test_embedding_query_against_all_pairs(spark):
    rows = [(r["vec_id"], np.array(r["embedding"], float)) for r in spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()]
    unit = np.stack([v / np.linalg.norm(v) for _, v in rows])
    links = [(a, b) for a, b in np.argwhere(unit @ unit.T >= 0.9).tolist() if b < a]
    group, degree = union_find(links, range(len(rows))), Counter(x for p in links for x in p)
    least = {g: min(rows[m][0] for m in group if group[m] == g) for g in set(group.values())}
    got = {(r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in queries.op1_embedding_dedup(spark, "/root/testdata/sf0.01").collect()}
    assert got == {(i, degree[k], least[group[k]], i == least[group[k]]) for k, (i, _) in enumerate(rows)}


def test_far_cells_never_meet():
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(8, 12))
    x = np.concatenate([c + rng.normal(size=(100, 12)) * 0.02 for c in centres])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    frame = embedding_dedup.Frame(x, 8)
    near, cell = frame.near(0.9), frame.cell(x @ frame.rotation)
    assert sum(map(len, near)) < len(near) ** 2
    hit = np.argwhere(x @ x.T >= 0.9)
    assert all(cell[b] in near[cell[a]] for a, b in hit[::50])


# 2 ---------------------------------------------------------------------------------------------------------------


EXTREMES = {}


def plain_count(scores, word, floor=10.0):
    """Tokens of one pre-token: all segmentations by their ends."""
    if id(scores) not in EXTREMES:
        EXTREMES[id(scores)] = scores, max(map(len, scores)), min(scores.values())
    _, longest, least = EXTREMES[id(scores)]
    unknown = least - floor
    best = [(0.0, 0)]
    for end in range(1, len(word) + 1):
        options = [(best[b][0] + scores[word[b:end]], best[b][1] - 1) for b in range(max(0, end - longest), end) if word[b:end] in scores]
        if word[end - 1] not in scores:
            n = len(word[end - 1].encode("utf-8", "surrogatepass"))
            options.append((best[end - 1][0] + unknown * n, best[end - 1][1] - n))
        best.append(max(options))
    return -best[-1][1]


def test_token_counts_against_the_plain_programme(spark, odd, none, tmp_path):
    path = public_tokenizers.path("piece_bpe_32k.model")
    scores = token_counts.piece_scores(path)
    count = lambda t: sum(plain_count(scores, token_counts.MARK + w.decode()) for w in (t or "").encode().split())
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    for r in queries.op2_token_counts(spark, SMALL).collect():
        assert (r["n_words"], r["n_tokens"]) == (len(texts[r["doc_id"]].encode().split()), count(texts[r["doc_id"]]))
    assert Counter(r["n_tokens"] for r in token_counts.token_counts(odd, path).collect()) == Counter(count(t) for _, t, _ in ODD)
    assert token_counts.token_counts(none, path).count() == 0
    named = odd.withColumn("whole_text", F.lit(1))
    assert token_counts.token_counts(named, path, keep=("doc_id", "whole_text", "__key")).count() == len(ODD)


def test_trie_shares_prefixes():
    scores = {"▁a": -1.0, "ab": -1.5, "b": -2.0, "▁ab": -4.0, "c": -1.0, "abc": -9.0}
    words = sorted(["▁a", "▁ab", "▁abc", "▁abcab", "▁b", "▁ü", "▁" + "abc" * 3000, "▁" + "abc" * 3000 + "ü", "", "a", "▁🙂b"])
    assert token_counts.UnigramCounter(scores).sorted_counts(words) == [plain_count(scores, w) for w in words]


def test_token_counts_as_a_sentencepiece_unigram_model():
    """The library's own programme over a model of the same pieces and scores, where it knows every character."""
    import sentencepiece

    scores = token_counts.piece_scores(public_tokenizers.path("piece_bpe_32k.model"))
    f, v = byte_bpe._field, byte_bpe._varint
    pieces = [f(1, 2, f(1, 2, p.encode()) + f(2, 5, np.float32(s).tobytes()) + f(3, 0, v(1))) for p, s in scores.items()]
    pieces.append(f(1, 2, f(1, 2, b"<unk>") + f(2, 5, np.float32(0).tobytes()) + f(3, 0, v(2))))
    trainer = f(3, 0, v(1)) + f(4, 0, v(len(pieces))) + f(40, 0, v(len(scores))) + b"".join(f(k, 0, v((1 << 64) - 1)) for k in (41, 42, 43))
    normaliser = f(1, 2, b"identity") + b"".join(f(k, 0, v(0)) for k in (3, 4, 5))
    library = sentencepiece.SentencePieceProcessor(model_proto=b"".join(pieces) + f(2, 2, trainer) + f(3, 2, normaliser))
    rng = random.Random(2)
    words = sorted({token_counts.MARK + "".join(rng.choices("abcdefghilmnoprstuvw", k=rng.randint(1, 30))) for _ in range(3000)})
    assert token_counts.UnigramCounter(scores).sorted_counts(words) == [len(x) for x in library.encode(words, num_threads=1)]


# 3 ---------------------------------------------------------------------------------------------------------------


def normal(line):
    return re.sub(" +", " ", re.sub(r"[^a-z0-9\x80-\U0010ffff]", " ", line.lower())).strip()


def plain_line_dedup(rows):
    """Texts left, by the edit similarity of all pairs of distinct lines."""
    docs = {}
    for i, t in rows:
        docs.setdefault((i is None, i if i is not None else 0, t), t)
    at = [(d, n, normal(x)) for d, t in docs.items() if t is not None for n, x in enumerate(t.split("\n")) if normal(x)]
    codes = sorted({x for _, _, x in at})
    links = [(a, b) for k, a in enumerate(codes) for b in codes[:k] if line_dedup.similar(a, b)]
    group = union_find(links, codes)
    first = {}
    for d, n, x in sorted(at, key=lambda r: (r[0][:2], r[1])):
        first.setdefault(group[x], (d, n))
    kept = set(first.values())
    drop = {(d, n) for d, n, x in at} - kept
    left = {d: None if t is None else "\n".join(x for n, x in enumerate(t.split("\n")) if (d, n) not in drop) for d, t in docs.items()}
    return Counter((i, left[i is None, i if i is not None else 0, t]) for i, t in rows)


def lines_with_changes(most):
    """Documents of lines that are copies of a few with up to ``most`` of 60 words replaced, and of odd ones."""
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 8))) for _ in range(300)]
    base = [" ".join(rng.choices(words, k=60)) for _ in range(12)]
    rows = []
    for i in range(90):
        lines = []
        for _ in range(rng.randint(0, 5)):
            b = rng.choice(base).split()
            for _ in range(rng.choice([0, 0, 1, 1, 2, most])):
                b[rng.randrange(len(b))] = rng.choice(words)
            lines.append(rng.choice(["", "  "]) + " ".join(b).upper() + rng.choice(["", ".", " !"]))
            lines += rng.choice([[], ["short one"], ["", "--"]])
        rows.append((i, "\n".join(lines)))
    return rows + [(None, base[0]), (90, None), (91, ""), (5, rows[5][1])]


def test_line_dedup_against_all_pairs(spark, odd, none):
    rows = lines_with_changes(5)
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert Counter((r["doc_id"], r["text"]) for r in got.collect()) == plain_line_dedup(rows)
    # a pair of lines with nine words replaced in each is hardly similar: such pairs may be missed
    rows = lines_with_changes(9)
    left = lambda found: sum(n * len((t or "").split("\n")) for (_, t), n in found.items())
    got = Counter((r["doc_id"], r["text"]) for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id bigint, text string")).collect())
    assert left(plain_line_dedup(rows)) <= left(got) <= left(plain_line_dedup(rows)) + 3
    out = line_dedup.dedup_lines(odd)
    assert out.count() == len(ODD) and out.columns[:6] == ["doc_id", "source", "__key", "score", "fp", "text"]
    assert {r["text"] for r in out.where("doc_id = 10").collect()} == {"line one is here today\n\nline 2"}
    assert line_dedup.dedup_lines(none).count() == 0


def test_numbers_of_one_shape_are_not_one_line(spark):
    lines = ["98 111 07", "12 450 33", "Order 9023 paid", "Order 4471 paid", "Page 2 of the long report", "Page 1 of the long report"]
    got = line_dedup.dedup_lines(spark.createDataFrame([(1, "\n".join(lines))], "doc_id bigint, text string")).first()
    assert got["text"].split("\n") == lines[:5]  # the last two are similar


def test_edit_distance():
    def plain(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    rng = random.Random(9)
    for _ in range(600):
        a, b = ("".join(rng.choices("abc", k=rng.randint(0, 14))) for _ in range(2))
        most = rng.randint(0, 14)
        assert line_dedup.edit_distance(a, b, most) == min(plain(a, b), most + 1)


def test_normal_lines():
    texts = ["  A b\tC \n\n12-3 x ", None, "", "\n", "Élan  vital\n !! \nz"]
    data, offsets, per_text = line_dedup.normal_lines(pa.array(texts))
    got = [data[a : b - 1].tobytes().decode() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    assert got == [normal(x) for t in texts for x in (t or "").split("\n")]
    assert per_text.tolist() == [len((t or "").split("\n")) for t in texts]


# 4 ---------------------------------------------------------------------------------------------------------------


def test_license_base_places(spark, odd, none, tmp_path):
    texts = ["CC BY-NC 4.0 cc\nby, all rights  reserved ALL-RIGHTS-RESERVED", "the GNU General Public License, version 3", "ccby all right reserved", "général public license cc é by", None, "", "mit dem der und", "Released under the MIT License and the Apache License, Version 2.0."]
    spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r for r in queries.op4_license_scan(spark, str(tmp_path)).collect()}
    word = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    phrases = {"cc-by": ["cc", "by"], "gpl": ["general", "public", "license"], "reserved": ["all", "rights", "reserved"]}
    for i, t in enumerate(texts):
        w = word.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        places = [(k, p) for p, q in phrases.items() for k in range(len(w)) if w[k : k + len(q)] == q]
        r = got[i]
        assert (r["n_words"], r["n_base"]) == (len(w), len(places))
        assert (r["first_word"], r["last_word"]) == (min((k for k, _ in places), default=None), max((k for k, _ in places), default=None))
        assert r["base_labels"] == ",".join(sorted({p for _, p in places})) and set(r["base_labels"].split(",")) - {""} <= set(r["labels"].split(","))
        assert 0 <= r["score"] <= 1
    assert "cc-by-nc-4.0" in got[0]["labels"] and "gpl-3.0" in got[1]["labels"] and got[6]["labels"] == "" and got[7]["labels"] == "apache-2.0,mit"
    assert license_scan.license_scan(odd).count() == len(ODD) and license_scan.license_scan(none).count() == 0


def test_a_contained_weaker_detection_is_suppressed():
    _, found = license_scan.Scanner().scan(b"gnu general public license version 3 and gpl")
    assert [x[0] for x in found] == ["gpl-3.0"]
    assert len(license_scan.Scanner().rules) >= 200


# 5 ---------------------------------------------------------------------------------------------------------------


def brute_nearest(rows, every=20, k=20):
    """query id -> (vec id, score) of the nearest, over distinct rows, of each id the best."""
    good = {(i, tuple(v)) for i, v in rows if i is not None and v is not None and any(v) and np.isfinite(v).all()}
    out = {}
    for q, v in good:
        if q % every == 0:
            best = out.setdefault(q, {})
            for i, w in good:
                if i != q and len(w) == len(v):
                    best[i] = max(best.get(i, -np.inf), float(np.dot(v, w)))
    return {q: sorted(best.items(), key=lambda x: (-x[1], x[0]))[:k] for q, best in out.items()}


def test_nearest_over_several_shards(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(ann, "SHARD", 256)
    monkeypatch.setattr(ann, "QUERY_BLOCK", 32)
    rng = np.random.default_rng(8)
    x = rng.normal(size=(1600, 24))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x[200:230] = x[40]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += rows[:45] + [(20, x[900].tolist()), (33, x[60].tolist())]  # rows that repeat, ids with two vectors
    spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").write.parquet(str(tmp_path / "embeddings.parquet"))
    got = {}
    for r in queries.op5_nearest_neighbours(spark, str(tmp_path)).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    want = brute_nearest(rows)
    assert got.keys() == want.keys() and all(len(v) == 20 == len({i for i, _ in v}) for v in got.values())
    assert sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want) >= 0.95 * 20 * len(want)
    assert all(v == sorted(v, key=lambda f: (-f[1], f[0])) for v in got.values())


def test_every_point_of_a_graph_can_be_reached():
    rng = np.random.default_rng(1)
    for n in (1, 2, 3, 40, 60):
        for _ in range(40):
            x = rng.normal(size=(n, 2)) * rng.choice([0.01, 1, 50], size=(n, 1))
            graph = ann.Graph.build(ann.lifted(x), degree=4, beam=8)
            assert graph.reached().all()
            assert set(graph.search(graph.points[:1], n)[0][0].tolist()) == set(range(n))


def test_nearest_recall_and_order(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(1500, 32)).astype(np.float32) * rng.uniform(0.5, 2, size=(1500, 1)).astype(np.float32)
    x[100:160] = x[7]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(5000, None), (5020, [0.0] * 32), (5040, [float("nan")] * 32), (None, x[0].tolist()), (5060, [1.0, 2.0])]
    got = {}
    for r in ann.nearest(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    exact = x.astype(np.float64) @ x.astype(np.float64).T
    hits = total = 0
    assert got.keys() == set(range(0, 1500, 20))
    for q, ranks in got.items():
        assert sorted(ranks) == list(range(1, 21))
        found = [ranks[k] for k in sorted(ranks)]
        assert found == sorted(found, key=lambda f: (-f[1], f[0])) and q not in {v for v, _ in found}
        for v, s in found:
            assert abs(s - exact[q, v]) < 1e-9
        order = sorted((c for c in range(1500) if c != q), key=lambda c: (-exact[q, c], c))[:20]
        hits += len(set(order) & {v for v, _ in found})
        total += 20
    assert hits / total >= 0.9
    assert ann.nearest(spark.createDataFrame([], "vec_id bigint, embedding array<float>")).count() == 0
    few = ann.nearest(spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [1.0, 0.0])], "vec_id bigint, embedding array<float>")).collect()
    assert [(r["query_id"], r["rank"], r["vec_id"]) for r in few] == [(0, 1, 2), (0, 2, 1)]


# 6 ---------------------------------------------------------------------------------------------------------------


def plain_print(t):
    w = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    if not w:
        return 0
    s = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_fingerprints_and_groups_against_all_pairs(spark, odd, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()] + [(9000 + k, t) for k, (_, t, _) in enumerate(ODD)] + [(None, "no id at all")]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.op6_simhash_dedup(spark, str(tmp_path)).collect()
    prints = [plain_print(t) for _, t in rows]
    links = [(a, b) for a in range(len(rows)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 2]
    group = union_find(links, range(len(rows)))
    least = {g: min((rows[m][0] for m in group if group[m] == g and rows[m][0] is not None), default=None) for g in set(group.values())}
    assert Counter((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got) == Counter((rows[k][0], f"{prints[k]:016x}", least[group[k]]) for k in range(len(rows)))


def test_variant_links_find_all(spark):
    rng = random.Random(6)
    base = [rng.getrandbits(64) for _ in range(20)] + [0, (1 << 64) - 1, 1 << 63]
    near = {b ^ sum(1 << k for k in rng.sample(range(64), rng.randint(0, 3))) for b in base for _ in range(30)} | set(base)
    signed = [x - (1 << 64) if x >> 63 else x for x in near]
    got = {(r["u"], r["v"]) for r in simhash.variant_links(spark.createDataFrame([(x,) for x in signed], "fp bigint")).collect()}
    assert got == {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= 2}


def test_keep_one_of_each_group(spark, odd, none):
    out = simhash.keep_one(odd)
    assert out.columns == odd.columns
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in out.collect()) == [(False, 1), (False, 2), (False, 5), (False, 6), (False, 7), (False, 9), (False, 10), (True, 0)]
    assert simhash.keep_one(none).count() == 0


def near_copies(rng, n, words, changes):
    """Texts and copies of them with some words replaced."""
    out = []
    for _ in range(n):
        a = [rng.choice(words) for _ in range(rng.randint(1, 120))]
        out.append(" ".join(a))
        for _ in range(rng.randint(0, 3)):
            b = list(a)
            for _ in range(rng.randint(0, changes)):
                b[rng.randrange(len(b))] = rng.choice(words)
            out.append(rng.choice([" ", "\n"]).join(b).upper())
    return out


def test_near_docs_against_all_pairs(spark, odd, none):
    rng = random.Random(11)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 8))) for _ in range(400)]
    rows = list(enumerate(near_copies(rng, 60, words, 2))) + [(900, None), (901, ""), (902, " \n"), (903, "one two"), (904, "ONE  two"), (905, "a b c d e"), (906, "a b c d e")]
    rng.shuffle(rows)
    got = near_docs.keep_one(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3))
    assert sorted(r["doc_id"] for r in got.collect()) == plain_near_docs(rows)
    out = near_docs.keep_one(odd)
    assert out.columns == odd.columns and near_docs.keep_one(none).count() == 0
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in out.collect()) == [(False, 1), (False, 2), (False, 5), (False, 6), (False, 7), (False, 9), (False, 10), (True, 0)]


def test_near_docs_recall():
    """Pairs of a similarity just above 0.8, and above 0.85, share a key nearly always."""
    rng, found = random.Random(12), {(n, least): [] for n in (200, 10**5, 10**6) for least in (0.8, 0.85)}
    for _ in range(400):
        a = [f"w{rng.randrange(10**9)}" for _ in range(200)]
        b = list(a)
        for i in rng.sample(range(0, 200, 9), rng.randint(2, 5)):
            b[i] = "new"
        texts = [" ".join(a), " ".join(b)]
        whole, gram, begin = near_docs.shingles(*utf8(pa.array(texts)))
        x, y = (set(gram[begin[k] : begin[k + 1]].tolist()) for k in (0, 1))
        alike = len(x & y) / len(x | y)
        margin = near_docs.margins(gram, begin)
        for (n, least), to in found.items():
            if least <= alike < least + 0.05:
                key = near_docs.keys(margin, near_docs.segments(n))
                to.append(bool(np.isin(key[0], key[1]).any()))
    assert all(len(x) > 30 and np.mean(x) >= (0.9 if least == 0.8 else 0.95) for (_, least), x in found.items())


def test_near_docs_mark_and_hash_of_words():
    texts = ["a b c d e f", "A  B\nc d e f", "f e d c b a", "a b", "b a", "", None, " "]
    whole, gram, begin = near_docs.shingles(*utf8(pa.array(texts)))
    assert whole[0] == whole[1] != whole[2] and whole[3] != whole[4] and whole[5] == whole[6] == whole[7]
    assert np.diff(begin).tolist() == [2, 2, 2, 1, 1, 0, 0, 0] and gram[:2].tolist() == gram[2:4].tolist()


# 7 ---------------------------------------------------------------------------------------------------------------


def test_toxicity_on_held_out_documents(spark):
    out = queries.op7_toxicity(spark, "/root/testdata/sf0.01")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = out.join(labels, "doc_id").where("held_out").select("predicted", "toxic").collect()
    assert sum(r["predicted"] == r["toxic"] for r in rows) >= 0.93 * len(rows)
    ids = {r["doc_id"]: r for r in out.collect()}
    assert len(ids) == 1000 and all(r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for i, r in ids.items())


def test_toxicity_of_odd_rows_and_single_classes(spark, odd, none):
    labels = spark.createDataFrame([(1, 0), (7, 1), (10, None), (None, 1), (7, 0)], "doc_id bigint, toxic int")
    for model in (toxicity.fit_model(odd, labels), toxicity.fit_model(none, labels), toxicity.fit_model(odd, labels.limit(0)), toxicity.fit_model(odd, labels.where("toxic = 0 and doc_id = 1"))):
        assert all(0 <= r["score"] <= 1 for r in toxicity.score_documents(odd, model).collect())
    assert toxicity.score_documents(none, model).count() == 0


def test_scores_do_not_depend_on_the_batch():
    texts = [f"you are a {w} person {i}" for i, w in enumerate(["nice", "rotten", "kind", "rotten"] * 30)]
    model = toxicity.fit(pa.array(texts), np.array([0, 1, 0, 1] * 30))
    together = model.scores(pa.array(texts))
    apart = np.concatenate([model.scores(pa.array([t])) for t in texts])
    assert np.allclose(together, apart) and together[1] > 0.5 > together[0]


def plain_grams(text):
    text = " " + re.sub(" +", " ", "".join(c if c == "'" or unicodedata.category(c)[0] in "LM" or ord(c) > 0xFFFF else " " for c in (text or "").lower())) + " "
    text = f" {text.strip()} " if text.strip() else "  "
    return {text[i : i + n] for n in toxicity.SIZES for i in range(len(text) - n + 1)}


def test_toxicity_against_a_plain_version():
    """Counts, log-count ratios, the fit and the scores, from sets of strings."""
    rng = random.Random(7)
    words = ["Über", "naïve", "日本語です", "день", "it's", "plain", "scum", "Worthless", "kind", "word", "été", "x", "🙂🙂"]
    texts = [" ".join(rng.choices(words, k=rng.randint(0, 14))) + rng.choice(["", "!", " 12", "\n"]) for _ in range(160)] + [None, ""]
    toxic = np.array([int(t is not None and ("scum" in t or "Worthless" in t)) for t in texts])
    grams = [plain_grams(t) for t in texts]
    n1, n0 = int(toxic.sum()), int((1 - toxic).sum())
    many = [Counter(g for k, gs in enumerate(grams) if toxic[k] == y for g in gs) for y in (0, 1)]
    ratio = {g: np.log((many[1][g] + 1) / (n1 + 2)) - np.log((many[0][g] + 1) / (n0 + 2)) for g in many[1] if many[0][g] + many[1][g] >= toxicity.LEAST_TEXTS}
    code, got = toxicity.features(pa.array(texts), toxic.astype(bool))
    assert dict(zip(code.tolist(), got.tolist(), strict=True)) == pytest.approx({toxicity.code_of(g): r for g, r in ratio.items()})
    names = sorted(ratio, key=toxicity.code_of)
    x = np.array([[ratio[g] * (g in gs) for g in names] for gs in grams])
    w, b = np.zeros(len(names)), np.log((n1 + 1) / (n0 + 1))
    m, v, mb, vb = np.zeros(len(names)), np.zeros(len(names)), 0.0, 0.0
    for t in range(1, 151):
        g = 1 / (1 + np.exp(-(x @ w + b))) - toxic
        gw, gb = x.T @ g + 0.5 * w, g.sum()
        m, v, mb, vb = 0.9 * m + 0.1 * gw, 0.999 * v + 0.001 * gw**2, 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb**2
        step = 0.02 * (1 - 0.5 * t / 150)
        w = w - step * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        b = b - step * (mb / (1 - 0.9**t)) / (np.sqrt(vb / (1 - 0.999**t)) + 1e-8)
    model = toxicity.fit(pa.array(texts), toxic)
    assert np.allclose(model.scores(pa.array(texts)), 1 / (1 + np.exp(-(x @ w + b))))


def test_features_of_one_bucket_are_told_apart():
    codes = np.array([5, 6, 7, 1 << 60], np.uint64)
    model = toxicity.Model(codes, np.array([1.0, 2.0, 3.0, 4.0]), 0.0)
    assert model.deep == 3 and model.first[1] == 3
    text = "abcdefgh"
    own = toxicity.Model(np.sort(np.array([toxicity.code_of("abcd"), toxicity.code_of("cdef"), toxicity.code_of("abcd") ^ 1], np.uint64)), np.ones(3), 0.0)
    assert len(own.present(pa.array([text]))[1]) == 2


def test_long_texts_are_fitted_up_to_the_bytes(spark):
    """No text is too long for the sample but one that does not fit in what is left of it."""
    rows = [(i, ("scum " if i % 2 else "kind ") * (30_000 if i < 4 else 5) + f"{i}") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id bigint, toxic int")
    seen = []
    whole = toxicity.fit
    try:
        toxicity.fit = lambda texts, toxic: seen.append([len(t) for t in texts.to_pylist()]) or whole(texts, toxic)
        toxicity.fit_model(docs, labels)
        toxicity.fit_model(docs, labels, most_bytes=200_000)
    finally:
        toxicity.fit = whole
    assert len(seen[0]) == 60 and len(seen[1]) == 57 and sum(seen[1]) <= 200_000


# 8 ---------------------------------------------------------------------------------------------------------------


def test_token_files_round_trip(spark, odd, none, tmp_path):
    path = public_tokenizers.path("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").unionByName(odd.select("doc_id", "text"))
    rows = sorted(((r["doc_id"] is not None, r["doc_id"] or 0, r["text"] or "") for r in docs.collect()))
    files = token_files.write_token_files(docs, path, f"file://{tmp_path}/t", queries.WORD_IDS, files=3)
    got = sorted(token_files.read_token_files(files, lambda ids: (ids.tolist(),), "ids array<bigint>").collect(), key=lambda r: r["start"])
    at = 0
    assert len(got) == len(rows)
    for r, (_, i, _) in zip(got, rows, strict=True):
        assert r["start"] == at and (r["doc_id"] or 0) == i and r["n_tokens"] == len(r["ids"])
        at += r["n_tokens"]
    want = Counter((i if some else None, tuple([*tok.encode(t, add_special_tokens=False).ids, 1])) for some, i, t in rows)
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in got) == want
    first = files.orderBy("part").first()["path"]
    reader = token_files.Reader(first)
    some = list(reader.documents())
    assert all((reader.document(k) == ids).all() for k, ids in enumerate(some))
    empty = token_files.write_token_files(none, path, f"file://{tmp_path}/e", queries.WORD_IDS)
    assert token_files.read_token_files(empty, lambda ids: (0,), "z bigint").count() == 0


def test_words_are_cut_as_the_library_cuts_them():
    path = public_tokenizers.path("word_bpe_49k.json")
    tok, own, rng = Tokenizer.from_file(path), token_files.WordCoder(path, 1), random.Random(3)
    parts = ["ab", "Über", "ß", "ÿ", "×", "÷", "it's", "'S", "'", "12", "٣", ".", "...", "!?", "é", "e\u0301", "J\u030c", "İ", "Σ", "ΑΣ", "日本", "🙂", "<|endoftext|>", "<", "|", "\x1c", "\x00", "\xa0", "\u2003", "\x85", " ", "  ", "\n", "\t", "\u200b", "A", "Z", "\x7f", "ª", "µ", "ſ", "K"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 12))) for _ in range(6000)]
    ids, ends = own.encode(pa.array([*texts, None]))
    got = np.split(ids, ends[:-1])
    for t, g in zip([*texts, ""], got, strict=True):
        assert g.tolist() == [*tok.encode(t, add_special_tokens=False).ids, 1], repr(t)


def test_token_file_query(spark):
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = sorted((r["doc_id"], r["text"] or "") for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect())
    want, at = [], 0
    for i, t in rows:
        ids = np.array([*tok.encode(t, add_special_tokens=False).ids, 1], "<u4")
        want.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert sorted(map(tuple, queries.op8_token_files(spark, SMALL).collect())) == want


@pytest.mark.parametrize("width", [1, 3, 8, 11, 16, 17, 31, 32])
def test_bit_packing(width, tmp_path):
    ids = np.random.default_rng(width).integers(0, 1 << width, 200_001).astype(np.uint32)
    assert (token_files.unpack(token_files.pack(ids, width), width, len(ids)) == ids).all()
    w = token_files.Writer(f"file://{tmp_path}/x.bin", width)
    w.add(pa.array([1, None, 3], pa.int64()), ids, np.array([0, 150_000, len(ids)]))
    w.close()
    r = token_files.Reader(f"file://{tmp_path}/x.bin")
    assert r.ids.to_pylist() == [1, None, 3] and (np.concatenate(list(r.documents())) == ids).all()
    assert (r.tokens(65_530, 140_000) == ids[65_530:140_000]).all()
    assert token_files.width_of(49_408) == 16 and token_files.width_of(2) == 1


# 9 ---------------------------------------------------------------------------------------------------------------


def test_byte_bpe_as_tiktoken(spark, odd, none):
    ranks, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    own = byte_bpe.model(ranks, pattern)
    want = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=own.ranks, special_tokens={})
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").unionByName(odd.select("doc_id", "text"))
    got = byte_bpe.round_trip(docs, ranks, pattern).collect()
    expect = Counter()
    for r in docs.collect():
        ids = np.array(want.encode_ordinary(r["text"] or ""), "<u4").tobytes()
        expect[r["doc_id"], len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256((r["text"] or "").encode()).hexdigest()] += 1
    assert Counter(tuple(r) for r in got) == expect
    coded = byte_bpe.encode_documents(odd, ranks, pattern)
    assert Counter(r["text"] for r in byte_bpe.decode_documents(coded, ranks, pattern).collect()) == Counter(t or "" for _, t, _ in ODD)
    assert byte_bpe.round_trip(none, ranks, pattern).count() == 0
    ids = {r["doc_id"]: tuple(r)[1:] for r in queries.op9_byte_bpe(spark, SMALL).collect()}
    for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect():
        raw = np.array(want.encode_ordinary(r["text"]), "<u4").tobytes()
        assert ids[r["doc_id"]] == (len(raw) // 4, hashlib.sha256(raw).hexdigest(), hashlib.sha256(r["text"].encode()).hexdigest())
    clash = odd.withColumn("whole_text", F.lit(2))
    assert byte_bpe.round_trip(clash, ranks, pattern, keep=("doc_id", "whole_text")).count() == len(ODD)
    rng = random.Random(8)
    for _ in range(300):
        t = "".join(rng.choices(" \n\t\xa0 　\x1c\x85ab'sté1,.日🙂", k=rng.randint(0, 25)))
        assert own.encode(pa.array([t]))[0] == np.array(want.encode_ordinary(t), "<u4").tobytes(), repr(t)


# 10 --------------------------------------------------------------------------------------------------------------


def plain_targets(sizes, weights, most=3):
    """Dealt by weight; what is over is dealt anew among the others until no source is above."""
    left, budget, out = set(sizes), sum(sizes.values()), {}
    while left:
        total = sum(weights[s] for s in left)
        above = {s for s in left if budget * weights[s] / total > most * sizes[s]}
        if not above:
            return out | {s: budget * weights[s] / total for s in left}
        out |= {s: most * sizes[s] for s in above}
        budget -= sum(out[s] for s in above)
        left -= above
    return out


def test_targets(spark):
    rng = random.Random(4)
    for sizes in ({"a": 100, "b": 100, "c": 100}, {"a": 10, "b": 990, None: 3}, {"a": 0, None: 0}, {"a": 5}, {f"s{k}": int(10 ** rng.uniform(0, 5)) for k in range(40)}):
        weights = {s: k % 3 + 1.0 for k, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
        rows = spark.createDataFrame([(s, n, weights[s]) for s, n in sizes.items()], "source string, source_size bigint, weight double")
        assert {r["source"]: r["target"] for r in mixing.targets(rows).collect()} == pytest.approx(plain_targets(sizes, weights))
    assert mixing.targets(rows.limit(0)).count() == 0


def plain_mix(rows, keys, quality):
    """Times that each row is taken: whole epochs, then by key until the rest is used up."""
    size = [len((t or "").split()) for _, t, _ in rows]
    total = Counter()
    for n, (_, _, s) in zip(size, rows, strict=True):
        total[s] += n
    order = sorted(total, key=lambda s: (s is None, s or ""))
    target = plain_targets(dict(total), {s: k % 3 + 1.0 for k, s in enumerate(order)})
    out = []
    for s in order:
        mine = sorted((-np.log(keys[i][0]) / quality.get(rows[i][0], 1.0), keys[i][1], size[i], i) for i in range(len(rows)) if rows[i][2] == s)
        epochs = int(target[s] // total[s]) if total[s] else 0
        rest, done = target[s] - epochs * total[s], 0
        for _, _, n, i in mine:
            out.append((rows[i][0], n, total[s], n * min(3, epochs + (done < rest and done + n / 2 <= rest))))
            done += n
    return out, target


def test_mix_against_a_plain_version(spark, odd, none, tmp_path):
    rng = random.Random(3)
    rows = [(i, " ".join(["w"] * rng.randint(0, 40)) + f" {i}", rng.choice(["s1"] * 9 + ["s2", "Ω", "s10", None])) for i in range(3000)] + [(3001, None, "s1"), (3002, "", "solo")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    df.write.parquet(str(tmp_path / "documents.parquet"))
    labels = [(i, rng.choice([0, 1, None])) for i in range(0, 3000, 3)] + [(None, 1)]
    spark.createDataFrame(labels, "doc_id bigint, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    got = queries.op10_mixing(spark, str(tmp_path)).collect()
    drawn = {r["doc_id"]: (r["u"], r["tie"]) for r in df.select("doc_id", ((F.pmod(F.xxhash64(F.lit(7), "source", "doc_id", "text"), F.lit((1 << 40) - 1)) + 0.5) / float((1 << 40) - 1)).alias("u"), F.xxhash64(F.lit(8), "source", "doc_id", "text").alias("tie")).collect()}
    want, target = plain_mix(rows, [drawn[i] for i, _, _ in rows], {i: {1: 2.0, 0: 0.5, None: 1.0}[q] for i, q in labels if i is not None})
    assert Counter((r["doc_id"], r["size"], r["source_size"], r["taken"]) for r in got) == Counter(want)
    source = {i: s for i, _, s in rows}
    taken = Counter()
    for r in got:
        assert r["target"] == pytest.approx(target[source[r["doc_id"]]]) and r["taken"] <= 3 * r["size"]
        taken[source[r["doc_id"]]] += r["taken"]
    assert all(abs(taken[s] - target[s]) <= 41 for s in target)
    again = mixing.mix(df.repartition(7), quality=queries.quality_of(spark.createDataFrame(labels, "doc_id bigint, quality int")))
    assert Counter((r["doc_id"], r["taken"]) for r in again.collect()) == Counter((r["doc_id"], r["taken"]) for r in got)
    assert mixing.mix(odd).count() == len(ODD) and mixing.mix(none).count() == 0
    clash = odd.select("doc_id", "text", "source", *(F.lit(1).alias(c) for c in ("kept", "s", "cell", "q", "u", "draw", "end", "rest", "more")))
    out = mixing.mix(clash, keep=("doc_id", "kept", "s", "cell", "q", "u", "draw", "end", "rest", "more"))
    assert out.count() == len(ODD) and out.columns[1:4] == ["kept", "s", "cell"]


def test_better_documents_are_taken_more_often(spark):
    df = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("a b c").alias("text"), (F.col("id") % 2).cast("string").alias("source"))
    quality = df.select("doc_id", F.when(F.col("doc_id") % 4 < 2, 4.0).otherwise(1.0).alias("quality"))
    got = mixing.mix(df, lambda place: place * 2 + 1, quality=quality)
    counts = {r["good"]: r["n"] for r in got.where("times = 1 and doc_id % 2 = 0").groupBy((F.col("doc_id") % 4 < 2).alias("good")).agg(F.count("*").alias("n")).collect()}
    assert counts[True] > 2 * counts[False]


def test_no_cell_holds_much_of_a_source(spark):
    """Whatever the weights: also where all are small, and keys are large."""
    rows = spark.range(40_000).select((-F.log(F.pmod(F.xxhash64("id"), F.lit(1 << 40)) / float(1 << 40)) / F.lit(0.001)).alias("draw"))
    most = rows.groupBy(F.floor(F.log2("draw") * mixing.CELLS)).count().agg(F.max("count")).first()[0]
    assert most < 0.003 * 40_000


# the pipeline ----------------------------------------------------------------------------------------------------


def plain_near_docs(rows):
    """Least ids of the groups, by the Jaccard similarity of all pairs."""
    words = [tuple((t or "").encode().lower().split()) for _, t in rows]
    sets = [{w[i : i + 5] for i in range(max(1, len(w) - 4))} for w in words]
    links = [(a, b) for a in range(len(rows)) for b in range(a) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    group = union_find(links, range(len(rows)))
    return sorted(min(rows[m][0] for m in group if group[m] == g) for g in set(group.values()))


def test_pipeline_stages_against_plain_versions(spark, tmp_path):
    import corpus_pipeline

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    toxic = docs.limit(1).withColumn("doc_id", F.lit(9999).cast("bigint"))
    docs.unionByName(toxic).write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    stage = dict(corpus_pipeline.STAGES)
    assert list(stage) == ["toxicity", "line dedup", "SimHash near-dedup", "mixing", "byte-level BPE"]
    d = spark.read.parquet(str(tmp_path / "documents.parquet"))
    one = stage["toxicity"](spark, d, str(tmp_path))
    rows = {(r["doc_id"], r["text"]) for r in one.collect()}
    scored = {r["doc_id"]: r["predicted"] for r in queries.op7_toxicity(spark, str(tmp_path)).collect()}
    assert rows == {(r["doc_id"], r["text"]) for r in d.collect() if not scored[r["doc_id"]]} and one.columns == d.columns
    two = stage["line dedup"](spark, d, str(tmp_path))
    plain = plain_line_dedup([(r["doc_id"], r["text"]) for r in d.collect()])
    assert Counter((r["doc_id"], r["text"]) for r in two.collect()) == plain
    digests = Counter((r["doc_id"], r["left_sha256"], r["n_chars_left"]) for r in queries.op3_line_dedup(spark, str(tmp_path)).collect())
    assert digests == Counter({(i, hashlib.sha256(t.encode()).hexdigest(), len(t)): n for (i, t), n in plain.items()})
    assert two.columns == d.columns and two.where("n_chars <> length(text)").count() == 0
    three = stage["SimHash near-dedup"](spark, d, str(tmp_path))
    assert sorted(r["doc_id"] for r in three.collect()) == plain_near_docs([(r["doc_id"], r["text"]) for r in d.collect()]) and three.columns == d.columns
    four = stage["mixing"](spark, d, str(tmp_path))
    taken = {r["doc_id"]: r["taken"] for r in queries.op10_mixing(spark, str(tmp_path)).collect()}
    assert four.columns == d.columns and abs(sum(len(r["text"].split()) for r in four.collect()) - sum(taken.values())) < 0.1 * sum(taken.values())
    assert corpus_pipeline.run(spark, str(tmp_path)).columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_every_operator_has_its_query():
    assert [q.split("_")[0] for q in queries.QUERIES][:13] == [f"op{n}" for n in range(1, 14)]


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_same_as_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    got = queries.QUERIES[name](spark, SMALL)
    want = con.execute(queries.ORACLE_SQL[name])
    names = [d[0] for d in want.description]
    plain = lambda r: tuple(round(v, 6) if isinstance(v, float) else v for v in r)
    assert sorted(got.columns) == sorted(names)
    assert Counter(map(plain, got.select(*names).collect())) == Counter(map(plain, want.fetchall()))
