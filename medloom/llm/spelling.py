"""Spelling variants: a distance-one Levenshtein automaton for each word, walked through compact trie shards."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medloom.llm.shared import drop_stored, fresh, store, text_batches
from medloom.llm.textcols import LOWER, column, slices, starts, units, utf8

#: Words of a trie shard, and words of a block that walks through the shards together, about.
SHARD, BLOCK = 262_144, 1_048_576
#: Words whose automata run at once.
TOGETHER = 8_192
#: Distinct words that a task counts before it hands their counts on.
COUNTED = 300_000
#: Letters: a to z, then U+00C0 to U+00FF, numbered in the order of code points; one more number ends a word.
LETTERS, END = 90, 127
_CODE = np.full(256, END, np.uint8)
_CODE[0x61:0x7B] = np.arange(26)
_CODE[0xC0:] = np.arange(26, LETTERS)
_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B), 0xC3]] = True
_ONE = np.uint64(1)


def runs(texts: pa.Array) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """Maximal runs of letters of every text, only A-Z lower-cased: the number in the dictionary of each, the dictionary
    (UTF-8), and each text's first run."""
    data, offsets = utf8(texts)
    letter = _LETTER[data]
    letter[1:] |= data[:-1] == 0xC3
    before = np.concatenate([[0], np.cumsum(letter)])
    return units(LOWER[data[letter]], before[offsets], before[starts(letter, offsets)])


def counted(docs: DataFrame, id_col: str, text: str, shortest: int, every: int) -> DataFrame:
    """word and n of all texts.  Where ``every`` divides h, the CRC-32 of ``<id>:<run>``, the run's code point h modulo
    its length is deleted before words are counted; a null id is written as nothing, a null text has no runs."""
    text_batches(docs.sparkSession)
    name, key = fresh(docs, "whole_text"), fresh(docs, "id_as_text")
    source = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias(key), F.col(text).cast("string").alias(name))

    def run(batches):
        found: dict[bytes, int] = {}
        for batch in batches:
            for piece in slices(batch, name, 2 << 20):
                which, words, per_row = runs(column(piece, name))
                if not words:
                    continue
                length = np.fromiter((len(w) - w.count(b"\xc3") for w in words), np.int64, len(words))
                long = length[which] >= shortest
                row = np.repeat(np.arange(len(per_row) - 1), np.diff(per_row))[long]
                pair, times = np.unique(row * len(words) + which[long], return_counts=True)
                row, which = pair // len(words), pair % len(words)
                first = [zlib.crc32(f"{i}:".encode()) for i in column(piece, key).to_pylist()]
                h = np.fromiter((zlib.crc32(words[w], first[r]) for r, w in zip(row.tolist(), which.tolist(), strict=True)), np.int64, len(row))
                cut = h % every == 0
                total = np.bincount(which[~cut], times[~cut], minlength=len(words)).astype(np.int64)
                for w in np.flatnonzero(total).tolist():
                    found[words[w]] = found.get(words[w], 0) + int(total[w])
                for w, x, n in zip(which[cut].tolist(), h[cut].tolist(), times[cut].tolist(), strict=True):
                    if length[w] > shortest:
                        plain = words[w].decode()
                        at = x % len(plain)
                        left = (plain[:at] + plain[at + 1 :]).encode()
                        found[left] = found.get(left, 0) + n
                if len(found) > COUNTED:
                    yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], names=["word", "n"])
                    found = {}
        yield pa.RecordBatch.from_arrays([pa.array([w.decode() for w in found], pa.string()), pa.array(list(found.values()), pa.int64())], names=["word", "n"])

    return source.mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


class Words:
    """Words as letter numbers, one after the other, each behind its end mark."""

    def __init__(self, codes: np.ndarray, begin: np.ndarray, n: np.ndarray):
        self.codes, self.begin, self.n = codes, begin, n
        self.size = np.diff(begin) - 1

    @classmethod
    def of(cls, words: pa.Array, n: np.ndarray) -> Words:
        data, offsets = utf8(words)
        point = data != 0xC3
        # a letter beyond ASCII is the byte behind 0xC3, and 0x40 more
        wide = np.zeros(len(data), bool)
        wide[1:] = ~point[:-1]
        codes = _CODE[np.where(wide, data + 0x40, data)][point]
        begin = np.concatenate([[0], np.cumsum(point)])[offsets]
        return cls(np.insert(codes, begin[1:], END).astype(np.uint8), begin + np.arange(len(begin)), n)

    def text(self, which: np.ndarray) -> pa.Array:
        points = np.concatenate([np.arange(0x61, 0x7B), np.arange(0xC0, 0x100)])
        return pa.array(["".join(map(chr, points[self.codes[self.begin[w] : self.begin[w + 1] - 1]])) for w in which.tolist()], pa.string())


class Trie:
    """A trie of words in ascending order whose branches of one word end where no other word shares them: the rest of
    that word is compared, not walked.  Nodes lie level by level, the children of a node together and in order."""

    def __init__(self, words: Words):
        self.words = words
        count = len(words.n)
        size, begin, codes = words.size, words.begin, words.codes
        shared = np.zeros(count + 1, np.int64)
        for at in range(1, count, 1 << 14):
            i = np.arange(at, min(count, at + (1 << 14)))
            shared[i] = common(codes, begin[i - 1], np.minimum(size[i - 1], size[i]), codes, begin[i])
        depth = np.minimum(size, np.maximum(shared[:-1], shared[1:]) + 1)
        # word j brings the nodes of depths behind what it shares with the word before it
        new = depth - shared[:-1]
        owner = np.repeat(np.arange(count), new)
        level = np.repeat(shared[:-1] + 1 - (np.cumsum(new) - new), new) + np.arange(new.sum())
        order = np.argsort(level, kind="stable")
        owner, level = owner[order], level[order]
        self.label = np.concatenate([[END], codes[begin[owner] + level - 1]]).astype(np.uint8)
        self.depth = np.concatenate([[0], level])
        # a node's parent: one level up, what the nearest word up to the owner brought
        number = np.arange(1, len(owner) + 1)
        place = level * (count + 1) + owner
        parent = np.zeros(len(owner) + 1, np.int64)
        parent[1:] = np.where(level > 1, np.searchsorted(place, place - (count + 1), "right"), 0)
        self.first = np.searchsorted(parent[1:], np.arange(len(parent) + 1)) + 1
        self.term = np.full(len(parent), -1, np.int64)
        ends = level == depth[owner]
        self.term[number[ends]] = owner[ends]
        self.has = np.zeros((2, len(parent)), np.uint64)
        bit = self.label[1:].astype(np.uint64)
        for half in (0, 1):
            own = (bit >> np.uint64(6)) == half
            np.bitwise_or.at(self.has[half], parent[1:][own], _ONE << (bit[own] & np.uint64(63)))

    def child(self, node: np.ndarray, code: np.ndarray) -> np.ndarray:
        """The child of each node by a letter, -1 where there is none."""
        code = code.astype(np.uint64)
        high = code >= 64
        mask = np.where(high, self.has[1][node], self.has[0][node])
        bit = _ONE << (code & np.uint64(63))
        before = np.bitwise_count(mask & (bit - _ONE)).astype(np.int64) + np.where(high, np.bitwise_count(self.has[0][node]), 0)
        return np.where((mask & bit) != 0, self.first[node] + before, -1)

    def neighbours(self, block: Words, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of words ``which`` of the block and words of the trie that are one edit apart, each pair once.

        Depth first: at each letter of the unedited path every edit branches off and is followed to its end before the
        path goes on.  Of a run of equal letters only the last is deleted, and a letter is put in only behind equal ones,
        so that no edit has two forms."""
        out_word, out_near = [], []
        codes, tail_codes = block.codes, self.words.codes

        def accept(word, near):
            out_word.append(word)
            out_near.append(near)

        def follow(word, at, node):
            """Edited once: the rest has to be the same."""
            while len(word):
                term, leaf = self.term[node], self.first[node] == self.first[node + 1]
                left = block.begin[word + 1] - 1 - at
                done = (term >= 0) & (leaf | (left == 0))
                if done.any():
                    w, t, a, n = word[done], term[done], at[done], node[done]
                    rest = self.words.begin[t] + self.depth[n]
                    ok = left[done] == self.words.begin[t + 1] - 1 - rest
                    w, t, a, rest, length = w[ok], t[ok], a[ok], rest[ok], left[done][ok]
                    same = common(codes, a, length, tail_codes, rest) == length
                    accept(w[same], t[same])
                go = ~leaf & (left > 0)
                word, at, node = word[go], at[go], node[go]
                down = self.child(node, codes[at])
                on = down >= 0
                word, at, node = word[on], at[on] + 1, down[on]

        word, at, node = which, block.begin[which], np.zeros(len(which), np.int64)
        if len(self.term) == 1:
            return which[:0], which[:0]
        while len(word):
            leaf = self.first[node] == self.first[node + 1]
            if leaf.any():
                w, t = word[leaf], self.term[node[leaf]]
                a, rest = at[leaf], self.words.begin[t] + self.depth[node[leaf]]
                one = one_edit(codes, a, block.begin[w + 1] - 1 - a, tail_codes, rest, self.words.begin[t + 1] - 1 - rest)
                accept(w[one], t[one])
                word, at, node = word[~leaf], at[~leaf], node[~leaf]
            code = codes[at]
            more = code != END
            # a letter deleted
            cut = more & (codes[np.minimum(at + 1, len(codes) - 1)] != code)
            follow(word[cut], at[cut] + 1, node[cut])
            # a letter put in, or in another's place
            many = self.first[node + 1] - self.first[node]
            i = np.repeat(np.arange(len(node)), many)
            kid = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + self.first[node][i]
            other = self.label[kid] != code[i]
            i, kid = i[other], kid[other]
            for step in (0, 1):
                go = i if step == 0 else i[more[i]]
                to = kid if step == 0 else kid[more[i]]
                # only branches that can go on
                following = codes[at[go] + step]
                fits = (following == END) | (self.child(to, following) >= 0) | (self.first[to] == self.first[to + 1])
                follow(word[go[fits]], at[go[fits]] + step, to[fits])
            word, at, node = word[more], at[more], node[more]
            down = self.child(node, codes[at])
            on = down >= 0
            word, at, node = word[on], at[on] + 1, down[on]
        if not out_word:
            return which[:0], which[:0]
        return np.concatenate(out_word), np.concatenate(out_near)


def common(a: np.ndarray, a_at: np.ndarray, length: np.ndarray, b: np.ndarray, b_at: np.ndarray, back: bool = False) -> np.ndarray:
    """How many of ``length`` letters are the same, from the places on (``back``: from their last one to the first)."""
    total = int(length.sum())
    out = length.copy()
    if not total:
        return out
    ends = np.cumsum(length)
    row = np.repeat(np.arange(len(length)), length)
    step = np.arange(total) - np.repeat(ends - length, length)
    differ = a[a_at[row] + step] != b[b_at[row] + step]
    row, step = row[differ], step[differ]
    if back:
        last = np.full(len(length), -1)
        np.maximum.at(last, row, step)
        return length - 1 - last
    np.minimum.at(out, row, step)
    return out


def one_edit(a, a_at, a_size, b, b_at, b_size) -> np.ndarray:
    """Which pairs of letter sequences are exactly one insertion, deletion or replacement apart."""
    out = np.abs(a_size - b_size) <= 1
    i = np.flatnonzero(out)
    a_at, a_size, b_at, b_size = a_at[i], a_size[i], b_at[i], b_size[i]
    shorter = np.minimum(a_size, b_size)
    front = common(a, a_at, shorter, b, b_at)
    behind = common(a, a_at + a_size - shorter, shorter, b, b_at + b_size - shorter, back=True)
    equal = a_size == b_size
    out[i] = np.where(equal, (front < shorter) & (front + behind >= shorter - 1), front + behind >= shorter)
    return out


def _packed(table: pa.Table) -> tuple[bytes, bytes, bytes]:
    words = Words.of(table.column("word").combine_chunks(), table.column("n").to_numpy())
    return words.codes.tobytes(), words.begin.tobytes(), words.n.astype(np.int64).tobytes()


def _words(codes: bytes, begin: bytes, n: bytes) -> Words:
    return Words(np.frombuffer(codes, np.uint8), np.frombuffer(begin, np.int64), np.frombuffer(n, np.int64))


def near_words(words: DataFrame) -> DataFrame:
    """``words`` holds distinct word and n; returns word, n_near (words one edit apart) and best (a struct of -n and word:
    the least is the near word of largest n, ties to the first in code-point order) of words that have any.

    The vocabulary is cut into trie shards by ranges of first letters, ranges that many words share also by hash, and
    dealt to blocks by hash; each shard, of bounded size, is sent to every block, and each word's automaton walks
    through every shard.  What is sent grows with the square of the vocabulary over the size of a shard; most words leave
    a foreign shard at its root."""
    total = words.count()
    if not total:
        return words.select("word", F.lit(0).cast("bigint").alias("n_near"), F.lit(None).cast("struct<less: bigint, form: string>").alias("best"))
    shards, blocks = max(1, -(-total // SHARD)), max(1, -(-total // BLOCK))
    # the first six letters as a number, each by its place among the letters
    point = F.transform(F.split(F.substring("word", 1, 6), ""), lambda c: F.ascii(c).cast("bigint"))
    key = F.aggregate(point, F.lit(0).cast("bigint"), lambda acc, c: acc * 256 + c)
    keyed = words.withColumn("key", key)
    cuts: list[int] = []
    if shards > 1:
        found = keyed.agg(F.percentile_approx("key", [k / shards for k in range(1, shards)], 100_000)).first()[0]
        cuts = sorted(set(found))
    span = F.lit(0)
    if cuts:
        span = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c < F.col("key")))
    ranged = store(keyed.select("word", "n", span.cast("int").alias("span")), "ranged")
    sizes = {r["span"]: -(-r["count"] // (2 * SHARD)) for r in ranged.groupBy("span").count().collect()}
    parts = F.element_at(F.array(*[F.lit(int(sizes.get(k, 1))) for k in range(len(cuts) + 1)]), F.col("span") + 1)

    def shard(key, table):
        codes, begin, n = _packed(table.sort_by([("word", "ascending")]))
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int32()), "part": pa.array([key[1].as_py()], pa.int32()), "t_codes": [codes], "t_begin": [begin], "t_n": [n]})

    def block(key, table):
        codes, begin, n = _packed(table)
        return pa.table({"block": pa.array([key[0].as_py()], pa.int32()), "codes": [codes], "begin": [begin], "n": [n]})

    tries = store(ranged.withColumn("part", F.pmod(F.xxhash64("word"), parts).cast("int")).groupBy("span", "part").applyInArrow(shard, "shard int, part int, t_codes binary, t_begin binary, t_n binary"), "tries")
    dealt = store(ranged.withColumn("block", F.pmod(F.xxhash64("word"), F.lit(blocks)).cast("int")).groupBy("block").applyInArrow(block, "block int, codes binary, begin binary, n binary"), "blocks")
    # a pair of a shard and a block is a key of its own, so that pairs are tasks
    cut = [F.struct(F.lit(k).alias("shard"), F.lit(p).alias("part")) for k, n in sorted(sizes.items()) for p in range(n)]
    sent = dealt.withColumn("pair", F.explode(F.array(*cut))).select("*", "pair.*").drop("pair")
    both = tries.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).join(sent.hint("shuffle_hash"), ["shard", "part", "block"])

    def walk(batches):
        for batch in batches:
            for at in range(len(batch)):
                r = batch.slice(at, 1).to_pylist()[0]
                mine, trie = _words(r["codes"], r["begin"], r["n"]), Trie(_words(r["t_codes"], r["t_begin"], r["t_n"]))
                for low in range(0, len(mine.n), TOGETHER):
                    word, near = trie.neighbours(mine, np.arange(low, min(len(mine.n), low + TOGETHER)))
                    if not len(word):
                        continue
                    n = trie.words.n[near]
                    order = np.lexsort((near, -n, word))
                    word, near, n = word[order], near[order], n[order]
                    own, first, count = np.unique(word, return_index=True, return_counts=True)
                    best = pa.StructArray.from_arrays([pa.array(-n[first]), trie.words.text(near[first])], names=["less", "form"])
                    yield pa.RecordBatch.from_arrays([mine.text(own), pa.array(count), best], names=["word", "n_near", "best"])

    parted = both.mapInArrow(walk, "word string, n_near bigint, best struct<less: bigint, form: string>")
    out = store(parted.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best")), "near")
    drop_stored(ranged, tries, dealt)
    return out


def _follow(forms: DataFrame) -> DataFrame:
    """word and root of words that have a form: each round doubles how far a word has gone.  A form is at least ten
    times as frequent as its word, so paths are short and have no circle."""
    hop = store(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = hop.select(F.col("word").alias("root"), F.col("root").alias("further"))
        after = store(hop.join(onward, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        moved = not after.where("moved").isEmpty()
        drop_stored(hop)
        hop = after.select("word", "root")
        hop._medloom_path = after._medloom_path
        if not moved:
            return hop


def variants(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shortest: int = 7, fewest: int = 2, times: int = 10, every: int = 31) -> DataFrame:
    """word, n, form, form_n, n_near and root of every word of the texts.

    Words are what is left of maximal runs of letters (A to Z, lower-cased, and U+00C0 to U+00FF), a code point deleted
    here and there (see ``counted``), of ``shortest`` code points and ``fewest`` occurrences at least.  form is the near
    word (one code point inserted, deleted or replaced) of largest n, ties in code-point order, if its n is ``times`` the
    word's or more, else null; root is the end of the forms, the word itself where it has none.

    A null text has no words, a null id counts as an empty one, rows that repeat count each time; words of any length
    are walked whole.
    """
    words = store(counted(docs, id_col, text, shortest, every).where(F.col("n") >= fewest), "words")
    near = near_words(words)
    form: Column = F.when(-F.col("best.less") >= times * F.col("n"), F.col("best.form"))
    joined = words.join(near, "word", "left").select("word", "n", form.alias("form"), F.when(form.isNotNull(), -F.col("best.less")).alias("form_n"), F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"))
    table = store(joined, "forms")
    roots = _follow(table.where("form is not null").select("word", "form"))
    out = store(table.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word")), "variants")
    drop_stored(words, near, table, roots)
    return out
