"""Large files read by several tasks: the same rows wherever they are cut."""

import gzip
import random

import pytest
from pyspark.sql import functions as F

from medloom.sources import articles, rdf, split


def pieces(tmp_path, name, text, members):
    """The text as a plain file, or gzipped in so many members, cut anywhere."""
    data = text.encode()
    if not members:
        (tmp_path / name).write_bytes(data)
    else:
        rng = random.Random(len(data) + members)
        cuts = sorted({0, len(data), *(rng.randrange(len(data)) for _ in range(members - 1))})
        (tmp_path / name).write_bytes(b"".join(gzip.compress(data[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)))
    return f"file://{tmp_path}/{name}"


def article(k):
    return f"<PubmedArticle><MedlineCitation><PMID>{k}</PMID><Article><ArticleTitle>On <i>é{k}</i></ArticleTitle><Abstract><AbstractText>{'text ' * (k % 40)}日本</AbstractText></Abstract></Article></MedlineCitation></PubmedArticle>"


@pytest.mark.parametrize("members", [0, 1, 40])
def test_articles_of_one_file_are_read_by_several_tasks(spark, tmp_path, monkeypatch, members):
    text = '<?xml version="1.0"?>\n<PubmedArticleSet>\n' + "\n".join(map(article, range(1, 400))) + "\n</PubmedArticleSet>"
    path = pieces(tmp_path, "a.xml", text, members)
    size = (tmp_path / "a.xml").stat().st_size
    whole = articles.records(articles.read_split(spark, path, 1 << 30)).select("identifier", "title", F.get("abstract", 0).alias("a"))
    want = [(k, f"On é{k}", "text " * (k % 40) + "日本") for k in range(1, 400)]
    assert sorted(map(tuple, whole.collect())) == want
    for cut in (size // 7, 1000, 997):
        got = split.records(spark, path, r"<PubmedArticle[\s>]", "</PubmedArticle>", split=cut)
        assert got.rdd.getNumPartitions() == -(-size // cut)
        tasks = got.groupBy(F.spark_partition_id()).count().count()
        assert tasks == 1 if members == 1 else tasks > 5
        assert sorted(map(tuple, articles.records(articles.read_split(spark, path, cut)).select("identifier", "title", F.get("abstract", 0)).collect())) == want
    if not members:
        assert sorted(map(tuple, articles.records(articles.read(spark, path)).select("identifier", "title", F.get("abstract", 0)).collect())) == want


def trix(prefix=""):
    rng = random.Random(5)
    out, rows = [f'<{prefix}TriX xmlns="http://www.w3.org/2004/03/trix/trix-1/">'], []
    for g in range(12):
        uri = f"http://g/{g}?a=1&amp;b" if g % 3 else ""
        out.append(f"<{prefix}graph>" + (f"\n <{prefix}uri>{uri}</{prefix}uri>" if uri else ""))
        for t in range(rng.randrange(0, 90)):
            lit = t % 3 == 0
            out.append(f"<{prefix}triple><{prefix}uri>s{t}</{prefix}uri><{prefix}uri>p</{prefix}uri>" + (f'<{prefix}plainLiteral xml:lang="de">w &lt;{t} graph></{prefix}plainLiteral>' if lit else f"<{prefix}uri>o{t}</{prefix}uri>") + f"</{prefix}triple>")
            rows.append((uri.replace("&amp;", "&"), f"s{t}", "p", None if lit else f"o{t}", f"w <{t} graph>" if lit else None))
        out.append(f"</{prefix}graph>")
    return "\n".join([*out, f"</{prefix}TriX>"]), sorted(rows, key=str)


@pytest.mark.parametrize("members", [0, 25])
@pytest.mark.parametrize("prefix", ["", "t:"])
def test_trix_keeps_its_graphs(spark, tmp_path, monkeypatch, members, prefix):
    text, want = trix(prefix)
    path = pieces(tmp_path, "t.xml", text, members)
    for cut in (1 << 30, 5_000, 700):
        got = rdf.trix(spark, path, cut).select("graph", "s", "p", "o", "lit.value")
        assert sorted(map(tuple, got.collect()), key=str) == want


@pytest.mark.parametrize("chunk", [7, 64, 1000])
def test_marks_on_the_edge_of_what_is_read(tmp_path, monkeypatch, chunk):
    monkeypatch.setattr(split, "CHUNK", chunk)
    monkeypatch.setattr(split, "MARKER", 16)
    rng = random.Random(chunk)
    want = [b"<r>" + bytes(rng.choice(b"ab<>/r") for _ in range(rng.randrange(0, 60))).replace(b"</r>", b"") .replace(b"<r>", b"") + b"</r>" for _ in range(80)]
    want = [w for w in want if w.find(b"</r>") == len(w) - 4]
    data = b"head " + b" \n".join(want) + b"<r>cut off"
    for members in (False, True):
        path = tmp_path / f"x{members}"
        path.write_bytes(b"".join(gzip.compress(data[i : i + 90]) for i in range(0, len(data), 90)) if members else data)
        size = path.stat().st_size
        for step in (size, 211, 64, 33):
            with open(path, "rb") as raw:
                file = type("File", (), {"seek": raw.seek, "read": raw.read, "size": lambda self, n=size: n})()
                got = [r for low in range(0, size, step) for _, r in split.records_of(file, low, min(size, low + step), b"<r>", b"</r>", None)]
            assert got == want


def test_a_chance_mark_is_no_member(tmp_path):
    body = bytes(range(256)) * 3 + split._MEMBER + b"x" * 500 + split._MEMBER
    # stored, not compressed: the marks stand in the file
    import zlib

    packer = zlib.compressobj(0, zlib.DEFLATED, 31)
    data = packer.compress(body) + packer.flush() + gzip.compress(b"second")
    path = tmp_path / "x"
    path.write_bytes(data)
    with open(path, "rb") as raw:
        file = split._Seeking(type("File", (), {"seek": raw.seek, "read": raw.read, "size": lambda self: len(data)})())
        assert split._first_member(file, 1, len(data)) == len(data) - len(gzip.compress(b"second"))
        assert b"".join(p for p, own in split.gzipped(file, 1, len(data))) == b"second"


def test_folders_and_missing_files(spark, tmp_path):
    for k in range(3):
        pieces(tmp_path, f"f{k}.xml", f"<r>{k}</r><r>x{k}</r>", k % 2)
    (tmp_path / "_SUCCESS").write_text("<r>no</r>")
    (tmp_path / "empty").write_text("")
    got = split.records(spark, f"file://{tmp_path}", "<r>", "</r>")
    assert sorted(r["record"] for r in got.collect()) == sorted(f"<r>{x}{k}</r>" for k in range(3) for x in ("", "x"))
    with pytest.raises(Exception, match="nowhere"):
        split.records(spark, f"file://{tmp_path}/nowhere", "<r>", "</r>").collect()
