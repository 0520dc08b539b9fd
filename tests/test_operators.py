"""Operators on literal rows: rules that the generic tables do not exercise."""

import gzip
import io
import tarfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from medloom import schema
from medloom.functions import text as S
from medloom.operators import citations, clusters, graph, nodes, reach, registry, reshape, tasks, triples, vectors
from medloom.sinks import tables
from medloom.sinks.keyed import KeyedTable
from medloom.sources import articles, files, jats, rdf


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_percentiles_of_small_and_large_groups(spark):
    counts = [(1, y, c) for y, n in ((2000, 7), (2001, 100), (2002, 523)) for c in range(n)] + [(1, None, 5)]
    got = {(r["year"], r["percentile"]): r["citationcount"] for r in citations.percentiles(spark.createDataFrame(counts, "identifier int, year int, citationcount int")).collect()}
    for year, n in ((2000, 7), (2001, 100), (2002, 523)):
        ordered = sorted(range(n), reverse=True)
        assert [got[year, p] for p in range(100)] == [ordered[p * (n // 100)] for p in range(100)]
    assert len(got) == 300


def test_upsert_twice_is_once(spark, tmp_path):
    path = str(tmp_path / "t")
    new = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, None, 1)], "k int, v string, n int")
    for _ in range(2):
        tables.keyed(path, ["k"], ["n"])(new)
        assert rows(KeyedTable(spark, path).read()) == [(1, "b", 2), (2, None, 1)]
    tables.keyed(path, ["k"])(spark.createDataFrame([(2, "z", 0), (3, "y", 0)], "k int, v string, n int"))
    assert rows(KeyedTable(spark, path).read()) == [(1, "b", 2), (2, "z", 0), (3, "y", 0)]
    tables.insert_missing(path, ["k"])(spark.createDataFrame([(3, "no", 9), (4, "w", 9)], "k int, v string, n int"))
    assert {r["k"]: r["v"] for r in KeyedTable(spark, path).read().collect()} == {1: "b", 2: "z", 3: "y", 4: "w"}
    tables.replace_keys(path, ["k"])(spark.createDataFrame([(4, "p", 1), (4, "q", 2)], "k int, v string, n int"))
    assert KeyedTable(spark, path).read().where("k = 4").count() == 2 and KeyedTable(spark, path).read().count() == 5


def test_tee_and_counts(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    seen = tables.counted(tables.tee(tables.append(a), tables.mapped(lambda d: d.where("k > 1"), tables.append(b))), "v")(df)
    assert seen["total"] >= 2 and spark.read.parquet(a).count() == 2 and spark.read.parquet(b).count() == 1
    tables.nowhere(df)
    assert tables.copy_checked(df, str(tmp_path / "c"), ["k"]) == (2, 2)
    tables.tab_index(str(tmp_path / "i"))(df)
    assert files.index(spark, str(tmp_path / "i"), "k int, v string").count() == 2
    assert files.index(spark, str(tmp_path / "missing"), "k int, v string").count() == 0


def test_declared_table(spark, tmp_path):
    df = spark.createDataFrame([("x" * 80, 2, "job", "extra"), (None, 1, "job", "")], "name string, state int, job string, other string")
    out = schema.TASKS.project(df)
    assert out.columns == ["name", "state", "job", "timestamp"] and rows(out) == [("x" * 60, 2, "job", None)]
    tables.declared(schema.TASKS, str(tmp_path / "t"))(df)
    assert KeyedTable(spark, str(tmp_path / "t")).read().count() == 1


def test_states(spark):
    assert tasks.STATES == {"Queued": 0, "InProgress": 1, "Completed": 2, "Failed": 3, "Unavailable": 4}
    listing = spark.sql("select * from values ('new', timestamp_ntz'2024-01-02'), ('same', timestamp_ntz'2024-01-01'), ('newer', timestamp_ntz'2024-01-03') t(name, remote)")
    known = spark.sql("select name, cast(state as smallint) state, timestamp from values ('same', 2, timestamp_ntz'2024-01-01'), ('newer', 2, timestamp_ntz'2024-01-01'), ('gone', 3, timestamp_ntz'2024-01-01') t(name, state, timestamp)")
    assert {r["name"]: r["state"] for r in tasks.reconcile(listing, known).collect()} == {"new": 0, "same": 2, "newer": 0, "gone": 3}
    assert tasks.gate(known.limit(0)).first()["passes"] and not tasks.gate(known).first()["passes"]
    assert [r["name"] for r in tasks.needs_work(known, ["Failed", "Queued"], 2, ["name"]).collect()] == ["gone"]


def test_change_stamp_is_null_safe(spark):
    old = spark.createDataFrame([(1, None, "o"), (2, "a", "o"), (3, "x", "o")], "k int, v string, at string")
    new = spark.createDataFrame([(1, None, ""), (2, None, ""), (4, "n", "")], "k int, v string, at string")
    assert rows(tasks.stamped_upsert(old, new, "k", "at", F.lit("now"))) == [(1, None, "o"), (2, None, "now"), (3, "x", "o"), (4, "n", "now")]


def test_last_child_and_missing_children(spark):
    children = spark.createDataFrame([(1, 1, "a"), (1, 2, None), (3, 1, "c")], "k int, n int, v string")
    last = registry.last_value(children, ["k"], ["n"], {"v": F.coalesce("v", F.lit("NA"))})
    driver = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    assert rows(registry.back_to_driver(driver, last, "k")) == [(1, "NA"), (2, None), (3, "c")]


@pytest.mark.parametrize(("given", "want"), [("jan", 0), ("J", None), ("ma", None), ("MAR", 2), ("may", 4), ("December", 11), ("", None), ("x", None), (None, None)])
def test_months(spark, given, want):
    assert one(spark, S.month_number(F.lit(given).cast("string"))) == want


def test_dates(spark):
    d = lambda y, m, day: one(spark, S.publication_date(S.partial_date(F.lit(y).cast("string"), F.lit(m).cast("string"), F.lit(day).cast("string"))))
    assert d("2000", "Jan", None) == "2000-01-01" and d("2000", None, None) == "2000-01-01" and d("1999", "12", "31") == "1999-12-31" and d(None, None, None) is None


def test_addresses_and_names(spark):
    assert one(spark, S.emails(F.lit("Dept. of X, Town (a.b@uni-y.example)."))) == ["a.b@uni-y.example"]
    assert one(spark, S.without_emails(F.lit("Dept. X. Electronic address: a@b.de"))) == "Dept. X."
    assert one(spark, S.emails(F.lit("none a@b here"))) == []
    assert one(spark, S.display_name(F.lit("J K"), F.lit("JK"), F.lit("Doe"))) == "JK Doe"
    assert one(spark, S.display_name(F.lit(None).cast("string"), F.lit("J"), F.lit("Doe"))) == "J Doe"
    assert one(spark, S.storage_path(F.lit("PMC12"), F.lit(2000))) == "data/2000/PM/PMC12"
    assert one(spark, S.bulk_path(F.lit("PMC123"))) == "bulk/PMC000xxxxxx/PMC123.xml"
    assert one(spark, S.doi(F.lit("https://doi.org/10.1000%2Fab"))) == "10.1000/ab" and one(spark, S.doi(F.lit("x"))) is None
    assert one(spark, S.enumeration(F.lit("a, and b; c and d,e"))) == ["a", "b", "c", "d", "e"]
    assert [one(spark, S.suffix(F.lit(n))) for n in ("abcde.xml.gz", "a.md5", "plain", "a.filelist.txt")] == [".xml.gz", ".md5", "tmp", ".txt"]
    assert one(spark, S.ordinal(F.lit("QUEUED"), tasks.STATES)) == 0 and one(spark, S.ordinal(F.lit("no"), tasks.STATES)) is None
    names = {"a": "http://x/", "ab": "http://x/y/"}
    assert one(spark, S.prefix_encode(F.lit("http://x/y/z"), names)) == "ab:z" and one(spark, S.prefix_decode(F.lit("ab:z:q"), names)) == "http://x/y/z:q"


def test_products_and_windows(spark):
    df = spark.createDataFrame([(1, ["a", "b"], ["x"]), (2, ["a"], []), (3, None, ["x"])], "k int, p array<string>, q array<string>")
    assert rows(reshape.explode_product(df, ["p", "q"])) == [(1, "a", "x"), (1, "b", "x"), (2, None, None), (3, None, None)]
    w = one(spark, reshape.word_windows(F.lit(" a b c d e f g "), 4, 1))
    assert [(x["position"], x["chunk"]) for x in w] == [(0, "a b c d"), (1, "d e f g")]
    assert one(spark, reshape.word_windows(F.lit(""), 4, 1)) == []
    assert [x["chunk"] for x in one(spark, reshape.word_windows(F.lit("a b"), 4, 1))] == ["a b"]


def test_graph_rules(spark):
    df = graph.stringify(spark.createDataFrame([(1, "Aa", None), (2, "aA", "x"), (None, "z", "z")], "k int, p string, q string"))
    v, e = graph.attribute_graph(df, "k", "root", ["p", "q"], suffix="_c")
    assert rows(v) == [("p", "aa", "Aa"), ("q", "x", "x"), ("root", "1_c", "1_c"), ("root", "2_c", "2_c")]
    assert rows(e) == [("has_parent", "aa", "1_c"), ("has_parent", "aa", "2_c"), ("has_parent", "x", "2_c")]
    with pytest.raises(ValueError, match="unknown key"):
        graph.lookup(df, {"key": "k"}, "other", "1", "p")
    labels = spark.createDataFrame([(1,), (2,), (None,)], "v int").select(graph.value_map("v", {None: "n", 1: "one"}).alias("l"))
    assert [r["l"] for r in labels.collect()] == ["one", None, "n"]


def test_closure_ends_in_cycles(spark):
    t = spark.createDataFrame([(None, a, "up", b, None) for a, b in (("a", "b"), ("b", "c"), ("c", "a"), ("c", "d"))] + [(None, "a", "name", None, "A")], "uri string, s string, p string, o string, lit string")
    starts = spark.createDataFrame([("a",), ("d",), ("q",)], "start string")
    got = rows(reach.closure(t, ["up"], starts))
    assert got == [("a", "a"), ("a", "b"), ("a", "c"), ("a", "d"), ("d", "d"), ("q", "q")]
    pairs = spark.createDataFrame([("a", "d"), ("d", "a"), ("q", "q")], "source string, target string")
    assert rows(reach.is_related(t, ["up"], pairs)) == [("a", "d", True), ("d", "a", False), ("q", "q", True)]
    named = t.limit(1).withColumn("uri", F.lit("n"))
    assert triples.assert_triples(named, t.union(t)).count() == 5


def test_sequences_are_numeric(spark):
    df = spark.createDataFrame([("l", [str(i) for i in range(12)])], "s string, items array<string>")
    m = triples.members(triples.sequence_triples(df, "s", "items"), "list")
    assert [r["member"] for r in m.orderBy("position").collect()] == [str(i) for i in range(12)]


def test_block_join_of_queries(spark, monkeypatch):
    monkeypatch.setattr(vectors, "FEW", 3)
    v = spark.createDataFrame([(i, np.random.default_rng(i).normal(size=8).tolist()) for i in range(30)], "id bigint, v array<double>")
    q = v.where("id % 3 = 0").select(F.col("id").alias("query_id"), F.col("v").alias("q"))
    small = rows(vectors.cosine_topk(q, v, 4))
    monkeypatch.setattr(vectors, "FEW", 100)
    assert small == rows(vectors.cosine_topk(q, v, 4)) and all(r[2] == 1.0 for r in small if r[0] == r[1])


def test_soft_clusters_find_what_is_apart():
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(size=(40, 12)) * 0.05 + c for c in (np.zeros(12), np.ones(12))])
    found = clusters.clusters(x, np.full(80, 10))
    assert all(len({int(i >= 40) for i in f}) == 1 for f in found) and set(np.concatenate(found)) == set(range(80))
    assert [f.tolist() for f in clusters.clusters(x[:5], np.full(5, 10))] == [[0, 1, 2, 3, 4]]
    again = clusters.clusters(x, np.full(80, 1000), most_tokens=5000)
    assert set(np.concatenate(again)) == set(range(80))


def test_result_codes(spark):
    t, n, f = F.lit(True), F.lit(None).cast("string"), F.lit("x")
    code = lambda *a: one(spark, nodes.result_code(*a))
    assert [code(F.lit(False), f, f, F.lit(1), t, t), code(t, n, f, F.lit(1), t, t), code(t, f, n, F.lit(1), t, t), code(t, f, f, F.lit(0), t, t), code(t, f, f, F.lit(1), F.lit(False), t), code(t, f, f, F.lit(1), t, F.lit(False)), code(t, f, f, F.lit(1), t, t)] == [-4, -3, -2, -5, -6, -1, 1]


ARTICLE = """<Set><PubmedArticle><MedlineCitation><PMID>7</PMID><DateCompleted><Year>1999</Year></DateCompleted><Article><ArticleTitle>A <i>bold <b>x</b></i> &amp; end</ArticleTitle>
<Abstract><AbstractText>One <sub>2</sub>.</AbstractText><AbstractText>Two</AbstractText></Abstract><AuthorList><Author><LastName>Doe</LastName><ForeName>Jane</ForeName><Initials>J</Initials>
<AffiliationInfo><Affiliation>Uni, Town. j@uni.example</Affiliation></AffiliationInfo><AffiliationInfo><Affiliation>Second</Affiliation></AffiliationInfo></Author><Author><LastName>Solo</LastName></Author></AuthorList></Article>
<MeshHeadingList><MeshHeading><DescriptorName UI="D1" MajorTopicYN="Y">Head</DescriptorName></MeshHeading></MeshHeadingList></MedlineCitation>
<PubmedData><ArticleIdList><ArticleId IdType="pubmed">7</ArticleId><ArticleId IdType="doi">10.1/x</ArticleId></ArticleIdList>
<ReferenceList><Reference><Citation>C1</Citation><ArticleIdList><ArticleId IdType="pubmed">1</ArticleId><ArticleId IdType="pubmed">2</ArticleId></ArticleIdList></Reference><Reference><Citation>C2</Citation></Reference></ReferenceList></PubmedData></PubmedArticle></Set>"""


def test_article_xml(spark, tmp_path):
    with gzip.open(tmp_path / "a.xml.gz", "wt") as f:
        f.write(ARTICLE)
    r = articles.records(articles.read(spark, str(tmp_path / "a.xml.gz")))
    x = r.first()
    assert (x["identifier"], x["title"], x["abstract"], x["published"], x["year"]) == (7, "A bold x & end", ["One 2.", "Two"], "1999-01-01", 1999)
    assert x["headings"][0]["major"] and [(y["citation"], y["ids"]) for y in x["references"]] == [("C1", {"pubmed": "2"}), ("C2", {})]
    a = articles.authorships(r).orderBy("ordinal", "affiliation").collect()
    assert [(y["ordinal"], y["affiliation"], y["email_address"]) for y in a] == [(0, "Second", "j@uni.example"), (0, "Uni, Town.", "j@uni.example"), (1, None, None)]
    assert articles.valid(r).count() == 1 and articles.in_years(r, 2000).count() == 0 and '"title":"A bold x & end"' in articles.to_json(r).first()["record"]


def test_file_lists_and_archives(spark, tmp_path):
    lines = ["File\tCitation\tAccession\tLast Updated\tPMID\tLicense\tRetracted", 'a.tar.gz\t"J. X\t1"\tPMC1\t2020-01-02 03:04:05\t11\tCC BY\tno', "b\tc\tPMC2\t2020-01-02 03:04:05\tx1\tCC0\tno", "short\tline", "c\td\tPMC3\t2020-01-02 03:04:05\t12\tCC0\tno"]
    (tmp_path / "list.filelist.txt").write_text("\n".join(lines))
    good, bad = files.file_list(spark, str(tmp_path / "list.filelist.txt"))
    assert [(r["container"], r["pmc_id"], r["pmid"]) for r in good.orderBy("pmid").collect()] == [("list.filelist", "PMC1", 11), ("list.filelist", "PMC3", 12)] and bad.count() == 2
    with tarfile.open(tmp_path / "x.tar.gz", "w:gz") as t:
        for name in ("d/a.txt", "d/b.nxml", "d/c.xml"):
            body = name.encode()
            info = tarfile.TarInfo(name)
            info.size = len(body)
            t.addfile(info, io.BytesIO(body))
    assert [r["name"] for r in files.archive_entries(spark, str(tmp_path / "x.tar.gz"), "xml", first=True).collect()] == ["d/b.nxml"]
    assert files.archive_entries(spark, str(tmp_path / "x.tar.gz")).count() == 3
    found = files.listing(spark, str(tmp_path), only=[".tar.gz", ".txt"])
    assert sorted(r["name"] for r in found.collect()) == ["list.filelist.txt", "x.tar.gz"] and files.newest(found, "tar").first()["name"] == "x.tar.gz"
    with pytest.raises(ValueError, match="no reader"):
        files.reader("nothing")
    assert files.reader("turtle") is rdf.turtle


TURTLE = '''@prefix ex: <http://e/> . # note
ex:a a ex:T ; ex:p "q\\"u"@en , "5"^^ex:int ; ex:l """two
"lines" """ .
<urn:triple:1:2:3> ex:p ex:b .
ex:g { ex:c ex:p ex:d . }'''


def test_rdf_readers(spark, tmp_path):
    (tmp_path / "a.trig").write_text(TURTLE)
    got = {(r["graph"], r["s"], r["p"].rpartition("/")[2], r["o"], r["lit"]["value"] if r["lit"] else None) for r in rdf.turtle(spark, str(tmp_path / "a.trig")).collect()}
    assert got == {("", "http://e/a", "22-rdf-syntax-ns#type", "http://e/T", None), ("", "http://e/a", "p", None, 'q"u'), ("", "http://e/a", "p", None, "5"), ("", "http://e/a", "l", None, 'two\n"lines" '), ("", "urn:triple:1:2:3", "p", "http://e/b", None), ("http://e/g", "http://e/c", "p", "http://e/d", None)}
    (tmp_path / "b.nt").write_text('# c\n<http://e/a> <http://e/p> <http://e/b> .\n<http://e/a>\t<http://e/q>\t"x \\"y\\""@en .\n<http://e/a> <http://e/r> "true"^^<http://e/bool> .\n')
    nt = {r["p"][-1]: r for r in rdf.ntriples(spark, str(tmp_path / "b.nt")).collect()}
    assert nt["p"]["o"] == "http://e/b" and nt["q"]["lit"].asDict() == {"value": 'x "y"', "lang": "en", "datatype": None} and nt["r"]["lit"]["datatype"] == "http://e/bool" and nt["p"]["lit"] is None
    trix = '<TriX xmlns="http://www.w3.org/2004/03/trix/trix-1/"><graph><uri>http://g</uri><triple><uri>s</uri><uri>p</uri><plainLiteral xml:lang="de">w</plainLiteral></triple></graph></TriX>'
    assert rdf.parse_trix(trix) == [{"graph": "http://g", "uri": None, "s": "s", "p": "p", "o": None, "lit": {"value": "w", "lang": "de", "datatype": None}}]
    (row,) = rdf.parse_jsonld('{"@context": {"e": "http://e/"}, "@id": "e:a", "e:p": {"@value": "v", "@language": "en"}}')
    assert row["s"] == "http://e/a" and row["lit"] == {"value": "v", "lang": "en", "datatype": None}


def test_jats_sections_and_tables():
    doc = jats.parse("""<article><front><article-meta><article-id pub-id-type="pmc">PMC1</article-id><title-group><article-title>T <sup>2</sup></article-title></title-group>
    <contrib-group><contrib contrib-type="author"><name><surname>Doe</surname><given-names>J</given-names></name></contrib></contrib-group><pub-date pub-type="ppub"><year>2019</year></pub-date><pub-date pub-type="epub"><year>2020</year><month>3</month><day>4</day></pub-date>
    <abstract><p>A <inline-formula>x</inline-formula>b</p></abstract></article-meta></front><body><sec><title>S</title><p>one <xref ref-type="bibr">1</xref></p><sec><title>U</title><p>two</p></sec><p>three</p>
    <table-wrap><label>T1</label><caption><p>cap</p></caption><table><thead><tr><th>a</th><th>b</th></tr></thead><tbody><tr><td colspan="2">1</td></tr></tbody></table></table-wrap></sec></body></article>""")
    assert (doc["published"], doc["date_status"], doc["authors"], doc["title"]) == ("2020-03-04", "ok", ["J Doe"], "T 2")
    assert [(c["id"], c["section"], c["text"]) for c in doc["contents"]] == [("1", "Title", "T 2"), ("2.1", "Abstract", "A b"), ("3.1", "S", "one 1"), ("3.2.1", "U", "two"), ("3.3.1", "wrap", "three"), ("3.3.2", "wrap", "T1 cap")]
    assert doc["contents"][-1]["columns"] == ["a", "b"] and doc["contents"][-1]["rows"] == [["1", "1"]]
    assert jats.parse("<broken") is None
