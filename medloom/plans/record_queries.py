"""Article records, file lists, archives, answers of an archive service, and scalar functions over whole tables."""

from __future__ import annotations

import gzip
import io
import tarfile

import pyarrow as pa
from pyspark.sql import functions as F

from medloom.functions import text as S
from medloom.operators import reshape as X
from medloom.operators import tasks as K
from medloom.plans.source_queries import escaped, folder
from medloom.session import table
from medloom.sinks import tables as W
from medloom.sources import articles, files, oai

_CONTROL = r"[\x00-\x08\x0b\x0c\x0e-\x1f]"


def article_text(spark, sf_dir):
    """Titles and abstracts of documents in gzipped article files, as read from them."""
    d = table(spark, sf_dir, "documents").withColumn("text", F.regexp_replace("text", _CONTROL, " "))
    xml = F.concat(F.lit("<PubmedArticle><MedlineCitation><PMID>"), "doc_id", F.lit("</PMID><Article><ArticleTitle>On <i>"), "lang", F.lit("</i> &amp; "), escaped(F.col("source")), F.lit("</ArticleTitle><Abstract><AbstractText>"), escaped(F.col("text")), F.lit("</AbstractText><AbstractText>End.</AbstractText></Abstract></Article></MedlineCitation></PubmedArticle>"))
    path = folder(spark, "articles")

    def pack(key, part):
        whole = "\n".join(["<PubmedArticleSet>", *part.column("x").to_pylist(), "</PubmedArticleSet>"])
        return pa.table({"name": [f"a{key[0].as_py()}.xml.gz"], "content": [gzip.compress(whole.encode())]})

    sets = d.select(F.floor(F.col("doc_id") / 200).alias("g"), xml.alias("x")).groupBy("g").applyInArrow(pack, "name string, content binary")
    W.put_objects(sets, path).write.format("noop").mode("overwrite").save()
    plain = lambda c: F.trim(F.regexp_replace(c, r"[ \t\r\n]+", " "))
    return articles.records(articles.read(spark, path)).select("identifier", plain(F.col("title")).alias("title"), F.md5(plain(F.get("abstract", 0))).alias("first_md5"), F.get("abstract", 1).alias("last"))


def _articles(spark, sf_dir):
    """Orders as articles: two authors, a heading, a journal and two references each."""
    o = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    k = F.col("o_orderkey").cast("string")
    author = lambda last, fore, where: F.concat(F.lit("<Author><LastName>"), last, F.lit("</LastName><ForeName>"), fore, F.lit("</ForeName><Initials>"), F.substring(fore, 1, 1), F.lit("</Initials><AffiliationInfo><Affiliation>"), where, F.lit("</Affiliation></AffiliationInfo></Author>"))
    xml = F.concat(
        F.lit("<PubmedArticle><MedlineCitation><PMID>"), k, F.lit("</PMID><Article><ArticleTitle>T</ArticleTitle><Abstract><AbstractText>A</AbstractText></Abstract><Journal><Title>J of "), "c_mktsegment", F.lit("</Title><ISSN>1-"), k,
        F.lit("</ISSN><JournalIssue><Volume>7</Volume><Issue>2</Issue><PubDate><Year>"), F.year("o_orderdate").cast("string"), F.lit("</Year></PubDate></JournalIssue></Journal><AuthorList>"),
        author(F.col("c_name"), F.lit("Ann"), F.concat(F.lit("Dept "), F.col("c_nationkey").cast("string"), F.lit(" (x"), k, F.lit("@uni.example)."))), author(F.lit("Second"), F.lit("Bo"), F.lit("Hall")),
        F.lit('</AuthorList></Article><MeshHeadingList><MeshHeading><DescriptorName UI="D'), k, F.lit('" MajorTopicYN="Y">'), "o_orderpriority", F.lit('</DescriptorName><QualifierName UI="Q1" MajorTopicYN="N">q</QualifierName></MeshHeading></MeshHeadingList></MedlineCitation>'),
        F.lit("<PubmedData><ReferenceList><Reference><Citation>C"), k, F.lit('</Citation><ArticleIdList><ArticleId IdType="pubmed">1</ArticleId><ArticleId IdType="pubmed">'), k, F.lit("</ArticleId></ArticleIdList></Reference><Reference><Citation>none</Citation></Reference></ReferenceList></PubmedData></PubmedArticle>"),
    )
    return articles.records(articles.parse(o.select(xml.alias("x")), "x"))


def article_authors(spark, sf_dir):
    return articles.authorships(_articles(spark, sf_dir)).select("publication_id", "ordinal", "fore_name", "last_name", "initials", "year_active", "affiliation", "email_address")


def article_parts(spark, sf_dir):
    """Heading, journal and references of each article."""
    r = _articles(spark, sf_dir)
    h, n = F.get("headings", 0), F.get("references", 0)
    return r.select("identifier", h["ui"].alias("ui"), h["name"].alias("heading"), h["major"].alias("major"), F.size(h["qualifiers"]).alias("qualifiers"), F.col("journal.Title").alias("journal"), F.col("journal.ISSN").alias("issn"), F.size("references").alias("n_references"), n["citation"].alias("citation"), n["ids"]["pubmed"].alias("last_id"))


def article_records(spark, sf_dir):
    """Valid records of some years as JSON, decoded again."""
    r = articles.to_json(articles.valid(articles.in_years(_articles(spark, sf_dir), 1996, 1998)))
    kind = "struct<title:string,abstract:array<string>,authors:array<struct<LastName:string>>>"
    x = F.from_json("record", kind)
    return r.select("identifier", "year", x["title"].alias("title"), F.size(x["abstract"]).alias("abstracts"), F.get(x["authors"], 0)["LastName"].alias("first_author"))


def _file_list(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    line = F.concat_ws("\t", F.concat(F.lit("a/"), "o_orderkey"), F.concat(F.lit('"tab\tin '), "o_orderkey", F.lit('"')), F.concat(F.lit("PMC"), "o_custkey"), F.lit("2020-01-01 00:00:00"), F.when(F.col("o_orderkey") % 7 == 1, F.lit("x")).otherwise(F.col("o_orderkey").cast("string")), F.col("o_orderstatus"), F.lit("no"))
    line = F.when(F.col("o_orderkey") % 10 == 0, F.substring_index(line, "\t", 6)).otherwise(line)
    head = spark.range(1).select(F.lit("Article File\tArticle Citation\tAccession ID\tLast Updated\tPMID\tLicense\tRetracted").alias("value"))
    path = folder(spark, "filelist")
    o.select(line.alias("value")).unionByName(head).write.text(path)
    return files.file_list(spark, path)


def filelist_parse(spark, sf_dir):
    """Lists of seven quoted columns as read from files; every tenth line is short, every seventh has no number."""
    return _file_list(spark, sf_dir)[0].select("article_file", "article_citation", "pmc_id", "pmid", "last_update", "license", "retracted")


def filelist_rejects(spark, sf_dir):
    return _file_list(spark, sf_dir)[1].select("value")


def _tars(rows):
    """name and content: a tar archive for each group, of an XML and a text file for each of its rows."""

    def pack(key, part):
        out = io.BytesIO()
        with tarfile.open(fileobj=out, mode="w:gz") as tar:
            for i, text in sorted(zip(part.column("id").to_pylist(), part.column("text").to_pylist(), strict=True)):
                for ending in ("txt", "nxml"):
                    body = f"{ending} {text}".encode()
                    info = tarfile.TarInfo(f"{i}/a.{ending}")
                    info.size = len(body)
                    tar.addfile(info, io.BytesIO(body))
        return pa.table({"name": [f"g{key[0].as_py()}.tar.gz"], "content": [out.getvalue()]})

    return rows.groupBy("g").applyInArrow(pack, "name string, content binary")


def _supplier_archives(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("g"), F.col("s_suppkey").alias("id"), F.col("s_name").alias("text"))
    path = folder(spark, "archives")
    W.put_objects(_tars(s), path).write.format("noop").mode("overwrite").save()
    return path


def archive_scan(spark, sf_dir):
    """XML entries of gzipped archives, a file of each supplier in its nation's archive."""
    e = files.archive_entries(spark, _supplier_archives(spark, sf_dir), "nxml")
    return e.select(F.element_at(F.split("archive", "/"), -1).alias("archive"), "name", F.col("content").cast("string").alias("content"))


def archive_listing(spark, sf_dir):
    """Archives by suffix, and the last of them by name."""
    found = files.listing(spark, _supplier_archives(spark, sf_dir), only=[".tar.gz"])
    last = files.newest(found, "g1").select("name", F.lit(True).alias("newest"))
    return found.join(last, "name", "left").select("name", "suffix", (F.col("length") > 0).alias("some"), F.coalesce("newest", F.lit(False)).alias("newest"))


def _answers(spark, sf_dir):
    s = table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey").cast("string")
    good = F.concat(F.lit('<OA><records returned-count="1"><record id="PMC'), k, F.lit('" citation="'), "s_name", F.lit('" license="CC BY" retracted="no"><link format="pdf" updated="2020" href="ftp://x/a.pdf"/><link format="tgz" updated="2021" href="ftp://x/y/g'), F.col("s_nationkey").cast("string"), F.lit('.tar.gz"/></record></records></OA>'))
    bad = lambda code: F.lit(f'<OA><error code="{code}">no</error></OA>')
    xml = F.when(F.col("s_suppkey") % 5 == 0, bad(oai.NOT_OPEN)).when(F.col("s_suppkey") % 5 == 1, bad("idDoesNotExist")).when(F.col("s_suppkey") % 5 == 2, F.lit("<OA></OA>")).otherwise(good)
    return oai.answers(s.select("s_suppkey", xml.alias("x")), "s_suppkey", "x")


def oai_answers(spark, sf_dir):
    a = _answers(spark, sf_dir)
    return a.select("s_suppkey", "status", F.col("record.id").alias("id"), F.col("record.citation").alias("citation"), F.col("record.license").alias("license"), F.array_join(F.transform("links", lambda x: x["format"]), ",").alias("formats"), S.mapped_state("status", S.RESPONSE_STATES, K.STATES, "Failed").alias("state"))


def full_text_fetch(spark, sf_dir):
    """From the answers by their links to archives, and the first XML file of each."""
    e = files.archive_entries(spark, _supplier_archives(spark, sf_dir))
    return oai.full_texts(_answers(spark, sf_dir), e, "s_suppkey", ending="xml").select("s_suppkey", F.col("content").cast("string").alias("content"))


def tab_index_round(spark, sf_dir):
    """Orders written as a tab separated index and read again."""
    path = folder(spark, "index")
    W.tab_index(path)(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice"))
    return files.index(spark, path, "o_orderkey bigint, o_orderstatus string, o_totalprice double")


def separated_round(spark, sf_dir):
    """Document lines with signs, quoted, under a header, and read again."""
    path = folder(spark, "csv")
    d = table(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit('say "a, b"; '), "lang").alias("remark"), "source")
    d.write.csv(path, header=True, escape='"', quoteAll=True)
    return files.separated(spark, path, "doc_id bigint, remark string, source string")


def mail_scan(spark, sf_dir):
    """Affiliations made from customers, by the exact scanner."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey").cast("string")
    shapes = [F.concat(F.lit("Dept "), "c_mktsegment", F.lit(", Town (m"), k, F.lit("@uni-y.example).")), F.concat(F.lit("Hall. Electronic address: a."), k, F.lit("@b.co.example; E-mail: z@w.example.")), F.concat(F.lit("Lab, no address "), k), F.concat(F.lit("x@nodot and q"), k, F.lit("@d.example, end")), F.concat("c_name", F.lit(" é Email: é"), k, F.lit("@x.org"))]
    t = c.select("c_custkey", F.element_at(F.array(*shapes), (F.col("c_custkey") % 5 + 1).cast("int")).alias("t"))
    return S.without_mails(t, "t").select("c_custkey", "stripped", F.array_join("mails", ";").alias("mails"))


def bracket_ranges(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", F.concat(F.col("p_brand"), F.lit(" ("), F.col("p_name"), F.lit(" [x] >) <"), F.col("p_type"), F.lit("> (open")).alias("t"), F.length("p_brand").alias("b"))
    r = S.with_brackets(p, "t")
    return r.select("p_partkey", F.array_join(F.transform("brackets", lambda x: F.concat_ws("-", x["start"], x["end"], x["depth"])), " ").alias("ranges"))


def text_values(spark, sf_dir):
    """Values as JSON, joined paths, doubled quotes, parameters and texts to embed."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", F.concat(F.lit("it's "), "o_orderpriority").alias("t"), F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderstatus")).alias("maybe"))
    return o.select("o_orderkey", S.json_value(F.array("o_orderstatus", "maybe")).alias("json"), S.path_join(F.when(F.col("o_orderkey") % 2 == 0, F.lit("a/")).otherwise(F.lit("a")), "o_orderstatus").alias("path"), S.quoted("t").alias("quoted"), S.parameters({"id": "t", "x y": "o_orderstatus"}).alias("parameters"), S.embedding_text("o_orderstatus", "maybe").alias("embedded"), S.typed_literal("o_orderkey")["datatype"].alias("datatype"))


def doi_find(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    t = F.concat(F.lit("see 10.1000/x"), "doc_id", F.lit(". and doi:10.55.1/(a)b, no 10/x"))
    return d.select("doc_id", F.array_join(S.dois(t), " ").alias("found"), S.is_doi(F.concat(F.lit("DOI:10.1000/x"), "doc_id")).alias("whole"), S.is_doi(t).alias("part"))


def enumeration_ends(spark, sf_dir):
    """Lists that end in a separator, or hold nothing."""
    p = table(spark, sf_dir, "part")
    t = F.element_at(F.array(F.concat("p_name", F.lit(",")), F.concat(F.lit(" a; b, and "), "p_brand", F.lit(";")), F.lit(""), F.lit("  "), F.concat("p_brand", F.lit(", "))), (F.col("p_partkey") % 5 + 1).cast("int"))
    return p.select("p_partkey", F.array_join(S.enumeration(t), "|").alias("items"), F.size(S.enumeration(t)).alias("n"))


def json_decode(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.from_json("props", "k bigint")["k"].alias("k"))


def run_documents(spark, sf_dir):
    """Events of a user in order, a document for each stretch of one type."""
    e = table(spark, sf_dir, "events")
    g = X.split_on_change(e, "event_type", ["ts", "event_id"], "user_id", "event_type")
    return g.select("user_id", "run", "event_type", "n", F.md5("document").alias("document_md5"))


def computed_key_join(spark, sf_dir):
    """Orders left-joined to counts by the beginning of a longer key."""
    li = table(spark, sf_dir, "lineitem").groupBy(F.concat(F.col("l_orderkey").cast("string"), F.lit(".0")).alias("id")).agg(F.count("*").alias("n"))
    li = li.withColumn("key", F.expr("substring(id, 1, length(id) - 2)"))
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderkey").cast("string").alias("key"))
    return o.join(li.select("key", "n"), "key", "left").select("o_orderkey", F.coalesce("n", F.lit(0)).alias("n"))


def latest_by_prefix(spark, sf_dir):
    """Of the ids that begin as asked, of late years: the last two hundred."""
    o = table(spark, sf_dir, "orders").select(F.concat(F.when(F.col("o_orderkey") % 2 == 0, F.lit("PMC")).otherwise(F.lit("X")), "o_orderkey").alias("id"), F.year("o_orderdate").alias("year"))
    return o.where(F.col("id").like("PMC%") & (F.col("year") > 1998)).orderBy(F.desc("year"), "id").limit(200)


def seeded_sample(spark, sf_dir):
    return K.sample_of(table(spark, sf_dir, "documents").select("doc_id", "source"), "doc_id", 5, 42)


def ids_semi_join(spark, sf_dir):
    """Orders of the customers of one segment, by a table of ids."""
    ids = table(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    return K.of_ids(table(spark, sf_dir, "orders"), "o_custkey", ids).select("o_orderkey", "o_custkey")


def map_by_key(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("user_id", "event_type", "ts", "event_id")
    return K.map_by_key(e, "user_id", ["ts", "event_id"])


_ART = "art AS (SELECT o_orderkey, year(o_orderdate)::INTEGER AS y, o_orderpriority, c_name, c_mktsegment, c_nationkey FROM orders JOIN customer ON o_custkey = c_custkey)"
_LINE = "line AS (SELECT o_orderkey, 'a/' || o_orderkey AS f, 'tab' || chr(9) || 'in ' || o_orderkey AS c, 'PMC' || o_custkey AS pmc, CASE WHEN o_orderkey % 7 = 1 THEN 'x' ELSE o_orderkey::VARCHAR END AS pmid, o_orderstatus FROM orders)"
_JSON_LIST = """'["' || o_orderstatus || '",' || CASE WHEN o_orderkey % 2 = 0 THEN '"' || o_orderstatus || '"' ELSE 'null' END || ']'"""
ORACLE = {
    "article_text": r"SELECT doc_id AS identifier, 'On ' || lang || ' & ' || source AS title, md5(trim(regexp_replace(regexp_replace(text, '[\x00-\x08\x0b\x0c\x0e-\x1f]', ' ', 'g'), '[ \t\r\n]+', ' ', 'g'))) AS first_md5, 'End.' AS last FROM documents",
    "article_authors": f"""WITH {_ART} SELECT o_orderkey AS publication_id, unnest([0, 1])::INTEGER AS ordinal, unnest(['Ann', 'Bo']) AS fore_name, unnest([c_name, 'Second']) AS last_name, unnest(['A', 'B']) AS initials, y AS year_active,
        unnest(['Dept ' || c_nationkey || ' .', 'Hall']) AS affiliation, unnest(['x' || o_orderkey || '@uni.example', NULL]) AS email_address FROM art""",
    "article_parts": f"WITH {_ART} SELECT o_orderkey AS identifier, 'D' || o_orderkey AS ui, o_orderpriority AS heading, true AS major, 1 AS qualifiers, 'J of ' || c_mktsegment AS journal, '1-' || o_orderkey AS issn, 2 AS n_references, 'C' || o_orderkey AS citation, o_orderkey::VARCHAR AS last_id FROM art",
    "article_records": f"WITH {_ART} SELECT o_orderkey AS identifier, y AS year, 'T' AS title, 1 AS abstracts, c_name AS first_author FROM art WHERE y BETWEEN 1996 AND 1998 AND o_orderkey > 0",
    "filelist_parse": f"WITH {_LINE} SELECT f AS article_file, c AS article_citation, pmc AS pmc_id, pmid::BIGINT AS pmid, TIMESTAMP '2020-01-01 00:00:00' AS last_update, o_orderstatus AS license, 'no' AS retracted FROM line WHERE o_orderkey % 10 <> 0 AND pmid <> 'x'",
    "filelist_rejects": f"""WITH {_LINE} SELECT f || chr(9) || '"' || c || '"' || chr(9) || pmc || chr(9) || '2020-01-01 00:00:00' || chr(9) || pmid || CASE WHEN o_orderkey % 10 = 0 THEN '' ELSE chr(9) || o_orderstatus || chr(9) || 'no' END AS value FROM line WHERE o_orderkey % 10 = 0 OR pmid = 'x'""",
    "archive_scan": "SELECT 'g' || s_nationkey || '.tar.gz' AS archive, s_suppkey || '/a.nxml' AS name, 'nxml ' || s_name AS content FROM supplier",
    "archive_listing": "WITH a AS (SELECT DISTINCT 'g' || s_nationkey || '.tar.gz' AS name FROM supplier) SELECT name, '.tar.gz' AS suffix, true AS some, name = (SELECT max(name) FROM a WHERE contains(name, 'g1')) AS newest FROM a",
    "oai_answers": """WITH s AS (SELECT *, CASE WHEN s_suppkey % 5 = 0 THEN 'Unavailable' WHEN s_suppkey % 5 IN (1, 2) THEN 'Fail' ELSE 'Ok' END AS status FROM supplier)
        SELECT s_suppkey, status, CASE WHEN status = 'Ok' THEN 'PMC' || s_suppkey END AS id, CASE WHEN status = 'Ok' THEN s_name END AS citation, CASE WHEN status = 'Ok' THEN 'CC BY' END AS license,
        CASE WHEN status = 'Ok' THEN 'pdf,tgz' END AS formats, CASE status WHEN 'Ok' THEN 2 WHEN 'Unavailable' THEN 4 ELSE 3 END::SMALLINT AS state FROM s""",
    "full_text_fetch": "SELECT s_suppkey, 'nxml ' || min_by(b.s_name, b.s_suppkey) AS content FROM supplier a JOIN (SELECT s_nationkey, s_suppkey AS k, s_name, s_suppkey FROM supplier) b USING (s_nationkey) WHERE a.s_suppkey % 5 IN (3, 4) GROUP BY a.s_suppkey".replace("SELECT s_suppkey,", "SELECT a.s_suppkey,"),
    "tab_index_round": "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders",
    "separated_round": """SELECT doc_id, 'say "a, b"; ' || lang AS remark, source FROM documents""",
    "mail_scan": """SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN 'Dept ' || c_mktsegment || ', Town.' WHEN 1 THEN 'Hall. .' WHEN 2 THEN 'Lab, no address ' || c_custkey WHEN 3 THEN 'x@nodot and , end' ELSE c_name || ' é Email: é' END AS stripped,
        CASE c_custkey % 5 WHEN 0 THEN 'm' || c_custkey || '@uni-y.example' WHEN 1 THEN 'a.' || c_custkey || '@b.co.example;z@w.example' WHEN 2 THEN '' WHEN 3 THEN 'q' || c_custkey || '@d.example' ELSE c_custkey || '@x.org' END AS mails FROM customer""",
    "bracket_ranges": "SELECT p_partkey, concat_ws(' ', concat_ws('-', b + 1, b + n + 9, 0), concat_ws('-', b + n + 3, b + n + 6, 1), concat_ws('-', b + n + 10, b + n + t + 12, 0)) AS ranges FROM (SELECT p_partkey, length(p_brand) AS b, length(p_name) AS n, length(p_type) AS t FROM part)",
    "text_values": f"""SELECT o_orderkey, {_JSON_LIST} AS json, 'a/' || o_orderstatus AS path, 'it''''s ' || o_orderpriority AS quoted, 'id=' || replace(replace('it%27s+' || o_orderpriority, ' ', '+'), '''', '%27') || '&x+y=' || o_orderstatus AS parameters,
        o_orderstatus || ' ' || CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus ELSE 'None' END AS embedded, 'http://www.w3.org/2001/XMLSchema#integer' AS datatype FROM orders""",
    "doi_find": "SELECT doc_id, '10.1000/x' || doc_id || ' 10.55.1/(a)b' AS found, true AS whole, false AS part FROM documents",
    "enumeration_ends": "SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN p_name WHEN 1 THEN 'a|b|' || p_brand WHEN 4 THEN p_brand || '|' ELSE '' END AS items, CASE p_partkey % 5 WHEN 0 THEN 1 WHEN 1 THEN 3 WHEN 4 THEN 2 ELSE 0 END::INTEGER AS n FROM part",
    "json_decode": "SELECT event_id, (props::JSON->>'k')::BIGINT AS k FROM events",
    "run_documents": """WITH a AS (SELECT *, lag(event_type) OVER w AS before, row_number() OVER w AS rn FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
        b AS (SELECT *, sum(CASE WHEN rn > 1 AND before IS DISTINCT FROM event_type THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS run FROM a)
        SELECT user_id, run::BIGINT AS run, event_type, count(*) AS n, md5(string_agg(event_type, chr(10))) AS document_md5 FROM b GROUP BY 1, 2, 3""",
    "computed_key_join": "SELECT o_orderkey, coalesce(n, 0) AS n FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey",
    "latest_by_prefix": "SELECT 'PMC' || o_orderkey AS id, year(o_orderdate)::INTEGER AS year FROM orders WHERE o_orderkey % 2 = 0 AND year(o_orderdate) > 1998 ORDER BY 2 DESC, 1 LIMIT 200",
    "seeded_sample": "SELECT doc_id, source FROM documents ORDER BY md5('42:' || doc_id), doc_id LIMIT 5",
    "ids_semi_join": "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')",
    "map_by_key": "SELECT user_id, event_type, ts, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1",
}
QUERIES = {k: globals()[k] for k in ORACLE}
