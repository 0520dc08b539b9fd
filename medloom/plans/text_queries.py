"""Scalar functions and exploding over the generic tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from medloom.functions import text as S
from medloom.operators import prefixes
from medloom.operators import reshape as X
from medloom.operators import sentences
from medloom.operators.tasks import STATES
from medloom.session import table

PREFIXES = {"ex": "http://example.org/", "exs": "http://example.org/src/", "o": "http://other.example/"}


def trim_fields(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", S.trimmed("p_name", 7).alias("name"), S.joined(S.trimmed_list(F.split("p_name", " "), 3)).alias("words"))


def storage_path(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.select("o_orderkey", S.storage_path(F.concat(F.lit("PMC"), "o_orderkey"), F.year("o_orderdate")).alias("path"))


def fulltext_location(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", S.bulk_path(F.concat(F.lit("PMC"), "o_orderkey")).alias("path"))


def author_display_name(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    fore = F.when(F.col("c_custkey") % 3 == 0, F.lit("J K")).when(F.col("c_custkey") % 3 == 1, F.lit("Jane"))
    return c.select("c_custkey", S.display_name(fore, F.lit("JK"), F.col("c_name")).alias("name"))


def month_lookup(spark, sf_dir):
    """How many words of each whole text are which month, or none; and the months of orders."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.explode(F.regexp_extract_all("text", F.lit("[^ ]+"), F.lit(0))).alias("word"))
    m = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("doc_id"), F.date_format("o_orderdate", "MMM").alias("word"))
    return d.unionByName(m).groupBy("doc_id", S.month_number("word").alias("month")).agg(F.count("*").alias("n"))


def partial_date(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    month = F.when(F.col("o_orderkey") % 3 == 0, F.lit(None)).when(F.col("o_orderkey") % 3 == 1, F.date_format("o_orderdate", "MMM")).otherwise(F.date_format("o_orderdate", "M"))
    day = F.when(F.col("o_orderkey") % 2 == 0, F.date_format("o_orderdate", "d"))
    return o.select("o_orderkey", S.publication_date(S.partial_date(F.year("o_orderdate"), month, day)).alias("published"))


def email_extract(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", S.emails("text").alias("m")).where(F.size("m") > 0).select("doc_id", F.array_join("m", ";").alias("mails"))


def email_strip(spark, sf_dir):
    return table(spark, sf_dir, "documents").where(F.size(S.emails("text")) > 0).select("doc_id", S.without_emails("text").alias("stripped"))


def doi_normalise(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    raw = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("https://doi.org/10.1000%2Fx"), "doc_id")).when(F.col("doc_id") % 3 == 1, F.concat(F.lit("doi: 10.1000 /x"), "doc_id")).otherwise(F.lit("none"))
    return d.select("doc_id", S.doi(raw).alias("doi"), S.doi_uri(raw).alias("uri"))


def split_enumeration(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", F.concat("p_name", F.lit(", and "), "p_brand", F.lit("; "), "p_type", F.lit(" and x")).alias("t"))
    return p.select("p_partkey", F.array_join(S.enumeration("t"), "|").alias("items"), F.size(S.enumeration("t")).alias("n"))


def clean_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", S.clean("text").alias("cleaned"))


def initials(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", S.initials("p_name").alias("initials"), S.cardinality(F.size(F.split("p_name", " "))).alias("cardinality"), S.page_range("p_size", F.when(F.col("p_size") > 9, F.col("p_size") + 1)).alias("pages"))


def abstract_join(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", S.joined(F.filter(F.split("text", "\n"), lambda x: x != "")).alias("abstract"))


def suffix_filter(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    name = F.concat(F.lit("File"), "p_partkey", F.element_at(F.array(*[F.lit(x) for x in (".xml.gz", ".filelist.txt", ".tar.gz", ".MD5", "")]), (F.col("p_partkey") % 5 + 1).cast("int")))
    return p.select("p_partkey", S.suffix(name).alias("suffix"))


def enum_ordinals(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    name = F.element_at(F.array(*[F.lit(x) for x in ("QUEUED", "inprogress", "Completed", "failed", "Unavailable", "other")]), (F.col("event_id") % 6 + 1).cast("int"))
    return e.select("event_id", S.ordinal(name, STATES).alias("state"))


def prefix_encode(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    uri = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("http://example.org/src/"), "doc_id")).when(F.col("doc_id") % 3 == 1, F.concat(F.lit("http://example.org/"), "source")).otherwise(F.concat(F.lit("urn:"), "doc_id"))
    return d.select("doc_id", S.prefix_encode(uri, PREFIXES).alias("name"))


def prefix_longest(spark, sf_dir):
    """Documents' addresses named by a table of namespaces: one for each customer key, some of which begin with others."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("http://example.org/"), "doc_id", F.lit("/x")).alias("uri"))
    known = table(spark, sf_dir, "customer").select(F.concat(F.lit("c"), "c_custkey").alias("prefix"), F.concat(F.lit("http://example.org/"), "c_custkey").alias("namespace"))
    return prefixes.encode(d, "uri", known).select("doc_id", "name")


def prefix_decode(spark, sf_dir):
    return prefix_encode(spark, sf_dir).select("doc_id", S.prefix_decode("name", PREFIXES).alias("uri"))


def explode_cartesian(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", F.split("p_name", " ").alias("a"), F.when(F.col("p_size") > 10, F.split("p_type", " ")).otherwise(F.array().cast("array<string>")).alias("b"))
    return X.explode_product(p, ["a", "b"])


def explode_outer_ordinal(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", F.filter(F.split("text", "\n"), lambda x: F.length(x) > 200).alias("items"))
    return X.with_ordinal(d, "items", ["doc_id"])


def references_explode(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.array(F.create_map(F.lit("PubMed"), F.col("o_custkey").cast("string"), F.lit("other"), F.lit("x")), F.create_map(F.lit("pubmed"), F.col("o_orderstatus"))).alias("groups"))
    return X.typed_references(o, "groups", ["o_orderkey"], ["pubmed"]).select("o_orderkey", "ordinal", "reference")


def link_pairs(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    ids = F.array(F.struct(F.lit("pubmed").alias("kind"), F.col("o_orderkey").cast("string").alias("value")), F.struct(F.when(F.col("o_orderstatus") == "F", "pmc").otherwise("x").alias("kind"), F.col("o_custkey").cast("string").alias("value")), F.struct(F.lit("pubmed").alias("kind"), F.lit("later").alias("value")))
    return X.first_links(o.select("o_orderkey", ids.alias("ids")), "ids", ["o_orderkey"], "pubmed", "pmc")


def chunk_words(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", F.explode(X.word_windows(F.col("text"), 512, 30)).alias("w"))
    return d.select("doc_id", "w.position", F.md5("w.chunk").alias("chunk_md5"))


def chunk_sentences(spark, sf_dir):
    """Documents in chunks of whole sentences, of at most 512 words and an overlap of at most 30."""
    made = sentences.chunked(table(spark, sf_dir, "documents"), "text", ["doc_id"], 512, 30)
    return made.select("doc_id", "position", F.md5("chunk").alias("chunk_md5"))


def section_group(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", F.concat_ws(".", F.col("l_suppkey") % 2, F.col("l_linenumber"), F.col("l_partkey")).alias("section"), F.concat("l_returnflag", "l_linestatus").alias("t"))
    return X.grouped_sections(li.distinct(), "l_orderkey", "section", "t", 2)



def daily_windows(spark, sf_dir):
    """Tumbling windows over events (an extension)."""
    e = table(spark, sf_dir, "events")
    return e.groupBy(F.date_format(F.date_trunc("day", "ts"), "yyyy-MM-dd").alias("day"), "event_type").agg(F.count("*").alias("n"), F.count_distinct("user_id").alias("users"))


_MAIL = r"[A-Za-z0-9!#$%&''*+/=?^_`{|}~.-]+@[A-Za-z0-9!#$%&''*+/=?^_`{|}~-]+(?:\.[A-Za-z0-9]+)+"
_RAWDOI = "CASE WHEN doc_id % 3 = 0 THEN 'https://doi.org/10.1000%2Fx' || doc_id WHEN doc_id % 3 = 1 THEN 'doi: 10.1000 /x' || doc_id ELSE 'none' END"
_MONTHS = "mo AS (SELECT unnest(['january','february','march','april','may','june','july','august','september','october','november','december']) AS m, unnest(range(0, 12))::INTEGER AS k), pre AS (SELECT p, min(k) AS k FROM (SELECT m[1:n] AS p, k FROM mo, (SELECT unnest(range(1, 10)) AS n) WHERE n <= length(m)) GROUP BY p HAVING count(*) = 1)"
_URI = "CASE WHEN doc_id % 3 = 0 THEN 'http://example.org/src/' || doc_id WHEN doc_id % 3 = 1 THEN 'http://example.org/' || source ELSE 'urn:' || doc_id END"
def sentence_chunks(key, source, size, overlap, text="text"):
    """Chunks of whole sentences as common table expressions; ``chunk`` has key, position and chunk."""
    listed = ", ".join(f"'{a}'" for a in sentences.ABBREVIATIONS)
    opening, closing, initial, quotes = (x.replace("'", "''") for x in (sentences.OPENING, sentences.CLOSING, sentences.INITIAL, sentences.QUOTES))
    return f"""sw AS (SELECT {key}, {WORDS.replace("text", text)} AS w FROM {source}),
        se AS (SELECT {key}, w, list_filter(range(0, len(w)), lambda i: i = len(w) - 1 OR (regexp_matches(w[i + 1], '{closing}') AND NOT list_contains([{listed}], lower(regexp_replace(w[i + 1], '{quotes}', '')))
            AND NOT regexp_matches(w[i + 1], '{initial}') AND regexp_matches(w[i + 2], '{opening}'))) AS ends FROM sw WHERE len(w) > 0),
        sc AS (SELECT {key}, 0 AS position, 0::BIGINT AS f, coalesce(list_max(list_filter(ends, lambda y: y < {size})), ends[1]) AS l FROM se
            UNION ALL SELECT {key}, position + 1, f, coalesce(list_max(list_filter(ends, lambda y: y >= x AND y - f < {size})), x) FROM (
                SELECT {key}, position, ends, x, coalesce(list_min(list_filter(ends, lambda y: y >= c.f AND y < c.l AND c.l - y <= {overlap} AND x - y <= {size})), c.l) + 1 AS f
                FROM (SELECT sc.*, ends, list_min(list_filter(ends, lambda y: y > sc.l)) AS x FROM sc JOIN se USING ({key}) WHERE sc.l < len(w) - 1) c)),
        chunk AS (SELECT {key}, position::INTEGER AS position, array_to_string(w[f + 1 : l + 1], ' ') AS chunk FROM sc JOIN se USING ({key}))"""


WORDS = r"list_filter(string_split_regex(text, '[ \t\n\x0b\f\r]+'), lambda x: x <> '')"

ORACLE = {
    "trim_fields": "SELECT p_partkey, p_name[1:7] AS name, array_to_string(list_transform(string_split(p_name, ' '), lambda x: x[1:3]), ',') AS words FROM part",
    "storage_path": """SELECT o_orderkey, 'data/' || year(o_orderdate) || '/' || CASE WHEN length(i) > 4 AND length(i[3:]) > 4 THEN i[1:2] || '/' || i[3:4] || '/' WHEN length(i) > 4 THEN i[1:2] || '/' ELSE '' END || i AS path
        FROM (SELECT *, 'PMC' || o_orderkey AS i FROM orders)""",
    "fulltext_location": "SELECT o_orderkey, 'bulk/PMC' || substr(lpad(substr('PMC' || o_orderkey, 4, 10), 9, '0'), 1, 3) || 'xxxxxx/PMC' || o_orderkey || '.xml' AS path FROM orders",
    "author_display_name": "SELECT c_custkey, CASE c_custkey % 3 WHEN 1 THEN 'Jane ' ELSE 'JK ' END || c_name AS name FROM customer",
    "month_lookup": f"WITH {_MONTHS}, w AS (SELECT doc_id, unnest(regexp_extract_all(text, '[^ ]+')) AS word FROM documents UNION ALL SELECT o_orderkey, strftime(o_orderdate, '%b') FROM orders) SELECT doc_id, k AS month, count(*) AS n FROM w LEFT JOIN pre ON lower(trim(word)) = p GROUP BY 1, 2",
    "partial_date": """SELECT o_orderkey, strftime(make_date(year(o_orderdate), CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE month(o_orderdate) END, CASE WHEN o_orderkey % 2 = 0 THEN day(o_orderdate) ELSE 1 END), '%Y-%m-%d') AS published FROM orders""",
    "email_extract": f"SELECT doc_id, array_to_string(m, ';') AS mails FROM (SELECT doc_id, regexp_extract_all(text, '{_MAIL}') AS m FROM documents) WHERE len(m) > 0",
    "email_strip": rf"SELECT doc_id, trim(regexp_replace(text, '\(?(?:(?:[Ee]-?mail|Electronic address):\s*)?{_MAIL}\)?', '', 'g'), ' ') AS stripped FROM documents WHERE regexp_matches(text, '{_MAIL}')",
    "doi_normalise": "SELECT doc_id, CASE WHEN doc_id % 3 = 2 THEN NULL ELSE '10.1000/x' || doc_id END AS doi, CASE WHEN doc_id % 3 = 2 THEN NULL ELSE 'https://doi.org/10.1000/x' || doc_id END AS uri FROM documents",
    "split_enumeration": """SELECT p_partkey, array_to_string(i, '|') AS items, len(i)::INTEGER AS n FROM (SELECT p_partkey, list_transform(string_split_regex(p_name || ', and ' || p_brand || '; ' || p_type || ' and x', ', and |; and | and |,|;'), lambda x: trim(x)) AS i FROM part)""",
    "clean_text": r"SELECT doc_id, trim(regexp_replace(text, '[ \t\n\x0b\f\r\x{00A0}]+', ' ', 'g'), ' ') AS cleaned FROM documents",
    "initials": """SELECT p_partkey, array_to_string(list_transform(list_filter(string_split_regex(p_name, '[ -]'), lambda x: x <> ''), lambda x: upper(x[1])), '') AS initials,
        CASE len(string_split(p_name, ' ')) WHEN 0 THEN '0' WHEN 1 THEN '1' ELSE 'N' END AS cardinality, p_size || '-' || CASE WHEN p_size > 9 THEN (p_size + 1)::VARCHAR ELSE '?' END AS pages FROM part""",
    "abstract_join": r"SELECT doc_id, array_to_string(list_filter(string_split(text, chr(10)), lambda x: x <> ''), ',') AS abstract FROM documents",
    "suffix_filter": "SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN '.xml.gz' WHEN 1 THEN '.txt' WHEN 2 THEN '.tar.gz' WHEN 3 THEN '.md5' ELSE 'tmp' END AS suffix FROM part",
    "enum_ordinals": "SELECT event_id, CASE event_id % 6 WHEN 5 THEN NULL ELSE (event_id % 6)::INTEGER END AS state FROM events",
    "prefix_encode": f"SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'exs:' || doc_id WHEN 1 THEN 'ex:' || source ELSE {_URI} END AS name FROM documents",
    "prefix_longest": """WITH u AS (SELECT doc_id, 'http://example.org/' || doc_id || '/x' AS uri FROM documents), k AS (SELECT 'c' || c_custkey AS prefix, 'http://example.org/' || c_custkey AS head FROM customer)
        SELECT doc_id, coalesce(prefix || ':' || substring(uri, length(head) + 1), uri) AS name FROM (SELECT doc_id, uri, prefix, head, row_number() OVER (PARTITION BY doc_id ORDER BY length(head) DESC NULLS LAST) AS r FROM u LEFT JOIN k ON starts_with(uri, head)) WHERE r = 1""",
    "prefix_decode": f"SELECT doc_id, {_URI} AS uri FROM documents",
    "explode_cartesian": """WITH x AS (SELECT p_partkey, string_split(p_name, ' ') AS a, string_split(p_type, ' ') AS b, p_size FROM part), y AS (SELECT p_partkey, unnest(a) AS a, b FROM x WHERE p_size > 10)
        SELECT p_partkey, a, unnest(b) AS b FROM y UNION ALL SELECT p_partkey, NULL, NULL FROM x WHERE p_size <= 10""",
    "explode_outer_ordinal": """WITH x AS (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: length(x) > 200) AS l FROM documents)
        SELECT doc_id, (generate_subscripts(l, 1) - 1)::INTEGER AS ordinal, unnest(l) AS field FROM x WHERE len(l) > 0 UNION ALL SELECT doc_id, NULL, NULL FROM x WHERE len(l) = 0""",
    "references_explode": "SELECT o_orderkey, 0 AS ordinal, o_custkey::VARCHAR AS reference FROM orders UNION ALL SELECT o_orderkey, 1, o_orderstatus FROM orders",
    "link_pairs": "SELECT o_orderkey, o_orderkey::VARCHAR AS source, o_custkey::VARCHAR AS target FROM orders WHERE o_orderstatus = 'F'",
    "chunk_words": f"""WITH w AS (SELECT doc_id, {WORDS} AS w FROM documents), s AS (SELECT doc_id, w, unnest(range(0, greatest(0, ceil((len(w) - 30) / 482.0)::BIGINT - 1) + 1)) AS position FROM w WHERE len(w) > 0)
        SELECT doc_id, position::INTEGER AS position, md5(array_to_string(w[position * 482 + 1 : position * 482 + 512], ' ')) AS chunk_md5 FROM s""",
    "chunk_sentences": f"WITH RECURSIVE {sentence_chunks('doc_id', 'documents', 512, 30)} SELECT doc_id, position, md5(chunk) AS chunk_md5 FROM chunk",
    "section_group": """WITH x AS (SELECT DISTINCT l_orderkey, l_suppkey % 2 AS a, l_linenumber AS b, l_partkey AS c, l_returnflag || l_linestatus AS t FROM lineitem)
        SELECT l_orderkey, a || '.' || b AS head, string_agg(t, '' ORDER BY c, t) AS section_text FROM x GROUP BY l_orderkey, a, b""",
    "daily_windows": "SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS n, count(DISTINCT user_id) AS users FROM events GROUP BY 1, 2",
}
QUERIES = {k: globals()[k] for k in ORACLE}
