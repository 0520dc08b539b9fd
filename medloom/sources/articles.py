"""Article XML: one row per article, nested lists kept as arrays of structs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from medloom.functions import text as S
from medloom.sources.split import SPLIT
from medloom.sources.split import records as records_in

#: Shape of the files: elements as fields, attributes with an underscore; a mixed element is declared as text.
SCHEMA = """
MedlineCitation struct<PMID string, DateCompleted struct<Year string, Month string, Day string>,
  Article struct<ArticleTitle string, Abstract struct<AbstractText array<string>>, ArticleDate struct<Year string, Month string, Day string>,
    Journal struct<Title string, ISSN string, ISOAbbreviation string, JournalIssue struct<Volume string, Issue string, PubDate struct<Year string, Month string, Day string>>>,
    AuthorList struct<Author array<struct<LastName string, ForeName string, Initials string, AffiliationInfo array<struct<Affiliation string>>>>>>,
  MeshHeadingList struct<MeshHeading array<struct<DescriptorName struct<_UI string, _MajorTopicYN string, _VALUE string>, QualifierName array<struct<_UI string, _MajorTopicYN string, _VALUE string>>>>>>,
PubmedData struct<ArticleIdList struct<ArticleId array<struct<_IdType string, _VALUE string>>>,
  ReferenceList struct<Reference array<struct<Citation string, ArticleIdList struct<ArticleId array<struct<_IdType string, _VALUE string>>>>>>>
"""


#: A start or end tag; the reader has resolved entities, so other signs are text.
TAG = r"""</?[A-Za-z][\w:.-]*(?:\s+[\w:.-]+\s*=\s*(?:"[^"]*"|'[^']*'))*\s*/?>"""


def element_text(c: Column) -> Column:
    """All characters of an element that was read as raw inner XML."""
    return F.regexp_replace(c, TAG, "")


def read(spark: SparkSession, path: str) -> DataFrame:
    """Articles of plain or gzipped files; ``origin`` is the file."""
    raw = spark.read.format("xml").option("rowTag", "PubmedArticle").schema(SCHEMA).load(path)
    return raw.withColumn("origin", F.input_file_name())


def parse(rows: DataFrame, xml: str, origin: Column | str = "") -> DataFrame:
    """Articles of a column that holds one each."""
    origin = F.lit(origin) if isinstance(origin, str) else origin
    return rows.select(F.from_xml(xml, SCHEMA, {"rowTag": "PubmedArticle"}).alias("a"), origin.alias("origin")).select("a.*", "origin")


def read_split(spark: SparkSession, path: str, split: int = SPLIT) -> DataFrame:
    """As ``read``, but large files are read by several tasks, gzipped ones too if they have several members."""
    return parse(records_in(spark, path, r"<PubmedArticle[\s>]", "</PubmedArticle>", split=split), "record", F.col("file"))


def _date(prefix: str) -> Column:
    return S.partial_date(f"{prefix}.Year", F.col(f"{prefix}.Month"), F.col(f"{prefix}.Day"))


def records(articles: DataFrame) -> DataFrame:
    """identifier, title, abstract, date, year, ids, authors, headings, references (citation and a map of ids in which
    the last of a type counts), journal and origin."""
    a, empty = "MedlineCitation.Article", F.array()
    ids = F.coalesce("PubmedData.ArticleIdList.ArticleId", empty)
    refs = F.coalesce("PubmedData.ReferenceList.Reference", empty)
    last_of = lambda entries: F.aggregate(
        F.coalesce(entries, empty.cast("array<struct<_IdType:string,_VALUE:string>>")), F.create_map().cast("map<string,string>"),
        lambda m, e: F.map_concat(F.map_filter(m, lambda k, v: k != e["_IdType"]), F.create_map(e["_IdType"], e["_VALUE"])),
    )
    published = S.publication_date(_date(f"{a}.ArticleDate"), _date("MedlineCitation.DateCompleted"), _date(f"{a}.Journal.JournalIssue.PubDate"))
    out = articles.select(
        F.coalesce(F.col("MedlineCitation.PMID"), F.try_element_at(F.filter(ids, lambda x: x["_IdType"] == "pubmed"), F.lit(1))["_VALUE"]).try_cast("bigint").alias("identifier"),
        element_text(F.col(f"{a}.ArticleTitle")).alias("title"), F.transform(F.coalesce(f"{a}.Abstract.AbstractText", empty.cast("array<string>")), element_text).alias("abstract"),
        published.alias("published"), F.transform(ids, lambda x: F.struct(x["_IdType"].alias("kind"), x["_VALUE"].alias("value"))).alias("ids"),
        F.coalesce(F.col(f"{a}.AuthorList.Author"), empty).alias("authors"),
        F.transform(F.coalesce("MedlineCitation.MeshHeadingList.MeshHeading", empty), lambda h: F.struct(h["DescriptorName"]["_UI"].alias("ui"), h["DescriptorName"]["_VALUE"].alias("name"), (h["DescriptorName"]["_MajorTopicYN"] == "Y").alias("major"), h["QualifierName"].alias("qualifiers"))).alias("headings"),
        F.transform(refs, lambda r: F.struct(r["Citation"].alias("citation"), last_of(r["ArticleIdList"]["ArticleId"]).alias("ids"))).alias("references"),
        F.col(f"{a}.Journal").alias("journal"), "origin",
    )
    return out.withColumn("year", F.substring("published", 1, 4).try_cast("int"))


def authorships(rows: DataFrame) -> DataFrame:
    """A row per author and affiliation; the address is the last affiliation's first one."""
    e = rows.select("identifier", F.coalesce("year", F.lit(0)).alias("year_active"), F.posexplode("authors").alias("ordinal", "a"))
    texts = F.transform(F.coalesce("a.AffiliationInfo", F.array()), lambda x: x["Affiliation"])
    mails = F.filter(F.transform(texts, lambda t: F.try_element_at(S.emails(t), F.lit(1))), lambda m: m.isNotNull())
    e = e.select(F.col("identifier").alias("publication_id"), "ordinal", F.col("a.ForeName").alias("fore_name"), F.col("a.LastName").alias("last_name"), F.col("a.Initials").alias("initials"), "year_active", F.try_element_at(mails, F.lit(-1)).alias("email_address"), F.explode_outer(texts).alias("affiliation"))
    return e.withColumn("affiliation", S.without_emails("affiliation"))


def in_years(rows: DataFrame, first: int = 1500, last: int = 3000) -> DataFrame:
    """Rows of the years; those without a year go."""
    return rows.where(F.col("year").between(first, last))


def valid(rows: DataFrame) -> DataFrame:
    return rows.where((F.col("identifier") > 0) & (F.size("abstract") > 0))


def to_json(rows: DataFrame) -> DataFrame:
    keep = [c for c in rows.columns if c not in ("identifier", "year", "origin")]
    return rows.select("identifier", "year", F.to_json(F.struct(*keep), {"ignoreNullFields": "false"}).alias("record"), "origin")
