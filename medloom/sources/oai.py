"""Records of an archive service's answers, and the full texts that their links lead to; fetching is not part of it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The error code of a record that is not open (fixed value).
NOT_OPEN = "idIsNotOpenAccess"
_RECORD = "_id string, _citation string, _license string, _retracted string, link array<struct<_format:string,_updated:string,_href:string>>"
SCHEMA = f"error struct<_code:string,_VALUE:string>, records struct<record: struct<{_RECORD.replace(' string', ':string').replace(' array', ':array')}>>"


def answers(rows: DataFrame, key: str, xml: str) -> DataFrame:
    """key, status (Ok, Unavailable or Fail), record (id, citation, license, retracted) and links (format, updated, href).

    No text, or one that holds neither an error nor a record, is a failure."""
    a = rows.select(key, F.from_xml(xml, SCHEMA, {"rowTag": "OA"}).alias("a"))
    r = F.col("a.records.record")
    status = F.when(F.col("a.error._code") == NOT_OPEN, "Unavailable").when(F.col("a.error").isNull() & r["_id"].isNotNull(), "Ok").otherwise("Fail")
    links = F.transform(F.coalesce(r["link"], F.array().cast("array<struct<_format:string,_updated:string,_href:string>>")), lambda x: F.struct(x["_format"].alias("format"), x["_updated"].alias("updated"), x["_href"].alias("href")))
    record = F.struct(r["_id"].alias("id"), r["_citation"].alias("citation"), r["_license"].alias("license"), r["_retracted"].alias("retracted"))
    ok = F.col("status") == "Ok"
    return a.select(key, status.alias("status"), record.alias("record"), links.alias("links")).select(key, "status", F.when(ok, F.col("record")).alias("record"), F.when(ok, F.col("links")).alias("links"))


def full_texts(found: DataFrame, entries: DataFrame, key: str, kind: str = "tgz", ending: str = "xml") -> DataFrame:
    """key and content: of each answer the first link of the format, its archive by name, and in it the first entry with
    the ending.  ``entries``: archive, position, name and content, as ``files.archive_entries`` gives them."""
    href = F.try_element_at(F.filter("links", lambda x: x["format"] == kind), F.lit(1))["href"]
    wanted = found.where("status = 'Ok'").select(key, F.element_at(F.split(href, "/"), -1).alias("file")).where("file is not null")
    named = entries.where(F.endswith("name", F.lit(ending))).withColumn("file", F.element_at(F.split("archive", "/"), -1))
    first = named.groupBy("file").agg(F.min_by("content", "position").alias("content"))
    return wanted.join(first, "file").select(key, "content")
