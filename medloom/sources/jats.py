"""Full-text article XML (JATS): metadata, flattened sections with dotted ids, tables as columns and rows."""

from __future__ import annotations

import re
from xml.etree import ElementTree as ET

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "pmcid string, pmid string, title string, abstract string, published string, date_status string, authors array<string>, keywords array<string>, contents array<struct<id:string,section:string,tag:string,text:string,columns:array<string>,rows:array<array<string>>>>"
_ARROW = pa.schema([
    ("pmcid", pa.string()), ("pmid", pa.string()), ("title", pa.string()), ("abstract", pa.string()), ("published", pa.string()), ("date_status", pa.string()), ("authors", pa.list_(pa.string())), ("keywords", pa.list_(pa.string())),
    ("contents", pa.list_(pa.struct([("id", pa.string()), ("section", pa.string()), ("tag", pa.string()), ("text", pa.string()), ("columns", pa.list_(pa.string())), ("rows", pa.list_(pa.list_(pa.string())))]))),
])

#: Elements that go with their text; of all others inside a paragraph the tags go and the text stays.
REMOVED = {"disp-formula", "inline-formula", "tex-math", "graphic", "inline-graphic"}
#: Tags with attributes and document types; what goes of them.  Text between tags stays as it is.
_TAG = re.compile(r"<[^<>\s]+\s(?:[^<>\"']|\"[^\"]*\"|'[^']*')*>|<xlink:[^<>]*>|</xlink:[^<>]*>")
_NAMES = re.compile(r"\sxmlns(:\w+)?=\"[^\"]*\"|^<!DOCTYPE.*>|xlink:", re.S)
DATE_ORDER = ("epub", "ppub", "collection", None)


def clean(text: str | None) -> str:
    return re.sub(r"[\s\xa0]+", " ", text or "").strip()


def text_of(e: ET.Element | None) -> str:
    """All text within, without formulas and footnote marks."""
    if e is None:
        return ""
    parts = [e.text or ""]
    for child in e:
        mark = child.tag == "xref" and child.get("ref-type") == "fn"
        if child.tag not in REMOVED and not mark:
            parts.append(text_of(child))
        parts.append(child.tail or "")
    return "".join(parts)


def table_rows(table: ET.Element) -> tuple[list[str], list[list[str]]]:
    """Column names of the head's last row and the body's rows; a cell over several columns repeats."""
    def cells(row):
        return [x for c in row if c.tag in ("td", "th") for x in [clean(text_of(c))] * int(c.get("colspan") or 1)]

    head = [cells(r) for h in table.iter("thead") for r in h.iter("tr")]
    body = [cells(r) for h in table.iter("tbody") for r in h.iter("tr")] or [cells(r) for r in table.iter("tr")][len(head) :]
    return (head[-1] if head else []), body


def first_date(meta: ET.Element) -> tuple[str | None, str]:
    """The first date by kind: yyyy[-mm[-dd]] and ok, incomplete or unparseable."""
    found = list(meta.iter("pub-date"))
    for kind in DATE_ORDER:
        for d in found:
            if kind is None or (d.get("pub-type") or d.get("date-type")) == kind:
                parts = [d.findtext(x) for x in ("year", "month", "day")]
                if not parts[0]:
                    return None, "unparseable"
                known = []
                for p, width in zip(parts, (4, 2, 2), strict=True):
                    if not p or not p.strip().isdigit():
                        break
                    known.append(p.strip().zfill(width))
                return "-".join(known) or None, "ok" if len(known) == 3 else "incomplete" if known else "unparseable"
    return None, "unparseable"


def sections(article: ET.Element) -> list[dict]:
    """Contents in order.  The title is section 1, the abstract the next, the body's follow; an id is the section's path
    and a running number of its contents; contents behind a sub-section stand in an implicit section of their own."""
    out: list[dict] = []

    def add(where: str, n: int, name: str, e: ET.Element) -> None:
        row = {"id": f"{where}.{n}", "section": name, "tag": e.tag, "text": clean(text_of(e)), "columns": None, "rows": None}
        if e.tag == "table-wrap":
            table = next(e.iter("table"), None)
            columns, rows = table_rows(table) if table is not None else ([], [])
            row |= {"text": clean(f"{e.findtext('label') or ''} {text_of(e.find('caption'))}"), "columns": columns, "rows": rows}
        elif e.tag == "fig":
            row["text"] = clean(f"{e.findtext('label') or ''} {text_of(e.find('caption'))}")
        if row["text"] or row["rows"]:
            out.append(row)

    def walk(e: ET.Element, where: str, name: str) -> None:
        n, deeper, wrapped = 0, 0, None
        for child in e:
            if child.tag in ("title", "label"):
                continue
            if child.tag == "sec":
                deeper, wrapped = deeper + 1, None
                walk(child, f"{where}.{n + deeper}", clean(text_of(child.find("title"))) or name)
            elif child.tag in ("table-wrap-group", "fig-group", "fn-group", "app-group"):
                label = clean(f"{child.findtext('label') or ''} {text_of(child.find('caption'))}")
                for part in child:
                    if part.tag not in ("label", "caption"):
                        if label:
                            caption = part.find("caption")
                            caption = ET.SubElement(part, "caption") if caption is None else caption
                            caption.text = f"{label} {caption.text or ''}"
                        n += 1
                        add(where, n + deeper, name, part)
            elif deeper:
                if wrapped is None:
                    deeper, wrapped = deeper + 1, 0
                wrapped += 1
                add(f"{where}.{n + deeper}", wrapped, "wrap", child)
            else:
                n += 1
                add(where, n, name, child)

    count = 1
    title = article.find(".//article-title")
    if title is not None:
        out.append({"id": "1", "section": "Title", "tag": "title", "text": clean(text_of(title)), "columns": None, "rows": None})
    for abstract in article.findall(".//abstract")[:1]:
        count += 1
        walk(abstract, str(count), "Abstract")
    body = article.find("body")
    for child in body if body is not None else ():
        count += 1
        if child.tag == "sec":
            walk(child, str(count), clean(text_of(child.find("title"))))
        else:
            holder = ET.Element("sec")
            holder.append(child)
            walk(holder, str(count), "")
    return out


def parse(xml: str) -> dict | None:
    """An article, or null where the text is no XML."""
    try:
        article = ET.fromstring(_TAG.sub(lambda m: _NAMES.sub("", m[0]), xml))
    except ET.ParseError:
        return None
    if article.tag != "article":
        found = article.find(".//article")
        article = article if found is None else found
    meta = article.find(".//article-meta")
    meta = ET.Element("article-meta") if meta is None else meta
    ids = {i.get("pub-id-type"): clean(i.text) for i in meta.iter("article-id")}
    published, status = first_date(meta)
    authors = [clean(f"{n.findtext('given-names') or ''} {n.findtext('surname') or ''}") for c in meta.iter("contrib") if c.get("contrib-type", "author") == "author" for n in c.iter("name")]
    return {"pmcid": ids.get("pmc") or ids.get("pmcid"), "pmid": ids.get("pmid"), "title": clean(text_of(meta.find(".//article-title"))), "abstract": clean(text_of(meta.find(".//abstract"))), "published": published, "date_status": status, "authors": authors, "keywords": [clean(text_of(k)) for k in meta.iter("kwd")], "contents": sections(article)}


def parse_column(texts: DataFrame, text: str) -> DataFrame:
    """One row per text that is an article."""

    def run(batches):
        for batch in batches:
            found = [parse(t) for t in batch.column(text).to_pylist() if t]
            yield pa.RecordBatch.from_pylist([f for f in found if f], schema=_ARROW)

    return texts.select(text).mapInArrow(run, SCHEMA)


def read(spark: SparkSession, path: str) -> DataFrame:
    return parse_column(spark.read.text(path, wholetext=True), "value")


def paragraphs(articles: DataFrame) -> DataFrame:
    """Paragraphs of titled sections but for title and abstract: pmcid, id, section, text."""
    e = articles.select("pmcid", F.explode("contents").alias("c")).select("pmcid", "c.id", "c.section", "c.tag", "c.text")
    return e.where("tag = 'p' and section <> '' and section not in ('Title', 'Abstract')").drop("tag")
