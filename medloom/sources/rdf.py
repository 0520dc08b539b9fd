"""N-Triples, Turtle and TriG, TriX and JSON-LD as rows (graph, uri, s, p, o, lit)."""

from __future__ import annotations

import gzip
import hashlib
import io
import json
import re
import zipfile

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medloom.sources.split import SPLIT, records

SCHEMA = "graph string, uri string, s string, p string, o string, lit struct<value:string,lang:string,datatype:string>"
RDF = "http://www.w3.org/1999/02/22-rdf-syntax-ns#"
TYPE, FIRST, REST, NIL = RDF + "type", RDF + "first", RDF + "rest", RDF + "nil"
XSD = "http://www.w3.org/2001/XMLSchema#"
STRING = XSD + "string"
_ARROW = pa.schema([("graph", pa.string()), ("uri", pa.string()), ("s", pa.string()), ("p", pa.string()), ("o", pa.string()), ("lit", pa.struct([("value", pa.string()), ("lang", pa.string()), ("datatype", pa.string())]))])


def ntriples(spark: SparkSession, path: str) -> DataFrame:
    """Line by line and splittable; comments and blank lines go.  Blank nodes keep their names (_:x); a backslash in a
    literal goes and the character behind it stays, whatever it is."""
    lines = spark.read.text(path).where(F.col("value").rlike(r"^\s*[<_]"))
    part = lambda pattern: F.regexp_extract("value", pattern, 1)
    some = lambda c: F.when(c != "", c)
    bare = lambda c: F.regexp_replace(c, "^<|>$", "")
    term = r"(?:<[^>]*>|_:[^\s<>\"]+)"
    head = rf"^\s*{term}\s*<[^>]*>\s*"
    literal = F.col("value").rlike(head + '"')
    value = F.regexp_replace(part(head + r'"((?:[^"\\]|\\.)*)"'), r"\\(.)", "$1")
    lit = F.struct(value.alias("value"), some(part(r'"@([A-Za-z0-9-]+)\s*\.\s*$')).alias("lang"), some(part(r'"\^\^<([^>]*)>\s*\.\s*$')).alias("datatype"))
    o = F.regexp_replace(part(rf"{head}({term})"), r"\.$", "")
    return lines.select(F.lit("").alias("graph"), F.lit(None).cast("string").alias("uri"), bare(part(rf"^\s*({term})")).alias("s"), part(rf"^\s*{term}\s*<([^>]*)>").alias("p"), some(bare(o)).alias("o"), F.when(literal, lit).alias("lit"))


_TOKEN = re.compile(r'''\s+|\#[^\n]*|(?P<iri><[^<>\s]*>)|(?P<long>"""(?:[^"\\]|\\.|"(?!""))*"""|\'\'\'(?:[^'\\]|\\.|'(?!\'\'))*\'\'\')|(?P<text>"(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*')|(?P<word>@?[^\s<>"'{};,^\[\]()]+)|(?P<mark>\^\^|[{};,\[\]()])''', re.S)


def _tokens(text: str):
    at = 0
    while at < len(text):
        m = _TOKEN.match(text, at)
        if not m:
            raise ValueError(f"unexpected {text[at : at + 20]!r}")
        at = m.end()
        kind = m.lastgroup
        if kind == "word":
            word = m["word"]
            # a statement's full stop may stand right behind a name
            if len(word) > 1 and word.endswith(".") and not word.startswith("@"):
                yield "word", word[:-1]
                yield "mark", "."
            else:
                yield ("mark" if word == "." else "word"), word
        elif kind:
            yield kind, m[0]


_PLAIN = {"integer": re.compile(r"[+-]?\d+"), "decimal": re.compile(r"[+-]?\d*\.\d+"), "double": re.compile(r"[+-]?(?:\d+\.?\d*|\.\d+)[eE][+-]?\d+"), "boolean": re.compile("true|false")}


def _cells(cells: list[str], graph: str) -> tuple[list[dict], str]:
    """The rows that chain the cells of a list, and its head."""
    rest = zip(cells, [*cells[1:], NIL], strict=False)
    return [{"graph": graph, "uri": None, "s": a, "p": REST, "o": b, "lit": None} for a, b in rest], cells[0] if cells else NIL


def parse_turtle(text: str) -> list[dict]:
    """Triples of a Turtle or TriG text: prefixes, ``a``, lists by ; and ,, typed, tagged and long literals, named graphs,
    blank nodes by name (_:x) and in brackets (_:anon1, _:anon2 in the order of their opening), collections in parentheses
    (a blank cell for each member, by rdf:first and rdf:rest; an empty one is rdf:nil), bare numbers and booleans as typed
    literals, and subjects urn:triple:s:p:o that name the triple they spell."""
    prefixes: dict[str, str] = {}
    base = ""
    out: list[dict] = []
    tokens = list(_tokens(text))
    i, graph, anonymous = 0, "", 0

    def name(word: str) -> str:
        if word.startswith("<"):
            iri = word[1:-1]
            return iri if ":" in iri or not base else base + iri
        head, colon, rest = word.partition(":")
        return prefixes[head] + rest if colon and head in prefixes else word

    def blank() -> str:
        nonlocal anonymous
        anonymous += 1
        return f"_:anon{anonymous}"

    def node():
        nonlocal i
        if i >= len(tokens):
            raise ValueError("the text ends within a statement")
        kind, word = tokens[i]
        i += 1
        if kind in ("text", "long"):
            n = 3 if kind == "long" else 1
            lit = {"value": re.sub(r"\\(.)", r"\1", word[n:-n], flags=re.S), "lang": None, "datatype": None}
            if i < len(tokens) and tokens[i] == ("mark", "^^"):
                lit["datatype"] = name(tokens[i + 1][1])
                i += 2
            elif i < len(tokens) and tokens[i][0] == "word" and tokens[i][1].startswith("@"):
                lang = tokens[i][1]
                lit["lang"] = lang[1:].rstrip(".")
                if lang.endswith("."):
                    tokens[i] = ("mark", ".")
                else:
                    i += 1
            return None, lit
        if (kind, word) == ("mark", "["):
            own = blank()
            if i < len(tokens) and tokens[i] != ("mark", "]"):
                parts(own)
            if i >= len(tokens) or tokens[i] != ("mark", "]"):
                raise ValueError("a bracket is not closed")
            i += 1
            return own, None
        if (kind, word) == ("mark", "("):
            cells = []
            while i < len(tokens) and tokens[i] != ("mark", ")"):
                cells.append(blank())
                o, lit = node()
                out.append({"graph": graph, "uri": None, "s": cells[-1], "p": FIRST, "o": o, "lit": lit})
            if i >= len(tokens):
                raise ValueError("a parenthesis is not closed")
            i += 1
            chain, head = _cells(cells, graph)
            out.extend(chain)
            return head, None
        if kind == "mark":
            raise ValueError(f"unexpected {word!r}")
        bare = next((k for k, pattern in _PLAIN.items() if kind == "word" and pattern.fullmatch(word)), None)
        if bare:
            return None, {"value": word, "lang": None, "datatype": XSD + bare}
        return name(word), None

    def parts(subject: str) -> None:
        """Verbs and objects of a subject, up to what ends them."""
        nonlocal i
        while True:
            if tokens[i] == ("word", "a"):
                verb, i = TYPE, i + 1
            else:
                verb, _ = node()
            while True:
                o, lit = node()
                out.append({"graph": graph, "uri": None, "s": subject, "p": verb, "o": o, "lit": lit})
                if i < len(tokens) and tokens[i] == ("mark", ","):
                    i += 1
                    continue
                break
            if i < len(tokens) and tokens[i] == ("mark", ";"):
                while i < len(tokens) and tokens[i] == ("mark", ";"):
                    i += 1
                if i < len(tokens) and tokens[i] not in (("mark", "."), ("mark", "}"), ("mark", "]")):
                    continue
            break

    while i < len(tokens):
        kind, word = tokens[i]
        low = word.lower().lstrip("@")
        if kind == "word" and low in ("prefix", "base") and (word.startswith("@") or word.isupper() or word.islower()):
            if low == "prefix":
                prefixes[tokens[i + 1][1].rstrip(":")] = tokens[i + 2][1][1:-1]
                i += 3
            else:
                base = tokens[i + 1][1][1:-1]
                i += 2
            if i < len(tokens) and tokens[i] == ("mark", "."):
                i += 1
            continue
        if (kind, word) == ("mark", "}"):
            graph, i = "", i + 1
            continue
        if (kind, word) in (("mark", "."), ("mark", ";")):
            i += 1
            continue
        if kind == "word" and low == "graph":
            i += 1
            kind, word = tokens[i]
        if i + 1 < len(tokens) and tokens[i + 1] == ("mark", "{"):
            graph, i = name(word), i + 2
            continue
        if (kind, word) == ("mark", "{"):
            i += 1
            continue
        subject, _ = node()
        if i < len(tokens) and tokens[i] not in (("mark", "."), ("mark", "}")):
            parts(subject)
    return out


def parse_trix(text: str) -> list[dict]:
    from xml.etree import ElementTree

    out = []
    local = lambda e: e.tag.rpartition("}")[2]
    for graph in (g for g in ElementTree.fromstring(text).iter() if local(g) == "graph"):
        own = next(((c.text or "").strip() for c in graph if local(c) == "uri"), "")
        for triple in (t for t in graph if local(t) == "triple"):
            s, p, o = list(triple)
            lit = None
            if local(o) in ("plainLiteral", "typedLiteral"):
                lit = {"value": o.text or "", "lang": o.get("{http://www.w3.org/XML/1998/namespace}lang"), "datatype": o.get("datatype")}
            out.append({"graph": own, "uri": None, "s": (s.text or "").strip(), "p": (p.text or "").strip(), "o": None if lit else (o.text or "").strip(), "lit": lit})
    return out


def parse_jsonld(text: str) -> list[dict]:
    """@context with prefixes and typed terms, @id, @type, nested nodes and named @graph; arrays and @set are several values,
    @list and terms of the container @list are rdf:first / rdf:rest chains of blank cells, @reverse and reverse terms swap
    subject and object."""
    out: list[dict] = []
    count = 0

    def blank() -> str:
        nonlocal count
        count += 1
        return f"_:b{count}"

    def many(value) -> list:
        return value if isinstance(value, list) else [value]

    def visit(node: dict, terms: dict, graph: str) -> str:
        terms = terms | (node.get("@context") if isinstance(node.get("@context"), dict) else {})

        def full(word: str) -> str:
            if word.startswith("@"):
                return word
            term = terms.get(word)
            if isinstance(term, dict):
                own = term.get("@id", term.get("@reverse", word))
                return full(own) if own != word else word
            if isinstance(term, str):
                return full(term) if term != word else word
            head, colon, rest = word.partition(":")
            return terms[head] + rest if colon and isinstance(terms.get(head), str) and not rest.startswith("//") else word

        def objects(item, declared: str | None) -> list[tuple[str | None, dict | None]]:
            """What a value stands for: (resource, literal), none for null, several for a set."""
            if isinstance(item, dict) and "@list" in item:
                return [(listed(many(item["@list"]), declared), None)]
            if isinstance(item, dict) and "@set" in item:
                return [x for member in many(item["@set"]) for x in objects(member, declared)]
            if isinstance(item, dict) and "@value" in item:
                return [(None, {"value": str(item["@value"]), "lang": item.get("@language"), "datatype": full(item["@type"]) if "@type" in item else None})]
            if isinstance(item, dict):
                return [(visit(item, terms, graph), None)]
            if isinstance(item, list):
                return [(listed(item, declared), None)]
            if isinstance(item, str) and (declared == "@id" or declared is None and re.match("https?://", item)):
                return [(full(item) if declared else item, None)]
            if item is None:
                return []
            kind = {bool: "boolean", int: "integer", float: "double"}.get(type(item), "string")
            return [(None, {"value": str(item).lower() if isinstance(item, bool) else str(item), "lang": None, "datatype": full(declared) if declared else XSD + kind})]

        def listed(items: list, declared: str | None) -> str:
            cells = []
            for item in items:
                for o, lit in objects(item, declared):
                    cells.append(blank())
                    out.append({"graph": graph, "uri": None, "s": cells[-1], "p": FIRST, "o": o, "lit": lit})
            chain, head = _cells(cells, graph)
            out.extend(chain)
            return head

        def backwards(verb: str, value) -> None:
            for item in many(value):
                for s, _ in objects(item, "@id"):
                    if s is not None:
                        out.append({"graph": graph, "uri": None, "s": s, "p": verb, "o": subject, "lit": None})

        subject = full(node["@id"]) if "@id" in node else blank()
        for key, value in node.items():
            if key in ("@context", "@id"):
                continue
            if key == "@graph":
                for child in many(value):
                    visit(child, terms, subject if "@id" in node else graph)
                continue
            if key == "@reverse":
                for verb, items in value.items():
                    backwards(full(verb), items)
                continue
            term = terms.get(key) if isinstance(terms.get(key), dict) else {}
            if "@reverse" in term:
                backwards(full(key), value)
                continue
            declared = "@id" if key == "@type" else term.get("@type")
            if term.get("@container") == "@list" and not (isinstance(value, dict) and "@list" in value):
                value = {"@list": value}
            for item in many(value):
                for o, lit in objects(item, declared):
                    out.append({"graph": graph, "uri": None, "s": subject, "p": TYPE if key == "@type" else full(key), "o": o, "lit": lit})
        return subject

    data = json.loads(text)
    for node in data if isinstance(data, list) else [data]:
        visit(node, {}, "")
    return out


def unpacked(content: bytes) -> str:
    """The text of a plain, gzipped or zipped file."""
    if content[:2] == b"\x1f\x8b":
        content = gzip.decompress(content)
    elif content[:4] == b"PK\x03\x04":
        with zipfile.ZipFile(io.BytesIO(content)) as z:
            content = b"\n".join(z.read(n) for n in z.namelist())
    return content.decode("utf-8")


def named_triples(rows: list[dict]) -> list[dict]:
    """A subject urn:triple:s:p:o gives its triple that name."""
    for r in rows:
        if (r["s"] or "").startswith("urn:triple:"):
            r["uri"] = r["s"]
    return rows


def _whole(parse):
    def load(spark: SparkSession, path: str, apart: bool = False) -> DataFrame:
        """A file is one task's work.  Blank nodes have the names that their file gives them; ``apart`` adds the file, so
        that nodes of several files are told apart."""

        def run(batches):
            for batch in batches:
                for name, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist(), strict=True):
                    rows = named_triples(parse(unpacked(content)))
                    if apart:
                        own = f"_:{hashlib.md5(name.encode()).hexdigest()}-"
                        for row in rows:
                            row |= {c: own + row[c][2:] for c in ("s", "o") if (row[c] or "").startswith("_:")}
                    for at in range(0, len(rows), 5_000):
                        yield pa.RecordBatch.from_pylist(rows[at : at + 5_000], schema=_ARROW)

        return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, SCHEMA)

    return load


turtle, trix_zipped, jsonld = _whole(parse_turtle), _whole(parse_trix), _whole(parse_jsonld)


def trix(spark: SparkSession, path: str, split: int = SPLIT) -> DataFrame:
    """Triples of plain or gzipped files, of which large ones are read by several tasks; the graph of a triple is the uri
    that its graph begins with.  A zipped file is one task's work."""
    if path.endswith(".zip"):
        return trix_zipped(spark, path)
    graph = r"<(?:\w+:)?graph\b[^>]*>\s*(?:<(?:\w+:)?uri>([^<]*)</(?:\w+:)?uri>)?"
    found = records(spark, path, r"<(?:\w+:)?triple\b", "triple>", graph, split)

    def run(batches):
        for batch in batches:
            rows = []
            for graph, record in zip(batch.column("context").to_pylist(), batch.column("record").to_pylist(), strict=True):
                bare = re.sub(r"(</?)\w+:(?=\w+[\s>/])", r"\1", record)
                own = f"<TriX><graph><uri>{graph or ''}</uri>{bare}</graph></TriX>"
                rows += named_triples(parse_trix(own))
            yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)

    return found.select("context", "record").mapInArrow(run, SCHEMA)
