"""Scalar functions of the bibliographic records, as column expressions."""

from __future__ import annotations

import re
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

MONTHS = ["january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december"]


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trimmed(c, size: int) -> Column:
    return F.substring(_col(c), 1, size)


def trimmed_list(c, size: int) -> Column:
    return F.transform(_col(c), lambda x: F.substring(x, 1, size))


def bulk_path(pmc) -> Column:
    """bulk/PMC + first three of the nine-digit number + xxxxxx/ + id + .xml"""
    digits = F.lpad(F.substring(_col(pmc), 4, 10), 9, "0")
    return F.concat(F.lit("bulk/PMC"), F.substring(digits, 1, 3), F.lit("xxxxxx/"), _col(pmc), F.lit(".xml"))


def storage_path(identifier, year) -> Column:
    """data/year/xx/yy/id: a level for the next two characters while more than four are left and these are
    alphanumeric, two levels at most."""
    c = _col(identifier)
    level = lambda x: (F.length(x) > 4) & x.rlike("^[A-Za-z0-9]{2}")
    rest = F.substring(c, 3, 1 << 20)
    one, two = F.concat(F.substring(c, 1, 2), F.lit("/")), F.concat(F.substring(rest, 1, 2), F.lit("/"))
    levels = F.when(level(c) & level(rest), F.concat(one, two)).when(level(c), one).otherwise(F.lit(""))
    return F.concat(F.lit("data/"), _col(year).cast("string"), F.lit("/"), levels, c)


def display_name(fore, initials, last) -> Column:
    """Initials replace the forename if it is the same without blanks; missing parts leave no blank."""
    f, i, n = _col(fore), _col(initials), _col(last)
    first = F.when(f.isNull(), i).when(F.replace(f, F.lit(" "), F.lit("")) == i, i).otherwise(f)
    return F.concat_ws(" ", first, n)


def month_number(text) -> Column:
    """0 to 11 of an English month or an unambiguous beginning of one, else null."""
    beginnings: dict[str, list[int]] = {}
    for k, name in enumerate(MONTHS):
        for n in range(1, len(name) + 1):
            beginnings.setdefault(name[:n], []).append(k)
    known = [(b, ks[0]) for b, ks in beginnings.items() if len(ks) == 1]
    table = F.create_map(*[F.lit(x) for pair in known for x in pair])
    return F.try_element_at(table, F.lower(F.trim(_col(text))))


def partial_date(year, month, day) -> Column:
    """A date of a year with January and the 1st for what is missing; months by number or name; null without a year
    or where the parts are no date."""
    number = F.coalesce(F.expr("1") * _col(month).try_cast("int"), month_number(month) + 1, F.lit(1))
    return F.call_function("try_to_date", F.concat_ws("-", F.lpad(_col(year).cast("string"), 4, "0"), F.lpad(number.cast("string"), 2, "0"), F.lpad(F.coalesce(_col(day).try_cast("int"), F.lit(1)).cast("string"), 2, "0")), F.lit("yyyy-MM-dd"))


def publication_date(*dates) -> Column:
    return F.date_format(F.coalesce(*[_col(d) for d in dates]), "yyyy-MM-dd")


NAME = r"[A-Za-z0-9!#$%&'*+/=?^_`{|}~.-]+"
EMAIL = NAME + r"@[A-Za-z0-9!#$%&'*+/=?^_`{|}~-]+(?:\.[A-Za-z0-9]+)+"


def emails(text) -> Column:
    return F.regexp_extract_all(_col(text), F.lit(f"({EMAIL})"), F.lit(1))


def without_emails(text) -> Column:
    """The text without addresses, their labels and the parentheses around them."""
    label = r"(?:(?:[Ee]-?mail|Electronic address):\s*)?"
    return F.trim(F.regexp_replace(_col(text), rf"\(?{label}{EMAIL}\)?", ""))


#: The public form: directory 10, dot-separated registrant codes of digits, a divider and any suffix.
_DOI = r"10\.\d+(?:\.\d+)*[/:%]\S+"


def doi(text) -> Column:
    """The DOI within a text or address, percent-decoded if it is an address; null without one."""
    plain = F.regexp_replace(_col(text), r"\s", "")
    plain = F.when(plain.rlike("(?i)^https?://"), F.try_url_decode(plain)).otherwise(plain)
    found = F.regexp_substr(plain, F.lit(_DOI))
    return F.when(found != "", found)


def dois(text) -> Column:
    """All DOIs between blanks of a text, without marks of the sentence behind them."""
    return F.transform(F.regexp_extract_all(_col(text), F.lit(f"({_DOI})"), F.lit(1)), lambda x: F.regexp_replace(x, r"[.,;)\]]+$", ""))


def is_doi(text) -> Column:
    """Whether the whole text is a DOI, with or without "doi:" before it in any case."""
    return F.coalesce(_col(text).rlike(rf"(?i)^(?:doi:)?{_DOI}$"), F.lit(False))


def doi_uri(text) -> Column:
    d = doi(text)
    return F.concat(F.lit("https://doi.org/"), F.regexp_replace(F.url_encode(d), "%2F", "/"))


def enumeration(text) -> Column:
    """Items of a list in words; at each place ", and ", "; and ", " and ", "," and ";" are tried in this order.  Nothing
    behind the last separator is no item; a text without characters has none."""
    raw = F.split(F.regexp_replace(_col(text), r"^\s+", ""), r", and |; and | and |,|;")
    real = F.when(F.element_at(raw, -1) == "", F.slice(raw, 1, F.greatest(F.size(raw) - 1, F.lit(0)))).otherwise(raw)
    return F.transform(real, lambda x: F.regexp_replace(x, r"^[\x00-\x20]+|[\x00-\x20]+$", ""))


def clean(text) -> Column:
    return F.trim(F.regexp_replace(_col(text), r"[\s\x{00A0}]+", " "))


def initials(names) -> Column:
    return F.array_join(F.transform(F.filter(F.split(_col(names), r"[ -]"), lambda x: x != ""), lambda x: F.upper(F.substring(x, 1, 1))), "")


def page_range(first, last) -> Column:
    f, n = F.coalesce(_col(first).cast("string"), F.lit("?")), F.coalesce(_col(last).cast("string"), F.lit("?"))
    return F.when((f == "?") & (n == "?"), F.lit(None)).when(f == n, f).otherwise(F.concat(f, F.lit("-"), n))


def cardinality(n) -> Column:
    return F.when(_col(n) == 0, "0").when(_col(n) == 1, "1").otherwise("N")


def joined(items, sep: str = ",") -> Column:
    return F.array_join(F.coalesce(_col(items), F.array()), sep)


def suffix(name) -> Column:
    """The last two extensions where the middle one has less than four characters and the last dot is past index 4,
    else the last; without a dot tmp."""
    n = F.lower(_col(name))
    two = F.regexp_extract(n, r"(\.[^.]{0,3}\.[^.]*)$", 1)
    one = F.regexp_extract(n, r"(\.[^.]*)$", 1)
    last_dot = F.length(n) - F.length(one)
    return F.when(one == "", F.lit("tmp")).when((two != "") & (last_dot > 4), two).otherwise(one)


def ordinal(name, known: dict[str, int]) -> Column:
    """The ordinal of an enum's name whatever its case; the first declared of equal names; else null."""
    lower: dict[str, int] = {}
    for k, v in known.items():
        lower.setdefault(k.lower(), v)
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in lower.items() for x in pair]), F.lower(_col(name)))


def prefix_encode(uri, prefixes: dict[str, str]) -> Column:
    """``prefix:rest`` by the longest known namespace that the address begins with, else the address."""
    u = _col(uri)
    ordered = sorted(prefixes.items(), key=lambda p: -len(p[1]))
    return reduce(lambda out, p: F.when(u.startswith(p[1]), F.concat(F.lit(p[0] + ":"), F.substring(u, len(p[1]) + 1, 1 << 20))).otherwise(out), reversed(ordered), u)


def prefix_decode(name, prefixes: dict[str, str]) -> Column:
    n = _col(name)
    space = F.try_element_at(F.create_map(*[F.lit(x) for p in prefixes.items() for x in p]), F.substring_index(n, ":", 1))
    return F.when(space.isNotNull() & F.contains(n, F.lit(":")), F.concat(space, F.expr("''"), F.regexp_replace(n, "^[^:]*:", ""))).otherwise(n)


#: Labels that go with an address (fixed values), and the characters of its name and of a domain's last part.
MAIL_LABELS = ("E-mail:", "Email:", "Electronic address:", "email:")
_MAIL_NAME = re.compile(r"[A-Za-z0-9!#$%&'*+/=?^_`{|}~.-]+@")
_MAIL_DOMAIN = re.compile(r"[A-Za-z0-9!#$%&'*+/=?^_`{|}~.-]*")


def _domain_length(run: str) -> int | None:
    """How much of a run of name characters is a domain: up to its end if letters and digits alone follow the last dot
    (the dot stays out if nothing does, unless it is the only one), else up to the last dot before which that held."""
    parts = run.split(".")
    if len(parts) < 2:
        return None
    plain = [x.isalnum() or not x for x in parts]
    stops = [k for k in range(1, len(parts) - 1) if plain[k]]
    until = lambda k: sum(len(x) + 1 for x in parts[: k + 1]) - 1
    if plain[-1]:
        return until(stops[-1]) if not parts[-1] and stops and stops[-1] == len(parts) - 2 else len(run)
    return until(stops[-1]) if stops else None


def split_mails(text: str) -> tuple[str, list[str]]:
    """The text without addresses, and the addresses.  A label before an address goes too, then parentheses around both,
    and a full stop, semicolon or comma before them where a full stop follows."""
    found, at = [], 0
    while m := _MAIL_NAME.search(text, at):
        run = _MAIL_DOMAIN.match(text, m.end())[0]
        length = _domain_length(run)
        at = m.end() if length is None else m.end() + length
        if length is not None:
            found.append((m.start(), at))
    kept, done = [], 0
    for begin, end in found:
        start = begin
        before = text[:start].rstrip()
        label = next((x for x in MAIL_LABELS if before.endswith(x)), None)
        if label:
            start = len(before) - len(label)
        if start and text[start - 1] == "(" and text[end : end + 1] == ")":
            start, stop = start - 1, end + 1
        else:
            stop = end
        if text[stop:].lstrip().startswith("."):
            bare = len(text[:start].rstrip())
            start = bare - 1 if bare and text[bare - 1] in ".;," else bare
        kept.append(text[done : max(done, start)])
        done = stop
    return ("".join(kept) + text[done:]).strip() if found else text, [text[a:b] for a, b in found]


def bracketed(text: str) -> list[tuple[int, int, int]]:
    """Ranges in (), [] or <> as start, end (behind the closing sign) and depth, outer before inner.  A closing sign of
    another kind than the last opening one counts for nothing; of ranges that are never closed only what the innermost
    of them holds is there."""
    closing = {"(": ")", "[": "]", "<": ">"}
    open_: list[tuple[str, int, list]] = []
    whole: list = []
    for at, sign in enumerate(text):
        if sign in closing:
            open_.append((closing[sign], at, []))
        elif open_ and sign == open_[-1][0]:
            _, start, inner = open_.pop()
            (open_[-1][2] if open_ else whole).append((start, at + 1, inner))
    if open_:
        whole += open_[-1][2]
    out: list[tuple[int, int, int]] = []
    todo = [(x, 0) for x in reversed(whole)]
    while todo:
        (start, end, inner), depth = todo.pop()
        out.append((start, end, depth))
        todo += [(x, depth + 1) for x in reversed(inner)]
    return out


def with_python(rows: DataFrame, column: str, fields: str, f) -> DataFrame:
    """``rows`` with the fields that ``f`` gives for each text, in Arrow batches; null gives nulls."""
    names = [x.split()[0] for x in re.split(r",\s*(?![^<]*>)", fields)]
    own = ", ".join(f"`{x.name}` {x.dataType.simpleString()}" for x in rows.schema.fields)
    kinds = [to_arrow_type(x.dataType) for x in rows.sparkSession.createDataFrame([], fields).schema.fields]

    def run(batches):
        for batch in batches:
            made = [f(t) if t is not None else (None,) * len(names) for t in batch.column(batch.schema.get_field_index(column)).to_pylist()]
            extra = [pa.array([m[k] for m in made], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *extra], names=[*batch.schema.names, *names])

    return rows.mapInArrow(run, f"{own}, {fields}")


def without_mails(rows: DataFrame, text: str) -> DataFrame:
    """``rows`` with stripped and mails, by the exact scanner."""
    return with_python(rows, text, "stripped string, mails array<string>", split_mails)


def with_brackets(rows: DataFrame, text: str) -> DataFrame:
    """``rows`` with brackets, the bracketed ranges of a text."""
    ranges = lambda t: ([dict(zip(("start", "end", "depth"), r, strict=True)) for r in bracketed(t)],)
    return with_python(rows, text, "brackets array<struct<start:int,end:int,depth:int>>", ranges)


def json_value(c) -> Column:
    """Any value as JSON text; null is null there too."""
    return F.coalesce(F.regexp_extract(F.to_json(F.array(_col(c)), {"ignoreNullFields": "false"}), r"(?s)^\[(.*)\]$", 1), F.lit("null"))


def path_join(a, b, separator: str = "/") -> Column:
    return F.when(F.endswith(_col(a), F.lit(separator)), F.concat(_col(a), _col(b))).otherwise(F.concat(_col(a), F.lit(separator), _col(b)))


def quoted(c) -> Column:
    """Single quotes doubled, as SQL text wants them."""
    return F.replace(_col(c), F.lit("'"), F.lit("''"))


def parameters(pairs: dict[str, object]) -> Column:
    """name=value pairs of a query, encoded and joined by &."""
    return F.concat_ws("&", *[F.concat(F.url_encode(F.lit(k)), F.lit("="), F.url_encode(_col(v))) for k, v in pairs.items()])


def embedding_text(*values) -> Column:
    """Values as one text, blanks between them; a null one reads None."""
    return F.concat_ws(" ", *[F.coalesce(_col(v).cast("string"), F.lit("None")) for v in values])


#: States of tasks by the response to a request, and by the status of a retrieval (fixed values).
RESPONSE_STATES = {"Ok": "Completed", "Unavailable": "Unavailable"}
RETRIEVAL_STATES = {"Seen": "Queued", "Open": "InProgress", "Error": "Failed", "Success": "Completed"}


def mapped_state(status, states: dict[str, str], known: dict[str, int], other: str | None = None) -> Column:
    """The ordinal of the state that a status stands for; ``other`` is the state of any not named."""
    found = F.try_element_at(F.create_map(*[F.lit(x) for k, v in states.items() for x in (k, known[v])]), _col(status))
    return F.coalesce(found, F.lit(known[other] if other else None)).cast("smallint")


def typed_literal(value) -> Column:
    """A number as a literal: its text and the type's address."""
    c = _col(value)
    kind = F.when(F.typeof(c).isin("double", "float"), F.lit("double")).otherwise(F.lit("integer"))
    return F.struct(c.cast("string").alias("value"), F.lit(None).cast("string").alias("lang"), F.concat(F.lit("http://www.w3.org/2001/XMLSchema#"), kind).alias("datatype"))
