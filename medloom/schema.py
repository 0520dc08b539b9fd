"""Tables declared as lists of fields: types, sizes, defaults and keys in one place."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KINDS = {"bigint": T.LongType(), "int": T.IntegerType(), "smallint": T.ShortType(), "text": T.StringType(), "varchar": T.StringType(), "timestamp": T.TimestampNTZType()}


@dataclass(frozen=True)
class Field:
    name: str
    kind: str
    size: int | None = None
    required: bool = False
    default: object = None

    def column(self, value: Column) -> Column:
        """The value cast, cut to size, with the default for null."""
        out = value.cast(KINDS[self.kind])
        if self.size:
            out = F.substring(out, 1, self.size)
        return (F.coalesce(out, F.lit(self.default).cast(KINDS[self.kind])) if self.default is not None else out).alias(self.name)


@dataclass(frozen=True)
class Table:
    name: str
    fields: tuple[Field, ...]
    keys: tuple[str, ...] = field(default=())

    def struct(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, KINDS[f.kind], not f.required) for f in self.fields])

    def project(self, rows: DataFrame, stamp: Column | None = None) -> DataFrame:
        """Rows in the table's shape; columns it does not know go, required ones that are null are rejected, and
        ``stamp`` adds a timestamp column."""
        out = rows.select(*[f.column(F.col(f.name) if f.name in rows.columns else F.lit(None)) for f in self.fields])
        for f in self.fields:
            if f.required:
                out = out.where(F.col(f.name).isNotNull())
        return out if stamp is None else out.withColumn("timestamp", stamp)


TASKS = Table("tasks", (Field("name", "varchar", 60, True), Field("state", "smallint"), Field("job", "varchar", 60), Field("timestamp", "timestamp")), ("name", "job"))
FULL_TEXT_TASKS = Table("full_text_tasks", (Field("identifier", "varchar", 60, True), Field("location", "varchar", 200), Field("year", "smallint"), Field("state", "smallint"), Field("timestamp", "timestamp")), ("identifier",))
AUTHORSHIPS = Table("authorships", (Field("publication_id", "bigint", None, True), Field("ordinal", "smallint"), Field("fore_name", "varchar", 40), Field("last_name", "varchar", 60), Field("initials", "varchar", 10), Field("affiliation", "varchar", 2000), Field("year_active", "smallint", None, False, 0), Field("email_address", "varchar", 60)), ("publication_id", "ordinal", "affiliation"))
REFERENCES = Table("references", (Field("article_id", "bigint", None, True), Field("reference", "varchar", 30), Field("reference_type", "smallint"), Field("ordinal", "int"), Field("citation", "varchar", 500, False, "")), ("article_id", "reference", "reference_type"))
LINKS = Table("links", (Field("source", "bigint", None, True), Field("target", "varchar", 100), Field("timestamp", "timestamp")), ("source",))
RECORDS = Table("records", (Field("identifier", "bigint", None, True), Field("year", "smallint"), Field("record", "text"), Field("origin", "varchar", 60)), ("identifier",))
FULL_TEXTS = Table("full_texts", (Field("identifier", "varchar", 20, True), Field("year", "smallint"), Field("record", "text")), ("identifier",))
LOCATIONS = Table("locations", (Field("container", "varchar", 30), Field("article_file", "varchar", 100), Field("article_citation", "varchar", 200), Field("pmc_id", "varchar", 30), Field("pmid", "bigint"), Field("last_update", "timestamp"), Field("license", "varchar", 30), Field("retracted", "varchar", 5)))
