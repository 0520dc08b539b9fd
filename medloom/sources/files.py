"""File lists, tab separated indexes, directory listings, archives and the choice of a reader."""

from __future__ import annotations

import gzip
import io
import tarfile

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medloom.functions.text import suffix

FILE_LIST = "article_file string, article_citation string, pmc_id string, last_update string, pmid string, license string, retracted string"


def file_list(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Rows of seven columns (tab separated, quoted by ", one header line) and, apart, the lines that are none."""
    lines = spark.read.text(path).select(F.col("value"), F.input_file_name().alias("file"), F.col("_metadata.file_block_start").alias("block"))
    fields = F.size(F.split(F.regexp_replace("value", '"[^"]*"', "q"), "\t"))
    parsed = lines.withColumn("n", fields).withColumn("r", F.from_csv("value", FILE_LIST, {"sep": "\t", "quote": '"'}))
    pmid = F.col("r.pmid").try_cast("bigint")
    header = F.lower("r.pmid").contains("pmid")
    good = (F.col("n") == 7) & (pmid.isNotNull() | (F.coalesce("r.pmid", F.lit("")) == ""))
    container = F.regexp_replace(F.element_at(F.split("file", "/"), -1), r"\.[^.]*$", "")
    rows = parsed.where(good & ~F.coalesce(header, F.lit(False))).select(
        container.alias("container"), "r.article_file", "r.article_citation", "r.pmc_id", pmid.alias("pmid"), F.try_to_timestamp("r.last_update", F.lit("yyyy-MM-dd HH:mm:ss")).cast("timestamp_ntz").alias("last_update"), "r.license", "r.retracted"
    )
    return rows, parsed.where(~good & ~F.coalesce(header, F.lit(False))).select(container.alias("container"), "value")


def index(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A tab separated index; one that does not exist is empty."""
    try:
        return spark.read.csv(path, sep="\t", schema=schema)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)


def separated(spark: SparkSession, path: str, schema: str, sep: str = ",") -> DataFrame:
    """A separated table with a header line, quoted by "; lines may stand within quotes."""
    return spark.read.csv(path, sep=sep, schema=schema, header=True, quote='"', escape='"', multiLine=True)


def listing(spark: SparkSession, folder: str, only: list[str] | None = None, ignored: list[str] | None = None) -> DataFrame:
    """name, path, remote (time stamp), suffix of a folder's files, by suffix; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path", F.col("modificationTime").cast("timestamp_ntz").alias("remote"), "length")
    files = files.withColumn("name", F.element_at(F.split("path", "/"), -1)).withColumn("suffix", suffix("name"))
    if only is not None:
        files = files.where(F.col("suffix").isin(only))
    return files.where(~F.col("suffix").isin(ignored)) if ignored else files


def newest(files: DataFrame, containing: str) -> DataFrame:
    """The last file by name that contains a text."""
    return files.where(F.contains("name", F.lit(containing))).orderBy(F.desc("name")).limit(1)


def first_matching(files: DataFrame, containing: str, order: str = "position") -> DataFrame:
    """The first of a page's links that contains a text."""
    return files.where(F.contains("name", F.lit(containing))).orderBy(order).limit(1)


def archive_entries(spark: SparkSession, path: str, ending: str | None = None, first: bool = False) -> DataFrame:
    """archive, position, name and content of the files in tar archives, plain or gzipped; only names with an ending, or
    only each archive's first such file.  An archive is one task's work."""

    def run(batches):
        for batch in batches:
            for where, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist(), strict=True):
                raw = gzip.decompress(content) if content[:2] == b"\x1f\x8b" else content
                with tarfile.open(fileobj=io.BytesIO(raw)) as tar:
                    for position, entry in enumerate(tar):
                        if entry.isfile() and (ending is None or entry.name.endswith(ending)):
                            body = tar.extractfile(entry).read()
                            yield pa.RecordBatch.from_pydict({"archive": [where], "position": pa.array([position], pa.int32()), "name": [entry.name], "content": [body]})
                            if first:
                                break

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(run, "archive string, position int, name string, content binary")


def reader(kind: str):
    """The function that reads a kind of source."""
    from medloom.sources import articles, jats, rdf

    known = {"pubmed": articles.read, "filelist": file_list, "archive": archive_entries, "ntriples": rdf.ntriples, "turtle": rdf.turtle, "trix": rdf.trix, "jsonld": rdf.jsonld, "jats": jats.read}
    if kind not in known:
        raise ValueError(f"no reader for {kind!r}: one of {sorted(known)}")
    return known[kind]
