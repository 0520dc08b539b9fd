"""Full texts to child nodes: a code for each record, counters, and records that come again."""

from medloom.operators import nodes
from medloom.sinks.keyed import KeyedTable


def test_codes_counters_and_reruns(spark, tmp_path):
    records = spark.createDataFrame([(1, True), (2, False), (3, True), (4, True), (5, True), (6, True), (7, None)], "record_id bigint, abstract_ok boolean")
    locations = spark.createDataFrame([(k, f"at/{k}") for k in (1, 2, 4, 5, 6, 7)] + [(3, None)], "record_id bigint, location string")
    sections = spark.createDataFrame([(1, "1", "One sentence here. Another one."), (1, "2", "More of it."), (2, "1", "Not wanted."), (3, "1", "No location."), (5, "1", "  "), (6, "1", "Good. " * 4), (6, "2", "broken"), (9, "1", "No record.")], "record_id bigint, head string, section_text string")
    broken = lambda t: None if "broken" in t else nodes.hashed_vector(t)
    index, results = f"file://{tmp_path}/index", f"file://{tmp_path}/results"
    counts = nodes.ingest_children(records, locations, sections, index, results, size=5, overlap=2, dense=broken)
    got = {r["record_id"]: (r["code"], r["n_nodes"]) for r in spark.read.parquet(results).collect()}
    c = nodes.CODES
    assert got == {1: (c["ok"], 2), 2: (c["bad_abstract"], 0), 3: (c["no_location"], 1), 4: (c["no_full_text"], 0), 5: (c["empty"], 0), 6: (c["embedding_failed"], 2), 7: (c["bad_abstract"], 0)}
    assert counts["records"] == 7 and counts["nodes"] == 5 and counts["ok"] == 1 and counts["bad_abstract"] == 2 and counts["embedding_failed"] == 1 and counts["index_failed"] == 0
    stored = KeyedTable(spark, index).read()
    assert {r["record_id"] for r in stored.collect()} == {1, 3} and stored.count() == 3
    # again: the nodes of records that come replace what they had, and a service that works now is heard
    counts = nodes.ingest_children(records, locations, sections.where("record_id <> 3"), index, results, size=100, overlap=2)
    assert counts["ok"] == 2 and {(r["record_id"], r["head"]) for r in KeyedTable(spark, index).read().collect()} == {(1, "1"), (1, "2"), (3, "1"), (6, "1"), (6, "2")}
