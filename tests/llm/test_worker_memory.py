"""Token files: what executors and their Python workers hold while texts are read and ids are read back."""

from __future__ import annotations

import public_tokenizers
from tokenizers import Tokenizer

from medloom.llm import queries, textcols, token_files

READ = "spark.sql.parquet.columnarReaderBatchSize"


def test_texts_are_read_in_small_batches_and_readers_keep_no_encoder(spark, tmp_path):
    path = public_tokenizers.path("word_bpe_49k.json")
    rows = [(i, None if i % 50 == 3 else f"word{i} " * (i % 9) + "Größe <x>, don't 12") for i in range(200)] + [(None, "null id"), (7, "again")]
    spark.conf.unset(READ)
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/docs")
    files = token_files.write_token_files(spark.read.parquet(f"{tmp_path}/docs"), path, f"file://{tmp_path}/t", queries.WORD_IDS, files=3)
    assert spark.conf.get(READ) == "512"
    got = token_files.read_token_files(files, lambda ids: (ids.tolist(), len(textcols._held)), "ids array<bigint>, kept bigint").collect()
    assert {r["kept"] for r in got} == {0}
    tokenizer = Tokenizer.from_file(path)
    want = {(i, tuple([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1])) for i, t in rows}
    assert len(got) == len(rows) and {(r["doc_id"], tuple(r["ids"])) for r in got} == want


def test_a_batch_size_that_was_set_stays(spark, tmp_path):
    spark.conf.set(READ, "300")
    try:
        token_files.text_batches(spark)
        assert spark.conf.get(READ) == "300"
    finally:
        spark.conf.unset(READ)
