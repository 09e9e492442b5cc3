"""What a Python worker keeps, and where texts with one key go."""

import pyarrow as pa
from pyspark.sql import functions as F

from conftest_llm import make_docs
from tenderspark.llm import bpe, simhash
from tenderspark.llm.q_text import vocabulary


def test_a_task_of_another_operator_frees_the_encoder(spark, corpus):
    """Encoders had stayed in the workers beside the next stages' memory."""
    docs = make_docs(spark, corpus)

    class Steps:  # runs the step of sketches() here, as in a worker that has encoded before
        def select(self, *columns):
            self.rows = docs.select(*columns)
            return self

        def mapInArrow(self, rows, schema):  # noqa: N802
            return list(rows(iter(self.rows.toArrow().to_batches())))

        sparkSession = spark  # noqa: N815

    bpe.encoder(vocabulary()).rows_of([b"some words"])
    assert bpe._ENCODERS
    found = pa.Table.from_batches(simhash.sketches(Steps(), "doc_id", "text", 4, True))
    assert not bpe._ENCODERS
    assert sorted(found["fp"].to_pylist()) == sorted(r.fp for r in simhash.sketches(docs, "doc_id", "text", 4, True).collect())


def test_hot_keys_are_dealt_without_a_rebalance(spark):
    """A rebalance had cut the texts into tasks of the advisory size, thousands where that is small."""
    rows = [(i, "the red bolt of steel and the ring " * 3 if i % 3 else f"text {i} of the table", "en") for i in range(6000)]
    docs = make_docs(spark, rows).repartition(3, "doc_id")
    shares = bpe.hot_keys(docs.select("doc_id", F.col("text").cast("binary").alias("text")))
    assert list(shares.values()) == [3] and list(shares) == [bpe.meeting_key(rows[1][1].encode())]
    for key, value in {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k", "spark.sql.adaptive.coalescePartitions.enabled": "false"}.items():
        spark.conf.set(key, value)
    try:
        found = bpe.encode_documents(docs, vocabulary(), digests=True)
        found = found.withColumn("task", F.spark_partition_id()).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes"), spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    enc = bpe.ChunkEncoder(vocabulary())
    assert sorted(r.doc_id for r in found) == list(range(6000)) and {r.task for r in found} <= set(range(4))
    assert {r.n_tokens for r in found if r.doc_id % 3} == {len(enc.library([rows[1][1].encode()])[0])}
    assert len({r.task for r in found if r.doc_id % 3}) > 1  # the copies are in several tasks
