"""What an executor holds at once in the pipeline: batches of bounded bytes, one Python worker a task."""

from __future__ import annotations

import pyarrow as pa
import pytest

import corpus_pipeline
from martflow.llm.common import SLICE_BYTES, small_batches

from . import cases

KEY = "spark.sql.execution.arrow.maxBytesPerBatch"


@pytest.fixture
def roomy(spark):
    """A session with Spark's own batches."""
    before = spark.conf.get(KEY)
    spark.conf.set(KEY, "64m")
    yield spark
    spark.conf.set(KEY, before)


def test_stages_send_small_batches(roomy):
    large = roomy.range(24, numPartitions=1).selectExpr("id doc_id", "repeat('many words ', 100000) text", "'en' lang", "'s' source", "1100000L n_chars")
    corpus_pipeline.cut_lines(roomy, large, "")

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": pa.array([batch.num_rows], pa.int64())})

    rows = [r["n"] for r in large.mapInArrow(sizes, "n bigint").collect()]
    assert sum(rows) == 24 and max(rows) <= 4  # the row that fills a batch is its last


def test_a_smaller_size_of_the_session_stays(roomy):
    roomy.conf.set(KEY, "1MB")
    small_batches(roomy)
    assert roomy.conf.get(KEY) == "1MB"
    roomy.conf.set(KEY, "1g")
    small_batches(roomy)
    assert roomy.conf.get(KEY) == str(SLICE_BYTES)


def test_texts_are_not_encoded_and_decoded_in_one_task(roomy):
    docs = roomy.createDataFrame(cases.rows(), cases.SCHEMA)
    found = corpus_pipeline.tokenize(roomy, docs, "")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1
    assert found.count() == len(cases.rows())
