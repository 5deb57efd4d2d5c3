"""The pipeline against plain versions of its stages, each on its own input."""

import corpus_pipeline
import numpy as np
import pyarrow as pa
import pytest
from conftest import SMALL
from pyspark.sql import functions as F
from test_models_and_records import plain_contamination
from test_text_operators import plain_components, plain_fingerprint, plain_line_dedup

from rowloom.llm import stringkernel
from rowloom.session import BATCH_BYTES, bounded_batches


def held(df):
    return {r.doc_id: r for r in df.collect()}


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    made = [docs]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp(name) / "out")
        stage(spark, docs, SMALL).write.parquet(path)
        docs = spark.read.parquet(path)
        made.append(docs)
    return made


def test_stages_keep_the_columns_of_documents(steps):
    for step in steps[1:-1]:
        assert step.columns == steps[0].columns
    assert "doc_id" in steps[-1].columns


def test_language_rejects_texts_without_letters_only(steps):
    before, after = held(steps[0]), held(steps[1])
    assert set(after) == {i for i, r in before.items() if r.text and any(c.isalpha() for c in r.text)}


def test_documents_carry_the_predicted_language(spark, steps):
    """The label of some documents is taken away; the stage puts in what the text says."""
    docs = steps[0].withColumn("lang", F.expr("CASE WHEN doc_id % 10 IN (1, 2) THEN NULL ELSE lang END"))
    true = {r.doc_id: r.lang for r in steps[0].collect()}
    after = held(corpus_pipeline.language(spark, docs, SMALL))
    changed = [i for i in after if i % 10 in (1, 2) and len(after[i].text) > 200]
    assert len(changed) > 10 and sum(after[i].lang == true[i] for i in changed) > 0.9 * len(changed)
    last = held(steps[-1])
    assert all(last[i].lang == held(steps[1])[i].lang for i in list(last)[:20])


def test_line_dedup_takes_effect(steps):
    before, after = held(steps[1]), held(steps[2])
    expected = plain_line_dedup(sorted((i, r.text) for i, r in before.items()))
    assert {i: r.text for i, r in after.items()} == {i: t for i, (t, n, gone) in expected.items() if not gone or gone < n}
    assert all(r.n_chars == len(r.text) for r in after.values())


def test_near_dedup_leaves_one_of_each_group(steps):
    before, after = held(steps[2]), held(steps[3])
    roots = plain_components({i: plain_fingerprint(r.text) for i, r in before.items()})
    assert set(after) == {i for i, root in roots.items() if i == root}


def test_decontamination_drops_what_is_contaminated(spark, steps):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    before, after = held(steps[3]), held(steps[4])
    assert set(after) == {i for i, _, hit, _ in plain_contamination([(i, r.text) for i, r in before.items()], items) if not hit}


def test_tokens_come_back(steps):
    assert set(held(steps[5])) == set(held(steps[4]))
    assert all(r.round_trip and r.n_tokens == len(r.ids) for r in steps[5].collect())


def test_run_applies_all_stages(spark, steps):
    got = held(corpus_pipeline.run(spark, SMALL))
    assert {i: r.ids for i, r in got.items()} == {i: r.ids for i, r in held(steps[5]).items()}


def test_pipeline_of_awkward_rows(spark):
    rows = [(1, None, "en", "s", 0), (2, "", None, None, None), (3, "12", "en", "s", 2), (None, "some words without an id", None, "s", 5), (4, "a b c", "en", "s", 5), (4, "a b c", "en", "s", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
    assert sorted((r.doc_id for r in docs.collect()), key=str) == [4, None]
    none = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        none = stage(spark, none, SMALL)
    assert none.collect() == []


def test_batches_of_the_pipeline_are_bounded(spark):
    """30 MB of text in one partition: no batch that a worker gets is much larger than BATCH_BYTES."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    docs = spark.range(0, 3000, numPartitions=1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("some words "), 1000).alias("text"), F.lit("en").alias("lang"), F.lit("s").alias("source"))

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], names=["n", "size"])

    for name_, stage in corpus_pipeline.STAGES:
        if name_ in ("language", "line_dedup", "near_dedup", "tokens"):
            spark.conf.unset(name)
            stage(spark, docs.limit(0).select(*docs.columns, F.lit(0).cast("long").alias("n_chars")), SMALL)
            got = docs.mapInArrow(sizes, "n long, size long").collect()
            assert sum(r.n for r in got) == 3000 and max(r.size for r in got) < BATCH_BYTES + (1 << 20)
    spark.conf.set(name, "1m")
    bounded_batches(spark)
    assert spark.conf.get(name) == "1m"  # a smaller limit stays
    spark.conf.set(name, before)


def test_language_starts_no_other_python_workers(spark):
    """The bounds of the sample are a local relation, not rows that a Python RDD brings."""
    parts = stringkernel._bounds(spark, {("en", False): (400, 9000), ("de", True): (3, 7)}, {("en", False): 0.3, ("de", True): 2.0})
    assert "ExistingRDD" not in parts._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, parts.collect())) == [("de", True, 3, 2.0), ("en", False, 400, 0.3)]


def test_tables_of_a_worker_stay_small():
    """All trigrams of the bytes that are left after folding, four bytes each, and no more."""
    model = stringkernel.train(["der die das und", "the and of it", "\u00e9t\u00e9 \U0001f600"], ["de", "en", "fr"], [0, 1, 2])
    found = stringkernel.tables(model)
    assert sum(t.nbytes for t in found.values()) < 16 << 20
    assert all(np.flatnonzero(found[n] >= 0).tolist() == model.grams[n].tolist() for n in found)
