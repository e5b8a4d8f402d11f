"""The stages on a small corpus: what must go goes, and nothing else."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tripgrid.llm.queries import QUERIES

from . import brute


@pytest.fixture(scope="module")
def stages(spark, sf_dir, tmp_path_factory):
    folder = tmp_path_factory.mktemp("stages")
    docs, out = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out.append(docs)
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{number}")
        docs = spark.read.parquet(f"{folder}/{number}")
    return [*out, docs]


def _pairs(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


def test_columns(stages):
    for docs in stages[1:-1]:
        assert docs.columns == stages[0].columns


def test_quality_keeps_good_documents(spark, sf_dir, stages):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    shares = {r.good: r.share for r in stages[0].join(labels, "doc_id").join(
        stages[1].select("doc_id", F.lit(1).alias("kept")), "doc_id", "left").groupBy(
        ((F.col("quality") == 1) & (F.col("toxic") == 0)).alias("good")).agg(F.avg(F.coalesce("kept", F.lit(0))).alias("share")).collect()}
    assert shares[True] > 0.97 and shares[False] < 0.25


def test_one_document_of_each_group(stages):
    before, after = _pairs(stages[1]), _pairs(stages[2])
    want = [(d, t) for (d, t), (_, k, _, _) in zip(before, brute.links(before)) if not brute.shingles(t) or d == k]
    assert sorted(after, key=repr) == sorted(want, key=repr)


def test_contaminated_documents_go(spark, sf_dir, stages):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    before = _pairs(stages[2])
    want = [p for p, r in zip(before, brute.contamination(before, items)) if not r[4]]
    assert sorted(_pairs(stages[3]), key=repr) == sorted(want, key=repr)


def test_secrets_are_masked(stages):
    before, after = dict(_pairs(stages[3])), dict(_pairs(stages[4]))
    assert before.keys() == after.keys()
    assert not any(brute.secrets(t) for t in after.values())
    assert all(after[d] == t for d, t in before.items() if not brute.secrets(t))


def test_all_is_packed(stages):
    lengths = stages[5].groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end"))
    assert lengths.filter("n != end or n > 1024").isEmpty()
    assert {r.doc_id for r in stages[5].collect()} == {d for d, _ in _pairs(stages[4])}


def test_run_is_the_stages(spark, sf_dir, stages):
    assert corpus_pipeline.run(spark, sf_dir).select("doc_id", "piece").exceptAll(stages[5].select("doc_id", "piece")).isEmpty()


def test_whole_tables(spark, sf_dir):
    """Queries with one row per row of their table return all of them."""
    counts = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet").count() for t in ("documents", "pages")}
    for name, query in QUERIES.items():
        if not name.startswith(("op7_", "op11_", "op13_", "quality_")):
            assert query(spark, sf_dir).count() == counts["pages" if name.startswith(("op2_", "op10_")) else "documents"], name


def test_stages_leave_only_the_result(spark, sf_dir, monkeypatch):
    """Tables of a stage go once it is written, and its input with them."""
    made, removed = [], []
    plain, remove = corpus_pipeline.Staging.__init__, corpus_pipeline.Staging.remove
    monkeypatch.setattr(corpus_pipeline.Staging, "__init__", lambda self, s: (plain(self, s), made.append(self.root))[0])
    monkeypatch.setattr(corpus_pipeline.Staging, "remove", lambda self: (remove(self), removed.append(self.root))[0])
    result = corpus_pipeline.run(spark, sf_dir)
    assert len(set(made) - set(removed)) == 1 and result.count() > 0


def test_odd_tables(spark, sf_dir):
    """No document, and documents with nulls, repeated rows and columns named like the operators' own."""
    names = ("judged_id", "_judged_id", "__postings", "_row", "words", "key", "text_hash", "kept", "component")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("*", *[F.lit(6).alias(n) for n in names])
    odd = docs.limit(0)
    for text in (None, "", " \n"):
        odd = odd.unionByName(docs.limit(1).withColumn("text", F.lit(text).cast("string")))
    some = docs.filter("doc_id < 40")
    odd = odd.unionByName(some).unionByName(some).unionByName(some.withColumn("doc_id", F.lit(None).cast(docs.schema["doc_id"].dataType)))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        for table in (docs.limit(0), odd):
            out = stage(spark, table, sf_dir)
            assert out.columns == docs.columns, name
            assert (out.count() > 0) == (table is odd), name
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), sf_dir).count() == 0
