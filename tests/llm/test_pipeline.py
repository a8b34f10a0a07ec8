"""The pipeline's stages against the operators' plain answers."""

import brute
import corpus_pipeline
import pytest

from trunkline.llm import registry, toxicity
from trunkline.llm.common import stored


@pytest.fixture(scope="module")
def folder(spark, sf_dir, edge, edge_rows, tmp_path_factory):
    """Edge cases as documents, with a benchmark and labels."""
    root = str(tmp_path_factory.mktemp("tables"))
    edge.write.parquet(f"{root}/documents.parquet")
    texts = {d: t for d, t in edge_rows if d is not None}
    items = [(1, " ".join(texts[14].split()[60:80])), (2, None), (3, "")]
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{root}/benchmark.parquet")
    spark.read.parquet(f"{sf_dir}/labels.parquet").write.parquet(f"{root}/labels.parquet")
    return root


def rows(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    items = rows(spark.read.parquet(f"{folder}/benchmark.parquet").withColumnRenamed("item_id", "doc_id"))
    given = rows(docs)
    for name, stage in corpus_pipeline.STAGES:
        out = stored(stage(spark, docs, folder), name)
        if name == "toxicity":
            labels = spark.read.parquet(f"{folder}/labels.parquet")
            named = docs.select("doc_id", "text")
            scores = toxicity.toxicity(named, labels).where("predicted = 1").select("doc_id")
            bad = {r.doc_id for r in scores.collect()}
        elif name == "exact_dedup":
            bad = {r[0] for r in brute.exact_rows(given) if not r[3]}
        elif name == "near_duplicates":
            found = brute.near_duplicates([(d, t) for d, t in given if d is not None])
            bad = {d for d, (_, c) in found.items() if d != c}
        elif name == "decontamination":
            bad = {r[0] for r in brute.contamination_rows(given, items) if r[-1]}
        else:
            assert {r.doc_id for r in out.select("doc_id").collect()} == {d for d, _ in given}
            break
        bad.discard(None)
        assert out.columns == columns
        assert brute.same_rows(rows(out), [(d, t) for d, t in given if d not in bad])
        docs, given = out, rows(out)
    assert len(given) < 100


def test_run(spark, folder):
    assert corpus_pipeline.run(spark, folder).count() > 0


def test_run_on_empty_documents(spark, empty, folder, tmp_path):
    empty.write.parquet(f"{tmp_path}/documents.parquet")
    for name in ("benchmark", "labels"):
        spark.read.parquet(f"{folder}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_registered_queries():
    names = registry.queries()
    assert [n for n in names if n.startswith("op")] == sorted(
        (n for n in names if n.startswith("op")), key=lambda n: int(n[2:].split("_")[0])
    )
    assert len(names) == 14 and "pipeline" in names
