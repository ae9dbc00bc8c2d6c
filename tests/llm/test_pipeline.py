"""The corpus pipeline: stages take effect on whole rows, and missing folders leave the rest importable."""
import __spark_entry__ as entry
import corpus_pipeline
from tramline.llm import minhash, mixing, quality_rank, toxicity
from tramline.llm.common import stored

SF = "/root/testdata/sf0.001"


def test_stages_one_by_one(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "quality", "near_dedup", "mixing", "sentencepiece"]
    outs = []
    now = docs
    for name, stage in corpus_pipeline.STAGES:
        now = stored(stage(spark, now, SF), name)
        outs.append(now)
        if name != "sentencepiece":
            assert now.columns == docs.columns
    ids = [sorted(r.doc_id for r in o.select("doc_id").collect()) for o in outs]
    assert ids[0] == sorted(r.doc_id for r in toxicity.clean(docs, labels).collect()) and len(ids[0]) < docs.count()
    assert ids[1] == sorted(r.doc_id for r in quality_rank.kept(outs[0], labels).collect()) and len(ids[1]) < len(ids[0])
    assert ids[2] == sorted(r.doc_id for r in minhash.near_duplicates(outs[1]).filter("kept").collect())
    want = [r.doc_id for r in mixing.copies(outs[2]).collect() for _ in range(r.copies)]
    assert ids[3] == sorted(want) and ids[4] == ids[3]
    final = outs[4].collect()
    assert all(r.decoded and r.n_ids == len(r.ids) for r in final)
    assert sorted(r.doc_id for r in corpus_pipeline.run(spark, SF).collect()) == ids[4]


def test_registered():
    names = entry.queries()
    assert "pipeline" in names
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{k}" for k in range(1, 14)}
    assert {"op8_source_mixing", "op10_url_filter", "op11_top_products", "op13_ranked_search"} <= set(entry.oracle_sql())
