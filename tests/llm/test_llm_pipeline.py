"""The pipeline's stages against their operators, and the registration."""

import corpus_pipeline
from seatcast.llm import langid, mixing, packing, quality, simhash


def ids(df):
    return sorted((r[0] is not None, r[0] or 0) for r in df.select("doc_id").collect())


def test_stages_take_effect(spark, docs, labels, tmp_path):
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    sf, d = str(tmp_path), docs
    for name, step in corpus_pipeline.STAGES:
        out = step(spark, d, sf)
        if name == "language":
            want = langid.identify(d).where("accepted")
        elif name == "quality":
            want = quality.classify(d, labels).where("predicted = 1")
        elif name == "near_duplicates":
            got = simhash.near_duplicates(d)
            assert out.count() == got.select("component_id").distinct().count()
        elif name == "source_mix":
            assert out.count() == mixing.copies(d).agg({"copies": "sum"}).first()[0]
        else:
            assert out.where("start = 0").count() == d.count()
            break
        if name in ("language", "quality"):
            assert ids(out) == ids(want)
        assert out.columns == docs.columns and 0 < out.count() <= 3 * d.count()
        out.write.parquet(str(tmp_path / name))
        d = spark.read.parquet(str(tmp_path / name))
    whole = corpus_pipeline.run(spark, sf)
    assert whole.count() == out.count() > 0


def test_empty_tables_pass_through(spark, no_docs, labels, tmp_path):
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    no_docs.write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_registered():
    import __spark_entry__ as entry
    names = set(entry.queries())
    assert {f"op{n}_" for n in range(1, 11)} <= {n.split("_")[0] + "_" for n in names if n.startswith("op")}
    assert "pipeline" in names and {"op3_topk", "op7_mixing"} <= set(entry.oracle_sql())
    assert packing.LENGTH == 2048
