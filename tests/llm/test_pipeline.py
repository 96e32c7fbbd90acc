"""The stages in order, each on what the one before kept."""

import corpus_pipeline
from tests.llm.test_operators import SCHEMA, rows
from vitalmart.llm import language_id, minmax_dedup, mixing, substring_dedup


def test_stages(spark, tmp_path):
    docs = spark.createDataFrame([r for r in rows() if r[0] is not None], SCHEMA).drop("size", "row", "part")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_dedup", "substring", "mix", "pack"]
    kept, read = {}, docs
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, read, str(tmp_path)).write.parquet(f"{tmp_path}/{name}")
        read = kept[name] = spark.read.parquet(f"{tmp_path}/{name}")
        if name != "pack":
            assert sorted(read.columns) == sorted(docs.columns)
    ids = {n: sorted(r.doc_id for r in d.select("doc_id").collect()) for n, d in kept.items()}
    assert 3 not in ids["language"] and 8 not in ids["language"] and 1 in ids["language"]  # null, no letters
    assert len(set(ids["near_dedup"])) == len(ids["near_dedup"]) and not {1, 2} & set(ids["near_dedup"])
    assert ids["substring"] == ids["near_dedup"]
    text = {r.doc_id: r.text for r in kept["substring"].collect()}
    assert text[14] == "This line is here five times.\n"
    assert set(ids["mix"]) <= set(ids["substring"])
    assert set(ids["pack"]) == set(ids["mix"])
    whole = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted(map(str, whole.drop("sequence_id", "offset").collect())) == sorted(
        map(str, kept["pack"].drop("sequence_id", "offset").collect()))
