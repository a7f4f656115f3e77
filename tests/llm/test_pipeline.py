"""The pipeline hands written tables from stage to stage."""

import os

import corpus_pipeline


def test_each_stage_reads_the_table_that_the_one_before_wrote(spark, small_dir, monkeypatch):
    seen = []

    def stage(spark, docs, sf_dir):
        seen.append(docs.inputFiles())
        return docs.where("doc_id > 0")

    monkeypatch.setattr(corpus_pipeline, "STAGES", [("one", stage), ("two", stage)])
    out = corpus_pipeline.run(spark, small_dir)
    assert [os.path.basename(os.path.dirname(f[0])) for f in (seen[1], out.inputFiles())] == ["one", "two"]
