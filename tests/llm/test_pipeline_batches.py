import corpus_pipeline
from changeguard import session


def test_stages_hand_python_batches_of_bounded_size(spark, monkeypatch, tmp_path):
    before = spark.conf.get(session.BATCH_SETTING, None)
    monkeypatch.setattr(corpus_pipeline.toxicity, "drop_toxic", lambda docs, labels: docs)
    monkeypatch.setattr(corpus_pipeline.decontaminate, "decontaminate", lambda docs, items: docs)
    monkeypatch.setattr(corpus_pipeline.packing, "pack", lambda docs: docs)
    docs = spark.range(1)
    for name in ("labels", "benchmark"):
        docs.write.parquet(f"{tmp_path}/{name}.parquet")
    try:
        for stage in (corpus_pipeline.not_toxic, corpus_pipeline.decontaminated, corpus_pipeline.packed):
            spark.conf.unset(session.BATCH_SETTING)
            stage(spark, docs, str(tmp_path))
            assert spark.conf.get(session.BATCH_SETTING) == str(session.BATCH_BYTES)
            spark.conf.set(session.BATCH_SETTING, "1000")  # a setting of the session's own stays
            stage(spark, docs, str(tmp_path))
            assert spark.conf.get(session.BATCH_SETTING) == "1000"
    finally:
        spark.conf.unset(session.BATCH_SETTING) if before is None else spark.conf.set(session.BATCH_SETTING, before)
