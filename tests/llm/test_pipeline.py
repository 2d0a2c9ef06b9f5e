import random

import corpus_pipeline as C
from changeguard.session import written


def test_each_stage_decides_and_clean_documents_stay(spark, rows, tmp_path):
    rng = random.Random(12)
    plain = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(600)]
    some = lambda n: [rng.choice(plain) for _ in range(n)]
    texts, labels = {}, []
    for i in range(600):
        w = some(60)
        if i % 5 == 0:
            w[3], w[30] = "vile", "rotten"
        labels.append((i, 1, int(i % 5 == 0)))
        texts[i] = " ".join(w)
    item = " ".join(some(25))
    clean = " ".join(some(200))
    texts |= {1001: clean, 1002: clean.upper(), 1003: clean + " tail", 1004: f"{texts[1]} {item}", 1005: None, 1006: ""}
    docs = [(i, t, "en", "s", len(t or "")) for i, t in texts.items()]
    rows(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    rows(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    rows([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs, left = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage in C.STAGES:
        before = docs.columns
        docs = written(stage(spark, docs, str(tmp_path)), name)
        left[name] = {r.doc_id for r in docs.select("doc_id").collect()}
        assert name == "packing" or docs.columns == before
    honest = {i for i in range(600) if i % 5}
    assert not left["toxicity"] & {i for i in range(600) if i % 5 == 0} and len(honest - left["toxicity"]) < 6
    assert {1001, 1005} & left["exact_dedup"] == set() and {1002, 1006} <= left["exact_dedup"]
    assert left["near_dedup"] == left["exact_dedup"] - {1003}
    assert left["decontamination"] == left["near_dedup"] - {1004}
    assert left["packing"] == left["decontamination"]
    assert {r.doc_id for r in C.run(spark, str(tmp_path)).select("doc_id").collect()} == left["packing"]
