"""Every stage of the pipeline against a plain restatement of it."""
import re

import brute
import corpus_pipeline
from pyspark.sql import functions as F

from wardline.llm import piece_sampling, toxicity
from wardline.llm.mix_sources import mix

SF = "/root/testdata/sf0.001"


def test_stages(spark, workdir):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, inputs, outputs = docs.columns, {}, {}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{workdir}/{i}")
        inputs[name], outputs[name] = docs, spark.read.parquet(f"{workdir}/{i}")
        assert name == "tokenise" or outputs[name].columns == columns
        docs = outputs[name]
    assert len(inputs) == 5
    ids = lambda df: sorted(r[0] for r in df.select("doc_id").collect())
    texts = {k: {r["doc_id"]: r["text"] for r in v.collect()} for k, v in inputs.items()}

    model = toxicity.train(inputs["toxicity"], spark.read.parquet(f"{SF}/labels.parquet"))
    pair = model.compressors()
    clean = [i for i, t in texts["toxicity"].items() if sum(a * b for a, b in zip(toxicity._features(t, *pair), model.weights)) < 0]
    assert ids(outputs["toxicity"]) == sorted(clean)

    first: dict = {}
    for i, t in sorted(texts["exact_dedup"].items()):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), i)
    assert ids(outputs["exact_dedup"]) == sorted(first.values())

    groups = brute.ngram_groups(texts["near_dedup"].items())
    assert ids(outputs["near_dedup"]) == sorted(i for i, (_, c) in groups.items() if i == c)

    copies = {r["doc_id"]: r["copies"] for r in mix(inputs["mix_sources"]).collect()}
    assert ids(outputs["mix_sources"]) == sorted(i for i, n in copies.items() for _ in range(n))

    vocab = piece_sampling.vocabulary(piece_sampling.DEFAULT_MODEL, 1.0)
    for r in outputs["tokenise"].select("doc_id", "ids", F.size("ids").alias("n"), "n_ids").collect():
        assert r["n"] == r["n_ids"] and piece_sampling.decode(__import__("numpy").array(r["ids"]), vocab) == texts["tokenise"][r["doc_id"]]
    assert ids(outputs["tokenise"]) == ids(inputs["tokenise"])
