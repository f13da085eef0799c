import corpus_pipeline as C
from test_near import plain_components

from lumenframe.llm import decontaminate, secrets, toxicity
from lumenframe.llm.tokens import default_path

SF = "/root/testdata/sf0.001"


def test_stages_take_effect(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    for k, (name, stage) in enumerate(C.STAGES[:-1]):
        before = {r["doc_id"]: r for r in docs.collect()}
        stage(spark, docs, SF).write.parquet(str(tmp_path / str(k)))
        out = spark.read.parquet(str(tmp_path / str(k)))
        assert out.columns == columns
        after = {r["doc_id"]: r for r in out.collect()}
        if name == "toxicity":
            scored, struct = toxicity.score_toxicity(docs, spark.read.parquet(f"{SF}/labels.parquet"))
            kept = {r["doc_id"] for r in scored.collect() if r[struct]["score"] < 0.7}
        elif name == "simhash":
            kept = set(plain_components([(i, r["text"]) for i, r in before.items()]).values())
        elif name == "decontamination":
            matched, struct = decontaminate.find_matches(docs, spark.read.parquet(f"{SF}/benchmark.parquet"))
            bad = decontaminate.measured(matched, struct)["contaminated"]
            kept = {r["doc_id"] for r in matched.where(~bad).collect()}
        else:
            kept = set(before)
            assert secrets.find_secrets(out).where("size(base_spans) > 0").count() == 0
            changed = [i for i in kept if after[i]["text"] != before[i]["text"]]
            assert changed and all(after[i]["n_chars"] == len(after[i]["text"]) for i in changed)
        assert set(after) == kept
        if name != "secrets":
            assert all(after[i] == before[i] for i in kept)
        docs = out
    last = C.STAGES[-1][1](spark, docs, SF)
    assert {r["doc_id"] for r in last.select("doc_id").collect()} == set(after)


def test_run_and_odd_rows(spark, odd_docs, no_docs):
    assert C.run(spark, SF).count() > 0
    assert default_path().endswith("byte_bpe_50k.json")
    for docs in (odd_docs, no_docs):
        for _, stage in C.STAGES[:-1]:
            docs = stage(spark, docs, SF)
            assert docs.columns == odd_docs.columns
        assert (C.STAGES[-1][1](spark, docs, SF).count() > 0) == (docs.count() > 0)
