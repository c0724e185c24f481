import corpus_pipeline
import pandas as pd
from test_ngram_join import brute

from lowfold.llm import packing, pii, quality_rules, registered

SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, [docs.toPandas()]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path / str(k))
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        assert k == 4 or docs.columns == columns
        seen.append(docs.toPandas())
    start, sound, single, masked, mixed, packed = seen
    judged = quality_rules.judged(spark.read.parquet(f"{SF}/documents.parquet")).select("doc_id", "__kept").toPandas()
    assert set(sound.doc_id) == set(judged.doc_id[judged["__kept"]])
    good = pd.read_parquet(f"{SF}/labels.parquet").query("quality == 1").doc_id
    passes = start[start.text.map(lambda t: quality_rules.describe(t)[0] >= 50 and 2 * quality_rules.describe(t)[4] <= quality_rules.describe(t)[0])]
    assert set(passes.doc_id) & set(good) <= set(sound.doc_id)
    reach = brute(dict(zip(sound.doc_id, sound.text, strict=True)), 5, 80)
    assert sorted(single.doc_id) == sorted(k for k, (_, top) in reach.items() if k == top)
    assert dict(zip(masked.doc_id, masked.text, strict=True)) == {k: pii.masked(t) for k, t in zip(single.doc_id, single.text, strict=True)}
    assert (masked.n_chars == masked.text.str.len()).all()
    assert set(mixed.doc_id) <= set(masked.doc_id) and mixed.doc_id.value_counts().max() <= 3
    encoder = packing.Encoder(packing.tokenizer_json())
    tokens = sum(len(code) // 4 + 1 for code in encoder.encode(mixed.text.tolist()))
    assert packed.length.sum() == tokens and packed.groupby("sequence_id").length.sum().max() <= 2048
    assert packed.sequence_id.nunique() <= packing.lower_bound(packed.length.value_counts().to_dict(), 2048) + 1


def test_each_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in registered.QUERIES if n.startswith("op")) == list(range(1, 14))
    assert "pipeline" in registered.QUERIES and set(registered.SQL) <= set(registered.QUERIES)
    assert len(corpus_pipeline.STAGES) == 5
