import public_tokenizers as P
from tokenizers import Tokenizer

import corpus_pipeline as pipeline
from corpusloom.llm import pii, toxicity
from corpusloom.llm.common import surrogate_key

from .conftest import texts_of
from .test_others import components_brute


def test_stages_against_brute_force(spark, docs, sf_dir):
    """Each stage on its own input, then run() as a whole, on whole tables."""
    assert [n for n, _ in pipeline.STAGES] == ["toxicity", "near_duplicates", "surrogates", "packing"]
    (_, clean), (_, distinct), (_, private), (_, windows) = pipeline.STAGES
    first = clean(spark, docs, sf_dir).cache()
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    rows = texts_of(docs)
    scores = model.scorer()([t for _, t in rows])
    assert first.columns == docs.columns and sorted(texts_of(first)) == sorted(r for r, s in zip(rows, scores, strict=True) if s < 0.5)
    second = distinct(spark, first, sf_dir).cache()
    one = {(d, t) for (d, t), (_, _, _, kept) in zip(texts_of(first), components_brute(texts_of(first), 5, 80), strict=True) if kept}
    assert second.columns == docs.columns and sorted(texts_of(second)) == sorted(one)
    third = private(spark, second, sf_dir).cache()
    changed = {r.doc_id: r.text for r in pii.surrogates(second, surrogate_key(spark)).collect()}
    assert third.columns == docs.columns and dict(texts_of(third)) == changed
    assert all(r.n_chars == len(r.text) for r in third.select("text", "n_chars").collect())
    lib = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    want = {d: len(lib.encode(t, add_special_tokens=False).ids) + 1 for d, t in texts_of(third)}
    for packed in (windows(spark, third, sf_dir), pipeline.run(spark, sf_dir)):
        got: dict = {}
        for p in packed.collect():
            assert p.doc_tokens == want[p.doc_id]
            got[p.doc_id] = got.get(p.doc_id, 0) + p.length
        assert got == want


def test_pipeline_on_odd_rows(spark, odd, none, sf_dir):
    """Nulls, empty texts, repeated rows and clashing columns pass every stage; an empty table stays empty."""
    for df in (odd, none):
        for name, stage in pipeline.STAGES:
            out = stage(spark, df, sf_dir)
            assert name == "packing" or out.columns == df.columns
            out = out.cache()
            assert (out.count() == 0) == (df.count() == 0)
            if name != "packing":
                df = out
