import re
from array import array

import public_tokenizers
from test_dedup import brute
from test_text_ops import windows
from tokenizers import Tokenizer

import corpus_pipeline

SF = "/root/testdata/sf0.001"


def grams(text, n=5):
    words = (text or "").lower().split()
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}


def test_stages_equal_brute_force(spark):
    """Each stage on what its predecessor kept, against plain Python; the whole run against the last stage."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    toxic = {r["doc_id"] for r in spark.read.parquet(f"{SF}/labels.parquet").filter("toxic = 1").collect()}
    kept = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "minhash", "decontaminate", "bpe_codec"]
    frame = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        frame = stage(spark, frame, SF)
        assert frame.columns == docs.columns
        frame = spark.createDataFrame(frame.collect(), docs.schema)
        got = {r["doc_id"] for r in frame.select("doc_id").collect()}
        if name == "toxicity":
            assert got <= kept.keys() and len(toxic & (kept.keys() - got)) >= 0.9 * len(toxic)
            expected = got
        elif name == "exact_dedup":
            runs = {}
            for i in sorted(kept):
                runs.setdefault(re.sub("[\x20\x09-\x0d]+", " ", kept[i]), i)
            expected = set(runs.values())
        elif name == "minhash":
            expected = {i for i, (_, root) in brute(list(kept.items()), 5, 80).items() if i == root}
        else:
            own = {i: grams(t) for i, t in kept.items()}
            sought = [(i, t, grams(t)) for i, t in items]
            hit = {d for d in kept for i, t, g in sought if own[d] & g and windows([(d, kept[d])], [(i, t)])}
            assert hit
            expected = kept.keys() - hit
        assert got == expected, name
        kept = {i: kept[i] for i in got}
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = corpus_pipeline.run(spark, SF).collect()
    assert {r["doc_id"] for r in rows} == kept.keys()
    for r in rows:
        assert r["round_trip"] and r["decoded"] == kept[r["doc_id"]]
        assert array("I", r["token_ids"]).tolist() == library.encode(kept[r["doc_id"]], add_special_tokens=False).ids and r["n_tokens"] == len(r["token_ids"])
