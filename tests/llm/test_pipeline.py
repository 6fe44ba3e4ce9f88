"""The pipeline stage by stage against plain Python."""

import base64
import hashlib

import public_tokenizers
import tiktoken

import __spark_entry__ as entry
import corpus_pipeline
from vantage.llm.keys import toxicity_scorer

from .test_duplicates import expected_hits, roots, slow_print

SF = "/root/testdata/sf0.001"


def test_stage_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "simhash_dedup", "decontamination", "byte_bpe"]
    assert entry.queries()["pipeline"] is corpus_pipeline.run


def test_run_equals_plain_python(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    scorer = toxicity_scorer(spark, SF)
    left = [(i, t) for i, t in docs if scorer.score(t) < 0.3]
    last = {}
    for i, t in left:
        last[t or ""] = max(i, last.get(t or "", i))
    left = sorted((i, t) for i, t in left if last[t or ""] == i)
    found = roots([slow_print(t) for _, t in left], 2)
    left = [d for k, d in enumerate(left) if found[k] == k]
    clean = {i for i, *_, hit in expected_hits(left, items) if not hit}
    left = [(i, t) for i, t in left if str(i) in clean]
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb"))}
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = []
    for i, t in left:
        ids = encoding.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    got = corpus_pipeline.run(spark, SF).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()
    assert sorted(tuple(r) for r in got) == sorted(want) and len(want) < len(docs)


def test_stages_keep_columns_and_take_empty_tables(spark, odd, empty):
    for rows in (odd, empty):
        for name, step in corpus_pipeline.STAGES[:-1]:
            out = step(spark, rows, SF)
            assert out.columns == rows.columns, name
            assert (out.count() > 0) == (rows is odd), name
        assert (corpus_pipeline.encode(spark, rows, SF).count() > 0) == (rows is odd)
