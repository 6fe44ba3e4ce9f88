"""A corpus run: toxicity, exact duplicates, near duplicates, benchmark leaks, token ids.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame.  All but the last return rows of
``docs`` with their columns; ``run`` writes each stage to the shared folder and reads it back, so a
lost executor costs at most the stage at work.

Defined cases: a null text counts as empty; a null ``doc_id`` is smaller than any other, its row stays
where its text has no other holder; of rows that repeat text and ``doc_id`` one stays; other columns,
whatever their names, reach the last stage unchanged and are left out by it; an empty table gives an
empty result of the last stage's columns.
"""

from __future__ import annotations

import public_tokenizers

from vantage.llm import bytebpe, digest_index, simhash, suffixes, toxicity
from vantage.llm.common import stage
from vantage.llm.keys import toxicity_scorer


def drop_toxic(spark, docs, sf_dir):
    return toxicity.without_toxic(docs, toxicity_scorer(spark, sf_dir))


def drop_exact_copies(spark, docs, sf_dir):
    index = digest_index.fresh_index(spark)
    kept = digest_index.deduplicated(docs, index)
    index.close()
    return kept


def drop_near_copies(spark, docs, sf_dir):
    return simhash.deduplicated(docs, words=3, max_bits=2)


def drop_leaks(spark, docs, sf_dir):
    return suffixes.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark, docs, sf_dir):
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bytebpe.digests(docs.select("doc_id", "text"), ranks).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("simhash_dedup", drop_near_copies),
    ("decontamination", drop_leaks),
    ("byte_bpe", encode),
]

# a trained score, fingerprints and byte pairs are beyond SQL
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
