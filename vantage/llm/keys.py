"""Queries of this subpackage and the DuckDB statements of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers

from pyspark.sql import functions as F

from vantage.llm import (bytebpe, digest_index, lbl, licenses, line_index, negatives, pieces, planes, simhash, suffixes,
                         toxicity, whitening, zquality)
from vantage.llm.common import documents, id_remainder, scratch

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def _query(key: str, oracle: str | None = None):
    def add(fn):
        QUERIES[key] = fn
        if oracle is not None:
            ORACLE[key] = oracle
        return fn
    return add


@_query("op1_plane_files")
def op1(spark, sf_dir):
    path = scratch(spark, "planes")
    planes.write_ids(documents(spark, sf_dir, "doc_id", "text"), path,
                     public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return planes.document_checksums(spark, path)


def licence_sql() -> str:
    """The scan of ``licenses`` as DuckDB SQL: rules are applied one after the other.  A part ends in a
    tab here, which stands for the look-ahead that this dialect lacks."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    lookup = " ".join(f"WHEN {quote(s)} THEN '|{i}|'" for i, s in licenses.SENTENCES.items())
    notice = "copyright (c )?[0-9]{4}[^\t\n]*"
    whole = "|".join(s.replace(" ", "[ \t\n]+") for s in sorted(licenses.SENTENCES.values(), key=len, reverse=True))
    steps, last = [], "r0"
    for k, (name, ids) in enumerate(licenses.RULES, 1):
        ids = licenses.identifiers(ids)
        rest = "rest"
        for n in [*licenses.NOTICES, []]:
            rest = f"replace({rest}, {quote(licenses.identifiers(n) + ids)}, '|~|')"
        hit = f"contains(rest, {quote(ids)})" + (" AND len(hits) = 0" if name in licenses.FALLBACK else "")
        steps.append(f"r{k} AS (SELECT * REPLACE (CASE WHEN {hit} THEN {rest} ELSE rest END AS rest, "
                     f"CASE WHEN {hit} THEN list_append(hits, {quote(name)}) ELSE hits END AS hits) FROM {last})")
        last = f"r{k}"
    count = "len(list_filter(string_split({}, '|'), lambda x: x NOT IN ('', '.', ',', '~')))"
    gaps = "regexp_replace({}, '(\\|\\.\\|)+', '|.|', 'g')"
    known = f"""CASE CASE WHEN regexp_matches(p, '^{notice}$') THEN 'copyright' ELSE regexp_replace(p, '[\t\n]+', ' ', 'g') END
        {lookup} ELSE '|.|' END"""
    return f"""
    WITH cut AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\n\r]+|[.!?;:]+[ \t]+', chr(10), 'g') AS ends FROM documents),
    plain AS (SELECT doc_id, replace(regexp_replace(regexp_replace(translate(chr(10) || ends || chr(10), '{licenses.UPPER}', '{licenses.LOWER}'),
        '[^a-z0-9\n]+', ' ', 'g'), ' ?\n ?', chr(10), 'g'), chr(10), chr(9) || chr(10)) AS parts FROM cut),
    found AS (SELECT doc_id, CASE WHEN regexp_matches(parts, '\n(?:{whole}|{notice})\t') THEN array_to_string(list_transform(
        regexp_extract_all(parts, '\n((?:{whole}|{notice}|[^\t\n]*))\t', 1),
        lambda p: CASE WHEN regexp_matches(p, '^[0-9 ]*$') THEN '|,|' ELSE {known} END), '') ELSE '|.|' END AS state FROM plain),
    r0 AS (SELECT doc_id, state, CASE WHEN length(regexp_replace(state, '\\|[.,]\\|', '', 'g')) > 0
        THEN {gaps.format("replace(state, '|,|', '')")} ELSE '' END AS rest, CAST([] AS VARCHAR[]) AS hits FROM found),
    {", ".join(steps)}
    SELECT doc_id, {gaps.format("replace(state, '|,|', '|.|')")} AS sentence_ids, {count.format('state')} AS n_sentences,
           array_to_string(list_filter(hits, lambda x, i: list_position(hits, x) = i), ',') AS licenses,
           len(hits) AS n_rules, {count.format('rest')} AS n_left
    FROM {last}"""


@_query("op2_license_sentences", licence_sql())
def op2(spark, sf_dir):
    return licenses.scan(documents(spark, sf_dir, "doc_id", "text")).drop("text")


def _labels(spark, sf_dir, label: str, mod: int, held_out: int):
    """Labels without those of the rows that are held out."""
    return (spark.read.parquet(f"{sf_dir}/labels.parquet").where(id_remainder(mod) != held_out)
            .select("doc_id", F.col(label).alias("label")))


def toxicity_scorer(spark, sf_dir):
    training = documents(spark, sf_dir, "doc_id", "text").where(id_remainder(4) != 2)
    return toxicity.fit_from(training, _labels(spark, sf_dir, "toxic", 4, 2))


def _judged(scored, mod: int, held_out: int):
    return scored.select("doc_id", (id_remainder(mod) == held_out).alias("held_out"), "score",
                         (F.col("score") >= 0.3).cast("int").alias("predicted"))


@_query("op3_channel_toxicity")
def op3(spark, sf_dir):
    scorer = toxicity_scorer(spark, sf_dir)
    return _judged(toxicity.with_scores(documents(spark, sf_dir, "doc_id", "text"), scorer), 4, 2)


@_query("op4_digest_index", """
    WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents)
    SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
           doc_id = max(doc_id) OVER same AS kept, text_sha256
    FROM d WINDOW same AS (PARTITION BY text_sha256)""")
def op4(spark, sf_dir):
    index = digest_index.fresh_index(spark)
    marked = digest_index.mark_in_batches(documents(spark, sf_dir, "doc_id", "text"), index, batches=2)
    index.close()
    return marked


@_query("op5_byte_bpe")
def op5(spark, sf_dir):
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bytebpe.digests(documents(spark, sf_dir, "doc_id", "text"), ranks).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


@_query("op6_compression_quality")
def op6(spark, sf_dir):
    scorer = zquality.fit_from(documents(spark, sf_dir, "doc_id", "text"), _labels(spark, sf_dir, "quality", 5, 0))
    return _judged(zquality.with_scores(documents(spark, sf_dir, "doc_id", "text"), scorer), 5, 0)


@_query("op7_suffix_decontamination")
def op7(spark, sf_dir):
    marked = suffixes.mark_contaminated(documents(spark, sf_dir, "doc_id", "text"),
                                        spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return marked.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


@_query("op8_simhash")
def op8(spark, sf_dir):
    return simhash.mark_components(documents(spark, sf_dir, "doc_id", "text"))


@_query("op10_token_counts")
def op10(spark, sf_dir):
    counted = pieces.with_token_counts(documents(spark, sf_dir, "doc_id", "text"),
                                       public_tokenizers.path("piece_bpe_32k.model"))
    return counted.select("doc_id", F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"),
                          "n_tokens", (F.col("n_tokens") > 4096).alias("over_limit"))


@_query("op9_log_bilinear")
def op9(spark, sf_dir):
    held_out = id_remainder(7) == 2
    docs = documents(spark, sf_dir, "doc_id", "text")
    marked = lbl.score_documents(docs, ~held_out)
    return marked.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@_query("op11_line_index", """
    WITH l AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS place
               FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents)),
    k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
    c AS (SELECT key, max(doc_id) AS keep_id FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
    m AS (SELECT k.*, c.key IS NOT NULL AND k.doc_id <> c.keep_id AS gone FROM k LEFT JOIN c ON k.key = c.key)
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
    FROM m GROUP BY doc_id""")
def op11(spark, sf_dir):
    docs = documents(spark, sf_dir, "doc_id", "text")
    index = line_index.fresh_index(spark, min_docs=3, min_chars=20)
    for half in (0, 1):         # the second half is added to what the first left
        index.add(docs.where(id_remainder(2) == half))
    return index.clean(docs).select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


@_query("op12_feast_whitening")
def op12(spark, sf_dir):
    return whitening.whitened(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))


@_query("op13_tree_negatives", """
    WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                      CAST(list_transform(embedding, lambda c: floor(256 * CAST(c AS DOUBLE))) AS DOUBLE[]) AS x
               FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
               AND len(list_filter(embedding, lambda c: coalesce(isfinite(c), false))) = len(embedding)),
    s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
                 CAST(list_inner_product(a.x, b.x) AS BIGINT) AS score
          FROM v a, v b WHERE a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
    p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
          QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
    SELECT p.anchor_id, positive_id, CAST(row_number() OVER best AS INTEGER) AS rank, id AS negative_id,
           positive_score, score AS negative_score
    FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT same
     AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
    WINDOW best AS (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id)
    QUALIFY row_number() OVER best <= 3""")
def op13(spark, sf_dir):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = negatives.vector_rows(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), label)
    return negatives.mine(rows, F.col("id") % 50 == 0)
