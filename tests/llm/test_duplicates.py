"""Digest index, SimHash and suffix arrays against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash

from vantage.llm import digest_index, simhash, suffixes
from vantage.llm.common import scratch
from vantage.llm.keys import QUERIES

from .conftest import odd_texts

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# -- exact -------------------------------------------------------------------------------------

def expected_exact(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    out = []
    for t, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        digest, spent = hashlib.sha256(t.encode()).hexdigest(), False
        for i in ids:
            kept = i == keep and not spent
            spent = spent or kept
            out.append((str(i), str(keep), len(ids), kept, digest))
    return sorted(out)


def exact_rows(df):
    return sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.kept, r.text_sha256) for r in df.collect())


def test_marks_of_odd_rows(spark, odd, empty):
    index = digest_index.fresh_index(spark)
    assert exact_rows(digest_index.mark_duplicates(odd, index)) == expected_exact(odd_texts())
    assert digest_index.mark_duplicates(empty, digest_index.fresh_index(spark)).count() == 0


def test_index_persists_and_is_idempotent(spark, odd):
    path = scratch(spark, "digests")
    index = digest_index.DigestIndex(spark, path, 4)
    digest_index.mark_duplicates(odd, index, batch=0).collect()
    size = index.entries().count()
    index.close()
    again = digest_index.DigestIndex(spark, path, 4)      # a later session
    assert again.entries().count() == size
    first = exact_rows(digest_index.mark_duplicates(odd, again, batch=0))
    assert again.entries().count() == size and first == expected_exact(odd_texts())
    new = spark.createDataFrame([(100, "same text here twice"), (101, "new"), (102, "new")], "doc_id long, text string")
    got = {r.doc_id: (r.kept, r.keep_id) for r in digest_index.mark_duplicates(new, again, batch=1).collect()}
    assert got == {100: (False, 7), 101: (False, 102), 102: (True, 102)}
    assert again.entries().count() == size + 1


def test_index_is_bucketed_and_joined_by_merge(spark, odd):
    index = digest_index.fresh_index(spark)
    digest_index.mark_duplicates(odd, index).collect()
    described = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {index.table}").collect()}
    assert "digest" in described["Bucket Columns"] and "digest" in described["Sort Columns"]
    rows = digest_index.digest_rows(odd)
    groups = rows.groupBy("digest").count()
    plan = groups.join(index.entries().select("digest").hint("merge"), "digest", "left_anti")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in text and "Python" not in text


def test_reopened_index_keeps_its_buckets(spark):
    """An index made under one setting of the session and opened under another admits nothing twice."""
    key, before = "spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions")
    path = scratch(spark, "digests")
    docs = spark.createDataFrame([(k, f"text {k}") for k in range(200)], "doc_id long, text string")
    try:
        first = digest_index.DigestIndex(spark, path)
        assert digest_index.mark_duplicates(docs, first).where("kept").count() == 200
        first.close()
        spark.conf.set(key, "3")
        again = digest_index.DigestIndex(spark, path)
        assert again.buckets == first.buckets != 3
        assert digest_index.mark_duplicates(docs, again, batch=1).where("kept").count() == 0
        assert again.entries().count() == 200
        with pytest.raises(ValueError):
            digest_index.DigestIndex(spark, path, 3)
    finally:
        spark.conf.set(key, before)


@pytest.mark.parametrize("batches", [1, 2, 5])
def test_batches_by_falling_ids_and_hot_digests(spark, odd, empty, batches):
    assert exact_rows(digest_index.mark_in_batches(odd, digest_index.fresh_index(spark), batches)) == expected_exact(odd_texts())
    assert digest_index.mark_in_batches(empty, digest_index.fresh_index(spark), batches).count() == 0
    rows = [(k, "hot" if k % 3 == 0 else "warm" if k % 7 == 0 else f"text {k % 250}") for k in range(600)] + [(None, "hot"), (5, "hot")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    index = digest_index.fresh_index(spark)
    assert exact_rows(digest_index.mark_in_batches(docs, index, batches)) == expected_exact(rows)
    assert index.entries().count() == len({t for _, t in rows})
    assert index.entries().select("batch").distinct().count() == batches
    # copies are summed up before they are shuffled, and no digest is one task of the last join
    plan = digest_index.mark_in_batches(docs, digest_index.fresh_index(spark), batches)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Python" not in plan


def test_kept_rows_have_their_columns(spark, odd, empty):
    kept = digest_index.deduplicated(odd, digest_index.fresh_index(spark))
    assert kept.columns == odd.columns
    rows = kept.collect()
    stay = {(i, h) for i, _, _, k, h in expected_exact(odd_texts()) if k}
    assert sorted((str(r.doc_id), hashlib.sha256((r.text or "").encode()).hexdigest()) for r in rows) == sorted(stay)
    assert all(r._digest == "y" and r.digest == "x" for r in rows)
    assert digest_index.deduplicated(empty, digest_index.fresh_index(spark)).count() == 0


# -- SimHash -----------------------------------------------------------------------------------

def slow_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not words:
        return 0
    shingles = [" ".join(words[k:k + 3]) for k in range(max(1, len(words) - 2))]
    bits = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), seed=42)
        for b in range(64):
            bits[b] += h >> b & 1
    return sum(1 << b for b in range(64) if bits[b] * 2 > len(shingles))


def roots(prints, most):
    """Component number of each fingerprint by brute force."""
    values, root = np.array(prints, np.uint64), list(range(len(prints)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for k in range(len(values)):
        for j in np.flatnonzero(np.bitwise_count(values ^ values[k]) <= most).tolist():
            a, b = find(k), find(j)
            root[max(a, b)] = min(a, b)
    return [find(k) for k in range(len(values))]


def expected_near(rows):
    prints = [slow_print(t) for _, t in rows]
    found = roots(prints, 2)
    least = {}
    for (i, _), r in zip(rows, found, strict=True):
        if i is not None:
            least[r] = min(i, least.get(r, i))
    return sorted((str(i), f"{p:016x}", str(least.get(r))) for (i, _), p, r in zip(rows, prints, found, strict=True))


def near_rows(df):
    return sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in df.collect())


def test_components_of_odd_rows(odd, empty):
    assert near_rows(simhash.mark_components(odd)) == expected_near(odd_texts())
    assert simhash.mark_components(empty).count() == 0


def test_query_on_whole_table(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert near_rows(QUERIES["op8_simhash"](spark, SF)) == expected_near(docs)


def test_kept_rows_are_one_of_each_component(odd, empty):
    kept = simhash.deduplicated(odd)
    assert kept.columns == odd.columns
    marks = expected_near(odd_texts())
    assert kept.count() == len({c for _, _, c in marks if c != "None"} | {(f, c) for _, f, c in marks if c == "None"}) + \
        len({f for i, f, c in marks if i == "10" and c == "10"}) - 1    # two texts share the id 10
    assert simhash.deduplicated(empty).count() == 0


@pytest.mark.parametrize(("most", "longest"), [(2, 32), (2, 1), (2, 4), (1, 32), (1, 1)])
def test_links_short_and_long_lists(spark, most, longest):
    """Dense balls of fingerprints: lists above the limit take the way without pairs."""
    choose = random.Random(7)
    values = set()
    for _ in range(6):
        centre = choose.getrandbits(64)
        values.add(centre)
        for _ in range(60):
            x = centre
            for b in choose.sample(range(64), choose.randint(1, 5)):
                x ^= 1 << b
            values.add(x)
    values = sorted(values)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    edges = simhash.links(spark.createDataFrame([(v,) for v in signed], "fp long"), most, longest)
    got = {r.node: r.root for r in simhash.components(edges).collect()}
    for r in edges.collect():
        assert ((r.a ^ r.b) & (2 ** 64 - 1)).bit_count() <= most
    want = roots([np.uint64(v) for v in values], most)
    groups = Counter()
    for s, w in zip(signed, want, strict=True):
        groups[(w, got.get(s, s))] += 1
    assert len(groups) == len(set(want)) == len({got.get(s, s) for s in signed})


def test_chain_of_links_is_one_component(spark):
    chain = spark.range(0, 300).selectExpr("id + 1 a", "id b")
    assert {r.root for r in simhash.components(chain).collect()} == {0}
    assert simhash.components(chain.limit(0)).count() == 0


# -- benchmark ---------------------------------------------------------------------------------

def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def expected_hits(docs, items):
    windows = {}
    for i, t in items:
        w = words(t)
        for a in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[a:a + 10]), set()).add("" if i is None else str(i))
    out = []
    for i, t in docs:
        w, hit, found = words(t), set(), set()
        for n in {len(k) for k in windows}:
            for p in range(len(w) - n + 1):
                if tuple(w[p:p + n]) in windows:
                    hit.update(range(p, p + n))
                    found |= windows[tuple(w[p:p + n])]
        out.append((str(i), len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out)


def hit_rows(df):
    return sorted((str(r.doc_id), r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in df.collect())


def planted():
    choose = random.Random(3)
    pool = [f"w{k}" for k in range(40)] + ["É", "日本", "X9"]
    items = [(k, " ".join(choose.choice(pool) for _ in range(choose.choice([0, 1, 3, 9, 10, 11, 25])))) for k in range(30)]
    items += [(3, items[4][1]), (None, "unique words of no id here to be found by all"), (77, None), (78, ""), (2, items[2][1])]
    docs = []
    for k in range(120):
        parts = [" ".join(choose.choice(pool) for _ in range(choose.randint(0, 40)))]
        for _ in range(choose.randint(0, 3)):
            w = (choose.choice(items)[1] or "").split()
            a = choose.randint(0, max(0, len(w) - 8))
            parts.append(", ".join(w[a:a + choose.randint(5, 30)]).upper())
        docs.append((k, "\n".join(parts)))
    return docs + odd_texts(), items


@pytest.mark.parametrize("block", [8 << 20, 300])
def test_hits_in_one_and_in_many_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(suffixes, "BLOCK_BYTES", block)
    monkeypatch.setattr(suffixes, "SHARD_BYTES", 2000)
    docs, items = planted()
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert hit_rows(suffixes.mark_contaminated(df, bench)) == expected_hits(docs, items)


def test_removal_and_odd_tables(spark, odd, empty):
    bench = spark.createDataFrame([(1, "Same text, HERE twice"), (2, " ".join(f"word{k} Thing{k}" for k in range(5, 12)))],
                                  "item_id long, text string")
    left = suffixes.decontaminated(odd, bench)
    assert left.columns == odd.columns
    assert sorted(str(r.doc_id) for r in left.collect()) == sorted(str(i) for i, _ in odd_texts() if i not in (5, 6, 7))
    none = bench.limit(0)
    assert suffixes.decontaminated(odd, none).count() == len(odd_texts())
    assert suffixes.mark_contaminated(empty, bench).count() == 0


def test_maximal_matches(spark):
    item = [f"t{k}" for k in range(30)]
    docs = [(1, "x y " + " ".join(item[4:21]) + " z"), (2, " ".join(item[:12] + ["gap"] + item[12:25])), (3, " ".join(item[:9]))]
    got = suffixes.verbatim_matches(spark.createDataFrame(docs, "doc_id long, text string"),
                                    spark.createDataFrame([(9, " ".join(item))], "item_id long, text string")).collect()
    assert sorted(tuple(r) for r in got) == [(1, "9", 2, 4, 17), (2, "9", 0, 0, 12), (2, "9", 13, 12, 13)]


def test_benchmark_query_on_whole_table(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = hit_rows(QUERIES["op7_suffix_decontamination"](spark, SF))
    assert got == expected_hits(docs, items)
