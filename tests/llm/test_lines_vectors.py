"""Line index, whitening and hard negatives against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.oracle_compare import compare, duck
from vantage.llm import feast, line_index, negatives, whitening
from vantage.llm.common import scratch
from vantage.llm.cuckoo import CuckooFilter
from vantage.llm.keys import ORACLE, QUERIES

from .conftest import odd_texts

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.mark.parametrize("key", ["op11_line_index", "op13_tree_negatives"])
def test_queries_equal_their_statements(spark, key):
    assert compare(spark, key, QUERIES[key], ORACLE[key], SF, duck(SF))["status"] == "ok"


# -- cuckoo filters ----------------------------------------------------------------------------

def test_filter_takes_back_exactly_what_was_inserted():
    rng = np.random.default_rng(1)
    items = rng.integers(0, 1 << 63, 20_000, dtype=np.uint64)
    f = CuckooFilter.sized(len(items))
    assert f.insert(items[:10_000])
    before = f.table.copy()
    assert f.insert(items[10_000:]) and f.contains(items).all() and len(f) == len(items)
    strangers = rng.integers(0, 1 << 63, 100_000, dtype=np.uint64)
    assert f.contains(strangers).mean() < 0.001
    f = CuckooFilter.from_bytes(f.to_bytes())
    f.remove(items[10_000:])
    assert f.contains(items[:10_000]).all() and len(f) == np.count_nonzero(before)
    assert f.contains(items[10_000:]).mean() < 0.001
    f.remove(items[:10_000])
    assert not f.table.any()


def test_filter_keeps_equal_items_apart_and_says_when_it_is_full():
    f = CuckooFilter.sized(8)
    twice = np.array([5, 5], dtype=np.uint64)
    assert f.insert(twice)
    f.remove(twice[:1])
    assert f.contains(twice).all()
    assert not f.insert(np.arange(1000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    assert CuckooFilter.sized(0).contains(twice).tolist() == [False, False]


# -- lines -------------------------------------------------------------------------------------

def keys_of(text):
    out = []
    for line in (text or "").split("\n"):
        key = line.strip(" \t\n\x0b\x0c\r").translate(LOWER)
        out.append((line, key if len(key) >= 20 else None))
    return out


def expected_clean(rows, indexed=None, min_docs=3):
    holders = {}
    for i, t in indexed if indexed is not None else rows:
        for _, key in keys_of(t):
            if key is not None:
                holders.setdefault(key, set()).add(i)
    keep = {k: max((i for i in ids if i is not None), default=None) for k, ids in holders.items() if len(ids) >= min_docs}
    out = []
    for i, t in rows:
        lines = keys_of(t)
        kept = [line for line, key in lines if key not in keep or keep[key] == i]
        out.append((str(i), len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out)


def cleaned(df):
    return sorted((str(r.doc_id), r.n_lines, r.n_dropped, r.text) for r in df.select("doc_id", "n_lines", "n_dropped", "text").collect())


def line_rows(seed=3, n=60):
    rng = random.Random(seed)
    pool = [f"a line that many documents share, number {k}" for k in range(12)] + ["short", "", "   ", "\t A LINE that many DOCUMENTS share, number 1 \r"]
    rows = [(i, "\n".join(rng.choice(pool) if rng.random() < 0.7 else f"only here {i} {rng.random()}" for _ in range(rng.randrange(12))))
            for i in range(n)]
    hot = "the line that every document of a third holds"
    return [(i, t + "\n" + hot if i % 3 == 0 else t) for i, t in rows] + [
        (None, hot + "\n" + pool[0]), (None, pool[1]), (7, rows[7][1]), (7, hot + "\nsome other text of the same id"),
        (100, " " * 50 + hot.upper() + "\x0b"), (101, "   " + hot), (102, "é" * 20), (103, "É" * 20), (104, "é" * 20), (105, "é" * 20)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(4)


@pytest.mark.parametrize("how", ["sent", "in shards", "split shards", "hot keys"])
def test_clean_equals_brute_force(spark, monkeypatch, how):
    if how == "in shards":
        monkeypatch.setattr(line_index, "SENT_BYTES", 0)
        monkeypatch.setattr(line_index, "GROUP_LINES", 10)
    if how == "split shards":
        monkeypatch.setattr(line_index, "SHARD_KEYS", 2)
    rows = line_rows(n=400 if how == "hot keys" else 60)      # over 64 documents for one line
    docs = frame(spark, rows)
    index = line_index.fresh_index(spark, shards=3)
    assert cleaned(index.add(docs).clean(docs)) == expected_clean(rows)
    assert (index.shards > 3) == (how == "split shards")
    one = line_index.fresh_index(spark, min_docs=1, shards=2).add(docs)
    assert cleaned(one.clean(docs)) == expected_clean(rows, min_docs=1)


def state(index):
    counts = sorted((bytes(r.digest), r.n_docs, str(r.keep_id)) for r in index.counts().collect())
    filters = {r.shard: len(CuckooFilter.from_bytes(bytes(r.slots))) for r in index.filters().collect() if r["items"]}
    return counts, filters


@pytest.mark.parametrize("tight", [False, True])
def test_deletions_bring_the_earlier_state_back(spark, monkeypatch, tight):
    rows = line_rows()
    first, second = [r for r in rows if (r[0] or 0) % 2 == 0], [r for r in rows if (r[0] or 0) % 2]
    path = scratch(spark, "lines")
    index = line_index.LineIndex(spark, path, shards=3).add(frame(spark, first))
    before = state(index)
    if tight:       # a filter that is found full is built anew from the counts
        monkeypatch.setattr(CuckooFilter, "insert", lambda self, h, insert=CuckooFilter.insert:
                            insert(self, h) and len(self) <= 0.5 * self.table.size)
    index.add(frame(spark, second))
    assert cleaned(index.clean(frame(spark, rows))) == expected_clean(rows)
    after = state(index)
    index = line_index.LineIndex(spark, path, min_docs=99, shards=50)     # a later session; its own settings stay
    assert (index.min_docs, index.shards, index.version) == (3, 3, 2)
    assert state(index.add(frame(spark, rows))) == after                  # all known
    index.remove(frame(spark, second).select("doc_id"))
    assert state(index) == before
    assert cleaned(index.clean(frame(spark, rows))) == expected_clean(rows, indexed=first)
    index.remove(frame(spark, [(12345, "")]))
    assert state(index) == before
    assert state(index.add(frame(spark, second))) == after                # and back again
    index.remove(frame(spark, rows).select("doc_id"))
    assert state(index) == ([], {})
    assert cleaned(index.clean(frame(spark, rows))) == expected_clean(rows, indexed=[])


def test_lines_of_odd_rows(spark, odd, empty):
    index = line_index.fresh_index(spark, min_docs=2, min_chars=5)
    out = index.add(odd).clean(odd)
    assert out.columns == [*odd.columns, "n_lines", "n_dropped"]
    holders = {}
    for i, t in odd_texts():
        holders.setdefault((t or "").strip(" \t\n\x0b\x0c\r"), set()).add(i)
    got = {(r.doc_id, r.text) for r in out.collect()}
    assert (6, "") in got and (7, "same text here twice") in got and (10, "repeated row") in got
    assert out.count() == len(odd_texts())
    nothing = line_index.fresh_index(spark)
    assert nothing.add(empty).clean(empty).count() == 0
    assert nothing.remove(odd).clean(odd).where("n_dropped > 0").count() == 0


# -- whitening ---------------------------------------------------------------------------------

def symmetric(kind, d, rng):
    if kind == "full":
        a = rng.standard_normal((d, d + 2))
        return a @ a.T
    if kind == "low rank":
        a = rng.standard_normal((d, max(1, d // 3)))
        return a @ a.T
    if kind == "ties":
        q, _ = np.linalg.qr(rng.standard_normal((d, d)))
        return q @ np.diag(np.r_[np.full(d // 2, 3.0), np.ones(d - d // 2)]) @ q.T
    if kind == "diagonal":
        return np.diag(np.arange(d, 0, -1.0))
    return np.zeros((d, d))


@pytest.mark.parametrize("kind", ["full", "low rank", "ties", "diagonal", "zero"])
def test_contour_integration_equals_the_library(kind):
    rng = np.random.default_rng(4)
    for d in (1, 2, 3, 9, 40):
        v = symmetric(kind, d, rng)
        v = (v + v.T) / 2
        for k in (1, 4, d):
            values, vectors = feast.largest(v, k)
            k = min(k, d)
            assert np.allclose(values, np.linalg.eigvalsh(v)[::-1][:k], atol=1e-11 * max(1, np.abs(v).max()))
            assert np.abs(v @ vectors - vectors * values).max() < 1e-11 * max(1, np.abs(v).max())
            assert np.allclose(vectors.T @ vectors, np.eye(k), atol=1e-9)
        counts = feast.Inertia(v)
        for shift in np.linalg.eigvalsh(v)[:-1] + np.diff(np.linalg.eigvalsh(v)) / 2:
            if np.abs(np.linalg.eigvalsh(v) - shift).min() > 1e-9:
                assert counts.above(shift) == (np.linalg.eigvalsh(v) > shift).sum()


def test_a_missed_pair_is_noticed():
    v = np.diag([5.0, 4.0, 1.0])
    with pytest.raises(ArithmeticError):
        feast.pairs_inside(v, 3.0, 6.0, 3, 5.0)


def vector_frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, x string, n int").repartition(4)


def odd_vectors(n=150, d=6):
    rng = np.random.default_rng(9)
    base = rng.standard_normal((n, d)).astype(np.float32) * np.linspace(0.2, 0.6, d).astype(np.float32)
    rows = [(i, [float(v) for v in row], int(rng.integers(0, 4)), "x", 1) for i, row in enumerate(base)]
    same = rows[0][1]
    rows += [(1000 + i, same, i % 3, None, None) for i in range(60)]                # copies
    rows += [(2000, None, 1, "", 0), (2001, [], 1, "", 0), (2002, [1.0] * (d - 1) + [None], 1, "", 0),
             (2003, [1.0] * (d - 1) + [float("nan")], 1, "", 0), (2004, [1.0] * (d - 1) + [float("inf")], 1, "", 0),
             (2005, [0.5] * (d + 1), 1, "", 0), (2050, same, None, "", 0), (None, same, 1, "", 0),
             rows[3], (rows[4][0], rows[5][1], 2, "", 0)]
    return rows


def usable_vectors(rows, d=6):
    return [(i, v, label) for i, v, label, *_ in rows if v is not None and len(v) == d
            and all(c is not None and np.isfinite(c) for c in v)]


def test_whitening_equals_plain_numpy(spark):
    rows = odd_vectors()
    good = usable_vectors(rows)
    got = whitening.whitened(vector_frame(spark, rows)).collect()
    assert len(got) == 4 * len(good)
    x = np.floor(256 * np.array([v for _, v, _ in good], dtype=np.float64)).astype(np.int64)
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    cov = np.cov(fit.T.astype(float), bias=True)
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    z = (x - sums / n) @ vectors[:, :4] / np.sqrt(values[:4])
    deviation = ((n * x - sums) ** 2).sum(axis=1)
    want = sorted((str(i), k + 1, n, int(deviation[r]), abs(z[r, k]), values[k] / np.trace(cov))
                  for r, (i, _, _) in enumerate(good) for k in range(4))
    have = sorted((str(r.vec_id), r.component, r.n, r.deviation, abs(r.whitened), r.explained) for r in got)
    for a, b in zip(have, want):
        assert a[:4] == b[:4] and a[4:] == pytest.approx(b[4:], rel=1e-9, abs=1e-9)
    assert all(r.identity_error < 1e-9 for r in got)


def test_whitening_of_few_and_equal_vectors(spark):
    none = vector_frame(spark, [])
    assert whitening.whitened(none).count() == 0
    equal = vector_frame(spark, [(1, [0.5, 0.25], 0, "", 0), (2, [0.5, 0.25], 0, "", 0)])
    assert whitening.whitened(equal).count() == 0
    line = vector_frame(spark, [(i, [float(i), 2.0 * i], 0, "", 0) for i in range(5)])      # one component only
    got = whitening.whitened(line).collect()
    assert {r.component for r in got} == {1} and len(got) == 5 and all(r.explained == pytest.approx(1.0) for r in got)
    large = vector_frame(spark, [(i, [1e18 * (-1) ** i, 3e17 * i, 1.0], 0, "", 0) for i in range(5)])
    got = whitening.whitened(large, components=1).collect()
    assert len(got) == 5 and all(r.deviation is None for r in got)      # beyond 64 bits


# -- hard negatives ----------------------------------------------------------------------------

def expected_negatives(rows, every, positives=5, negatives=3, low=50, high=95, d=6):
    good = sorted({(i, label, tuple(int(np.floor(256 * float(np.float32(c)))) for c in v))
                   for i, v, label in usable_vectors(rows, d) if i is not None and label is not None})
    out = []
    dot = lambda a, b: sum(p * q for p, q in zip(a, b))
    for i, label, x in good:
        if i % every:
            continue
        mine = sorted((-dot(x, y), j) for j, other, y in good if other == label and j != i)[:positives]
        theirs = sorted((-dot(x, y), j) for j, other, y in good if other != label)
        for p, j in mine:
            fit = [(s, k) for s, k in theirs if low * -p <= 100 * -s <= high * -p][:negatives]
            out += [(i, j, r, k, -p, -s) for r, (s, k) in enumerate(fit, 1)]
    return sorted(out)


@pytest.mark.parametrize("block,scale", [(2048, 1.0), (7, 1.0), (2048, 2e4), (2048, 1e6)])
def test_negatives_equal_brute_force(spark, block, scale):
    rows = [(i, None if v is None else [None if c is None else c * scale for c in v], label, *rest)
            for i, v, label, *rest in odd_vectors()]
    found = negatives.mine(negatives.vector_rows(vector_frame(spark, rows), F.col("label")), F.col("id") % 5 == 0, block=block)
    want = expected_negatives(rows, 5)
    assert sorted(map(tuple, found.collect())) == want and len(want) > 100


def test_entries_beyond_the_range_take_no_part(spark):
    rows = odd_vectors() + [(5000, [1e18] * 6, 1, "", 0)]
    found = negatives.mine(negatives.vector_rows(vector_frame(spark, rows), F.col("label")), F.col("id") % 5 == 0)
    assert sorted(map(tuple, found.collect())) == expected_negatives(odd_vectors(), 5)


def test_negatives_of_nothing(spark):
    none = negatives.vector_rows(vector_frame(spark, []), F.col("label"))
    assert negatives.mine(none, F.col("id") % 5 == 0).count() == 0
    alone = negatives.vector_rows(vector_frame(spark, [(5, [1.0, 2.0], 1, "", 0), (10, [1.0, 2.0], 2, "", 0)]), F.col("label"))
    assert negatives.mine(alone, F.col("id") % 5 == 0).count() == 0


def test_bounds_spare_scores_of_clustered_vectors():
    """Far from a cluster's window nothing is scored again."""
    rng = np.random.default_rng(2)
    import pandas as pd
    centres = rng.integers(-200, 200, (20, 16))
    x = np.concatenate([c + rng.integers(-2, 3, (30, 16)) for c in centres])
    anchors = pd.DataFrame({"id": np.arange(len(x)), "label": 0, "x": [list(v) for v in x], "block": 0})
    forest = negatives.Forest(negatives.spanning_trees(anchors))
    taken = {}
    own = {a: int(forest.x[a] @ forest.x[a]) for a in range(len(x))}
    scored = negatives.descend(forest, forest.trees[0], x, lambda a: (0.9 * own[a], np.inf),
                               lambda a, s, where: taken.setdefault(a, {}).update(zip(where.tolist(), s.tolist())))
    for a in range(len(x)):
        exact = x @ forest.x[a]
        for c in np.flatnonzero(exact >= 0.9 * own[a]):
            assert taken[a][c] == exact[c]
    assert scored < 0.3 * len(x) * len(x)
