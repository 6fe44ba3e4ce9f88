"""Classifiers by held-out accuracy and planted disguises; licences and the language model by brute force."""

import math
import random
import re
import subprocess
import sys
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.oracle_compare import compare
from vantage.llm import lbl, licenses, toxicity, zquality
from vantage.llm.keys import ORACLE, QUERIES

from .conftest import odd_texts

SF, MID = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


# -- toxicity ----------------------------------------------------------------------------------

INSULTS = ["stupid", "moron", "loser", "worthless"]


@pytest.fixture(scope="module")
def scorer():
    choose = random.Random(1)
    plain = ["the", "house", "river", "walked", "slowly", "under", "bridge", "green", "open", "table", "letter", "summer"]
    texts, labels = [], []
    for k in range(600):
        words = [choose.choice(plain) for _ in range(choose.randint(5, 40))]
        if k % 6 == 0:
            for _ in range(choose.randint(1, 3)):
                words.insert(choose.randint(0, len(words)), choose.choice(INSULTS))
        texts.append(" ".join(words))
        labels.append(int(k % 6 == 0))
    return toxicity.fit(texts, labels)


@pytest.mark.parametrize("disguise", ["5tup1d", "s.t.u.p.i.d", "s t u p i d", "stuuuupid", "$tupid", "m0r0n", "l0ser",
                                      "w-o-r-t-h-l-e-s-s", "STUPID!!!", "m o r o n", "stu​pid", "(loser)", "l@ser moron"])
def test_disguised_words_are_restored_and_scored(scorer, disguise):
    assert scorer.score(f"The house under the {disguise} bridge") >= 0.3


@pytest.mark.parametrize("disguise", ["s_t_u_p_i_d", "st_upid", "stuupid", "stu pid", "st up id", "mo ron", "los_er", "w0r th less"])
def test_more_disguises_are_restored(scorer, disguise):
    assert scorer.score(f"The house under the {disguise} bridge") >= 0.3


@pytest.mark.parametrize("text", ["", None, "The house under the open bridge", "a a a a a a", "1234 5678 90", "summmmmer 7able", "s l o w l y"])
def test_clean_texts_score_low(scorer, text):
    assert scorer.score(text) < 0.3


def test_viterbi_keeps_plain_words(scorer):
    for word in ("table", "letter", "slowly"):
        assert toxicity.restore(word, scorer.restorer.model) == word
    assert toxicity.restore("t a b l e", scorer.restorer.model) == "table"


def test_viterbi_finds_the_best_path(scorer):
    """Against all paths of a short lattice."""
    model = scorer.restorer.model

    def paths(token):
        found = [("", 0.0, "")]
        for c in token:
            step = []
            for out, cost, raw in found:
                for x, more in [(c, 0.0), *((x, toxicity.SWAP) for x in toxicity.LEET.get(c, ""))]:
                    step.append((out + x, cost + more, c))
                if raw == c:
                    step.append((out, cost + toxicity.REPEAT, c))
            found = step
        return {out: max(c for o, c, _ in found if o == out) for out, _, _ in found}

    for token in ("5t1ll", "m00n", "t4bl3"):
        best = max(paths(token).items(), key=lambda x: x[1] + sum(
            model.log10(f"  {x[0]} "[k - 2:k + 1]) for k in range(2, len(x[0]) + 3)))
        assert toxicity.restore(token, model) == best[0]


def test_fit_without_labels_of_both_kinds():
    assert toxicity.fit([], []).score("any") < 0.01
    assert toxicity.fit(["a b c"] * 3, [1, 1, 1]).score("any") > 0.99


def test_toxic_rows_go(scorer, odd, empty, spark):
    kept = toxicity.without_toxic(odd, scorer)
    assert kept.columns == odd.columns and kept.count() == len(odd_texts())
    more = spark.createDataFrame([(1, "you stupid moron"), (2, "the river"), (3, None)], "doc_id long, text string")
    assert sorted(r.doc_id for r in toxicity.without_toxic(more, scorer).collect()) == [2, 3]
    assert toxicity.with_scores(empty, scorer).count() == 0


def judged(spark, key, label, sf=MID):
    rows = {r.doc_id: r for r in QUERIES[key](spark, sf).collect()}
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows.values())
    truth = {r.doc_id: r[label] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    return rows, [(rows[i].predicted, y) for i, y in truth.items() if i in rows and rows[i].held_out]


@pytest.mark.parametrize("share", [None, 0.4, 0.5])
def test_features_are_found_whatever_the_share_of_toxic_labels(spark, share):
    """Held-out texts of a larger table, with its own mixture of labels and with fewer clean ones."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").select("doc_id", F.col("toxic").alias("label"))
    if share:
        n = {r.label: r["count"] for r in labels.groupBy("label").count().collect()}
        keep = int((1 << 20) * n[1] * (1 - share) / share / n[0])
        labels = labels.where((F.col("label") == 1) | (F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < keep))
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    fitted = toxicity.fit_from(docs, labels.where(~held))
    rows = docs.join(labels.where(held), "doc_id").where("length(text) < 20000").collect()
    found = {y: [fitted.score(r.text) >= 0.3 for r in rows if r.label == y] for y in (0, 1)}
    # with half of the labels toxic there are some 330 texts of each label to learn from
    assert np.mean(found[1]) > (0.82 if share else 0.88) and np.mean(found[0]) < (0.05 if share else 0.02)


def test_every_labelled_text_teaches(spark):
    """Texts of any length and number; equal texts once, whatever their labels' rows."""
    choose = random.Random(5)
    pool = ["river", "house", "under", "open", "green", "letter", "bridge", "summer", "table"]
    def text(n):
        return " ".join(choose.choice(pool) for _ in range(n))
    rows = [(k, text(20), 0) for k in range(300)] + [(1000 + k, f"{text(8000)} {w}", 1) for k, w in enumerate(["gr0bble", "grobble"] * 6)]
    rows += [(2000 + k, "the same open table", 0) for k in range(400)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(None, "no id grobble"), (5000, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(5000, 0), (5001, 1), (3, None)], "doc_id long, label int")
    texts = toxicity.training_texts(docs, labels, "text", "label", "doc_id").collect()
    assert sorted((r.t, r.y) for r in texts) == sorted({(t, y) for _, t, y in rows} | {("", 0)})
    scorer = toxicity.fit_from(docs, labels)
    assert scorer.score("you grobble") > 0.3 > scorer.score("you table")
    assert scorer.score("you g.r.o.b.b.l.e") > 0.3
    only = toxicity.fit_from(docs, labels.where("label = 0"))
    assert only.score("you grobble") < 0.01


def test_the_fit_runs_in_one_kind_of_python_worker(spark, monkeypatch):
    """Workers of another kind would stand idle beside those that count, each with its own memory."""
    plans = []

    class Seen(toxicity.LogisticRegression):
        def fit(self, rows):
            plans.append(rows._jdf.queryExecution().executedPlan().toString())
            return super().fit(rows)

    monkeypatch.setattr(toxicity, "LogisticRegression", Seen)
    rows = [("the river grobble", 1)] * 3 + [(f"grobble house {k}", 1) for k in range(9)] + [(f"open house {k}", 0) for k in range(90)]
    texts = spark.createDataFrame(rows, "t string, y int")
    weights, bias = toxicity.fit_weights(texts, toxicity.Restorer(toxicity.CharModel({})), ["grobble$", "river$"], len(rows))
    assert weights[0] > weights[1] >= 0 > bias
    assert "ArrowEvalPython" in plans[0] and "BatchEvalPython" not in plans[0]


def test_evidence_is_computed_once_by_a_task(spark):
    counts = spark.createDataFrame([("loser$", 40, 2), ("the$", 90, 900), ("rare$", 1, 0)], "feature string, toxic long, clean long")
    likely = toxicity._likely(counts, 100, 1000)
    assert [(r.feature, r.low) for r in likely.collect()] == [("loser$", toxicity.evidence(40, 2, 100, 1000))]
    for rows in (likely, likely.drop("low"), likely.select("feature", F.log1p("low"))):
        assert rows._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1


def test_freed_memory_goes_back_to_the_system():
    """A worker that is done with a batch keeps what it uses, not what it used."""
    code = """
import re
from vantage.llm.common import give_back
size = lambda: int(re.search(r"Pss_Anon:\\s+(\\d+)", open("/proc/self/smaps_rollup").read())[1]) >> 10
texts = [b"x" * 5000 for _ in range(20000)]
held = texts[::1000]
del texts
before = size()
give_back()
print(before - size())
"""
    out = subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).parents[2], capture_output=True, text=True, check=True).stdout
    assert int(out) > 50


def test_feature_counts_equal_a_plain_count(spark):
    choose = random.Random(6)
    pool = ["river", "r1ver", "ri", "ver", "a", "b", "hous", "e.", "(loser)", "lo5er", "l.o.s.e.r", "the"]
    rows = [(" ".join(choose.choice(pool) for _ in range(12)), k % 2) for k in range(40)]
    restorer = toxicity.Restorer(toxicity.CharModel(toxicity.grams_of(Counter(["river", "house", "loser", "the"] * 9))))
    want = [Counter(f for t, y in rows if y == label for f in {
        f for x in toxicity.tokens_of(t) for w in restorer.words(x) for f in toxicity.features(w)}) for label in (0, 1)]
    got = toxicity.feature_counts(spark.createDataFrame(rows, "t string, y int").repartition(3), restorer).collect()
    assert {r.feature: (r.clean, r.toxic) for r in got} == {f: (want[0][f], want[1][f]) for f in want[0] | want[1]}


@pytest.mark.parametrize("most", [toxicity.CANDIDATES, 2, 0])
def test_candidates_counted_by_halves_are_chosen_alike(spark, most):
    """Only what the first half leaves open is looked for in the other one; before, everything was counted there."""
    choose = random.Random(8)
    pool = ["river", "house", "r1ver", "ri", "ver", "a", "the", "under", "open"]
    toxic = ["loser", "lo5er", "l.o.s.e.r", "lo ser", "(loser)", "moron", "m0ron", "mo ron", "opens"]
    rows = [(" ".join([*(choose.choice(pool) for _ in range(12)), *choose.sample(toxic, 3 if k % 5 == 0 else k % 3 == 0)]) + f" x{k}", int(k % 5 == 0))
            for k in range(400)]
    restorer = toxicity.Restorer(toxicity.CharModel(toxicity.grams_of(Counter(["river", "house", "loser", "moron", "the"] * 9))))
    texts = spark.createDataFrame(rows, "t string, y int").repartition(3)
    every, some = toxicity.feature_counts(texts, restorer), toxicity.candidate_counts(texts, restorer, 80, 320, most)
    want = toxicity.choose_features(every, 80, 320)
    assert {"loser$", "moron$"} <= set(want) and toxicity.choose_features(some, 80, 320) == want
    full, got = ({r.feature: (r.toxic, r.clean) for r in df.collect()} for df in (every, some))
    assert {f: got[f] for f in want} == {f: full[f] for f in want}
    assert not most > 2 or "the$" in full and not {"the$", "river$"} & got.keys() and len(got) < len(full) / 5


def test_no_candidates_without_evidence(spark):
    texts = spark.createDataFrame([(f"the river {k}", k % 2) for k in range(40)], "t string, y int")
    assert toxicity.candidate_counts(texts, toxicity.Restorer(toxicity.CharModel({})), 20, 20).count() == 0


def test_more_clean_texts_never_add_evidence():
    for n_toxic, n_clean in [(4, 1), (4, 2), (5, 3), (7, 40), (300, 5), (300, 300), (20, 2000)]:
        for a in range(toxicity.MIN_TEXTS, n_toxic + 1):
            passes = [toxicity.evidence(a, c, n_toxic, n_clean) > toxicity.EVIDENCE for c in range(n_clean + 1)]
            assert passes == sorted(passes, reverse=True)


def test_no_token_with_a_feature_is_left_out(scorer):
    choose = random.Random(7)
    tokens = ["".join(choose.choice("stupid 5.-1$_mor0nl@") for _ in range(choose.randint(1, 14))) for _ in range(5000)]
    tokens += [f"{a}{w}{b}" for w in INSULTS for a in ("", "so", ".") for b in ("", "s", "!")]
    found = set(scorer.wanted.among(tokens))
    assert found >= {t for t in tokens if scorer.token_weight(t)} and len(found) < len(tokens) / 2
    assert [scorer.score(t) for t in tokens[:200]] == scorer.scores(tokens[:200])


def test_tokens_are_searched_where_words_begin_and_end():
    wanted = toxicity.Wanted(["mor$", "stupidly$", "idio"])
    some = ["(m0r)", "x-mmor!", "m o r", "$tup1dly", "a.s-tupid.ly", "1diotic", "a idi ot", "...mor", "m\u200bor"]
    assert wanted.among(some) == some
    # in the middle of a word none can be read; before, all were decoded
    assert wanted.among(["more", "amor", "unstupidly", "stupendous", "anidiot", "", "...", "ror m"]) == []


def test_long_words_are_searched_as_wholes():
    wanted = toxicity.Wanted(["stupidly$", "worthlessness$", "a" + "bc" * 10 + "$"])
    some = ["$tupidly", "so.s-t-u-p-i-d-l-y!", "stupid ly", "w0rthlessne5s", "a" + "bc" * 10, "worthle ss ness"]
    assert wanted.among(some) == some and all(map(wanted, some))
    # they begin like a wanted word, but none of their words ends where it does; before, these were decoded
    assert wanted.among(["stupidest", "stupid", "stupidlyest", "worthless", "worthlessnesses", "stu pid el y"]) == []


def test_evidence_does_not_depend_on_the_mixture():
    few, many = toxicity.evidence(50, 2, 300, 300), toxicity.evidence(50, 20, 300, 3000)
    assert few > toxicity.EVIDENCE and many > toxicity.EVIDENCE and abs(few - many) < 1
    assert toxicity.evidence(50, 50, 300, 300) < 0 < toxicity.evidence(300, 0, 300, 300)


def test_toxicity_query_held_out(spark):
    rows, pairs = judged(spark, "op3_channel_toxicity", "toxic")
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in rows.items())
    assert np.mean([p for p, y in pairs if y == 0]) < 0.05
    assert np.mean([p for p, y in pairs if y == 1]) > 0.55     # 36 toxic texts to learn from


# -- quality -----------------------------------------------------------------------------------

def test_quality_query_held_out(spark):
    rows, pairs = judged(spark, "op6_compression_quality", "quality")
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in rows.items())
    assert np.mean([p for p, y in pairs if y == 1]) > 0.95
    assert np.mean([p for p, y in pairs if y == 0]) < 0.5


def test_compression_tells_kinds_apart():
    choose = random.Random(2)
    good = [" ".join(choose.choice(["river", "house", "under", "open", "green", "letter"]) for _ in range(60)).encode() for _ in range(120)]
    bad = [" ".join(choose.choice(["BUY!!", "$$$", "click", "|", "###", "free%%"]) for _ in range(60)).encode() for _ in range(120)]
    scorer = zquality.fit(good[:100], bad[:100], share=0.5)
    assert scorer.scores(good[100:]).min() > 0.5 > scorer.scores(bad[100:]).max()
    assert 0 <= scorer.scores([b""])[0] <= 1
    assert zquality.fit(good[:3], bad, share=0.25).scores([b"x", b""]).tolist() == [0.25, 0.25]


def test_quality_of_odd_rows(spark, odd, empty):
    scorer = zquality.fit_from(odd, odd.withColumn("label", F.lit(None).cast("int")))
    rows = zquality.with_scores(odd, scorer, out="quality").collect()
    assert len(rows) == len(odd_texts()) and all(r.quality == 0.5 and r.score == 0.5 for r in rows)
    assert zquality.with_scores(empty, scorer).count() == 0


# -- licences ----------------------------------------------------------------------------------

def test_licence_query_equals_sql(spark):
    key = "op2_license_sentences"
    for sf in (SF, MID):
        assert compare(spark, key, QUERIES[key], ORACLE[key], sf)["status"] == "ok"


def licence_of(spark, text):
    r = licenses.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    return r.licenses, r.n_sentences, r.n_rules, r.n_left


def test_rules_match_sequences_in_order(spark):
    grant, notice = licenses.SENTENCES["mit-grant"], licenses.SENTENCES["mit-notice"]
    warranty = licenses.SENTENCES["as-is"].capitalize()
    assert licence_of(spark, f"The MIT License\nCopyright (c) 2020 Some One\n{grant}:\n\n{notice}.\n{warranty}!") == ("MIT", 5, 1, 2)
    assert licence_of(spark, f"{grant}. Other words here. {notice}. {warranty}.") == ("MIT-grant-only", 3, 1, 2)
    assert licence_of(spark, f"{notice}. {grant}. {warranty}.") == ("MIT-grant-only", 3, 1, 2)      # wrong order
    assert licence_of(spark, "x\nReleased under the MIT License.\ny. LICENSED under   the apache license, version 2.0.")[0] == "Apache-2.0,MIT"
    assert licence_of(spark, "(c) 2019. All rights reserved.") == ("proprietary", 1, 1, 0)


WRAPPED = {
    "MIT": """The MIT License (MIT)

Copyright (c) 2021 Some One

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM.
""",
    "BSD-3-Clause": """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution. 

3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
""",
    "GPL-3.0-or-later": """ * This program is free software: you can redistribute it and/or modify
 * it under the terms of the GNU General Public License as published by
 * the Free Software Foundation, either version 3 of the License, or
 * (at your option) any later version.
""",
    "GPL-2.0-or-later": """# This program is free software; you can redistribute it and/or modify
# it under the terms of the GNU General Public License as published by
# the Free Software Foundation; either version 2 of the License, or
# (at your option) any later version.
""",
    "MPL-2.0": """// This Source Code Form is subject to the terms of the Mozilla Public
// License, v. 2.0. If a copy of the MPL was not distributed with this
// file, You can obtain one at https://mozilla.org/MPL/2.0/.
""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.
""",
    "Apache-2.0": """# Licensed under the Apache License, Version 2.0 (the "License");
# you may not use this file except in compliance with the License.
# You may obtain a copy of the License at
""",
}


HEADED = {
    "BSD-3-Clause": "Copyright (c) 2020, Some One\nAll rights reserved.\n\n" + WRAPPED["BSD-3-Clause"] + """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL ANYONE BE LIABLE.
""",
    "Apache-2.0": "# Copyright 2019 Some One. All rights reserved.\n#\n" + WRAPPED["Apache-2.0"] + """#
#     http://www.apache.org/licenses/LICENSE-2.0
#
# Unless required by applicable law or agreed to in writing, software
# distributed under the License is distributed on an "AS IS" BASIS,
# WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
# See the License for the specific language governing permissions and
# limitations under the License.
""",
    "LGPL-2.1-or-later": """ * This library is free software; you can redistribute it and/or
 * modify it under the terms of the GNU Lesser General Public
 * License as published by the Free Software Foundation; either
 * version 2.1 of the License, or (at your option) any later version.
""",
    "AGPL-3.0-or-later": """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU Affero General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.
""",
    "zlib": """This software is provided 'as-is', without any express or implied
warranty. In no event will the authors be held liable for any damages
arising from the use of this software.

Permission is granted to anyone to use this software for any purpose,
including commercial applications, and to alter it and redistribute it
freely, subject to the following restrictions:
""",
    "Unlicense": "This is free and unencumbered software released into the public domain.\n",
    "BSL-1.0": "// Distributed under the Boost Software License, Version 1.0. (See accompanying file)\n",
    "EPL-2.0": " * This program and the accompanying materials are made available under the\n * terms of the Eclipse Public License 2.0 which\n"
               " * accompanies this distribution, and is available at\n * https://www.eclipse.org/legal/epl-2.0/\n",
    "MIT": "Read me\n\nThis project is licensed under the MIT License.\n",
    "GPL-2.0-only": "// SPDX-License-Identifier: GPL-2.0-only\n#include <x.h>\n",
    "proprietary": "Copyright (c) 2018 A Firm. All rights reserved.\nNothing else.",
    "": "Some text about the MIT License and all rights.\n",
}


def test_licences_with_notices_and_headers(spark):
    rows = [(name, t) for name, t in HEADED.items()]
    got = {r.doc_id: (r.licenses, r.n_left) for r in licenses.scan(spark.createDataFrame(rows, "doc_id string, text string")).collect()}
    assert got == {name: (name, 0) for name in HEADED}


def test_licence_statement_equals_the_operator(spark):
    """Over wrapped and headed texts, which the driver's tables lack."""
    import duckdb
    from vantage.llm.keys import ORACLE
    texts = [*WRAPPED.values(), *HEADED.values(), None, "", "\n", "1. 2. 3."]
    texts += [f"{a}\n{b}" for a in texts[:4] for b in texts[4:12]] + [t.replace("\n", "\r\n") for t in texts if t]
    rows = list(enumerate(texts))
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    want = sorted(con.execute(ORACLE["op2_license_sentences"]).fetchall())
    got = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).drop("text").collect()
    assert sorted(map(tuple, got)) == want


def test_wrapped_licence_texts(spark):
    rows = [(f"{name} {k}", text) for name, t in WRAPPED.items()
            for k, text in enumerate((t, t.replace("\n", "\r\n"), "\n\n".join(" ".join(p.split()) for p in t.split("\n\n")),
                                     f"Some heading\n{t}\nand a line after"))]
    got = {r.doc_id: r.licenses for r in licenses.scan(spark.createDataFrame(rows, "doc_id string, text string")).collect()}
    assert got == {i: i.split()[0] for i, _ in rows}


def test_licences_of_odd_rows(odd, empty):
    rows = licenses.scan(odd).collect()
    assert len(rows) == len(odd_texts()) and all(r.licenses == "" and r.n_sentences == 0 and r._digest == "y" for r in rows)
    assert licenses.scan(empty).count() == 0


def test_licence_plan_is_native_without_shuffle(odd):
    text = licenses.scan(odd.coalesce(1))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Exchange" not in text.split("Coalesce")[0]


# -- language model ----------------------------------------------------------------------------

def slow_base(rows, training):
    counts, tokens = Counter(), {}
    for k, (i, t) in enumerate(rows):
        tokens[k] = [w.encode() for w in re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in t or ""))] + [b""]
        if training(i):
            counts.update(tokens[k])
    n, v = sum(counts.values()), len(counts)
    return n, [(str(i), len(tokens[k]), sum(counts[w] > 0 for w in tokens[k]),
                sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens[k])) for k, (i, _) in enumerate(rows)]


@pytest.mark.parametrize("frequent", [200_000, 40, 0])
def test_counts_of_frequent_and_other_words(spark, odd, monkeypatch, frequent):
    """Whatever part of the vocabulary is broadcast, the result is the same."""
    monkeypatch.setattr(lbl, "FREQUENT", frequent)
    monkeypatch.setattr(lbl.vocabulary, "__defaults__", (frequent, 16))
    training = F.coalesce(F.col("doc_id"), F.lit(0)) != 6
    got = lbl.score_documents(odd, training).collect()
    n, want = slow_base(odd_texts(), lambda i: i != 6)
    assert {r.train_tokens for r in got} == {n}
    assert sorted((str(r.doc_id), r.n_tokens, r.n_known, round(r.base_score, 6)) for r in got) == sorted((*w[:3], round(w[3], 6)) for w in want)
    assert all(r.score < 0 and r._digest == "y" for r in got)


def vocabulary(tokens=("the", "cat", "sat", "on", "mat")):
    random_ = random.Random(4)
    texts = [" ".join(random_.choices(tokens, weights=range(len(tokens), 0, -1), k=12)).encode() for _ in range(50)]
    counts = Counter(w for t in texts for w in t.split()).most_common()
    return texts, lbl.Vocabulary([w for w, _ in counts], np.array([c for _, c in counts], np.int64),
                                 sum(c for _, c in counts) + 50, len(counts) + 1, 50, shortlist=3)


def test_probabilities_sum_to_one():
    texts, known = vocabulary()
    model = lbl.LogBilinear(known.noise())
    every = np.arange(known.outputs)
    for a in every:
        for b in every:
            at = np.tile([a, b], (known.outputs, 1))
            assert abs((10 ** model.log10(at, every)).sum() - 1) < 1e-6
    # the class of others: its words and the unseen word share it
    shares = 10 ** (known.log_counts[known.shortlist:] - known.log_other)
    assert abs(shares.sum() + 10 ** -known.log_other - 1) < 1e-9


def test_training_beats_the_start():
    """Text in which each word decides the next."""
    cycle = [b"the", b"cat", b"sat", b"on", b"mat"]
    text = b" ".join(cycle * 40)
    known = lbl.Vocabulary(cycle, np.full(5, 40), 201, 6, 1, shortlist=5)
    ids = known.ids(known.ranks(text)[0])
    at, model = lbl.contexts(ids, known.end), lbl.LogBilinear(known.noise())
    before = model.log10(at, ids).mean()
    squares = model.squares()
    for step in range(300):
        model.train(at, ids, squares, np.random.default_rng(step))
    model._log_z = None
    assert model.log10(at, ids).mean() > before + 0.3
    again, _ = lbl.LogBilinear(known.noise(), seed=9).take_table(model.table(squares))
    assert np.allclose(again.log10(at, ids), model.log10(at, ids), atol=1e-5)


def test_vocabulary_grows_with_the_corpus():
    counts = np.array([100_000 // (k + 1) for k in range(5000)])
    sizes = []
    for times in (1, 10, 100):
        known = lbl.Vocabulary([b"w%d" % k for k in range(5000)], counts * times, int(counts.sum()) * times + 9, 5001, 9)
        sizes.append(known.shortlist)
        assert (known.ids(np.arange(known.shortlist))[:-1] == np.arange(known.shortlist)).all()
    assert 512 < sizes[0] < sizes[1] < sizes[2]


def test_classes_of_words(monkeypatch):
    """Factored outputs: probabilities sum to one, and words of classes are learned from their context."""
    monkeypatch.setattr(lbl, "HEAD", 4)
    monkeypatch.setattr(lbl, "CACHED", 6)
    n = 40
    text = b" ".join(b"w%d" % (k % n) for k in range(n * 40))
    known = lbl.Vocabulary([b"w%d" % k for k in range(n)], np.full(n, 40), n * 40 + 1, n + 1, 1, shortlist=n)
    ids = known.ids(known.ranks(text)[0])
    at, model = lbl.contexts(ids, known.end), lbl.LogBilinear(known.noise())
    assert len(model.outputs) > known.outputs and len(model.top) < known.outputs
    before = model.log10(at, ids).mean()
    squares = model.squares()
    for step in range(300):
        model.train(at, ids, squares, np.random.default_rng(step))
    model._log_z = None
    assert model.log10(at, ids).mean() > before + 0.5
    every = np.arange(known.outputs)
    for a, b in [(0, 1), (20, 21), (39, known.end), (known.other, known.other), (3, 30)]:
        assert abs((10 ** model.log10(np.tile([a, b], (known.outputs, 1)), every)).sum() - 1) < 1e-5
    again, _ = lbl.LogBilinear(known.noise(), seed=9).take_table(model.table(squares))
    assert np.allclose(again.log10(at, ids), model.log10(at, ids), atol=1e-4)


def test_parameters_are_averaged_in_groups(spark, monkeypatch):
    """Rows that some share moved become the mean by uses, others stay."""
    monkeypatch.setattr(lbl, "FANIN", 3)
    rng = np.random.default_rng(5)
    table = rng.standard_normal((3000, lbl.DIMENSION + 3)).astype(np.float32)
    uses, sums, records = np.zeros(3000), np.zeros(table.shape), []
    for share in range(0, 40, 2):
        at = np.sort(rng.choice(2900, 200, replace=False))
        u, rows = rng.random(200) + 0.1, rng.standard_normal((200, lbl.DIMENSION + 3))
        uses[at] += u
        sums[at] += rows * u[:, None]
        records.append(lbl._records(share, at, u, rows * u[:, None]))
    made = spark.createDataFrame([tuple(r) for part in records for r in part.itertuples(index=False)], lbl.MOVED).repartition(7)
    want = table.copy()
    want[uses > 0] = sums[uses > 0] / uses[uses > 0, None]
    assert np.allclose(lbl._averaged(made, table), want, rtol=1e-4, atol=1e-5)
    assert (lbl._averaged(made.limit(0), table) == table).all()


def slow_score(t, known, model, counts):
    """The sum over tokens of the model's log10 probability, token by token."""
    words = [w for w in (t or "").encode().lower().split()]
    ids, total = [known.rank[w] if -1 < known.rank[w] < known.shortlist else known.other for w in words] + [known.end], 0.0
    before = [known.end, known.end]
    for k, i in enumerate(ids):
        total += float(model.log10(np.array([before]), np.array([i]))[0])
        before = [i, before[0]]
        if i == known.other:
            total += math.log10(counts[words[k]] + 1) - known.log_other
    return total


def test_scores_equal_token_by_token_and_do_not_depend_on_partitions(spark, odd, monkeypatch):
    monkeypatch.setattr(lbl, "SHARE_TOKENS", 20_000)      # several shares, two rounds
    monkeypatch.setattr(lbl, "SHORTLIST", 300)
    kept = {}

    def remember(*args, made=lbl.train, **more):
        kept["model"], kept["known"] = made(*args, **more), args[1]
        return kept["model"]

    monkeypatch.setattr(lbl, "train", remember)
    rows = [(i, t) for i, t in odd_texts()] + [(100 + k, " ".join(f"w{(k * j) % 97}" for j in range(40))) for k in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = []
    for parts in (1, 6):
        found.append(sorted((str(r.doc_id), r.n_tokens, round(r.score, 3)) for r in lbl.score_documents(docs.repartition(parts), F.lit(True)).collect()))
    assert found[0] == found[1]
    counts = Counter(w for _, t in rows for w in (t or "").encode().lower().split())
    short = [(i, t) for i, t in rows if len(t or "") < 10_000]
    want = sorted((str(i), round(slow_score(t, kept["known"], kept["model"], counts), 2)) for i, t in short)
    got = sorted((i, round(x, 2)) for i, n, x in found[0] if n < 2000)
    assert [i for i, _ in got] == [i for i, _ in want] and np.allclose([x for _, x in got], [x for _, x in want], atol=0.05)
    # the odd table's columns, and a table of texts alone
    assert lbl.score_documents(odd, F.lit(True)).columns[:3] == ["doc_id", "digest", "fp"]
    alone = lbl.score_documents(docs.select("text"), F.lit(True))
    assert alone.columns == ["n_tokens", "n_known", "train_tokens", "base_score", "score"] and alone.count() == len(rows)


def test_language_model_query(spark, empty):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = QUERIES["op9_log_bilinear"](spark, SF).collect()
    n, want = slow_base(docs, lambda i: zlib.crc32(str(i).encode()) % 7 != 2)
    assert {r.train_tokens for r in got} == {n} and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 7 == 2) for r in got)
    assert sorted((str(r.doc_id), r.n_tokens, r.n_known, round(r.base_score, 5)) for r in got) == sorted((*w[:3], round(w[3], 5)) for w in want)
    assert sum(r.score for r in got if r.held_out) > sum(r.base_score for r in got if r.held_out)
    assert lbl.score_documents(empty, F.lit(True)).count() == 0
