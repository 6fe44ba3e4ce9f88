"""Licence scans by sentence rules (operator 2; DataFrame functions only).

A text is cut into parts, each is normalised and looked up among known licence sentences; the
identifiers stand in the text's order, with a gap mark where other parts lie between.  The
rules, sequences of identifiers, are tried in their order, longest and most specific first; each
takes the places it matches, so a later rule can't claim them again.  A rule takes a copyright notice
that stands right before its sentences with them; the rules of FALLBACK count only where no other
rule matched, so that the notice of an open licence claims nothing.  Everything is one projection
per row: no shuffle, no grouping, so no source or text can become a hot key.

A part ends at a line end, or at one of ``.!?;:`` before white space.  Normal form: A-Z
lower-cased, every run of other characters than a-z and 0-9 one space, ends trimmed; a part that
begins with "copyright" and a year becomes "copyright".  Neighbouring parts that together are a known
sentence, the longest one, are one part: wrapped lines, comment marks before them, and stops inside
("v. 2.0", "free software: you") don't matter.  Parts without letters (empty ones, list numbers)
show as gaps but don't part the sentences of a rule.

Defined cases: null and empty texts have no sentences and no licence; a sentence that is known but
in no matched rule counts as left over; repeated rows each give a row; other columns, whatever
their names, pass unchanged; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vantage.llm.common import fresh_name

# Sentences of public licences in normal form, by identifier.
SENTENCES = {
    "copyright": "copyright",
    "rights": "all rights reserved",
    "mit-short": "released under the mit license",
    "mit-under": "licensed under the mit license",
    "mit-title": "the mit license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "mit-notice": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "as-is": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "apache-short": "licensed under the apache license version 2 0",
    "apache-grant": "licensed under the apache license version 2 0 the license",
    "apache-use": "you may not use this file except in compliance with the license",
    "apache-copy": "you may obtain a copy of the license at",
    "bsd-grant": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd-source": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "bsd-names": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "isc-grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "gpl3-work": "this work is licensed under the gnu general public license version 3",
    "gpl3-program": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl2-program": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "cc-by-nc": "licensed under cc by nc 4 0",
    "cc-by": "licensed under cc by 4 0",
    "cc-by-sa": "licensed under cc by sa 4 0",
    "cc0": "licensed under cc0 1 0",
    "mpl2": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "mpl2-copy": "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0",
    "mit-project": "this project is licensed under the mit license",
    "mit-software": "this software is licensed under the mit license",
    "mit-terms": "this project is licensed under the terms of the mit license",
    "apache-project": "this project is licensed under the apache license 2 0",
    "apache-url": "http www apache org licenses license 2 0",
    "apache-unless": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "apache-see": "see the license for the specific language governing permissions and limitations under the license",
    "bsd-as-is": "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed",
    "isc-as-is": "the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness",
    "gpl-hope": "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "gpl-see": "see the gnu general public license for more details",
    "gpl-received": "you should have received a copy of the gnu general public license along with this program",
    "lgpl3-program": "this program is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "lgpl3-library": "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "lgpl21-library": "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version",
    "agpl3-program": "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "epl2": "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 which accompanies this distribution and is available at https www eclipse org legal epl 2 0",
    "epl2-short": "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0",
    "unlicense": "this is free and unencumbered software released into the public domain",
    "boost-title": "boost software license version 1 0 august 17th 2003",
    "boost-short": "distributed under the boost software license version 1 0",
    "zlib-as-is": "this software is provided as is without any express or implied warranty",
    "zlib-liable": "in no event will the authors be held liable for any damages arising from the use of this software",
    "zlib-grant": "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions",
}
# Identifiers that may stand in an SPDX line, which is a sentence of its own.
SPDX = ["MIT", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "ISC", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only",
        "GPL-3.0-or-later", "LGPL-2.1-or-later", "LGPL-3.0-or-later", "AGPL-3.0-only", "AGPL-3.0-or-later", "MPL-2.0",
        "EPL-2.0", "Unlicense", "BSL-1.0", "Zlib", "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0"]
SENTENCES.update({f"spdx-{name}": "spdx license identifier " + "".join(c if c.isalnum() else " " for c in name.lower()) for name in SPDX})

# Licence and its sentences, in the order in which rules are tried.
RULES = [
    ("MIT", ["mit-title", "copyright", "rights", "mit-grant", "mit-notice", "as-is"]),
    ("MIT", ["mit-grant", "mit-notice", "as-is"]),
    ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-names", "bsd-as-is"]),
    ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-names"]),
    ("BSD-2-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-as-is"]),
    ("BSD-2-Clause", ["bsd-grant", "bsd-source", "bsd-binary"]),
    ("Apache-2.0", ["apache-grant", "apache-use", "apache-copy", "apache-url", "apache-unless", "apache-see"]),
    ("Apache-2.0", ["apache-grant", "apache-use", "apache-copy"]),
    ("MIT-grant-only", ["mit-grant"]),
    ("ISC", ["isc-grant", "isc-as-is"]),
    ("ISC", ["isc-grant"]),
    ("zlib", ["zlib-as-is", "zlib-liable", "zlib-grant"]),
    ("GPL-3.0-or-later", ["gpl3-program", "gpl-hope", "gpl-see", "gpl-received"]),
    ("GPL-3.0-or-later", ["gpl3-program"]),
    ("GPL-2.0-or-later", ["gpl2-program", "gpl-hope", "gpl-see", "gpl-received"]),
    ("GPL-2.0-or-later", ["gpl2-program"]),
    ("GPL-3.0-only", ["gpl3-work"]),
    ("LGPL-3.0-or-later", ["lgpl3-program"]),
    ("LGPL-3.0-or-later", ["lgpl3-library"]),
    ("LGPL-2.1-or-later", ["lgpl21-library"]),
    ("AGPL-3.0-or-later", ["agpl3-program"]),
    ("MPL-2.0", ["mpl2", "mpl2-copy"]),
    ("MPL-2.0", ["mpl2"]),
    ("EPL-2.0", ["epl2"]),
    ("EPL-2.0", ["epl2-short"]),
    ("Unlicense", ["unlicense"]),
    ("BSL-1.0", ["boost-title"]),
    ("BSL-1.0", ["boost-short"]),
    *[(name, [f"spdx-{name}"]) for name in SPDX],
    ("MIT", ["mit-project"]),
    ("MIT", ["mit-software"]),
    ("MIT", ["mit-terms"]),
    ("Apache-2.0", ["apache-project"]),
    ("Apache-2.0", ["apache-short"]),
    ("Apache-2.0", ["apache-grant"]),
    ("MIT", ["mit-short"]),
    ("MIT", ["mit-under"]),
    ("CC-BY-NC-4.0", ["cc-by-nc"]),
    ("CC-BY-SA-4.0", ["cc-by-sa"]),
    ("CC-BY-4.0", ["cc-by"]),
    ("CC0-1.0", ["cc0"]),
    ("proprietary", ["copyright", "rights"]),
    ("proprietary", ["rights"]),
]

# What a notice may be, longest first, and licences that count only where no other does.
NOTICES = [["copyright", "rights"], ["copyright"], ["rights"]]
FALLBACK = {"proprietary"}

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


# A year after "copyright" makes the rest of the part a copyright line.
NOTICE = "copyright (?:c )?[0-9]{4}[^\n]*"


def identifiers(ids: list[str]) -> str:
    return "".join(f"|{i}|" for i in ids)


def normal_parts(text: Column) -> Column:
    """The normal forms of a text's parts, each between line ends."""
    ends = F.regexp_replace(F.coalesce(text, F.lit("")), r"[\n\r]+|[.!?;:]+[ \t]+", "\n")
    plain = F.regexp_replace(F.translate(F.concat(F.lit("\n"), ends, F.lit("\n")), UPPER, LOWER), "[^a-z0-9\n]+", " ")
    return F.regexp_replace(plain, " ?\n ?", "\n")


def scan(df: DataFrame, text: str = "text", sentences: dict[str, str] | None = None,
         rules: list[tuple[str, list[str]]] | None = None) -> DataFrame:
    """``df`` with sentence_ids (identifiers in order, each between bars, ``|.|`` for a gap),
    n_sentences (known ones), licenses (of the rules that matched, in rule order, each once),
    n_rules (that matched) and n_left (known sentences that no rule took)."""
    sentences, rules = sentences or SENTENCES, rules or RULES
    known = F.create_map(*[F.lit(x) for name, s in sentences.items() for x in (s, f"|{name}|")])
    state, parts = fresh_name(df, "licence"), fresh_name(df, "parts")
    # a known sentence may run over the ends of parts; of those that begin alike the longest is taken
    whole = "|".join([s.replace(" ", "[ \n]+") for s in sorted(sentences.values(), key=len, reverse=True)] + [NOTICE])
    found = F.transform(F.regexp_extract_all(F.col(parts), F.lit(f"\n((?:{whole}|[^\n]*))(?=\n)"), F.lit(1)), lambda p: F.when(
        p.rlike("^[0-9 ]*$"), F.lit("|,|")).otherwise(F.coalesce(F.element_at(known, F.when(
            p.rlike(f"^{NOTICE}$"), F.lit("copyright")).otherwise(F.regexp_replace(p, "\n+", " "))), F.lit("|.|"))))
    marked = F.when(F.col(parts).rlike(f"\n(?:{whole})(?=\n)"), F.array_join(found, "")).otherwise(F.lit("|.|"))
    gaps = lambda c: F.regexp_replace(c, r"(\|\.\|)+", "|.|")

    rule_rows = F.array(*[F.struct(F.lit(name).alias("name"), F.lit(identifiers(ids)).alias("ids"),
                                   F.lit(name in FALLBACK).alias("last")) for name, ids in rules])

    def step(acc: Column, rule: Column) -> Column:
        hit = F.contains(acc["rest"], rule["ids"]) & (~rule["last"] | (F.size(acc["hits"]) == 0))
        rest = acc["rest"]
        for notice in [*NOTICES, []]:
            rest = F.replace(rest, F.concat(F.lit(identifiers(notice)), rule["ids"]), F.lit("|~|"))
        return F.struct(F.when(hit, rest).otherwise(acc["rest"]).alias("rest"),
                        F.when(hit, F.concat(acc["hits"], F.array(rule["name"]))).otherwise(acc["hits"]).alias("hits"))

    start = F.struct(gaps(F.replace(F.col(state), F.lit("|,|"), F.lit(""))).alias("rest"), F.array().cast("array<string>").alias("hits"))
    none = F.struct(F.lit("").alias("rest"), F.array().cast("array<string>").alias("hits"))
    folded = F.when(F.length(F.regexp_replace(F.col(state), r"\|[.,]\|", "")) > 0,
                    F.aggregate(rule_rows, start, step)).otherwise(none)
    out = fresh_name(df.withColumn(state, F.lit(0)), "folded")
    count = lambda c: F.size(F.filter(F.split(c, r"\|"), lambda x: ~x.isin("", ".", ",", "~"))).cast("long")
    return (df.withColumn(parts, normal_parts(F.col(text))).withColumn(state, marked).withColumn(out, folded)
              .withColumns({"sentence_ids": gaps(F.replace(F.col(state), F.lit("|,|"), F.lit("|.|"))), "n_sentences": count(F.col(state)),
                            "licenses": F.array_join(F.array_distinct(F.col(out)["hits"]), ","),
                            "n_rules": F.size(F.col(out)["hits"]).cast("long"),
                            "n_left": count(F.col(out)["rest"])}).drop(parts, state, out))
