"""Licence scans by sentence rules, with DataFrame functions only.

A text is cut at sentence signs and newlines; the pieces are normalised and looked up among known
licence sentences, as are those that a wrapped sentence's lines make together. The identifiers
met, in their order, are matched against an ordered list of rules, each a sequence of
identifiers. A sentence used by a rule is gone for the rules after it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sentences of well-known licence texts and notices, and their identifiers. Texts run
# on to the next sentence sign, so the whole sentence is listed beside a beginning that also stands alone.
TERMS = "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"
WITHOUT = "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an"
ENDORSE = "names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"
SENTENCES = {
    "Licensed under the Apache License, Version 2.0": "apache-2",
    'Licensed under the Apache License, Version 2.0 (the "License")': "apache-2-long",
    "you may not use this file except in compliance with the License": "apache-comply",
    "You may obtain a copy of the License at": "apache-obtain",
    "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0": "apache-obtain",
    "You may obtain a copy of the License at https://www.apache.org/licenses/LICENSE-2.0": "apache-obtain",
    f'You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 {WITHOUT} "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied': "apache-obtain",
    f'You may obtain a copy of the License at https://www.apache.org/licenses/LICENSE-2.0 {WITHOUT} "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied': "apache-obtain",
    "Released under the MIT License": "mit",
    "Licensed under the MIT License": "mit",
    "The MIT License": "mit-title",
    "MIT License": "mit-title",
    "The MIT License (MIT)": "mit-title",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software": "mit-grant",
    'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions': "mit-grant",
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software": "mit-notice",
    "The above copyright notice and this permission notice (including the next paragraph) shall be included in all copies or substantial portions of the Software": "mit-notice",
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND': "as-is",
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT': "as-is",
    "Redistribution and use in source and binary forms, with or without modification, are permitted": "bsd-grant",
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met": "bsd-grant",
    "Redistributions of source code must retain the above copyright notice": "bsd-source",
    "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer": "bsd-source",
    "Redistributions in binary form must reproduce the above copyright notice": "bsd-binary",
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution": "bsd-binary",
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products": "bsd-endorse",
    f"Neither the name of the copyright holder nor the {ENDORSE}": "bsd-endorse",
    f"Neither the name of the University nor the {ENDORSE}": "bsd-endorse",
    "This work is licensed under the GNU General Public License, version 3": "gpl-3",
    "This work is licensed under the GNU General Public License, version 2": "gpl-2",
    "This program is free software": "gpl-free",
    TERMS: "gpl-terms",
    f"{TERMS}, either version 3 of the License, or (at your option) any later version": "gpl-3-later",
    f"{TERMS}, either version 2 of the License, or (at your option) any later version": "gpl-2-later",
    "either version 3 of the License, or (at your option) any later version": "gpl-3-later",
    "either version 2 of the License, or (at your option) any later version": "gpl-2-later",
    "This work is licensed under the GNU Lesser General Public License, version 3": "lgpl-3",
    "Licensed under CC BY 4.0": "cc-by",
    "Licensed under CC BY-SA 4.0": "cc-by-sa",
    "Licensed under CC BY-NC 4.0": "cc-by-nc",
    "This work is in the public domain": "public-domain",
    "All rights reserved": "all-rights",
}

#: Licence and the identifiers that state it, the most specific first.
RULES = (
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("MIT", ("mit-title", "mit-grant", "mit-notice", "as-is")),
    ("MIT", ("mit-grant", "mit-notice", "as-is")),
    ("Apache-2.0", ("apache-2-long", "apache-comply", "apache-obtain")),
    ("GPL-3.0-or-later", ("gpl-free", "gpl-terms", "gpl-3-later")),
    ("GPL-2.0-or-later", ("gpl-free", "gpl-terms", "gpl-2-later")),
    ("GPL-3.0-or-later", ("gpl-free", "gpl-3-later")),
    ("GPL-2.0-or-later", ("gpl-free", "gpl-2-later")),
    ("Apache-2.0", ("apache-2-long",)),
    ("Apache-2.0", ("apache-2",)),
    ("MIT", ("mit",)),
    ("MIT", ("mit-title",)),
    ("GPL-3.0-only", ("gpl-3",)),
    ("GPL-2.0-only", ("gpl-2",)),
    ("LGPL-3.0-only", ("lgpl-3",)),
    ("CC-BY-4.0", ("cc-by",)),
    ("CC-BY-SA-4.0", ("cc-by-sa",)),
    ("CC-BY-NC-4.0", ("cc-by-nc",)),
    ("Public-Domain", ("public-domain",)),
    ("Proprietary", ("all-rights",)),
)

#: Unknown sentences that may stand between two of one rule. More known sentences than this table may hold are no literal.
GAP, MOST_SENTENCES = 2, 2000
#: A blank line or sentence signs end a sentence for certain, a newline may stand inside one. MARK stands for the former.
ENDS, OTHER = r"[.!?;:]+[ \t\r\n]+|[.!?;:]+$|\n[ \t\r]*\n[ \t\r\n]*", r"[^a-z0-9\x{80}-\x{10FFFF}]+"
MARK, IN_TEXT = "\x01", "\x02"
UPPER, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normalised(sentence: Column) -> Column:
    """A-Z lower-cased, every run of other ASCII characters than letters and digits one blank."""
    return F.trim(F.regexp_replace(F.translate(sentence, UPPER, SMALL), OTHER, " "))


def normalised_text(sentence: str) -> str:
    """``normalised`` for a known sentence."""
    return " ".join("".join(c if c.isalnum() or ord(c) >= 128 else " " for c in sentence.translate(str.maketrans(UPPER, SMALL))).split())


def beginnings(sentences: Mapping[str, str]) -> dict[str, int]:
    """What a wrapped sentence's first line may hold: all beginnings of words but the whole, and
    how many words may follow at most."""
    most: dict[str, int] = {}
    for words in (normalised_text(text).split() for text in sentences):
        for n in range(1, len(words)):
            begin = " ".join(words[:n])
            most[begin] = max(most.get(begin, 0), len(words) - n)
    return most


def scan_licences(docs: DataFrame, key: str = "doc_id", sentences: Mapping[str, str] = SENTENCES, rules: Sequence[tuple[str, Sequence[str]]] = RULES, gap: int = GAP) -> DataFrame:
    """``key, n_sentences, n_known, sentence_ids, licences`` for every row of ``docs``.

    ``n_sentences`` are the pieces between newlines and sentence signs. A known sentence is such a
    piece or, wrapped, several lines that no sentence sign or blank line parts; the longest counts,
    and none inside it. ``sentence_ids`` are their identifiers in text order, joined by blanks, with
    a ``|`` where more than ``gap`` unknown pieces lie between; ``licences`` are those the rules
    find, without repeats, in the order of the rules, joined by commas. A rule matches its
    identifiers in a row, however often. Null and empty texts have no sentences; repeated rows
    are judged each, other columns are not read. All is one projection: no shuffle, no Python.
    """
    if len(sentences) > MOST_SENTENCES:
        raise ValueError("so many sentences are no literal: split them over several scans")
    known = {normalised_text(text): name for text, name in sentences.items()}
    ids = F.create_map(*(F.lit(x) for pair in known.items() for x in pair))
    # Sets are looked up by hash, maps from end to end: most pieces never come to the map.
    named = lambda line: F.when(line.isin(*known), F.try_element_at(ids, line))
    begins = beginnings(sentences)
    most = max(begins.values(), default=0)
    marked = F.regexp_replace(F.translate(F.coalesce("text", F.lit("")), MARK, IN_TEXT), ENDS, MARK)
    lines = lambda part: F.filter(F.transform(F.split(part, r"\n+"), normalised), lambda s: s != "")
    numbered = lambda part: F.transform(part, lambda s, at: F.struct(s.alias("line"), (F.size(part) - at - 1).alias("more")))
    rows = docs.select(key, F.transform(F.split(marked, MARK), lines).alias("parts")).select(key, F.flatten(F.transform("parts", numbered)).alias("cut"))

    def longest(s: Column, at: Column) -> Column:
        """The identifier and number of lines of the longest known sentence that begins with ``s``."""
        begin = F.struct(s["line"].alias("line"), F.lit(1).alias("n"), F.lit(1).alias("size"), named(s["line"]).alias("id"))

        def step(had: Column, after: Column) -> Column:
            line, n = F.concat(had["line"], F.lit(" "), after["line"]), had["n"] + 1
            is_known = line.isin(*known)
            # Null from where on no known sentence begins so.
            on = F.when(is_known | line.isin(*begins), line)
            return F.struct(on.alias("line"), n.alias("n"), F.when(is_known, n).otherwise(had["size"]).alias("size"), F.when(is_known, F.try_element_at(ids, line)).otherwise(had["id"]).alias("id"))

        following = F.slice("cut", at + 2, F.least(s["more"], F.lit(most)))
        joined = F.aggregate(following, begin, step, lambda had: F.struct(at.alias("at"), had["size"].alias("size"), had["id"].alias("id")))
        alone = F.struct(at.alias("at"), F.lit(1).alias("size"), named(s["line"]).alias("id"))
        return F.when((s["more"] > 0) & s["line"].isin(*begins), joined).otherwise(alone)

    met = F.filter(F.transform("cut", longest), lambda s: s["id"].isNotNull())
    rows = rows.select(key, F.size("cut").cast("long").alias("n_sentences"), met.alias("met"))
    # What begins inside a longer one goes; the last one's end is the most any had.
    end = lambda s: s["at"] + s["size"]
    apart = F.aggregate(
        "met",
        F.struct(F.lit(0).alias("end"), F.filter("met", lambda s: F.lit(False)).alias("met")),
        lambda had, s: F.when(s["at"] >= had["end"], F.struct(end(s).alias("end"), F.array_append(had["met"], s).alias("met"))).otherwise(had),
        lambda had: had["met"],
    )
    wrapped = F.exists("met", lambda s: s["size"] > 1)
    rows = rows.select(key, "n_sentences", F.when(wrapped, apart).otherwise(F.col("met")).alias("met"))
    far = lambda s, at: (at > 0) & (s["at"] - end(F.element_at("met", F.greatest(at, F.lit(1)))) > gap)
    rows = rows.select(
        key,
        "n_sentences",
        F.size("met").cast("long").alias("n_known"),
        F.array_join(F.transform("met", lambda s, at: F.concat(F.when(far(s, at), "| ").otherwise(""), s["id"])), " ").alias("sentence_ids"),
    )
    listed = F.array(*(F.struct(F.lit(name).alias("name"), F.lit("".join(f"<{x}>" for x in of)).alias("of")) for name, of in rules))
    begin = F.struct(F.concat(F.lit("<"), F.replace("sentence_ids", F.lit(" "), F.lit("><")), F.lit(">")).alias("left"), F.array().cast("array<string>").alias("found"))
    step = lambda had, rule: F.struct(
        F.replace(had["left"], rule["of"], F.lit("|")).alias("left"),
        F.when(F.contains(had["left"], rule["of"]), F.array_append(had["found"], rule["name"])).otherwise(had["found"]).alias("found"),
    )
    found = F.aggregate(listed, begin, step, lambda had: F.array_join(F.array_distinct(had["found"]), ","))
    return rows.withColumn("licences", F.when(F.col("n_known") > 0, found).otherwise(F.lit("")))
