"""Licence texts as they are published, wrapped at several widths and not at all."""

import textwrap

from pagesieve.llm import licences

MIT = """MIT License

Copyright (c) 2020 Somebody

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
BSD2 = """Copyright (c) 2020, Somebody

Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
"""
BSD3 = f"""{BSD2}
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.
"""
AS_IS = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED."""
APACHE = """Copyright 2020 Somebody

Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""
GPL3 = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.

This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."""
GPL2 = GPL3.replace("software:", "software;").replace("Foundation, either version 3", "Foundation; either version 2")
BSD_IDS = "bsd-grant bsd-source bsd-binary"
TEXTS = {
    "MIT": (MIT, "mit-title mit-grant mit-notice as-is"),
    "BSD-2-Clause": (BSD2 + AS_IS, BSD_IDS),
    "BSD-3-Clause": (BSD3 + AS_IS, f"{BSD_IDS} bsd-endorse"),
    "Apache-2.0": (APACHE, "apache-2-long apache-comply apache-obtain"),
    "GPL-3.0-or-later": (GPL3, "gpl-free gpl-3-later"),
    "GPL-2.0-or-later": (GPL2, "gpl-free gpl-terms gpl-2-later"),
}


def forms(text):
    parts = [" ".join(part.split()) for part in text.split("\n\n")]
    yield text
    yield "\n".join(parts)
    if parts[0] != "MIT License":
        yield " ".join(parts["Copyright" in parts[0] :])
    for width in (20, 50, 64, 72, 78):
        lines = [textwrap.fill(part, width, break_long_words=False, break_on_hyphens=False) for part in parts]
        yield "\n\n".join(lines)
        yield "\r\n\r\n".join(lines).replace("\r\n", "\n").replace("\n", "\r\n")
        yield "/*\n" + textwrap.indent("\n\n".join(lines), " * ", lambda line: True) + "\n */"
        yield "\n".join(lines)


def test_licence_texts(spark):
    rows, want = [], []
    for name, (text, ids) in TEXTS.items():
        for form in forms(text):
            rows.append((len(rows), form))
            want.append((ids, name))
    found = licences.scan_licences(spark.createDataFrame(rows, "doc_id long, text string")).orderBy("doc_id").collect()
    for (_, text), row, (ids, name) in zip(rows, found, want, strict=True):
        assert (row.sentence_ids, row.licences) == (ids, name), text


def test_a_wrapped_sentence_stays_one(spark):
    cases = {
        # A sentence sign or a blank line parts, the longest sentence counts, and none inside it.
        "All rights\nreserved": (2, "all-rights"),
        "All\nrights\n \treserved!": (3, "all-rights"),
        "All rights.\nreserved": (2, ""),
        "All rights\n \nreserved": (2, ""),
        "All rights\n\nreserved": (2, ""),
        "All\nAll rights\nreserved": (3, "all-rights"),
        'Licensed under the Apache License, Version 2.0\n(the "License")': (2, "apache-2-long"),
        "The\nMIT License": (2, "mit-title"),
        "All rights\x01reserved\x01": (1, "all-rights"),
        "MIT License\na\nb\nc\nAll rights\nreserved": (6, "mit-title | all-rights"),
        "All\nrights\nreserved\na\nb\nMIT License": (6, "all-rights mit-title"),
    }
    docs = spark.createDataFrame(list(enumerate(cases)), "doc_id long, text string")
    found = licences.scan_licences(docs).orderBy("doc_id").collect()
    assert {text: (row.n_sentences, row.sentence_ids) for text, row in zip(cases, found, strict=True)} == cases
