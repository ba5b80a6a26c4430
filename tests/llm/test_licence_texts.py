"""Whole published licence texts and notices, wrapped at several widths and inside comments."""
import textwrap

import pytest

from ledgerloom.llm import licences

AS_IS = ('THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED '
         "TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL "
         "THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
         "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
         "DEALINGS IN THE SOFTWARE.")
MIT = ["MIT License", "Copyright (c) 2020 Some Body",
       "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
       'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
       "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
       "to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
       "The above copyright notice and this permission notice shall be included in all copies or substantial portions "
       "of the Software.", AS_IS]
BSD_2 = ["Copyright (c) 2020, Some Body. All rights reserved.",
         "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
         "the following conditions are met:",
         "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the "
         "following disclaimer.",
         "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
         "following disclaimer in the documentation and/or other materials provided with the distribution."]
BSD_END = ['THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED '
           "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
           "PARTICULAR PURPOSE ARE DISCLAIMED."]
BSD_3 = BSD_2 + ["3. Neither the name of Some Body nor the names of its contributors may be used to endorse or promote "
                 "products derived from this software without specific prior written permission."]
ISC = ["Copyright (c) 2020, Some Body",
       "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
       "granted, provided that the above copyright notice and this permission notice appear in all copies.",
       'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE.']


def gpl(subject, name, version, end):
    return [f"{subject} is free software{end} you can redistribute it and/or modify it under the terms of the GNU {name} "
            f"License as published by the Free Software Foundation{',' if end == ':' else ';'} either version {version} of "
            "the License, or (at your option) any later version.",
            f"{subject} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
            "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License "
            "for more details."]


APACHE = ["Copyright 2020 Some Body",
          'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
          "with the License. You may obtain a copy of the License at", "    http://www.apache.org/licenses/LICENSE-2.0",
          "Unless required by applicable law or agreed to in writing, software distributed under the License is "
          'distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.']
TEXTS = {"MIT": MIT, "BSD-2-Clause": BSD_2 + BSD_END, "BSD-3-Clause": BSD_3 + BSD_END, "ISC": ISC, "Apache-2.0": APACHE,
         "GPL-3.0-or-later": gpl("This program", "General Public", 3, ":"),
         "GPL-2.0-or-later": gpl("Foo", "General Public", 2, ";"),
         "LGPL-2.1-or-later": gpl("This library", "Lesser General Public", "2.1", ";"),
         "AGPL-3.0-or-later": gpl("This program", "Affero General Public", 3, ":")}
LEADERS = {"plain": ("", "", ""), "//": ("", "// ", ""), "#": ("", "# ", ""), "--": ("", "-- ", ""), ";;": ("", ";; ", ""),
           "*": ("/*\n", " * ", "\n */"), "javadoc": ("/**\n", "\t* ", "\n */"), "box": ("", "*  ", "")}


@pytest.mark.parametrize("width", [50, 79, 10_000])
def test_published_texts(spark, width):
    rows = []
    for licence, paragraphs in TEXTS.items():
        lines = [x for p in paragraphs for x in [*textwrap.wrap(p, width), ""]]
        for kind, (head, lead, tail) in LEADERS.items():
            for end in ("\n", "\r\n"):
                text = "int x = 1; " + "\n" + head + "\n".join((lead + x).rstrip() for x in lines) + tail + "\ncode();"
                rows.append((f"{licence} {kind} {len(end)}", text.replace("\n", end)))
    got = {r.doc_id: r.licence for r in licences.scan(spark.createDataFrame(rows, "doc_id string, text string")).collect()}
    assert got == {k: k.split()[0] for k, _ in rows}


def test_phrases_stay_inside_sentences_and_words(spark):
    texts = {1: "It is licensed under the MIT. License texts follow.", 2: "Licensed under the MIT licenses.",
             3: "SPDX-License-Identifier: MIT-0", 4: "we say all rights\n\nreserved seats", 5: "ALL RIGHTS\n#  RESERVED",
             6: "/* SPDX-License-Identifier: MIT */", 7: "code is licensed under the MIT license, see (LICENSE.)",
             8: "GNU GENERAL PUBLIC LICENSE\n   Version 3, 29 June 2007\n\n" + TEXTS["GPL-3.0-or-later"][0]}
    d = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert {r.doc_id: r.licence for r in licences.scan(d).collect()} == {
        1: "none", 2: "none", 3: "none", 4: "none", 5: "Proprietary", 6: "MIT", 7: "MIT", 8: "GPL-3.0"}
