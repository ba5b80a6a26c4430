"""Licence scan (1): sentence-rule recognition, DataFrame functions only.

Texts are normalised: comment leaders go, wrapped lines are joined, sentences
are kept apart. Known licence sentences are then found as phrases, each whole
and inside one sentence (one pattern, no shuffle); the identifiers of the hits,
in the order of the text, form a sequence that is matched against ordered
licence rules: a rule holds if its identifiers occur in that order.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Normalised sentences of public licence texts and notices.
SENTENCES = {
    "licensed under the apache license version 2.0": "apache-2-notice",
    "licensed under the apache license version 2.0 the license": "apache-2-notice",
    "you may not use this file except in compliance with the license": "apache-2-compliance",
    "you may obtain a copy of the license at": "apache-2-copy",
    "released under the mit license": "mit-notice",
    "licensed under the mit license": "mit-notice",
    "permission is hereby granted free of charge to any person obtaining a copy of this software": "mit-grant",
    "the above copyright notice and this permission notice shall be included in all copies": "mit-include",
    "the software is provided as is without warranty of any kind": "as-is",
    "this work is licensed under the gnu general public license version 3": "gpl-3-notice",
    "this work is licensed under the gnu general public license version 2": "gpl-2-notice",
    "this program is free software": "gpl-free",
    "you can redistribute it and/or modify it under the terms of the gnu general public license": "gpl-terms",
    "either version 3 of the license or at your option any later version": "gpl-3-later",
    "either version 2 of the license or at your option any later version": "gpl-2-later",
    "licensed under the gnu lesser general public license version 3": "lgpl-3-notice",
    "licensed under the gnu affero general public license version 3": "agpl-3-notice",
    "redistribution and use in source and binary forms are permitted": "bsd-redistribute",
    "redistributions of source code must retain the above copyright notice": "bsd-source",
    "redistributions in binary form must reproduce the above copyright notice": "bsd-binary",
    "neither the name of the copyright holder nor the names of its contributors may be used": "bsd-names",
    "permission to use copy modify and distribute this software for any purpose is granted": "isc-grant",
    "licensed under the mozilla public license version 2.0": "mpl-2-notice",
    "licensed under cc0 1.0": "cc0-notice",
    "licensed under cc by 4.0": "cc-by-notice",
    "licensed under cc by-sa 4.0": "cc-by-sa-notice",
    "licensed under cc by-nc 4.0": "cc-by-nc-notice",
    "licensed under cc by-nd 4.0": "cc-by-nd-notice",
    "licensed under cc by-nc-sa 4.0": "cc-by-nc-sa-notice",
    "licensed under cc by-nc-nd 4.0": "cc-by-nc-nd-notice",
    "spdx-license-identifier mit": "spdx-mit",
    "spdx-license-identifier apache-2.0": "spdx-apache-2",
    "spdx-license-identifier gpl-3.0-only": "spdx-gpl-3",
    "spdx-license-identifier gpl-2.0-only": "spdx-gpl-2",
    "all rights reserved": "reserved",
}

# Fixed values: (licence, class, identifiers in order). The first rule that
# holds names the document's licence, so longer rules stand first.
RULES = (
    ("Apache-2.0", "permissive", ("apache-2-notice", "apache-2-compliance", "apache-2-copy")),
    ("BSD-3-Clause", "permissive", ("bsd-redistribute", "bsd-source", "bsd-binary", "bsd-names")),
    ("BSD-2-Clause", "permissive", ("bsd-redistribute", "bsd-source", "bsd-binary")),
    ("MIT", "permissive", ("mit-grant", "mit-include", "as-is")),
    ("GPL-3.0-or-later", "copyleft", ("gpl-free", "gpl-terms", "gpl-3-later")),
    ("GPL-2.0-or-later", "copyleft", ("gpl-free", "gpl-terms", "gpl-2-later")),
    ("AGPL-3.0", "copyleft", ("agpl-3-notice",)),
    ("LGPL-3.0", "copyleft", ("lgpl-3-notice",)),
    ("GPL-3.0", "copyleft", ("gpl-3-notice",)),
    ("GPL-3.0", "copyleft", ("spdx-gpl-3",)),
    ("GPL-2.0", "copyleft", ("gpl-2-notice",)),
    ("GPL-2.0", "copyleft", ("spdx-gpl-2",)),
    ("CC-BY-NC-ND-4.0", "noncommercial", ("cc-by-nc-nd-notice",)),
    ("CC-BY-NC-SA-4.0", "noncommercial", ("cc-by-nc-sa-notice",)),
    ("CC-BY-NC-4.0", "noncommercial", ("cc-by-nc-notice",)),
    ("CC-BY-ND-4.0", "noderivatives", ("cc-by-nd-notice",)),
    ("CC-BY-SA-4.0", "copyleft", ("cc-by-sa-notice",)),
    ("CC-BY-4.0", "permissive", ("cc-by-notice",)),
    ("CC0-1.0", "permissive", ("cc0-notice",)),
    ("MPL-2.0", "copyleft", ("mpl-2-notice",)),
    ("Apache-2.0", "permissive", ("apache-2-notice",)),
    ("Apache-2.0", "permissive", ("spdx-apache-2",)),
    ("MIT", "permissive", ("mit-grant",)),
    ("MIT", "permissive", ("mit-notice",)),
    ("MIT", "permissive", ("spdx-mit",)),
    ("ISC", "permissive", ("isc-grant",)),
    ("Proprietary", "proprietary", ("reserved",)),
)

# Sentences of the published texts and notices as they run there,
# where the fragments above leave words out or stop short.
PUBLISHED = {
    "apache license version 2.0 january 2004": "apache-2-text",
    "redistribution and use in source and binary forms with or without modification are permitted":
        "bsd-redistribute",
    "nor the names of its contributors may be used to endorse or promote products derived from this software":
        "bsd-names",
    "nor the names of the contributors may be used to endorse or promote products derived from this software":
        "bsd-names",
    "the names of its contributors may not be used to endorse or promote products derived from this software":
        "bsd-names",
    "the name of the author may not be used to endorse or promote products derived from this software": "bsd-names",
    "permission to use copy modify and/or distribute this software for any purpose with or without fee is hereby granted":
        "isc-grant",
    "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted":
        "isc-grant",
    "gnu general public license version 3 29 june 2007": "gpl-3-text",
    "gnu general public license version 2 june 1991": "gpl-2-text",
    "gnu affero general public license version 3 19 november 2007": "agpl-3-text",
    "gnu lesser general public license version 3 29 june 2007": "lgpl-3-text",
    "gnu lesser general public license version 2.1 february 1999": "lgpl-2.1-text",
    "under the terms of the gnu general public license version 3 as published by the free software foundation":
        "gpl-3-notice",
    "under the terms of the gnu general public license as published by the free software foundation version 3":
        "gpl-3-notice",
    "under the terms of the gnu general public license version 2 as published by the free software foundation":
        "gpl-2-notice",
    "under the terms of the gnu general public license as published by the free software foundation version 2":
        "gpl-2-notice",
    "you can redistribute it and/or modify it under the terms of the gnu lesser general public license": "lgpl-terms",
    "you can redistribute it and/or modify it under the terms of the gnu affero general public license": "agpl-terms",
    "either version 2.1 of the license or at your option any later version": "lgpl-2.1-later",
    "this source code form is subject to the terms of the mozilla public license": "mpl-terms",
    "if a copy of the mpl was not distributed with this file you can obtain one at": "mpl-2-obtain",
}

KNOWN = SENTENCES | PUBLISHED

# Rules for these. A whole GPL text ends with a sample notice
# "or any later version", so the texts stand before the notices.
_TEXT_RULES = (
    ("AGPL-3.0", "copyleft", ("agpl-3-text",)),
    ("LGPL-3.0", "copyleft", ("lgpl-3-text",)),
    ("LGPL-2.1", "copyleft", ("lgpl-2.1-text",)),
    ("GPL-3.0", "copyleft", ("gpl-3-text",)),
    ("GPL-2.0", "copyleft", ("gpl-2-text",)),
)
_NOTICE_RULES = (
    ("AGPL-3.0-or-later", "copyleft", ("agpl-terms", "gpl-3-later")),
    ("LGPL-3.0-or-later", "copyleft", ("lgpl-terms", "gpl-3-later")),
    ("LGPL-2.1-or-later", "copyleft", ("lgpl-terms", "lgpl-2.1-later")),
    ("GPL-3.0-or-later", "copyleft", ("gpl-terms", "gpl-3-later")),
    ("GPL-2.0-or-later", "copyleft", ("gpl-terms", "gpl-2-later")),
    ("MPL-2.0", "copyleft", ("mpl-terms", "mpl-2-obtain")),
    ("Apache-2.0", "permissive", ("apache-2-text",)),
)
ALL_RULES = RULES[:4] + _TEXT_RULES + RULES[4:6] + _NOTICE_RULES + RULES[6:]

#: Comment leaders at the start of a line; a blank or the line's end follows.
LEADER = r"""(?m)^(?:[ \t]*(?:[#*;%!/<>+"'-]+|\.\.|\.?\\"|@?rem|dnl|::)(?=[ \t\r]|$)){1,4}"""
#: Ends of sentences: a full stop, mark or semicolon (and what closes after it) before white space, or an empty line.
SENTENCE_END = r"""[.!?;]+(?=["')\]*]*(?:\s|\z))|\n[ \t\r]*\n|\r[ \t]*\r"""
#: Everything but letters, digits, ends of sentences and what stands inside names and versions.
NOISE = r"[^a-z0-9./+|-]+|(?<![a-z0-9])[./+-]+|[./-]+(?![a-z0-9])"


def normalise(text: Column) -> Column:
    """Lower case; comment leaders out; ends of sentences become '|', all else
    that is not part of a word, line ends too, becomes a blank."""
    t = F.regexp_replace(F.translate(F.lower(text), "|", " "), LEADER, "")
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(t, SENTENCE_END, "|"), NOISE, " "), " {2,}", " ")


def anchors(known: Sequence[str]) -> list[str]:
    """A few words of which every known sentence has one at least."""
    left, out = [set(k.split()) for k in known], []
    while left:
        words = sorted({w for ws in left for w in ws}, key=lambda w: (-sum(w in ws for ws in left), -len(w), w))
        # Words that any prose has would let every text through.
        out.append(next((w for w in words if len(w) > 6), words[0]))
        left = [ws for ws in left if not any(out[-1] in w for w in ws)]
    return out


def phrases(text: Column, known: Sequence[str]) -> Column:
    """The known sentences in the text, in order; of those that begin at one word the longest."""
    longest_first = sorted(known, key=lambda k: (-len(k), k))
    pattern = "(?<![^ |])(?=(" + "|".join(map(re.escape, longest_first)) + ")(?![^ |]))"
    low = F.lower(text)
    some = F.lit(False)
    for word in anchors(known):
        some = some | low.contains(word)
    return F.when(some, F.regexp_extract_all(normalise(text), F.lit(pattern), F.lit(1))) \
        .otherwise(F.array().cast("array<string>"))


def scan(docs: DataFrame, known: dict[str, str] = KNOWN,
         rules: Sequence[tuple[str, str, Sequence[str]]] = ALL_RULES, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """One row per input row: id, sentence_ids (identifiers of the known
    sentences found, alone or inside longer ones, in text order, each in angle
    brackets), n_licence_sentences (how many), licence and licence_class of
    the first rule that holds ('none' if no rule holds), n_rules (rules that
    hold) and licences (all that hold, in rule order, joined by commas).

    NULL or empty text: no sentences, licence 'none'. NULL ids, ties and
    repeated rows give a row each. Texts are scanned whole. Empty table: no
    rows. Other columns are not read.
    """
    hits = phrases(F.col("text"), list(known))
    table = F.create_map(*[F.lit(x) for pair in known.items() for x in pair])
    ids = F.transform(hits, lambda s: F.concat(F.lit("<"), table[s], F.lit(">")))
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")) \
        .select("id", ids.alias("ids")) \
        .select("id", F.array_join("ids", "").alias("sentence_ids"),
                F.size("ids").cast("long").alias("n_licence_sentences"))
    sequence = F.col("sentence_ids")

    def holds(wanted: Sequence[str]) -> Column:
        return sequence.like("%" + "%".join(f"<{i}>" for i in wanted) + "%")

    licence, kind = F.lit("none"), F.lit("none")
    for name, cls, wanted in reversed(rules):
        licence = F.when(holds(wanted), F.lit(name)).otherwise(licence)
        kind = F.when(holds(wanted), F.lit(cls)).otherwise(kind)
    # Most rows have no hit; they skip the rules.
    some = F.col("n_licence_sentences") > 0
    held = F.array_compact(F.array(*[F.when(holds(w), F.lit(n)) for n, _, w in rules]))
    return d.select(
        F.col("id").alias(id_col), "sentence_ids", "n_licence_sentences",
        F.when(some, licence).otherwise("none").alias("licence"),
        F.when(some, kind).otherwise("none").alias("licence_class"),
        F.when(some, F.size(held)).otherwise(0).cast("long").alias("n_rules"),
        F.when(some, F.array_join(F.array_distinct(held), ",")).otherwise("").alias("licences"))
