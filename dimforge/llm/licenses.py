"""License recognition by sentence rules, in native Spark expressions.

A text is cut into sentences, each sentence is normalised (ASCII lower case,
punctuation to blanks) and looked up among known licence sentences.  The
identifiers found, in text order, form a sequence that is matched against
ordered rules: at each place the first rule that fits takes its identifiers.
An identifier that no rule takes is reported as ``fragment``.

A sentence ends at ``. ! ?`` before white space or the end of the text, so a
sentence may run over several lines (wrapped licence texts).  If such a
sentence is not known as a whole, the known sentences in it are looked for that
start and end with its lines: after a copyright line, a blank line, a colon or a
list number, and over any number of lines (the longest first).  Comment marks
and list numbers around a line do not count.  ``n_sentences`` counts by ``. ! ?``.

Defined results: NULL and empty texts have no sentences and no licences;
repeated sentences count each time they occur; input columns that clash with
the added ones (``n_sentences sentence_ids licenses``) are replaced.  The plan
is one projection over the scan: no shuffle, no Python, any text length.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Normalised licence sentences.  The letter is the identifier
# used in the rules below.
SENTENCES = {
    "M": ("mit-grant", "released under the mit license"),
    "m": ("mit-licensed", "licensed under the mit license"),
    "P": ("mit-permission", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and/or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions"),
    "N": ("mit-notice", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    "W": ("mit-as-is", "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement"),
    "L": ("mit-liability", "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software"),
    "A": ("apache-2.0-grant", "licensed under the apache license version 2.0"),
    "a": ("apache-2.0-header", "licensed under the apache license version 2.0 the license you may not use this file except in compliance with the license"),
    "o": ("apache-2.0-copy", "you may obtain a copy of the license at http //www.apache.org/licenses/license-2.0"),
    "u": ("apache-2.0-as-is", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied"),
    "v": ("apache-2.0-see", "see the license for the specific language governing permissions and limitations under the license"),
    "G": ("gpl-3-grant", "this work is licensed under the gnu general public license version 3"),
    "g": ("gpl-3-only", "licensed under the gnu general public license version 3"),
    "F": ("gpl-free-software", "this program is free software you can redistribute it and/or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    "f": ("gpl-2-free-software", "this program is free software you can redistribute it and/or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version"),
    "H": ("gpl-hope", "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose"),
    "h": ("gpl-details", "see the gnu general public license for more details"),
    "C": ("cc-by-nc-4.0-grant", "licensed under cc by-nc 4.0"),
    "c": ("cc-by-4.0-grant", "licensed under cc by 4.0"),
    "s": ("cc-by-sa-4.0-grant", "licensed under cc by-sa 4.0"),
    "z": ("cc0-grant", "released under cc0 1.0"),
    "R": ("bsd-redistribution", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    "S": ("bsd-source", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    "B": ("bsd-binary", "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution"),
    "E": ("bsd-endorse", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    "Z": ("mpl-2.0-grant", "this source code form is subject to the terms of the mozilla public license v. 2.0"),
    "U": ("unlicense-grant", "this is free and unencumbered software released into the public domain"),
    "X": ("all-rights-reserved", "all rights reserved"),
}

# Ordered rules: identifier sequence -> licence.  Earlier rules win.
RULES = (
    ("PNWL", "MIT"), ("PNW", "MIT"), ("MPNWL", "MIT"),
    ("aouv", "Apache-2.0"), ("aou", "Apache-2.0"), ("Aouv", "Apache-2.0"),
    ("FHh", "GPL-3.0-or-later"), ("FH", "GPL-3.0-or-later"), ("fHh", "GPL-2.0-or-later"), ("fH", "GPL-2.0-or-later"),
    ("RSBE", "BSD-3-Clause"), ("RSB", "BSD-2-Clause"),
    ("M", "MIT"), ("m", "MIT"), ("A", "Apache-2.0"), ("a", "Apache-2.0"), ("G", "GPL-3.0"), ("g", "GPL-3.0"),
    ("F", "GPL-3.0-or-later"), ("f", "GPL-2.0-or-later"), ("C", "CC-BY-NC-4.0"), ("c", "CC-BY-4.0"),
    ("s", "CC-BY-SA-4.0"), ("z", "CC0-1.0"), ("Z", "MPL-2.0"), ("U", "Unlicense"), ("X", "all-rights-reserved"),
)

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ENDS = r"[.!?]+(?:[\x09-\x0D\x20]+|$)"
NOISE = r"[\x00-\x20!-*,:-@\[-`{-\x7F]+"
_BLANK = r"[\x00-\x20]"
# what comes before the words of a line: comment marks, then a list number or bullet
PREFIX = (rf"^(?:{_BLANK}|/\*+|\*+/|//+|--+|<!--|[*#;%!>|]|(?:dnl|rem)(?={_BLANK}))*"
          rf"(?:(?:\(?(?:[0-9]{{1,2}}|[a-z])\)|[0-9]{{1,2}}\.|[-+\u2022\u00b7]){_BLANK}+)?")
SUFFIX = rf"{_BLANK}*(?:\*+/|-->){_BLANK}*$"
# the number of the next list item, cut off from it by its full stop
NEXT_ITEM = rf":{_BLANK}+\(?[0-9]{{1,2}}\)?{_BLANK}*$"
RULER = r"^[-+./ ]*$"
ADDED = ("n_sentences", "sentence_ids", "licenses")


def _normal(s):
    return F.trim(F.regexp_replace(s, NOISE, " "))


def recognise(docs: DataFrame, *, text: str = "text", sentences=SENTENCES, rules=RULES) -> DataFrame:
    """``docs`` plus ``n_sentences`` (non-empty sentences), ``sentence_ids``
    (names of the known sentences found, in order) and ``licenses`` (what the
    rules make of them, in order); both arrays."""
    letter = F.create_map(*[F.lit(x) for k, (_, s) in sentences.items() for x in (s, k)])
    name = F.create_map(*[F.lit(x) for k, (n, _) in sentences.items() for x in (k, n)])
    rule = F.create_map(*[F.lit(x) for k, n in rules for x in (k, n)])
    base = docs.drop(*[c for c in ADDED if c != text])
    low = F.translate(F.coalesce(F.col(text), F.lit("")), UPPER, LOWER)
    raw = F.filter(F.split(low, ENDS), lambda s: F.length(_normal(s)) > 0)

    longest = sorted((s for _, s in sentences.values()), key=lambda s: (-len(s), s))
    inside = "\n(" + "|".join(re.escape(s).replace("\\ ", "[ \n]") for s in longest) + ")(?=\n)"

    def known(s):
        lines = F.transform(F.split(F.regexp_replace(s, NEXT_ITEM, ""), r"[\x0A\x0D]+"), lambda line: _normal(
            F.regexp_replace(F.regexp_replace(line, PREFIX, ""), SUFFIX, "")))
        lines = F.filter(lines, lambda line: ~line.rlike(RULER))
        found = F.regexp_extract_all(F.concat(F.lit("\n"), F.array_join(lines, "\n"), F.lit("\n")), F.lit(inside), F.lit(1))
        whole = F.element_at(letter, _normal(s))
        return F.when(whole.isNotNull(), whole).otherwise(F.array_join(
            F.transform(found, lambda m: F.element_at(letter, F.translate(m, "\n", " "))), ""))

    # array_join skips NULLs, so unknown sentences leave no letter
    step = (base.select("*", raw.alias("_raw"))
                .select(*base.columns, F.size("_raw").cast("long").alias("n_sentences"),
                        F.array_join(F.transform("_raw", known), "").alias("_seq")))
    pattern = "(" + "|".join(k for k, _ in rules) + "|.)"
    found = F.regexp_extract_all(F.col("_seq"), F.lit(pattern), F.lit(1))
    ids = F.filter(F.split("_seq", ""), lambda c: c != "")
    return step.select(*base.columns, "n_sentences",
                       F.transform(ids, lambda c: F.element_at(name, c)).alias("sentence_ids"),
                       F.transform(found, lambda m: F.coalesce(F.element_at(rule, m), F.lit("fragment")))
                       .alias("licenses"))
