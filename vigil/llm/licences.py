"""Licence texts by sentences: known sentences become identifiers, and rules are ordered sequences of identifiers.

A text is cut into sentences twice: by line, and by paragraph with its wrapped lines joined. Sentences are compared in lower
case, letters and digits only. Sentences that are not known are passed over, so a name or a year between two sentences does
not hide a licence; a rule holds where its identifiers stand next to each other in what remains. Every known sentence
contains one of ``SIGNS``, so texts without any of them need not be cut. One projection of built-in functions: no shuffle.

A notice that cutting takes apart at a semicolon is a rule over its parts, the one with the version included. The version of
the Mozilla licence, cut off after "v.", is looked up in the text; the SQL twin does not do that and takes every version for 2.0.

"All rights reserved." is reported as ``all-rights-reserved``, also beside a licence whose text or copyright line holds it.

Defined results: null or empty texts hold no licence; ids may repeat or be null; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import re
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import documents

# Sentences of public licence texts and notices, and the licences they make up in this order.
SENTENCES = {
    "mit-notice": "Released under the MIT License.",
    "mit-notice-2": "Licensed under the MIT License.",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "mit-keep": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "mit-as-is": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "bsd-names": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "apache-notice": "Licensed under the Apache License, Version 2.0.",
    "apache-grant": "Licensed under the Apache License, Version 2.0 (the \"License\");",
    "apache-compliance": "you may not use this file except in compliance with the License.",
    "apache-copy": "You may obtain a copy of the License at",
    "gpl3-notice": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-grant": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "gpl2-grant": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 2 of the License, or (at your option) any later version.",
    "gpl2-only-grant": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, version 2 of the License.",
    "gpl3-only-grant": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, version 3 of the License.",
    "gpl-terms": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation;",
    "gpl2-or-later": "either version 2 of the License, or (at your option) any later version.",
    "gpl2-or-later-2": "either version 2, or (at your option) any later version.",
    "gpl2-only": "version 2 of the License.",
    "gpl2-only-2": "version 2.",
    "gpl3-or-later": "either version 3 of the License, or (at your option) any later version.",
    "gpl3-or-later-2": "either version 3, or (at your option) any later version.",
    "gpl3-only": "version 3 of the License.",
    "gpl3-only-2": "version 3.",
    "lgpl-notice": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "mpl-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "cc-by-nc": "Licensed under CC BY-NC 4.0.",
    "cc-by": "Licensed under CC BY 4.0.",
    "cc-by-sa": "Licensed under CC BY-SA 4.0.",
    "cc-by-text": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-sa-text": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "reserved": "All rights reserved.",
}
RULES = (
    ("MIT", ("mit-grant", "mit-keep", "mit-as-is")),
    ("MIT", ("mit-notice",)),
    ("MIT", ("mit-notice-2",)),
    ("ISC", ("isc-grant",)),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-names")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("Apache-2.0", ("apache-grant", "apache-compliance", "apache-copy")),
    ("Apache-2.0", ("apache-notice",)),
    ("GPL-3.0", ("gpl3-notice",)),
    ("GPL-3.0-or-later", ("gpl-grant",)),
    ("GPL-2.0-or-later", ("gpl2-grant",)),
    ("GPL-2.0-only", ("gpl2-only-grant",)),
    ("GPL-3.0-only", ("gpl3-only-grant",)),
    ("GPL-2.0-or-later", ("gpl-terms", "gpl2-or-later")),
    ("GPL-2.0-or-later", ("gpl-terms", "gpl2-or-later-2")),
    ("GPL-2.0-only", ("gpl-terms", "gpl2-only")),
    ("GPL-2.0-only", ("gpl-terms", "gpl2-only-2")),
    ("GPL-3.0-or-later", ("gpl-terms", "gpl3-or-later")),
    ("GPL-3.0-or-later", ("gpl-terms", "gpl3-or-later-2")),
    ("GPL-3.0-only", ("gpl-terms", "gpl3-only")),
    ("GPL-3.0-only", ("gpl-terms", "gpl3-only-2")),
    ("LGPL-3.0", ("lgpl-notice",)),
    ("MPL-2.0", ("mpl-notice",)),
    ("CC-BY-NC-4.0", ("cc-by-nc",)),
    ("CC-BY-4.0", ("cc-by",)),
    ("CC-BY-4.0", ("cc-by-text",)),
    ("CC-BY-SA-4.0", ("cc-by-sa",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-text",)),
    ("all-rights-reserved", ("reserved",)),
)
# Like a name or a year, a copyright line between two sentences does not hide a licence.
RULES = tuple(
    (name, (ids[0], *(x for also, id in zip(gaps, ids[1:], strict=True) for x in (*also, id))))
    for name, ids in RULES
    for gaps in product(((), ("reserved",)), repeat=len(ids) - 1)
)
# A rule whose sequence another rule continues gives way where that one holds.
GIVES_WAY = {"BSD-2-Clause": "BSD-3-Clause"}
SIGNS = ("licen", "permission", "redistribut", "merchantability", "endorse", "later version", "version 2", "version 3", "reserved")

LINE = r"\n+|[.;:!?]+[\s)\"']+"
PARAGRAPH = r"\n\s*\n\s*|[.;:!?]+[\s)\"']+"


# "v." ends a sentence for both cuts; where another version than 2.0 follows, Spark's side spoils the part before it.
OTHER_MPL = r"(?i)(mozilla\s+public\s+license,?\s+v)\.(?!\s*2\.0(?!\.?\d))"


def normal(sentence: str) -> str:
    return re.sub("[^a-z0-9]+", " ", sentence.lower()).strip()


# The longest part that cutting leaves of a known sentence stands for it; what else must hold is a sentence of its own, or OTHER_MPL.
KNOWN = {max((normal(part) for part in re.split(LINE, text + " ")), key=len): name for name, text in SENTENCES.items()}


def _identifiers(text: Column, cut: str) -> Column:
    """The identifiers of the known sentences in order, as one string with a bar on either side of each."""
    names = F.create_map(*(F.lit(x) for pair in KNOWN.items() for x in pair))
    plain = F.transform(F.split(text, cut), lambda s: F.trim(F.regexp_replace(F.lower(s), "[^a-z0-9]+", " ")))
    known = F.transform(F.filter(plain, lambda s: s.isin(*KNOWN)), lambda s: F.element_at(names, s))
    return F.concat(F.lit("|"), F.array_join(F.transform(known, lambda s: F.concat(s, F.lit("|"))), "|"))


def _licences(sequence: Column) -> Column:
    held = [F.when(sequence.contains("|" + "||".join(ids) + "|"), name) for name, ids in RULES]
    return F.array_compact(F.array_distinct(F.array(*held)))


def licences(df: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: id, ``licences`` (sorted, joined by commas; empty if none) and the ``sentences`` found by line."""
    bare = df.select(F.col(id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    signed = F.lit(False)
    for sign in SIGNS:
        signed = signed | F.lower("text").contains(sign)
    relevant = F.when(signed, F.col("text")).otherwise("")
    relevant = F.regexp_replace(relevant, OTHER_MPL, "$1 other ")
    found = bare.select("id", _identifiers(relevant, LINE).alias("a"), _identifiers(relevant, PARAGRAPH).alias("b"))
    names = F.array_union(_licences(F.col("a")), _licences(F.col("b")))
    out = found.select("id", "a", names.alias("names"))
    for less, more in GIVES_WAY.items():
        out = out.withColumn("names", F.when(F.array_contains("names", more), F.array_remove("names", less)).otherwise(F.col("names")))
    return out.select(
        F.col("id").alias(id),
        F.array_join(F.array_sort("names"), ",").alias("licences"),
        F.trim(F.regexp_replace("a", r"\|+", " ")).alias("sentences"),
    )


def op4_licences(spark, folder):
    return licences(documents(spark, folder))


def _sql() -> str:
    def text(x: str) -> str:
        return "'" + x.replace("'", "''") + "'"

    keys, names = (", ".join(map(text, x)) for x in (KNOWN, KNOWN.values()))
    signed = " OR ".join(f"contains(lower(text), {text(s)})" for s in SIGNS)

    def sequence(cut: str) -> str:
        return f"""'|' || array_to_string(list_transform(list_filter(list_transform(string_split_regex(t, {text(cut)}),
            lambda s: list_position([{keys}], trim(regexp_replace(lower(s), '[^a-z0-9]+', ' ', 'g')))), lambda i: i IS NOT NULL AND i > 0),
            lambda i: ([{names}])[i] || '|'), '|')"""

    held = ", ".join(f"CASE WHEN contains(a, {q}) OR contains(b, {q}) THEN {text(n)} END" for n, ids in RULES for q in [text("|" + "||".join(ids) + "|")])
    ways = " AND ".join(f"NOT (n = {text(k)} AND list_contains(names, {text(v)}))" for k, v in GIVES_WAY.items())
    return f"""
        WITH r AS (SELECT doc_id, CASE WHEN {signed} THEN text ELSE '' END AS t FROM documents),
        s AS (SELECT doc_id, coalesce({sequence(LINE)}, '|') AS a, coalesce({sequence(PARAGRAPH)}, '|') AS b FROM r),
        h AS (SELECT doc_id, a, list_distinct(list_filter([{held}], lambda n: n IS NOT NULL)) AS names FROM s)
        SELECT doc_id, coalesce(array_to_string(list_sort(list_filter(names, lambda n: {ways})), ','), '') AS licences,
               trim(regexp_replace(a, '[|]+', ' ', 'g')) AS sentences FROM h
    """


QUERIES = {"op4_licences": op4_licences}
ORACLE = {"op4_licences": _sql()}
