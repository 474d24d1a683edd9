"""Licence scan by sentences: known sentences become identifiers, and ordered rules read the sequence of identifiers.

A text is normalised (small letters and digits, single spaces) with its cuts marked, and read for the
sentences that licences are made of. A known sentence stands between two cuts; colons, semicolons and line ends are cuts
too, but may also lie within it, so that wrapped texts and headers match. The identifiers found, in order, are matched against the rules from
the first to the last; what a rule matches is used up, so that a full licence text isn't reported again by
the shorter rules below it.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Normalised sentences of well-known licences and notices, by identifier.
SENTENCES = {
    "mit grant": (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software "
        "to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell "
        "copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions"
    ),
    "mit notice": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "mit warranty": (
        "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability "
        "fitness for a particular purpose and noninfringement"
    ),
    "mit name": "released under the mit license",
    "mit name 2": "this project is licensed under the mit license",
    "mit spdx": "spdx license identifier mit",
    "apache name": "licensed under the apache license version 2 0",
    "apache name 2": "licensed under the apache license version 2 0 the license",
    "apache use": "you may not use this file except in compliance with the license",
    "apache copy": "you may obtain a copy of the license at http www apache org licenses license 2 0",
    "apache warranty": (
        "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis "
        "without warranties or conditions of any kind either express or implied"
    ),
    "apache spdx": "spdx license identifier apache 2 0",
    "gpl3 name": "this work is licensed under the gnu general public license version 3",
    "gpl3 later": (
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by "
        "the free software foundation either version 3 of the license or at your option any later version"
    ),
    "gpl2 later": (
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by "
        "the free software foundation either version 2 of the license or at your option any later version"
    ),
    "gpl warranty": "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "gpl3 spdx": "spdx license identifier gpl 3 0 only",
    "bsd grant": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd source": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsd binary": (
        "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation "
        "and or other materials provided with the distribution"
    ),
    "bsd names": (
        "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software "
        "without specific prior written permission"
    ),
    "cc by": "this work is licensed under a creative commons attribution 4 0 international license",
    "cc by sa": "this work is licensed under a creative commons attribution sharealike 4 0 international license",
    "cc by short": "licensed under cc by 4 0",
    "cc by sa short": "licensed under cc by sa 4 0",
    "cc by nc short": "licensed under cc by nc 4 0",
    "cc by nc": "this work is licensed under a creative commons attribution noncommercial 4 0 international license",
    "cc0": "this work is dedicated to the public domain",
    "rights": "all rights reserved",
}


class Rule(NamedTuple):
    licence: str
    sentences: tuple[str, ...]


#: From full texts down to names and notices. The first rule that matches uses its sentences up.
RULES = (
    Rule("MIT", ("mit grant", "mit notice", "mit warranty")),
    Rule("BSD-3-Clause", ("bsd grant", "bsd source", "bsd binary", "bsd names")),
    Rule("BSD-2-Clause", ("bsd grant", "bsd source", "bsd binary")),
    Rule("Apache-2.0", ("apache name 2", "apache use", "apache copy", "apache warranty")),
    Rule("Apache-2.0", ("apache name", "apache use", "apache copy", "apache warranty")),
    Rule("GPL-3.0-or-later", ("gpl3 later", "gpl warranty")),
    Rule("GPL-2.0-or-later", ("gpl2 later", "gpl warranty")),
    Rule("GPL-3.0-or-later", ("gpl3 later",)),
    Rule("GPL-2.0-or-later", ("gpl2 later",)),
    Rule("MIT", ("mit grant",)),
    Rule("MIT", ("mit name",)),
    Rule("MIT", ("mit name 2",)),
    Rule("MIT", ("mit spdx",)),
    Rule("Apache-2.0", ("apache name 2",)),
    Rule("Apache-2.0", ("apache name",)),
    Rule("Apache-2.0", ("apache spdx",)),
    Rule("GPL-3.0-only", ("gpl3 name",)),
    Rule("GPL-3.0-only", ("gpl3 spdx",)),
    Rule("CC-BY-4.0", ("cc by",)),
    Rule("CC-BY-4.0", ("cc by short",)),
    Rule("CC-BY-SA-4.0", ("cc by sa",)),
    Rule("CC-BY-SA-4.0", ("cc by sa short",)),
    Rule("CC-BY-NC-4.0", ("cc by nc",)),
    Rule("CC-BY-NC-4.0", ("cc by nc short",)),
    Rule("CC0-1.0", ("cc0",)),
    Rule("All-Rights-Reserved", ("rights",)),
)

#: Every known sentence holds one of these (single words, as any blank may be a line end), so that a text without any of them has none.
HINTS = ("licen", "permission", "warrant", "redistribution", "reserved", "copyright", "domain")

#: A sentence ends at one of these marks, where white space or the text's end follows.
SENTENCE_END = r"[.!?](?=\s|$)"
#: It may end here, or go on.
PART_END = r"\n|[;:](?=\s|$)"

#: Stand for the two kinds of cut in a normalised text.
_CUT, _PART = "\x01", "\x02"
#: Any known sentence from cut to cut, the longest first. Between its words there may be part ends.
_KNOWN = (
    rf"(?<=[{_CUT}{_PART}] {{0,1}})(?:"
    + "|".join(s.replace(" ", f"[ {_PART}]++") for s in sorted(SENTENCES.values(), key=len, reverse=True))
    + rf")(?= ?[{_CUT}{_PART}])"
)


def sentence_ids(text: Column) -> Column:
    """Identifiers of the known sentences of a text, in order."""
    table = F.create_map(*(F.lit(x) for name, sentence in SENTENCES.items() for x in (sentence, name)))
    marked = F.regexp_replace(F.translate(F.lower(text), _CUT + _PART, "  "), SENTENCE_END, _CUT)
    plain = F.regexp_replace(F.regexp_replace(marked, PART_END, _PART), f"[^a-z0-9{_CUT}{_PART}]+", " ")
    known = F.regexp_extract_all(F.concat(F.lit(_CUT), plain, F.lit(_CUT)), F.lit(_KNOWN), F.lit(0))
    return F.transform(known, lambda s: F.element_at(table, F.regexp_replace(s, f"[ {_PART}]+", " ")))


def licence_scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``doc_id``, ``n_sentences``, ``sentences``, ``licences`` and ``unmatched`` of every row of ``docs``.

    ``sentences`` lists the known sentences in order, ``licences`` what the rules find, in rule order and each licence
    once, ``unmatched`` the sentences that no rule uses; all are joined by ", ". A missing or empty text has none, and
    nor has one without known sentences: the lists are then empty. Each row is scanned by itself, whatever
    its identifier.
    """
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    small = F.lower("text")
    hinted = texts.select("doc_id", "text", F.greatest(*(small.contains(h) for h in HINTS)).alias("hint"))
    found = hinted.select("doc_id", F.when(F.col("hint"), sentence_ids(F.col("text"))).otherwise(F.array().cast("array<string>")).alias("ids"))
    # Identifiers stand between bars, so that a rule is a stretch of the sequence and matches whole identifiers only.
    found = found.select("doc_id", "ids", F.array_join(F.transform("ids", lambda i: F.concat(F.lit("|"), i, F.lit("|"))), "").alias("line"))
    table = F.array(*(F.struct(F.lit(r.licence).alias("licence"), F.lit("".join(f"|{i}|" for i in r.sentences)).alias("stretch")) for r in rules))

    def apply(done: Column, rule: Column) -> Column:
        return F.struct(
            F.replace(done["line"], rule["stretch"], F.lit("||")).alias("line"),
            F.when(F.contains(done["line"], rule["stretch"]), F.array_union(done["found"], F.array(rule["licence"]))).otherwise(done["found"]).alias("found"),
        )

    start = F.struct(F.col("line"), F.array().cast("array<string>").alias("found"))
    read = found.select("doc_id", "ids", F.when(F.size("ids") > 0, F.aggregate(table, start, apply)).alias("done"))
    left = F.filter(F.split("done.line", r"\|"), lambda s: s != "")
    return read.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_sentences"),
        F.array_join("ids", ", ").alias("sentences"),
        F.coalesce(F.array_join("done.found", ", "), F.lit("")).alias("licences"),
        F.coalesce(F.array_join(left, ", "), F.lit("")).alias("unmatched"),
    )
