"""Licence scans: sentences to known sentence ids, then ordered rules over the ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sentences of public licence texts and notices, normalised, with their ids.
SENTENCES = {
    "released under the mit license": 1,
    "licensed under the mit license": 1,
    "this project is licensed under the mit license": 1,
    "the mit license": 2,
    "mit license": 2,
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": 3,
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": 4,
    "licensed under the apache license version 2 0": 5,
    "licensed under the apache license version 2 0 the license": 5,
    "apache license": 6,
    "version 2 0 january 2004": 7,
    "this work is licensed under the gnu general public license version 3": 8,
    "licensed under the gnu general public license version 3": 8,
    "gnu general public license": 9,
    "version 3 29 june 2007": 10,
    "version 2 june 1991": 11,
    "licensed under cc by nc 4 0": 12,
    "this work is licensed under cc by nc 4 0": 12,
    "licensed under cc by 4 0": 13,
    "licensed under cc by sa 4 0": 14,
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": 15,
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": 16,
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": 17,
    "spdx license identifier mit": 1,
    "spdx license identifier apache 2 0": 5,
    "spdx license identifier gpl 3 0 only": 8,
    "spdx license identifier gpl 3 0 or later": 8,
    "all rights reserved": 18,
}

# Licence to sentence ids that must follow each other in this order; other known sentences may stand between.
RULES = [
    ("MIT", [1]),
    ("MIT", [3, 4]),
    ("Apache-2.0", [5]),
    ("Apache-2.0", [6, 7]),
    ("GPL-3.0", [8]),
    ("GPL-3.0", [9, 10]),
    ("GPL-2.0", [9, 11]),
    ("CC-BY-NC-4.0", [12]),
    ("CC-BY-4.0", [13]),
    ("CC-BY-SA-4.0", [14]),
    ("BSD-3-Clause", [15, 16, 17]),
    ("BSD-2-Clause", [15, 16]),
    ("all-rights-reserved", [18]),
]


# Rules that are part of a longer one: no match where this id follows before the rule's first id comes again.
SHORTER = {"BSD-2-Clause": 17}

_LINE_END = r"(?>\r\n|[\r\n])"


def known_sentences(text: Column) -> Column:
    """The sentences of ``SENTENCES`` in text order: lower case, other signs as one blank.

    They start and end at marks before white space or at line ends. Line ends inside them count as blanks, with the
    signs, list letters, ``rem`` or ``dnl`` that start the next line; lines without a Latin letter or digit do not.
    Of sentences that start at the same place the longest counts.
    """
    lines = F.translate(F.concat(F.lit("\n"), F.lower(text), F.lit("\n")), "\u0002", " ")
    blocks = F.regexp_replace(lines, rf"{_LINE_END}(?:[^a-z0-9\r\n]*+{_LINE_END})++", "\u0001\n")
    joined = F.regexp_replace(blocks, r"[\r\n]+[^a-z0-9\r\n]*+(?:(?:rem|dnl|(?:[0-9]{1,2}|[a-z])\))[ \t]+(?=[a-z]))?", "\u0002")
    cut = F.regexp_replace(joined, r"[.!?;]+(?=[\s\x01\x02])", "\u0001")
    plain = F.regexp_replace(cut, r"[^a-z0-9\x01\x02]+", " ")
    any_of = "|".join(s.replace(" ", r"[ \x02]+") for s in sorted(SENTENCES, key=len, reverse=True))
    hits = F.regexp_extract_all(plain, F.lit(rf"[\x01\x02] ?({any_of})(?= ?[\x01\x02])"), F.lit(1))
    return F.transform(hits, lambda s: F.regexp_replace(s, r"[ \x02]+", " "))


def _pattern(name: str, rule: list[int]) -> str:
    """Of comma-joined ids that hold ``rule``; its loops give nothing back, so that many ids need no deep stack."""
    later = "".join(rf",(?:(?!{i},)[0-9]+,)*+{i}" for i in rule[1:])
    if name not in SHORTER:
        return f"(^|,){rule[0]}{later}(,|$)"
    first, last = rule
    between = rf"(?:(?!(?:{first}|{last}),)[0-9]+,)*+"
    return rf"(^|,){first},{between}{last}(?:,(?!(?:{first}|{SHORTER[name]})(?:,|$))[0-9]+)*+(,{first}(,|$)|$)"


def scan(docs: DataFrame) -> DataFrame:
    """``(doc_id, sentence_ids, licenses)`` for every row: ids in text order and licences by name, comma-joined.

    Null and empty texts, and texts without a known sentence, have two empty strings; repeated rows and null ids give
    a row each; other columns are left out. Each row is worked on where it was read, without a shuffle.
    """
    known = F.create_map(*[F.lit(x) for pair in SENTENCES.items() for x in pair])
    hits = known_sentences(F.coalesce(F.col("text"), F.lit("")))
    ids = F.concat_ws(",", F.transform(hits, lambda s: F.element_at(known, s).cast("string")))
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), ids.alias("sentence_ids"))
    names = []
    for name, rule in RULES:
        names.append(F.when(F.col("sentence_ids").rlike(_pattern(name, rule)), F.lit(name)))
    licences = F.concat_ws(",", F.array_sort(F.array_distinct(F.array_compact(F.array(*names)))))
    return found.select("doc_id", "sentence_ids", licences.alias("licenses"))


def oracle() -> str:
    """The scan in DuckDB SQL, of sentences that stand on one line each; BSD-2-Clause also where BSD-3-Clause holds."""
    cases = " ".join(f"WHEN '{s}' THEN '{i}'" for s, i in SENTENCES.items())
    names = ", ".join(
        f"CASE WHEN regexp_matches(sentence_ids, '(^|,)" + ",([0-9]+,)*".join(map(str, rule)) + f"(,|$)') THEN '{name}' END" for name, rule in RULES
    )
    return rf"""
WITH cut AS (
  SELECT doc_id, string_split(regexp_replace(lower(regexp_replace(regexp_replace(coalesce(text, ''), '[.!?;]+(\s|$)', chr(1) || '\1', 'g'),
         '[\r\n]+', chr(1), 'g')), '[^a-z0-9\x01]+', ' ', 'g'), chr(1)) AS parts
  FROM documents),
ids AS (
  SELECT doc_id, array_to_string(list_filter(list_transform(parts, lambda s: CASE trim(s) {cases} END), lambda x: x IS NOT NULL), ',') AS sentence_ids
  FROM cut)
SELECT doc_id, sentence_ids, array_to_string(list_sort(list_distinct(list_filter([{names}], lambda x: x IS NOT NULL))), ',') AS licenses
FROM ids"""
