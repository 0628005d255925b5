"""Licence scans by sentence-rule recognition.

A text is cut into pieces (at line ends and after . ! ? before white space), each is normalised (lower case, only
letters a-z and digits, single spaces).  One piece, or a run of pieces without a blank one between them, that reads like a known
licence sentence is mapped to its identifier: so a sentence wrapped over lines, or with an abbreviation's point inside, is found
like one on a line.  The longest known sentence at a place wins, and a piece is used once.  The sequence of
identifiers of a document, unknown pieces left out, is matched against ordered rules: a rule is a run of
identifiers, earlier rules win, and an identifier is used once.  Everything is column expressions on one pass.

Defined results: null and empty texts have no sentences and no licences; repeated rows are rows of their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table

# Sentences of public licence texts and of common licence notices.
SENTENCES: dict[str, str] = {
    "mit_name": "The MIT License (MIT)",
    "mit_notice": "Released under the MIT License.",
    "mit_licensed": "Licensed under the MIT License.",
    "mit_grant": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:',
    "mit_condition": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "mit_warranty": 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.',
    "apache_name": "Apache License",
    "apache_notice": "Licensed under the Apache License, Version 2.0.",
    "apache_under": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
    "apache_copy": "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "apache_basis": 'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
    "apache_see": "See the License for the specific language governing permissions and limitations under the License.",
    "gpl3_notice": "This work is licensed under the GNU General Public License, version 3.",
    "gpl2_notice": "This work is licensed under the GNU General Public License, version 2.",
    "gpl_free": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "gpl2_free": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "gpl_hope": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    "gpl_details": "See the GNU General Public License for more details.",
    "bsd_redistribution": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "bsd_endorse": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "bsd_notice": "Licensed under the BSD License.",
    "mpl_notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "isc_grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "unlicense": "This is free and unencumbered software released into the public domain.",
    "cc_by": "Licensed under CC BY 4.0.",
    "cc_by_sa": "Licensed under CC BY-SA 4.0.",
    "cc_by_nc": "Licensed under CC BY-NC 4.0.",
    "cc_by_nd": "Licensed under CC BY-ND 4.0.",
    "cc0": "Released under CC0 1.0.",
}
# Ordered rules: longer evidence before shorter.
RULES: list[tuple[str, list[str]]] = [
    ("MIT", ["mit_name", "mit_grant", "mit_condition", "mit_warranty"]),
    ("MIT", ["mit_grant", "mit_condition", "mit_warranty"]),
    ("MIT", ["mit_grant", "mit_condition"]),
    ("Apache-2.0", ["apache_under", "apache_copy", "apache_basis", "apache_see"]),
    ("Apache-2.0", ["apache_under", "apache_basis", "apache_see"]),
    ("Apache-2.0", ["apache_under"]),
    ("GPL-3.0-or-later", ["gpl_free", "gpl_hope", "gpl_details"]),
    ("GPL-3.0-or-later", ["gpl_free"]),
    ("GPL-2.0-or-later", ["gpl2_free", "gpl_hope", "gpl_details"]),
    ("GPL-2.0-or-later", ["gpl2_free"]),
    ("BSD-3-Clause", ["bsd_redistribution", "bsd_endorse"]),
    ("BSD-2-Clause", ["bsd_redistribution"]),
    ("MIT", ["mit_notice"]), ("MIT", ["mit_licensed"]), ("MIT", ["mit_grant"]), ("MIT", ["mit_name"]),
    ("Apache-2.0", ["apache_notice"]), ("GPL-3.0-only", ["gpl3_notice"]), ("GPL-2.0-only", ["gpl2_notice"]),
    ("BSD-unspecified", ["bsd_notice"]), ("MPL-2.0", ["mpl_notice"]), ("ISC", ["isc_grant"]), ("Unlicense", ["unlicense"]),
    ("CC-BY-4.0", ["cc_by"]), ("CC-BY-SA-4.0", ["cc_by_sa"]), ("CC-BY-NC-4.0", ["cc_by_nc"]), ("CC-BY-ND-4.0", ["cc_by_nd"]), ("CC0-1.0", ["cc0"]),
]


def normalise(sentence: str) -> str:
    low = "".join(c if c.isascii() and c.isalnum() else " " for c in sentence.lower())
    return " ".join(low.split())


def known_sentences(sentences: dict[str, str]) -> dict[str, str]:
    """Normalised text -> identifier."""
    return {normalise(t): k for k, t in sentences.items()}


def sentence_pattern(known: dict[str, str]) -> str:
    """A known sentence between two marks ``|`` of pieces' edges; any of its spaces may be such an edge."""
    longest_first = sorted((t for t in known if t), key=lambda t: (-len(t), t))
    return rf"\|({'|'.join(t.replace(' ', '[ |]') for t in longest_first)})(?=\|)"


def scan(docs: DataFrame, sentences: dict[str, str] | None = None, rules: list[tuple[str, list[str]]] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_sentences (recognised), sentence_ids, licences: lists in reading order (rules' order for licences), joined by ';'."""
    known, rules = known_sentences(sentences or SENTENCES), rules or RULES
    table = F.create_map(*[F.lit(x) for pair in known.items() for x in pair])
    lines = F.regexp_replace(F.coalesce(F.col(text_col).cast("string"), F.lit("")), r"([.!?])[\t\f\r ]+", "$1\n")
    norm = F.regexp_replace(F.regexp_replace(F.lower(lines), r"[^a-z0-9\n]+", " "), r" ?\n ?", "|")
    found = F.regexp_extract_all(F.concat(F.lit("|"), F.trim(norm), F.lit("|")), F.lit(sentence_pattern(known)), F.lit(1))
    ids = F.transform(found, lambda x: table[F.translate(x, "|", " ")])
    out = docs.select(F.col(id_col).cast("long").alias("id"), ids.alias("ids"))
    out = out.select("id", F.size("ids").cast("long").alias("n_sentences"), F.array_join("ids", ";").alias("sentence_ids"), F.concat_ws("", F.transform("ids", lambda x: F.concat(F.lit("<"), x, F.lit(">")))).alias("s"), F.array().cast("array<string>").alias("found"))
    for name, sequence in rules:
        pattern = "".join(f"<{x}>" for x in sequence)
        # a mark stays in the place, so that what stood on either side of a match does not become one run
        out = out.select("id", "n_sentences", "sentence_ids", F.replace("s", F.lit(pattern), F.lit("#")).alias("s"),
                         F.when(F.col("s").contains(pattern), F.array_append("found", name)).otherwise(F.col("found")).alias("found"))
    return out.select("id", "n_sentences", "sentence_ids", F.array_join(F.array_sort(F.array_distinct("found")), ";").alias("licences"))


def op9_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(read_table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def _sql() -> str:
    known = known_sentences(SENTENCES)
    quoted = ", ".join(f"('{t}', '{k}')" for t, k in known.items())
    text = r"regexp_replace(coalesce(text, ''), '([.!?])[\t\f\r ]+', '\1' || chr(10), 'g')"
    steps, name = [], "j"
    for k, (licence, sequence) in enumerate(RULES):
        pattern = "".join(f"<{x}>" for x in sequence)
        steps.append(f"r{k} AS (SELECT doc_id, n, sentence_ids, replace(s, '{pattern}', '#') AS s, CASE WHEN contains(s, '{pattern}') THEN list_append(found, '{licence}') ELSE found END AS found FROM {name})")
        name = f"r{k}"
    return f"""
WITH k(t, id) AS (VALUES {quoted}),
x AS (SELECT doc_id, unnest(string_split({text}, chr(10))) AS line, generate_subscripts(string_split({text}, chr(10)), 1) AS p FROM documents),
m AS (SELECT x.doc_id, k.id, p FROM x JOIN k ON trim(regexp_replace(lower(line), '[^a-z0-9]+', ' ', 'g')) = k.t),
g AS (SELECT doc_id, count(*) AS n, string_agg(id, ';' ORDER BY p) AS sentence_ids, string_agg('<' || id || '>', '' ORDER BY p) AS s FROM m GROUP BY 1),
j AS (SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n, coalesce(sentence_ids, '') AS sentence_ids, coalesce(s, '') AS s, []::VARCHAR[] AS found FROM documents d LEFT JOIN g ON d.doc_id = g.doc_id),
{", ".join(steps)}
SELECT doc_id, n AS n_sentences, sentence_ids, array_to_string(list_sort(list_distinct(found)), ';') AS licences FROM {name}"""


OP9_SQL = _sql()
