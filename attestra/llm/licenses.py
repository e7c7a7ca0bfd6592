"""License scans by sentence rules (operator 3), DataFrame functions only.

Sentences are normalised and mapped to the identifiers of known licence sentences by a join; the identifiers of a document, in reading order,
are then matched against ordered licence rules. Lines are read as sentences and so are the wrapped lines of a paragraph together.

The DuckDB text reads single lines and the sentences of ``SENTENCES`` only: it is a twin where no known sentence is wrapped, whole canonical
(``CANONICAL``) or an SPDX tag with a blank.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from attestra.llm.common import query, table

# Known sentences of public licences after ``normalised`` (version digits as 0) and their identifiers.
SENTENCES = {
    "released under the mit license": "MIT-NAME",
    "licensed under the mit license": "MIT-NAME",
    "this project is licensed under the mit license": "MIT-NAME",
    "spdx license identifier mit": "MIT-NAME",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction": "MIT-GRANT",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "MIT-NOTICE",
    "the software is provided as is without warranty of any kind": "MIT-WARRANTY",
    "licensed under the apache license version 0 0": "APACHE-NAME",
    "licensed under the apache license version 0 0 the license": "APACHE-HEAD",
    "spdx license identifier apache 0 0": "APACHE-NAME",
    "you may not use this file except in compliance with the license": "APACHE-COMPLY",
    "you may obtain a copy of the license at": "APACHE-COPY",
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis": "APACHE-WARRANTY",
    "this work is licensed under the gnu general public license version 0": "GPL-NAME",
    "licensed under the gnu general public license version 0": "GPL-NAME",
    "spdx license identifier gpl 0 0": "GPL-NAME",
    "spdx license identifier gpl 0 0 only": "GPL-NAME",
    "spdx license identifier gpl 0 0 or later": "GPL-NAME",
    "this program is free software": "GPL-FREE",
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation": "GPL-TERMS",
    "this program is distributed in the hope that it will be useful but without any warranty": "GPL-WARRANTY",
    "licensed under cc by nc 0 0": "CC-BY-NC-NAME",
    "this work is licensed under cc by nc 0 0": "CC-BY-NC-NAME",
    "licensed under cc by 0 0": "CC-BY-NAME",
    "licensed under cc by sa 0 0": "CC-BY-SA-NAME",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "BSD-GRANT",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "BSD-SOURCE",
    "redistributions in binary form must reproduce the above copyright notice": "BSD-BINARY",
    "this software is provided by the copyright holders and contributors as is": "BSD-WARRANTY",
    "all rights reserved": "RIGHTS",
}
# Ordered rules, a licence and the identifiers that must follow each other among the known sentences of a text.
RULES = (
    ("MIT", ("MIT-NAME",)), ("MIT", ("MIT-GRANT", "MIT-NOTICE")), ("MIT", ("MIT-NOTICE", "MIT-WARRANTY")),
    ("Apache", ("APACHE-NAME",)), ("Apache", ("APACHE-HEAD",)), ("Apache", ("APACHE-COMPLY", "APACHE-COPY")),
    ("GPL", ("GPL-NAME",)), ("GPL", ("GPL-FREE", "GPL-TERMS")),
    ("CC-BY-NC", ("CC-BY-NC-NAME",)), ("CC-BY", ("CC-BY-NAME",)), ("CC-BY-SA", ("CC-BY-SA-NAME",)),
    ("BSD", ("BSD-GRANT", "BSD-SOURCE")), ("BSD", ("BSD-SOURCE", "BSD-BINARY")),
    ("Proprietary", ("RIGHTS",)),
)
# The whole sentences of the canonical texts, where those above stop short of them, titles and more tags.
CANONICAL = {
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "MIT-GRANT",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement": "MIT-WARRANTY",
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied": "APACHE-WARRANTY",
    "apache license version 0 0 january 0 http www apache org licenses": "APACHE-TITLE",
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 0 of the license or at your option any later version": "GPL-TERMS",
    "gnu general public license version 0 june 0": "GPL-TITLE",
    "gnu general public license version 0 0 june 0": "GPL-TITLE",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution": "BSD-BINARY",
    "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed": "BSD-WARRANTY",
    "spdx license identifier bsd 0 clause": "BSD-NAME",
    "spdx license identifier cc by 0 0": "CC-BY-NAME",
    "spdx license identifier cc by nc 0 0": "CC-BY-NC-NAME",
    "spdx license identifier cc by sa 0 0": "CC-BY-SA-NAME",
}
CANONICAL_RULES = (("Apache", ("APACHE-TITLE",)), ("GPL", ("GPL-TITLE",)), ("BSD", ("BSD-NAME",)))


def sentences(text: Column) -> Column:
    """A text's sentences with their line breaks: paragraphs, cut after a full stop, colon (but that of an SPDX tag), semicolon, question or exclamation
    mark that white space follows. A line without a letter or digit, such as an empty one of a comment, ends a paragraph."""
    return F.split(text, r"(?<=[.:;!?])(?<!(?i:SPDX-License-Identifier):)[ \t\r\n]+|\n(?=[^A-Za-z0-9\n]*+\n)", -1)


def readings(sentence: Column) -> Column:
    """The whole sentence, or null where it is one line, and its lines."""
    lines = F.split(sentence, "\n", -1)
    return F.concat(F.array(F.when(F.rlike(sentence, F.lit(r"\A[^A-Za-z0-9]*+[A-Za-z0-9][^\n]*+\n[^A-Za-z0-9]*+[A-Za-z0-9]")), sentence)), lines)


def normalised(sentence: Column) -> Column:
    """Lower-case words and numbers, every number as 0: what stands between them does not matter."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(sentence), "[0-9]+", "0"), "[^a-z0]+", " "))


def license_scan(docs: DataFrame, text: str = "text", id_col: str = "doc_id", known: dict[str, str] | None = None, rules=RULES + CANONICAL_RULES) -> DataFrame:
    """One row per document: doc_id, n_sentences (known ones), sentence_ids, versions and licenses (blank-separated strings; licenses sorted).

    versions: the numbers of each known sentence that has some, as in 2.0. Null and empty texts have no sentence; rows with the same id
    and text give equal rows; a null id stays; other columns are not read; an empty table gives no rows. ``known`` is a rule table, bounded by what a person writes.
    """
    known = SENTENCES | CANONICAL if known is None else known
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), body.alias("body")).withColumn("row", F.xxhash64(F.col("doc_id").cast("string"), "body"))
    names = docs.sparkSession.createDataFrame(list(known.items()), "norm string, name string")
    cut = rows.select("row", F.posexplode(sentences(F.col("body"))).alias("at", "sentence"))
    said = cut.select("row", "at", F.posexplode(readings(F.col("sentence"))).alias("line", "raw")).withColumn("norm", normalised(F.col("raw"))).filter("norm <> ''")
    version = F.array_join(F.regexp_extract_all("raw", F.lit("[0-9]+"), 0), ".")
    found = said.join(F.broadcast(names), "norm").select("row", "at", "line", "name", version.alias("version")).distinct()
    # a known sentence is not read again from its lines
    found = found.withColumn("first", F.min("line").over(Window.partitionBy("row", "at"))).filter("line = 0 or first > 0")
    listed = found.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("at", "line", "name", "version"))).alias("s"))
    joined = rows.select("doc_id", "row").join(listed, "row", "left")
    ids = F.coalesce(F.array_join(F.transform("s", lambda x: x["name"]), " "), F.lit(""))
    padded = F.concat(F.lit(" "), ids, F.lit(" "))
    hits = F.array(*[F.when(F.contains(padded, F.lit(f" {' '.join(seq)} ")), F.lit(name)) for name, seq in rules])
    return joined.select("doc_id", F.coalesce(F.size("s"), F.lit(0)).cast("long").alias("n_sentences"), ids.alias("sentence_ids"),
                         F.coalesce(F.array_join(F.filter(F.transform("s", lambda x: x["version"]), lambda v: v != ""), " "), F.lit("")).alias("versions"),
                         F.array_join(F.array_sort(F.array_distinct(F.filter(hits, lambda h: h.isNotNull()))), " ").alias("licenses"))


def _oracle() -> str:
    known = ", ".join(f"('{a}', '{b}')" for a, b in SENTENCES.items())
    rules = ", ".join(f"CASE WHEN contains(padded, ' {' '.join(seq)} ') THEN '{name}' END" for name, seq in RULES)
    return rf"""
WITH known(norm, name) AS (VALUES {known}),
s AS (SELECT doc_id, unnest(string_split(regexp_replace(coalesce(text, ''), '([.:;!?])[ \t\r]+', '\1' || chr(10), 'g'), chr(10))) AS raw,
  generate_subscripts(string_split(regexp_replace(coalesce(text, ''), '([.:;!?])[ \t\r]+', '\1' || chr(10), 'g'), chr(10)), 1) AS pos FROM documents),
f AS (SELECT doc_id, pos, raw, name FROM (SELECT *, trim(regexp_replace(regexp_replace(lower(raw), '[0-9]+', '0', 'g'), '[^a-z0]+', ' ', 'g')) AS norm FROM s) JOIN known USING (norm)),
g AS (SELECT doc_id, count(*) AS n, string_agg(name, ' ' ORDER BY pos) AS ids,
  string_agg(array_to_string(regexp_extract_all(raw, '[0-9]+'), '.'), ' ' ORDER BY pos) FILTER (regexp_matches(raw, '[0-9]')) AS versions FROM f GROUP BY doc_id),
j AS (SELECT d.doc_id, coalesce(n, 0) AS n_sentences, coalesce(ids, '') AS sentence_ids, coalesce(versions, '') AS versions, ' ' || coalesce(ids, '') || ' ' AS padded
  FROM documents d LEFT JOIN g ON d.doc_id = g.doc_id)
SELECT doc_id, n_sentences, sentence_ids, versions, coalesce(array_to_string(list_sort(list_distinct(list_filter([{rules}], lambda x: x IS NOT NULL))), ' '), '') AS licenses FROM j"""


@query("op3_sentence_rules", _oracle())
def op3_sentence_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents"))
