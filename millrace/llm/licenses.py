"""Licence scan by sentence rules: known sentences become identifiers, rules are ordered runs of identifiers.

A text is cut into sentences (at . ! ? ; : before white space, at blank lines) and normalised to lower-case ASCII letters
and digits with single spaces; a sentence that is not known is tried line by line. A rule applies where its sentences
follow each other in order with at most ``GAP`` other known sentences in between; rules never use unknown sentences, so
wrapped, indented or commented notices match too.

Nulls and odd input: a null or empty text has no licence; repeated notices count once in ``licenses``; all rules that
apply are given, sorted by name. Whole texts are scanned.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import name

GAP = 2

# Sentences of public licence notices, by identifier.
SENTENCES = {
    "mit_line": "Released under the MIT License.",
    "mit_grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions",
    "mit_notice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
    "as_is_upper": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT",
    "apache_line": "Licensed under the Apache License, Version 2.0.",
    "apache_header": "Licensed under the Apache License, Version 2.0 (the \"License\")",
    "apache_may": "you may not use this file except in compliance with the License",
    "apache_copy": "You may obtain a copy of the License at",
    "apache_basis": "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied",
    "gpl3_line": "This work is licensed under the GNU General Public License, version 3.",
    "gpl_free": "This program is free software",
    "gpl_3_later": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "gpl_2_later": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    "gpl_2_version": "either version 2 of the License, or (at your option) any later version",
    "gpl_hope": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY",
    "bsd_grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "bsd_source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
    "bsd_binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution",
    "cc_by_nc_line": "Licensed under CC BY-NC 4.0.",
    "cc_by_line": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc0_line": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
}

# Licence -> ordered sentence identifiers.
RULES = {
    "MIT-notice": ("mit_line",),
    "MIT": ("mit_grant", "mit_notice", "as_is_upper"),
    "Apache-2.0-notice": ("apache_line",),
    "Apache-2.0": ("apache_header", "apache_may", "apache_copy", "apache_basis"),
    "GPL-3.0-notice": ("gpl3_line",),
    "GPL-3.0-or-later": ("gpl_free", "gpl_3_later", "gpl_hope"),
    "GPL-2.0-or-later": ("gpl_free", "gpl_2_later", "gpl_2_version", "gpl_hope"),
    "BSD-2-Clause": ("bsd_grant", "bsd_source", "bsd_binary"),
    "CC-BY-NC-4.0-notice": ("cc_by_nc_line",),
    "CC-BY-4.0-notice": ("cc_by_line",),
    "CC0-1.0-notice": ("cc0_line",),
}

SENTENCE_END = r"[.!?;:](?=[\x20\x09-\x0D]|$)|\n[\x20\x09\x0B-\x0D]*\n"


def normal(sentence: str) -> str:
    """What the expression of :func:`normalised` gives, for the table of known sentences."""
    lower = sentence.translate({c: c + 32 for c in range(65, 91)})
    return re.sub("[^a-z0-9]+", " ", lower).strip(" ")


def normalised(sentence: Column) -> Column:
    lower = F.translate(sentence, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.trim(F.regexp_replace(lower, "[^a-z0-9]+", " "))


def sentence_ids(text: Column, sentences: dict[str, str] = SENTENCES) -> Column:
    """Identifiers of the known sentences of a text, in order. The table of sentences is a parameter, some hundred rows."""
    table = F.create_map(*(F.lit(x) for key, s in sentences.items() for x in (normal(s), key)))
    # cheap first test: a text without the first word of any known sentence is not cut at all
    first = "|".join(sorted({normal(s).split(" ")[0] for s in sentences.values()}))
    def known(sentence: Column) -> Column:
        whole = F.element_at(table, normalised(sentence))
        lines = F.transform(F.split(sentence, "\n"), lambda line: F.element_at(table, normalised(line)))
        return F.when(whole.isNotNull(), F.array(whole)).when(sentence.contains("\n"), lines)

    found = F.filter(F.transform(F.split(text, SENTENCE_END), known), lambda k: k.isNotNull())
    ids = F.filter(F.flatten(found), lambda k: k.isNotNull())
    return F.when(text.rlike(f"(?i)(?<![a-z0-9])({first})(?![a-z0-9])"), ids).otherwise(F.array().cast("array<string>"))


def rule_pattern(ids: tuple[str, ...], gap: int = GAP) -> str:
    """A rule as a pattern over identifiers that each end in a comma."""
    between = rf"(?:[^,]+,){{0,{gap}}}?"
    return "(?:^|,)" + between.join(f"{re.escape(i)}," for i in ids)


def licenses_of(ids: Column, rules: dict[str, tuple[str, ...]] = RULES, gap: int = GAP) -> Column:
    """Names of the rules that apply to a sequence of identifiers, sorted; empty if none."""
    line = F.concat(F.array_join(ids, ","), F.lit(","))
    hits = (F.when(line.rlike(rule_pattern(seq, gap)), F.lit(rule)) for rule, seq in sorted(rules.items()))
    return F.array_compact(F.array(*hits))


def scan(docs: DataFrame, id_column: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """doc_id, sentence_ids (array), licenses (array): a narrow pass without a shuffle."""
    ids = docs.select(name(id_column).alias("doc_id"), sentence_ids(F.coalesce(name(text), F.lit(""))).alias("sentence_ids"))
    return ids.withColumn("licenses", licenses_of(F.col("sentence_ids"), **how))
