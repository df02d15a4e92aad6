"""Licences recognised by their sentences.

Texts are cut into sentences, sentences are normalised (case, punctuation, spelling), and those that are known become identifiers. A licence is
recognised where the identifiers of one of its rules stand in the document in the rule's
order, other sentences between them or not. Everything is DataFrame expressions; a text
that has no known sentence leaves its row without a shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from proofline.functions.lookups import lookup_join
from proofline.llm import tables

# Sentences of public licence texts and notices, by identifier. A stop before a blank ends one.
SENTENCES = {
    "apache-notice": "Licensed under the Apache License, Version 2.0",
    "apache-notice-you": 'Licensed under the Apache License, Version 2.0 (the "License")',
    "apache-compliance": "you may not use this file except in compliance with the License",
    "apache-as-is": 'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied',
    "apache-definition": '"License" shall mean the terms and conditions for use, reproduction, and distribution as defined by Sections 1 through 9 of this document',
    "apache-licensor": '"Licensor" shall mean the copyright owner or entity authorized by the copyright owner that is granting the License',
    "apache-grant": "Subject to the terms and conditions of this License, each Contributor hereby grants to You a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright license to reproduce, prepare Derivative Works of, publicly display, publicly perform, sublicense, and distribute the Work and such Derivative Works in Source or Object form",
    "apache-project": "This project is licensed under the Apache License, Version 2.0",
    "apache-project-short": "This project is licensed under the Apache License 2.0",
    "mit-see": "Licensed under the MIT License (see LICENSE)",
    "mit-terms": "This project is licensed under the terms of the MIT License",
    "mit-project-file": "This project is licensed under the MIT License - see the LICENSE file for details",
    "mit-notice": "Released under the MIT License",
    "mit-notice-licensed": "Licensed under the MIT License",
    "mit-notice-project": "This project is licensed under the MIT License",
    "mit-grant": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions',
    "mit-condition": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
    "as-is-software": 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT',
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution",
    "bsd-endorse": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "bsd-notice": "Licensed under the BSD License",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    "gpl3-notice": "This work is licensed under the GNU General Public License, version 3",
    "gpl3-notice-licensed": "Licensed under the GNU General Public License, version 3",
    "gpl2-notice": "This work is licensed under the GNU General Public License, version 2",
    "gpl-free": "This program is free software",
    "gpl3-terms": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "gpl2-terms": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    "gpl2-version": "either version 2 of the License, or (at your option) any later version",
    "gpl-hope": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY",
    "lgpl-notice": "This work is licensed under the GNU Lesser General Public License, version 3",
    "mpl-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v",
    "mpl-version": "2.0",
    "isc-grant-and": "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    "zero-bsd-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    "bsd2-project": "This project is licensed under the BSD 2-Clause License",
    "bsd3-project": "This project is licensed under the BSD 3-Clause License",
    "gpl-title": "GNU GENERAL PUBLIC LICENSE",
    "lgpl-title": "GNU LESSER GENERAL PUBLIC LICENSE",
    "agpl-title": "GNU AFFERO GENERAL PUBLIC LICENSE",
    "gnu2-date": "Version 2, June 1991",
    "gnu21-date": "Version 2.1, February 1999",
    "gnu3-date": "Version 3, 29 June 2007",
    "agpl3-date": "Version 3, 19 November 2007",
    "gpl2-applies": "This License applies to any program or other work which contains a notice placed by the copyright holder saying it may be distributed under the terms of this General Public License",
    "gpl3-refers": '"This License" refers to version 3 of the GNU General Public License',
    "agpl3-refers": '"This License" refers to version 3 of the GNU Affero General Public License',
    "agpl3-terms": "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "lgpl21-applies": 'This License Agreement applies to any software library or other program which contains a notice placed by the copyright holder or other authorized party saying it may be distributed under the terms of this Lesser General Public License (also called "this License")',
    "lgpl-free": "This library is free software",
    "lgpl21-terms": "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
    "lgpl21-version": "either version 2.1 of the License, or (at your option) any later version",
    "lgpl-hope": "This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY",
    "lgpl3-incorporates": "This version of the GNU Lesser General Public License incorporates the terms and conditions of version 3 of the GNU General Public License, supplemented by the additional permissions listed below",
    "mpl-contributor": '"Contributor" means each individual or legal entity that creates, contributes to the creation of, or owns Covered Software',
    "epl1-title": "Eclipse Public License - v 1.0",
    "epl2-title": "Eclipse Public License - v 2.0",
    "epl-program": 'THE ACCOMPANYING PROGRAM IS PROVIDED UNDER THE TERMS OF THIS ECLIPSE PUBLIC LICENSE ("AGREEMENT")',
    "epl1-notice": "This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 which accompanies this distribution, and is available at http://www.eclipse.org/legal/epl-v10.html",
    "epl2-notice": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    "epl2-notice-http": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at http://www.eclipse.org/legal/epl-2.0",
    "zlib-grant": "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions",
    "zlib-origin": "The origin of this software must not be misrepresented",
    "boost-grant": 'Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following',
    "cc-by": "Licensed under CC BY 4.0",
    "cc-by-sa": "Licensed under CC BY-SA 4.0",
    "cc-by-nc": "Licensed under CC BY-NC 4.0",
    "cc-by-nd": "Licensed under CC BY-ND 4.0",
    "cc-by-nc-sa": "Licensed under CC BY-NC-SA 4.0",
    "cc-by-nc-nd": "Licensed under CC BY-NC-ND 4.0",
    "cc-zero": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work",
    "unlicense": "This is free and unencumbered software released into the public domain",
}
# Licence identifiers, and the sentences that make them in order.
RULES = [
    ("Apache-2.0", ["apache-notice"]),
    ("Apache-2.0", ["apache-notice-you"]),
    ("Apache-2.0", ["apache-compliance", "apache-as-is"]),
    ("Apache-2.0", ["apache-definition", "apache-licensor"]),
    ("Apache-2.0", ["apache-grant"]),
    ("Apache-2.0", ["apache-project"]),
    ("Apache-2.0", ["apache-project-short"]),
    ("MIT", ["mit-see"]),
    ("MIT", ["mit-terms"]),
    ("MIT", ["mit-project-file"]),
    ("MIT", ["mit-notice"]),
    ("MIT", ["mit-notice-licensed"]),
    ("MIT", ["mit-notice-project"]),
    ("MIT", ["mit-grant", "mit-condition"]),
    ("BSD-2-Clause", ["bsd-grant", "bsd-source", "bsd-binary"]),
    ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse"]),
    ("BSD", ["bsd-notice"]),
    ("ISC", ["isc-grant"]),
    ("GPL-3.0", ["gpl3-notice"]),
    ("GPL-3.0", ["gpl3-notice-licensed"]),
    ("GPL-3.0-or-later", ["gpl-free", "gpl3-terms", "gpl-hope"]),
    ("GPL-2.0", ["gpl2-notice"]),
    ("GPL-2.0-or-later", ["gpl-free", "gpl2-terms", "gpl2-version", "gpl-hope"]),
    ("LGPL-3.0", ["lgpl-notice"]),
    ("MPL-2.0", ["mpl-notice", "mpl-version"]),
    ("ISC", ["isc-grant-and"]),
    ("0BSD", ["zero-bsd-grant"]),
    ("BSD-2-Clause", ["bsd2-project"]),
    ("BSD-3-Clause", ["bsd3-project"]),
    ("GPL-2.0", ["gpl-title", "gnu2-date"]),
    ("GPL-2.0", ["gpl2-applies"]),
    ("GPL-3.0", ["gpl-title", "gnu3-date"]),
    ("GPL-3.0", ["gpl3-refers"]),
    ("AGPL-3.0", ["agpl-title", "agpl3-date"]),
    ("AGPL-3.0", ["agpl3-refers"]),
    ("AGPL-3.0-or-later", ["gpl-free", "agpl3-terms", "gpl-hope"]),
    ("LGPL-2.1", ["lgpl-title", "gnu21-date"]),
    ("LGPL-2.1", ["lgpl21-applies"]),
    ("LGPL-2.1-or-later", ["lgpl-free", "lgpl21-terms", "lgpl21-version", "lgpl-hope"]),
    ("LGPL-3.0", ["lgpl-title", "gnu3-date"]),
    ("LGPL-3.0", ["lgpl3-incorporates"]),
    ("MPL-2.0", ["mpl-contributor"]),
    ("EPL-1.0", ["epl1-title", "epl-program"]),
    ("EPL-1.0", ["epl1-notice"]),
    ("EPL-2.0", ["epl2-title", "epl-program"]),
    ("EPL-2.0", ["epl2-notice"]),
    ("EPL-2.0", ["epl2-notice-http"]),
    ("Zlib", ["zlib-grant", "zlib-origin"]),
    ("BSL-1.0", ["boost-grant"]),
    ("CC-BY-4.0", ["cc-by"]),
    ("CC-BY-SA-4.0", ["cc-by-sa"]),
    ("CC-BY-NC-4.0", ["cc-by-nc"]),
    ("CC-BY-ND-4.0", ["cc-by-nd"]),
    ("CC-BY-NC-SA-4.0", ["cc-by-nc-sa"]),
    ("CC-BY-NC-ND-4.0", ["cc-by-nc-nd"]),
    ("CC0-1.0", ["cc-zero"]),
    ("Unlicense", ["unlicense"]),
]

# known sentences up to which a text's own are compared with a list, without a join
LISTED = 1000
# ends of sentences: a stop before white space; where lines are not joined, their ends too
_STOP = r"(?<=[.;:!?])\s+"
_LINE = r"[\r\n]+|" + _STOP
# lines that are no part of a sentence: titles of licences, copyright notices
_TITLE = r"(?:The |THE )?(?:MIT|ISC|BSD|[234]-[Cc]lause|New|Simplified|Modified|Apache|GNU|Mozilla)\b[\w .,\"-]{0,50}\b(?i:licen[cs]e)\b[\w .,()\"-]{0,30}"
_NOTICE = r"(?i:copyright|\(c\)|©)[ \t,:]*(?i:\(c\)|©|\d{4}|<|\[).*|(?i:all rights reserved)\.?"
_ALONE = rf"(?m)^[ \t]*(?:{_TITLE}|{_NOTICE})[ \t]*$"
_BLANK = r"(?>\r\n|\r|\n)[ \t]*(?>\r\n|\r|\n)"
# stands for the end of a paragraph; no text has it once white space is joined
_END = "\u2029"


def normalised(text: Column) -> Column:
    """Lower-case words with single blanks between them, in one spelling.

    The number that lists a sentence, such as ``1.`` or ``(a)``, is left out.
    """
    words = F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))
    unlisted = F.regexp_replace(words, r"^(\d{1,2}|[a-z]) (?=\p{L}{2})", "")
    return F.regexp_replace(F.regexp_replace(unlisted, r"\blicence", "license"), r"\bnon infringement\b", "noninfringement")


def _sentences(text: Column, ends: str) -> Column:
    return F.transform(F.split(text, ends, -1), normalised)


def _pieces(spark: SparkSession, sentences: Mapping[str, str] | DataFrame) -> tuple[DataFrame, DataFrame]:
    """Known sentences cut as texts are: (sentence, id), and the (id, at, piece) that identifiers stand for.

    The pieces of a sentence with stops inside are called ``id/0``, ``id/1`` and so on; pieces
    that are the same have the least of their names.
    """
    if not isinstance(sentences, DataFrame):
        sentences = spark.createDataFrame(list(sentences.items()), "id string, sentence string")
    own = F.filter(_sentences(F.regexp_replace(F.trim("sentence"), r"\s+", " "), _STOP), lambda s: s != "")
    cut = sentences.select("id", own.alias("own")).select("id", F.size("own").alias("n"), F.posexplode("own").alias("at", "sentence"))
    name = F.when(F.col("n") > 1, F.concat_ws("/", "id", F.col("at").cast("string"))).otherwise(F.col("id"))
    cut = tables.stored(cut.select("id", "at", "sentence", name.alias("name")), "pieces")
    known = tables.stored(cut.groupBy("sentence").agg(F.min("name").alias("piece")), "sentences")
    return known.withColumnRenamed("piece", "id"), tables.stored(cut.join(known, "sentence").select("id", "at", "piece"), "pieces")


def identified(docs: DataFrame, sentences: Mapping[str, str] | DataFrame = SENTENCES) -> DataFrame:
    """row, doc_id and the known sentences of each row: ``found``, an array of (pass, at, id) in order.

    Sentences are looked for three times: with every line an end (pass 0), with all lines joined up
    (pass 1), and with those of a paragraph joined up (pass 2), as licence texts are often
    wrapped. Blank lines, titles and copyright notices end a paragraph. ``sentences`` maps identifiers to texts,
    or is a table (id, sentence) of any size; sentences with stops inside are known by their pieces.
    """
    return _identified(docs, _pieces(docs.sparkSession, sentences)[0])


def _identified(docs: DataFrame, known: DataFrame) -> DataFrame:
    text = F.col("text")
    apart = F.regexp_replace(F.regexp_replace(text, _ALONE, f"{_END}$0{_END}"), _BLANK, _END)
    apart = _sentences(F.regexp_replace(apart, r"\s+", " "), f"{_END}|{_STOP}")
    # a text of one line has no paragraphs
    apart = F.when(text.rlike(r"[\r\n]"), apart).otherwise(F.array().cast("array<string>"))
    cut = [_sentences(text, _LINE), _sentences(F.regexp_replace(text, r"\s+", " "), _STOP), apart]
    count = known.count()
    named = tables.texts(docs).select("doc_id", *[c.alias(f"pass{i}") for i, c in enumerate(cut)])

    def placed(number: int, keep) -> Column:
        own = F.transform(F.col(f"pass{number}"), lambda s, i: F.struct(F.lit(number).alias("pass"), i.alias("at"), s.alias("sentence")))
        return F.filter(own, keep)

    if count <= LISTED:
        listed = [r["sentence"] for r in known.select("sentence").collect()]
        keep = (lambda s: s["sentence"].isin(*listed)) if listed else (lambda s: F.lit(False))
    else:
        keep = lambda s: s["sentence"] != ""
    scanned = named.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.concat(*[placed(i, keep) for i in range(len(cut))]).alias("own"))
    scanned = tables.stored(scanned, "sentences")
    hits = lookup_join(scanned.select("row", F.inline("own")), known, ["sentence"], "inner")
    hits = hits.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("pass", "at", "id"))).alias("found"))
    return scanned.select("row", "doc_id").join(hits, "row", "left")


def licenses(
    docs: DataFrame,
    sentences: Mapping[str, str] | DataFrame = SENTENCES,
    rules: Sequence[tuple[str, Sequence[str]]] | DataFrame = RULES,
) -> DataFrame:
    """doc_id, licenses and sentences of every row: sorted names, and identifiers in the order of the text.

    ``rules`` names a licence and the identifiers of its sentences in order, or is a table
    (license, ids). A null text is an empty one and has no licences; null and repeated
    doc_ids give a row for each row; an empty table gives none, as do no rules or sentences
    give no licences. Other columns are not looked at.
    """
    spark = docs.sparkSession
    if not isinstance(rules, DataFrame):
        rules = spark.createDataFrame([(name, list(ids)) for name, ids in rules], "license string, ids array<string>")
    numbered = rules.where(F.size("ids") > 0).select(F.xxhash64("license", F.to_json("ids")).alias("rule"), "license", "ids").distinct()
    known, pieces = _pieces(spark, sentences)
    # identifiers of sentences with stops inside stand for their pieces, in order
    listed = numbered.select("rule", "license", F.posexplode("ids").alias("step", "id")).join(pieces, "id", "left")
    listed = listed.groupBy("rule", "license").agg(F.array_sort(F.collect_list(F.struct("step", "at", F.coalesce("piece", "id").alias("id")))).alias("ids"))
    numbered = tables.stored(listed.select("rule", "license", F.col("ids.id").alias("ids")), "rules")
    # an identifier is looked up with all the places that it has in rules
    steps = numbered.select("rule", "license", F.size("ids").alias("size"), F.posexplode("ids").alias("step", "id"))
    steps = tables.stored(steps.groupBy("id").agg(F.collect_list(F.struct("rule", "license", "size", "step")).alias("steps")), "steps")
    rows = tables.stored(_identified(docs, known), "identified")
    met = lookup_join(rows.where(F.col("found").isNotNull()).select("row", F.inline("found")), steps, ["id"], "inner")
    met = met.select("row", "pass", "at", F.inline("steps"))
    # the steps of a rule in the order of the text: a rule holds if they come one after the other
    in_order = met.groupBy("row", "pass", "rule", "license", "size").agg(F.array_sort(F.collect_list(F.struct("at", "step"))).alias("places"))
    reached = F.aggregate("places", F.lit(0), lambda next_, p: F.when(p["step"] == next_, next_ + 1).otherwise(next_))
    holding = in_order.where(reached == F.col("size")).groupBy("row").agg(F.array_sort(F.collect_set("license")).alias("names"))
    # all passes see most sentences; the first that saw any is told
    of = lambda number: F.filter("found", lambda f: f["pass"] == number)
    first, second, third = of(0), of(1), of(2)
    told = F.when(F.size(first) > 0, first).when(F.size(second) > 0, second).otherwise(third)
    return rows.join(holding, "row", "left").select(
        "doc_id",
        F.coalesce(F.array_join("names", ","), F.lit("")).alias("licenses"),
        F.coalesce(F.array_join(F.transform(told, lambda f: f["id"]), ","), F.lit("")).alias("sentences"),
    )
