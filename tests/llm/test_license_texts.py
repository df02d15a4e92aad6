"""Standard notices of licences, with the licence each should give as a plain value."""

from __future__ import annotations

import textwrap

from proofline.llm import licenses

GPL = "This program is free software{0} you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation{1} either version {2} of the License, or (at your option) any later version."
HOPE = "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."
NOTICES = {
    "GPL-3.0-or-later": f"{GPL.format(':', ',', 3)}\n\n{HOPE}",
    "GPL-2.0-or-later": f"{GPL.format(';', ';', 2)}\n\n{HOPE}",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
}


def names_of(docs_of, texts):
    return [r["licenses"] for r in sorted(licenses.licenses(docs_of(list(enumerate(texts)))).collect(), key=lambda r: r["doc_id"])]


def test_notices_with_stops_inside_are_recognised(spark, docs_of):
    assert names_of(docs_of, NOTICES.values()) == list(NOTICES)


def test_every_rule_is_recognised_in_its_sentences(spark, docs_of):
    texts = [". ".join(licenses.SENTENCES[i] for i in ids) + "." for _, ids in licenses.RULES]
    got = names_of(docs_of, texts)
    assert all(name in found.split(",") for (name, _), found in zip(licenses.RULES, got))


def test_given_sentences_with_stops_inside(spark, docs_of):
    docs = docs_of([(1, "One thing; another thing, v. 3. Then more."), (2, "One thing. Then more."), (3, "One thing; last.")])
    got = licenses.licenses(docs, {"a": "One thing; another thing, v. 3", "b": "One thing; last", "c": "then more"}, [("A", ["a", "c"]), ("B", ["b"])])
    assert {r["doc_id"]: r["licenses"] for r in got.collect()} == {1: "A", 2: "", 3: "B"}


AS_IS = 'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE.'
S = licenses.SENTENCES
# title, copyright notice and paragraphs
WRAPPED = {
    "MIT": ["MIT License", "Copyright (c) 2020 Some Body", f"{S['mit-grant']}:", f"{S['mit-condition']}.", f"{S['as-is-software']}."],
    "ISC": ["ISC License", "Copyright 2020, Some Body", f"{S['isc-grant']}.", AS_IS],
    "BSD-2-Clause,BSD-3-Clause": ["BSD 3-Clause License", "Copyright (c) 2020, Some Body", f"{S['bsd-grant']}:", f"1. {S['bsd-source']}.", f"2. {S['bsd-binary']}.", f"3. {S['bsd-endorse']}."],
    "GPL-3.0-or-later": ["One line to give the name and a brief idea", "Copyright (C) 2020  Some Body", *NOTICES["GPL-3.0-or-later"].split("\n\n")],
    "GPL-2.0-or-later": ["A tool", "Copyright (C) 2020  Some Body", *NOTICES["GPL-2.0-or-later"].split("\n\n")],
}


# how the texts of licences begin, without the notices at their ends
OPENINGS = {
    "Apache-2.0": ["Apache License", "Version 2.0, January 2004", "TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION", "1. Definitions.", f"{S['apache-definition']}.", f"{S['apache-licensor']}."],
    "GPL-3.0": ["GNU GENERAL PUBLIC LICENSE\nVersion 3, 29 June 2007", "Copyright (C) 2007 Some Body", "Preamble", "TERMS AND CONDITIONS", "0. Definitions.", f"{S['gpl3-refers']}."],
    "GPL-2.0": ["GNU GENERAL PUBLIC LICENSE\nVersion 2, June 1991", "Copyright (C) 1989, 1991 Some Body", f"0. {S['gpl2-applies']}."],
    "AGPL-3.0": ["GNU AFFERO GENERAL PUBLIC LICENSE\nVersion 3, 19 November 2007", "Preamble", f"{S['agpl3-refers']}."],
    "LGPL-2.1": ["GNU LESSER GENERAL PUBLIC LICENSE\nVersion 2.1, February 1999", f"0. {S['lgpl21-applies']}."],
    "LGPL-3.0": ["GNU LESSER GENERAL PUBLIC LICENSE\nVersion 3, 29 June 2007", f"{S['lgpl3-incorporates']}."],
    "MPL-2.0": ["Mozilla Public License Version 2.0", "1. Definitions", '1.1. "Contributor"\n    means each individual or legal entity that creates, contributes to\n    the creation of, or owns Covered Software.'],
    "EPL-2.0": ["Eclipse Public License - v 2.0", f"{S['epl-program']}. ANY USE, REPRODUCTION OR DISTRIBUTION OF THE PROGRAM CONSTITUTES RECIPIENT'S ACCEPTANCE OF THIS AGREEMENT."],
    "EPL-1.0": ["Eclipse Public License - v 1.0", f"{S['epl-program']}."],
    "Zlib": ["Copyright (c) 2020 Some Body", f"{S['zlib-grant']}:", f"1. {S['zlib-origin']}; you must not claim that you wrote the original software."],
    "BSL-1.0": ["Boost Software License - Version 1.0 - August 17th, 2003", f"{S['boost-grant']}:"],
    "0BSD": ["Copyright (C) 2020 Some Body", f"{S['zero-bsd-grant']}."],
    "MIT": ["Licensed under the MIT licence (see LICENSE)."],
}


def test_openings_of_texts_wrapped_at_72_columns(spark, docs_of):
    texts = ["\n\n".join(p if "\n" in p else textwrap.fill(p, 72) for p in own) for own in OPENINGS.values()]
    assert names_of(docs_of, texts) == [*OPENINGS]
    # a version's date is not enough, nor is the title
    assert names_of(docs_of, ["Version 3, 29 June 2007", "GNU GENERAL PUBLIC LICENSE", "GNU GENERAL PUBLIC LICENSE\nVersion 9"]) == [""] * 3


def test_standard_texts_wrapped_at_72_columns(spark, docs_of):
    parts = [[textwrap.fill(p, 72) for p in own] for own in WRAPPED.values()]
    texts = ["\n\n".join(own) for own in parts]
    # without blank lines around title and notice, and with the line ends of other systems
    texts += ["\n".join(own[1:3]) + "\n\n" + "\n\n".join(own[3:]) for own in parts]
    texts += [t.replace("\n", "\r\n") for t in texts]
    texts += ["\n".join(parts[0][:3]) + "\n" + "\n".join(parts[0][3:])]
    assert names_of(docs_of, texts) == [*WRAPPED] * 4 + ["MIT"]
