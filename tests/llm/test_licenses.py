import re

from hypothesis import given, settings
from hypothesis import strategies as st

from smoglake.llm import licenses
from smoglake.llm.catalog import QUERIES


def brute(text):
    low = (text or "").translate({i: i + 32 for i in range(65, 91)})
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    found = [(i, label) for phrase, label in licenses.PHRASES.items() for i in range(len(words))
             if words[i:i + len(phrase.split())] == phrase.split()]
    return (len(words), len(found), min((i for i, _ in found), default=None), max((i for i, _ in found), default=None),
            ",".join(sorted({label for _, label in found})))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["Under", "the", "MIT", "License", "apache", "version", "2", "cc", "by", "nc", "é", "-", ",", "\n", " ", "BY-NC"]),
                max_size=25).map(" ".join))
def test_base_matches_brute_force(text):
    assert licenses.scan(text)[:5] == brute(text)


def accepts(template, text):
    words = licenses.WORDS.findall(text.lower().encode())
    return [licenses.Automaton(template).run(words, i) for i in range(len(words))]


def test_markup():
    t = "one <<optional>>two three<</optional>> {four|five six} <<any 2>> end"
    for good in ("one four end", "one two three five six end", "one four x end", "one four x y end"):
        assert accepts(t, good)[0] == len(good.split())
    for bad in ("one two four end", "one five end", "one four x y z end", "one end", "one two three four"):
        assert accepts(t, bad)[0] is None
    assert accepts("a b <<optional>>c<</optional>>", "a b c d")[0] == 3  # the longest run
    assert accepts("a <<optional>>b <<optional>>c<</optional>><</optional>> d", "a b d")[0] == 3


def test_notices():
    for text, label in (("Licensed under the Apache License, Version 2.0.", "apache-2"), ("Released under the MIT License.", "mit"),
                        ("This work is licensed under the GNU General Public License, version 3.", "gpl-3"),
                        ("Licensed under CC BY-NC 4.0.", "cc-by-nc"), ("All rights reserved.", "all-rights-reserved")):
        assert licenses.scan("before it. " + text + " after it")[5] == label
    assert licenses.scan("the license of all the rights under the sun")[5] == ""
    assert licenses.scan("Licensed under the Apache Permit, Version 2.0.")[5] == ""


GPL = """This program is free software: you can redistribute it and/or modify
# it under the terms of the GNU {name} as published by
# the Free Software Foundation{version}"""
NOTICES = [
    (GPL.format(name="General Public License", version=", either version 3 of the License, or\n# (at your option) any later version."), "gpl-3"),
    (GPL.format(name="General Public License", version="; either version 2 of the License, or (at your option) any later version."), "gpl-2"),
    (GPL.format(name="General Public License", version="; version 2."), "gpl-2"),
    (GPL.format(name="Lesser General Public License", version="; either version 2.1 of the License"), "lgpl-2.1"),
    (GPL.format(name="Library General Public License", version="; either version 2 of the License"), "lgpl-2"),
    (GPL.format(name="Affero General Public License", version=", either version 3 of the License"), "agpl-3"),
    ("you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 only, as published by the "
     "Free Software Foundation.", "gpl-2"),
    ("GNU GENERAL PUBLIC LICENSE\n   Version 3, 29 June 2007\n", "gpl-3"),
    ("GNU LESSER GENERAL PUBLIC LICENSE\n   Version 2.1, February 1999", "lgpl-2.1"),
    ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed "
     "with this file, You can obtain one at http://mozilla.org/MPL/2.0/.", "mpl-2"),
    ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided "
     "that the above copyright notice and this permission notice appear in all copies.", "isc"),
    ("This work is licensed under a Creative Commons Attribution 4.0 International License.", "cc-by"),
    ("This work is licensed under the Creative Commons Attribution-ShareAlike 3.0 Unported License.", "cc-by-sa"),
    ("see https://creativecommons.org/licenses/by-sa/4.0/", "cc-by-sa"), ("(http://creativecommons.org/licenses/by/4.0/)", "cc-by"),
    ("Licensed under CC BY 4.0", "cc-by"), ("https://creativecommons.org/publicdomain/zero/1.0/", "cc0"),
    ("This is free and unencumbered software released into the public domain.", "unlicense"),
    ("Distributed under the Boost Software License, Version 1.0.", "boost-1"),
    ("// SPDX-License-Identifier: GPL-2.0-or-later", "gpl-2"), ("# SPDX-License-Identifier: Apache-2.0", "apache-2"),
    ("SPDX-License-Identifier: BSD-3-Clause", "bsd"), ("SPDX-License-Identifier: LGPL-2.1-only", "lgpl-2.1"),
    ("SPDX-License-Identifier: (MIT OR Apache-2.0)", "apache-2,mit"),
    ("SPDX-License-Identifier: GPL-2.0-only OR MIT", "gpl-2,mit"),
]


def test_real_notices_and_their_near_misses():
    for text, labels in NOTICES:
        assert licenses.scan("# (c) 2020 someone\n" + text + "\n# more")[5] == labels, text
    for text in ("you can redistribute it and or modify it under the terms of the GNU General Public Permit",
                 "the GNU project and its General Public License are old", "licensed under a creative plan",
                 "SPDX-License-Identifier: none", "permission to use this hall for any purpose is granted"):
        assert licenses.scan(text)[5] == "", text


def test_every_template_accepts_itself_and_may_match():
    for label, texts in licenses.templates().items():
        for t in texts:
            plain = re.sub(r"<<[^>]*>>", " ", t)
            while "{" in plain:  # the first wording of each choice
                plain = re.sub(r"\{([^|{}]*)[^{}]*\}", r"\1", plain)
            plain = plain.replace("either only", "either")
            assert licenses.may_match(plain.encode())
            assert label in licenses.scan(plain)[5].split(",")


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    out = {r.doc_id: r for r in QUERIES["op8_license_scan"](spark, sf).collect()}
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        got = out[r.doc_id]
        assert (got.n_words, got.n_base, got.first_word, got.last_word, got.base_labels) == brute(r.text)
        assert set(got.base_labels.split(",")) - {""} <= set(got.labels.split(",")) and 0 <= got.score <= 1


def test_awkward_rows(awkward, no_docs, clashing):
    assert licenses.scan_documents(no_docs).count() == 0
    assert licenses.scan_documents(awkward).count() == awkward.count()
    assert licenses.scan_documents(clashing).count() == awkward.count()
