import random

import numpy as np

from hearth.llm import op1_licenses as op
from tests.llm.helpers import crowded, docs, found, prose


def brute(text):
    """Every window of every template, without MinHash: best containment per template and place."""
    memo = op._WordHash()
    index = op.LicenseIndex()
    h = op.word_hashes(text, memo)
    best = []
    for t in index.templates:
        s = op.shingles(h, t.k)
        for i in range(max(0, len(h) - t.length + 1)):
            share = np.isin(t.own, s[i:i + t.length - t.k + 1]).mean()
            if share >= op.CONTAINMENT:
                best.append((t.name, float(share)))
    return {n for n, _ in best}


def test_probability_guarantee():
    assert op.collision_probability(0.6) > 0.999


def test_matches_brute_force(spark):
    rng = random.Random(1)
    rows, want = [], {}
    for i in range(120):
        name, text = op.TEMPLATES[rng.randrange(len(op.TEMPLATES))]
        words = text.split()
        if i % 3 == 0 and len(words) > 12:
            words[rng.randrange(len(words))] = "changed"
        body = prose(rng, rng.randrange(0, 60)) + "\n" + " ".join(words) + "\n" + prose(rng, rng.randrange(0, 60))
        rows.append((i, body if i % 5 else prose(rng, 50)))
        want[i] = brute(rows[-1][1])
    got = {r["doc_id"]: {m["license"] for m in r["matches"]} for r in op.scan_licenses(docs(spark, rows)).collect()}
    for i in want:  # overlapping templates: the best one stays
        assert got[i] <= want[i]
        assert bool(got[i]) == bool(want[i])


def test_spans_ties_and_long_text(spark):
    line = "Licensed under CC BY-NC 4.0."
    text = "ä " + line + " x\n" + line
    big = prose(random.Random(2), 30_000) + " All rights reserved. " + prose(random.Random(3), 30_000)
    out = {r["doc_id"]: r for r in op.license_digest(docs(spark, [(1, text), (1, text), (2, big), (3, "version 2 of it")])).collect()}
    assert out[1]["spans"] == "CC-BY-NC-4.0:2:29,CC-BY-NC-4.0:33:60" and out[1]["n_matches"] == 2
    s = out[2]["spans"].split(":")
    assert s[0] == "All-Rights-Reserved" and big[int(s[1]):int(s[2])] == "All rights reserved"
    assert out[3]["n_matches"] == 0


def test_nulls_empty_and_clashes(spark):
    d = crowded(docs(spark, [(None, None), (1, ""), (1, None), (None, "All Rights  Reserved")]), "matches", "spans", "start")
    assert found(op.license_digest(d), "doc_id", "licenses") == sorted(
        [(None, ""), (1, ""), (1, ""), (None, "All-Rights-Reserved")], key=repr)
    assert op.license_digest(d.limit(0)).count() == 0


def test_each_notice_has_its_own_name():
    gnu = ("{} is free software; you can redistribute it and/or\n# modify it under the terms of the GNU {}\n# as published by the "
           "Free Software Foundation; either version {} of the License, or\n# (at your option) any later version.")
    clauses = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
               "following conditions are met:\n{0}Redistributions of source code must retain the above copyright notice, this list "
               "of conditions and the following disclaimer.\n{1}Redistributions in binary form must reproduce the above copyright "
               "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
               "with the distribution.\n")
    name = ("{}Neither the name of {} nor the names of its contributors may be used to endorse or promote products derived from "
            "this software without specific prior written permission.\n")
    advert = ("3. All advertising materials mentioning features or use of this software must display the following "
              "acknowledgement: This product includes software developed by the University of X and its contributors.\n")
    end = 'THIS SOFTWARE IS PROVIDED BY THE {} "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES ARE DISCLAIMED.'
    holders = "COPYRIGHT HOLDERS AND CONTRIBUTORS"
    index, memo, rng = op.LicenseIndex(), op._WordHash(), random.Random(4)
    cases = [(want, gnu.format(start, text, version)) for start in ("This program", "This library", "Foobar") for want, text, version in (
        ("GPL-1.0", "General Public License", "1"), ("GPL-2.0", "General Public License", "2"), ("GPL-3.0", "General Public License", "3"),
        ("LGPL-2.0", "Library General Public License", "2"), ("LGPL-2.0", "Lesser General Public License", "2"),
        ("LGPL-2.1", "Lesser General Public License", "2.1"), ("LGPL-3.0", "Lesser General Public License", "3"),
        ("AGPL-3.0", "Affero General Public License", "3"))]
    for marks in (("1. ", "2. ", "3. "), ("* ", "* ", "* ")):
        for who in (holders, "REGENTS AND CONTRIBUTORS"):
            cases += [("BSD-2-Clause", clauses.format(*marks) + end.format(who)),
                      ("BSD-3-Clause", clauses.format(*marks) + name.format(marks[2], "the copyright holder") + end.format(who)),
                      ("BSD-3-Clause", clauses.format(*marks) + name.format(marks[2], "Foo Inc.") + end.format(who))]
    cases += [("BSD-4-Clause", clauses.format("1. ", "2. ") + advert + name.format("4. ", "the University") + end.format(holders)),
              ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
                      "the following conditions are met: see the file COPYING.")]
    for want, text in cases:
        around = prose(rng, 80) + "\n" + text + "\n" + prose(rng, 80)
        assert [m[0] for m in index.scan(around, memo)] == [want], (want, text)
