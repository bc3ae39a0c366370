import random
import re

from affinis.llm import license_scan as L
from tests.llm.odd import odd_rows, words, no_docs, odd_docs  # noqa: F401


def brute(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    at = [(i, label) for phrase, label in L.BASE.items() for i in range(len(w)) if w[i:i + len(phrase.split())] == phrase.split()]
    places = [i for i, _ in at]
    return (len(w), len(at), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in at})))


def test_base_equals_brute_force():
    rng = random.Random(1)
    texts = ["", "...", "CC-BY", "cc by cc by", "cc cc by", "cc bye", "xcc by", "all rights reserved.All Rights\n\nReserved",
             "GENERAL public LICENSE", "écc by cc by cc byé", "general public", "all rights reserved all rights"]
    texts += [" ".join(rng.choice("cc by all rights reserved general public license x".split()) for _ in range(40)) for _ in range(200)]
    for t in texts:
        assert L.scan(t.encode())[:5] == brute(t), t


def test_signatures():
    labels = lambda t: L.scan(t.encode())[5].split(",")
    assert labels("Licensed under the Apache License, Version 2.0.") == ["apache-2.0"]
    assert labels("GNU General Public License, version 3 or later") == ["gpl", "gpl-3"]
    assert labels("GNU Lesser General Public License v2.1") == ["gpl", "lgpl-2.1"]
    assert labels("Licensed under CC BY-NC-SA 4.0.") == ["cc-by", "cc-by-nc-sa-4.0"]
    assert labels("Creative Commons Attribution-ShareAlike 4.0 International") == ["cc-by-sa-4.0"]
    assert labels("SPDX-License-Identifier: MIT") == ["mit"]
    assert labels("the house by the sea, rights and wrongs") == [""]
    assert len(L.rules()) > 200


def test_contained_detections_are_suppressed_and_gates_hold():
    text = " licensed under the mozilla public license version 2 0 and the mit license "
    taken = L.detections(text)
    assert [r.label for _, _, r in taken] == ["mpl-2.0", "mit"]
    for rule in L.rules():                     # a rule's text always holds its gate: the prefilter loses nothing
        assert rule.gate in rule.pattern.pattern.replace("(?:", " ") or rule.gate in rule.pattern.pattern


def test_all_rules_equal_gated_rules():
    rng = random.Random(2)
    parts = ["mit license", "apache license version 2 0", "cc by sa 4 0", "gpl v2", "all rights reserved", "x", "licensed under the"]
    for _ in range(200):
        t = " " + " ".join(rng.choice(parts) for _ in range(6)) + " "
        found = [(m.start(), m.end(), i) for i, r in enumerate(L.rules()) for m in r.pattern.finditer(t)]
        found.sort(key=lambda d: (-L.rules()[d[2]].priority, d[0] - d[1], d[0], d[2]))
        taken = []
        for b, e, i in found:
            if not any(x <= b and e <= y for x, y, _ in taken):
                taken.append((b, e, L.rules()[i]))
        assert taken == L.detections(t)


def test_odd_rows(odd_docs, no_docs):
    rows = L.scan_documents(odd_docs).collect()
    assert sorted((r.n_words, r.n_base) for r in rows) == sorted(brute(r[1])[:2] for r in odd_rows())
    assert all(r.labels == "" and r.first_word is None and r.score == 0 for r in rows)
    assert L.scan_documents(no_docs).collect() == []


def test_detections_with_their_places(spark, odd_docs):
    from tests.llm.odd import SCHEMA

    rows = [(1, "See: Licensed under the Apache License, Version 2.0. All rights reserved.", None, None, 0), (2, None, None, None, 0),
            (3, "\u00e9 MIT License", None, None, 0)]
    got = {(r.doc_id, r.label, r.first_word, r.n_words) for r in L.detect(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {(1, "apache-2.0", 1, 8), (1, "reserved", 9, 3), (3, "mit", 1, 2)}
    assert L.detect(odd_docs).collect() == []


# Notices as they are written, with the labels a reader gives them.
NOTICES = [
    ("Licensed under apache 2.0", "apache-2.0"),
    ("PHP 3.0 and Elastic 1.0, no rights reserved to anyone", ""),
    ("We upgraded to gpl 3 laps before noon", ""),
    ("SPDX-License-Identifier: GPL-2.0-or-later", "gpl-2.0"),
    ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
     "License as published by the Free Software Foundation, either version 3 of the License", "gpl,gpl-3"),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software", "mit"),
    ("Redistribution and use in source and binary forms, with or without modification, are permitted", "bsd"),
    ("Distributed under the 3-clause BSD license.", "bsd-3-clause"),
    ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "mpl-2.0"),
    ("Copyright (c) 2019 Jane Doe. All rights reserved.", "copyright,reserved"),
    ("Available under the Open Database License v1.0", "odbl-1.0"),
    ("published under a Creative Commons Attribution-NonCommercial-NoDerivs 3.0 Unported", "cc-by-nc-nd-3.0"),
    ("Released into the public domain.", "public-domain"),
    ("licensed under terms to be agreed", "unknown-license"),
    ("available under the GPLv3 or later", "gpl-3"),
    ("the mit campus and the apache tribe", ""),
]


def test_notices():
    assert [(t, L.scan(t.encode())[5]) for t, _ in NOTICES] == NOTICES


def test_keywords_are_in_every_match():
    """What the gate rests on: a rule's keyword stands in every text the rule matches."""
    texts = [L.words_of(t.encode())[1].decode() for t, _ in NOTICES]
    texts += [f" x licensed under the {r.gate} version 2 0 licence {r.gate} license v3 1 0 " for r in L.rules()]
    for rule in L.rules():
        for t in texts:
            if rule.pattern.search(t):
                assert rule.gate in t, (rule, t)


def test_suppression_equals_all_pairs(monkeypatch):
    """Random intervals of three priorities against the definition."""
    rng = random.Random(7)
    for _ in range(300):
        found = [(b, b + rng.randint(1, 12), rng.randint(0, 2)) for b in (rng.randrange(40) for _ in range(rng.randint(0, 25)))]
        fake = tuple(L.Rule(str(k), "g", type("P", (), {"finditer": lambda self, w, k=k: iter([
            type("M", (), {"start": lambda s, d=d: d[0], "end": lambda s, d=d: d[1]})() for d in found if d[2] == k])})(), p, 1.0)
            for k, p in enumerate((60, 50, 10)))
        monkeypatch.setattr(L, "rules", lambda f=fake: f)
        monkeypatch.setattr(L, "gates", lambda: type("A", (), {"iter": lambda self, w: [(0, (0, 1, 2))]})())
        want = []
        for b, e, i in sorted(found, key=lambda d: (-fake[d[2]].priority, d[0] - d[1], d[0], d[2])):
            inside = any(x <= b and e <= y for x, y, _ in want)
            crossed = fake[i].priority <= L.GENERAL and any(x < e and b < y for x, y, _ in want)
            if not inside and not crossed:
                want.append((b, e, fake[i]))
        assert [(b, e, r.label) for b, e, r in L.detections(" ")] == [(b, e, r.label) for b, e, r in want]


def test_long_texts_take_near_linear_time():
    import time

    text = b"mit license " * 90_000            # over 1 MB
    t = time.process_time()
    assert L.scan(text)[5] == "mit" and len(L.detections(L.words_of(text)[1].decode())) == 90_000
    assert time.process_time() - t < 8
