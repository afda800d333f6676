"""Whole licence texts without the words of a notice."""

import random

from reportkit.llm.license_scan import TEXTS, license_scan


def test_whole_texts_are_found(docs_of):
    rng = random.Random(6)
    full = {t.label: t.text for t in TEXTS}
    noise = lambda n: " ".join(rng.choice(["alpha", "the", "software", "permission", "copy"]) for _ in range(n))
    lines = lambda t: "\n".join(" * " + " ".join(t.split()[i:i + 9]).capitalize() for i in range(0, len(t.split()), 9))
    rows = [(i, f"/* Copyright 2020 X\n{lines(full[k])}\n*/ {noise(50)}") for i, k in enumerate(full)]
    numbered = full["bsd-3-clause"].replace("redistributions of", "1. redistributions of").replace("redistributions in", "2. redistributions in") \
        .replace("neither the name of the copyright holder", "3. neither the name of the Regents of the University")
    mixed = " ".join([noise(300), full["isc"], noise(300), full["mit"], full["bsd-2-clause"], "under the MIT license"])
    rows += [(10, numbered), (11, mixed), (12, full["mit"].replace("sublicense", "")), (13, noise(400)),
             (14, "Permission is hereby granted, free of charge, to any person obtaining a copy")]
    got = {r.doc_id: r for r in license_scan(docs_of(rows)).collect()}
    for i, k in enumerate(full):
        assert got[i].labels == k and got[i].score == 1.0 and [(p.label, p.start) for p in got[i].places] == [(k, 3)] and got[i].n_base == 0
    assert got[10].labels == "bsd-3-clause" and 0.9 < got[10].score < 1
    assert got[11].labels == "bsd-2-clause,isc,mit" and got[11].base_labels == "mit" and got[11].n_base == 1 and len(got[11].places) == 4
    assert all((got[i].labels, got[i].score) == ("", 0.0) for i in (12, 13, 14))
