import math
import random
import re

import pyarrow as pa
import pytest

from postlake.llm import license_scan as q

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def brute(text, templates=q.TEMPLATES, containment=q.CONTAINMENT):
    w, places, base, found = WORD.findall(lower(text)), [], set(), {}
    for phrase, label in q.PHRASES.items():
        p = phrase.split()
        hits = [i for i in range(len(w) - len(p) + 1) if w[i : i + len(p)] == p]
        places += hits
        base |= {label} if hits else set()
    lines = [set(WORD.findall(x)) for x in lower(text).split("\n")]
    paragraphs = [set()]
    for line in lines:
        if line:
            paragraphs[-1] |= line
        else:
            paragraphs.append(set())
    sets = [(label, set(WORD.findall(lower(t)))) for label, t in templates]
    for blocks, long in ((lines, False), (paragraphs, True)):
        for block in blocks:
            hit = [(n, t, len(t & block) / len(t)) for n, t in sets
                   if (len(t) >= q.LONG_TEMPLATE or not long) and len(t & block) >= math.ceil(containment * len(t) - 1e-9)]
            for n, t, share in hit:
                if not any(t < u for _, u, _ in hit):
                    found[n] = max(share, found.get(n, 0.0))
    score = 1.0 if base else max(found.values(), default=0.0)
    return [len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(base | set(found))), score]


def scan(texts, containment=q.CONTAINMENT):
    vocabulary = q.Vocabulary({w for words in q.spelled([*q.PHRASES, *[t for _, t in q.TEMPLATES]]) for w in words})
    columns = q.scan(pa.array(texts, pa.string()), vocabulary, q.Templates(q.TEMPLATES, {}, containment))
    return [[c[i].as_py() for c in columns] for i in range(len(texts))]


def test_equals_brute_force():
    rng = random.Random(5)
    texts = [None, "", "\n\n", "under the MIT License", "under the MIT\nLicense, apache license version 2.0 CC-BY-NC"]
    for _ in range(150):
        out = []
        for _ in range(rng.randrange(5)):
            words = rng.choice(q.TEMPLATES)[1].split() + ["a", "b"]
            for _ in range(rng.randrange(3)):
                words.pop(rng.randrange(len(words)))
            out += [rng.choice([" ", "\n", "\n\n"]).join([" ".join(words[:9]), " ".join(words[9:])])]
        texts.append(rng.choice(["\n", " ", "\n\n"]).join(out))
    for containment in (0.95, 0.6):
        assert scan(texts, containment) == [brute(t, containment=containment) for t in texts]


BSD = "Redistribution and use in source and binary forms, with or without\n{0}modification, are permitted provided that the following conditions\n{0}are met:\n"
GPL, LGPL, AGPL = (f"Licensed under the GNU {x}General Public License, version 3." for x in ("", "Lesser ", "Affero "))


@pytest.mark.parametrize("text, labels", [
    (BSD.format(""), "bsd"), ("x\n\n * " + BSD.format(" * ") + " * 1. Redistributions of source code", "bsd"),
    ("# This Source Code Form is subject to the terms of the Mozilla Public License,\n# v. 2.0. If a copy", "mpl-2"),
    ("This work is licensed under a Creative Commons\nAttribution-ShareAlike 4.0\nInternational License.", "cc-by-sa"),
    ("\n".join(BSD.format("").split()), "bsd"), (BSD.format("").replace("with", "\n\nwith", 1), ""),
    ("Released\n" + "word " * 40 + "\nunder the\n" + "word " * 40 + "\nMIT\nLicense", ""),
    (f"{GPL} {LGPL}", "gpl-3,lgpl-3"), (f"{LGPL} {GPL}", "gpl-3,lgpl-3"), (f"{LGPL} {AGPL}", "agpl-3,lgpl-3"), (LGPL, "lgpl-3"),
    (f"{LGPL} {LGPL} the license", "lgpl-3"), (LGPL.replace("Lesser ", "Lesser\n"), "lgpl-3"), (f"{GPL}\n{LGPL}", "gpl-3,lgpl-3"),
    ("Licensed under the GNU General Public License, version 3, or the GNU Lesser General Public License, version 3.", "gpl-3,lgpl-3"),
])
def test_wrapped_and_neighbouring_notices(spark, text, labels):
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert q.scanned(docs, ["doc_id"]).first().labels == labels


def test_query_and_empty_tables(spark, small_dir, empty_dir, awkward_rows):
    rows = q.op7_license_scan(spark, small_dir).collect()
    assert len(rows) == len(awkward_rows)
    text = dict(awkward_rows)
    for r in rows:
        if r.doc_id is not None:
            assert list(r)[1:] == brute(text[r.doc_id])
    assert q.op7_license_scan(spark, empty_dir).count() == 0
