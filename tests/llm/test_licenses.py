import re

from candlewick.llm import licenses

BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}


def brute(text):
    lower = re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    places, labels = [], set()
    for phrase, label in BASE.items():
        p = phrase.split()
        at = [i for i in range(len(words)) if words[i : i + len(p)] == p]
        places += at
        labels |= {label} if at else set()
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def test_base_equals_brute_force(spark):
    texts = [
        "Released UNDER the MIT-License.", "cc by nc cc by nc by nc", "Apache License, Version 2.0",
        "under the mit license under the mit licence", "é" * 9 + " CC BY-NC 4.0 ünder", None, "", " .. ",
        "x " * 70_000 + "licensed under cc by-nc", "cc_by nc", "İ under the mit license K",
        "cc by nc " * 3000, "the mit license under", "cc\x00by\x7fnc",
    ]
    rows = [(i, t, i, "x") for i, t in enumerate(texts)] + [(1, texts[1], 0, "y"), (None, texts[0], 0, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, template int, label string")
    got = licenses.license_scan(docs).collect()
    want = sorted(str((r[0], *brute(r[1]))) for r in rows)
    assert sorted(str((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels)) for r in got) == want
    assert all((r.score == 1.0) == bool(r.n_base) for r in got)
    assert licenses.license_scan(docs.limit(0)).count() == 0


def test_notices(spark):
    granted = (
        "Permission is granted, free of charge, to any person obtaining a copy of this software"  # one word less
    )
    texts = [
        "GNU General Public License, version 3", "GNU General Public License version 2 or 3", granted,
        "permission to copy this software free of charge", "Redistribution and use in source and very binary "
        "forms, with or without modification, are permitted", "public license version",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.labels, round(r.score, 2), r.n_base) for r in licenses.license_scan(docs).collect()}
    assert got[0] == ("gpl-3", 1.0, 0) and got[1] == ("gpl-2", 1.0, 0)
    assert got[2] == ("mit", round(15 / 16, 2), 0) and got[3] == ("", 0.0, 0)
    assert got[4] == ("bsd", 1.0, 0) and got[5] == ("", 0.0, 0)
