from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import functions as F

from ledgerlint.llm import licenses as L


def brute(rows):
    out = Counter()
    for d, t in rows:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        places, labels = [], set()
        for phrase, label in L.BASE:
            p = phrase.split()
            here = [i for i in range(len(w)) if w[i : i + len(p)] == p]
            places += here
            labels |= {label} if here else set()
        out[(d, len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels)))] += 1
    return out


TEXTS = [None, "", "...", "Licensed under CC BY-NC 4.0.", "MIT License\n\nmit-license x", "cc by cc by cc  by", "The GNU General\tPublic License; Apache license", "mit licenses, smit license", "É mit license é", "a" * 100_000 + " mit license",
         "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
         "x y " + L.TEMPLATES[0][1].upper() + " z", "permission is hereby granted, free of charge: nothing else here", "redistribution of forms and source and binary use in", "words " * 30_000 + "cc by"]


def test_base_against_plain_python(spark, docs_of):
    rows = list(enumerate(TEXTS)) + [(500 + i, f"plain words number {i}") for i in range(200)] + [(None, "mit license"), (900, "cc by"), (900, "cc by")]
    docs = docs_of(rows).withColumns({c: F.lit(1) for c in ("tie", "body", "base", "score", "labels", "word", "template")})
    got = L.scanned(docs.repartition(3)).collect()
    assert Counter(tuple(r)[:6] for r in got) == brute(rows)
    by = {r.doc_id: r for r in got if r.doc_id is not None}
    assert by[3].labels == "cc-by,cc-by-nc" and by[10].labels == "bsd" and by[10].base_labels == "" and by[11].labels == "mit"
    assert by[12].labels == by[13].labels == "" and by[500].score == 0 and by[10].score > 0.9
    assert all(0 <= r.score <= 1 and set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) for r in got)


def test_given_documents_and_native_plan(spark, docs_of):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = L.scanned(docs)
    assert Counter(tuple(r)[:6] for r in found.collect()) == brute([(r.doc_id, r.text) for r in docs.collect()])
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|NestedLoop", found._jdf.queryExecution().toString())
    assert L.scanned(docs_of([])).count() == 0


def test_licences_that_stand_together_or_in_most_files(spark, docs_of):
    text = {t[0]: t[1] for t in reversed(L.TEMPLATES)}
    together = [("mit", "bsd", "isc"), ("mit", "apache", "bsd"), ("mit", "apache", "bsd", "isc", "mpl"), ("apache", "gpl", "unlicense", "cc0", "isc", "bsd")]
    rows = [(i, " and then ".join(text[k] for k in kinds)) for i, kinds in enumerate(together)]
    rows += [(1000 + i, f"plain words number {i} of this and the other") for i in range(200)]
    got = {r.doc_id: r for r in L.scanned(docs_of(rows)).collect()}
    for i, kinds in enumerate(together):
        assert set(kinds) <= set(got[i].labels.split(",")), (kinds, got[i].labels)
    other = {r.doc_id: r for r in L.scanned(docs_of([(i, f"{text['bsd']} file {i}") for i in range(300)] + rows[-200:])).collect()}
    assert all(other[i].labels == "bsd" and other[i].score > 0.99 for i in range(300))
    assert not any(got[1000 + i].labels for i in range(200))


def test_only_ascii_letters_are_lowered(spark, docs_of):
    docs = docs_of([(1, "\u0130STANBUL MIT LICENSE \u212a"), (2, "C\u0043 BY")])
    got = {r.doc_id: tuple(r)[1:6] for r in L.scanned(docs).collect()}
    assert {(i, *v) for i, v in got.items()} == set(brute([(1, "\u0130STANBUL MIT LICENSE \u212a"), (2, "CC BY")]))


def test_places_are_kept_only_where_a_key_phrase_stands(spark, docs_of):
    docs = docs_of([(1, L.TEMPLATES[5][1]), (2, "redistribution of forms and source"), (3, None)])
    read = {r.doc_id: r for r in L._read(docs, "doc_id", "text").collect()}
    assert [x.word for x in read[1].placed] == L.TEMPLATES[5][1].split() and read[1]["keys"] == [5]
    assert read[2].placed is None and set(read[2].has) == {"redistribution", "of", "forms", "and", "source"} and read[3].has == []
