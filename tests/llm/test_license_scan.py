import re

from hypothesis import given, settings
from hypothesis import strategies as st

from barlens.llm import license_scan as X

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute_blocks(text, templates=X.TEMPLATES, containment=X.CONTAINMENT):
    """(label, share, start, length) of what stands, every stretch of the text against every template."""
    w = words(text)
    found = set()
    for t in templates:
        own = words(t.text)
        tokens, width = set(own), len(own) + max(1, len(own) // 4)
        if not tokens:
            continue
        at = [i for i, x in enumerate(w) if x in tokens]
        for e in at:
            s = min(i for i in at if e - width < i <= e)
            held = tokens & set(w[s:e + 1])
            if (len(held) >= containment * len(tokens) - 1e-9 and set(t.must) <= set(w[s:e + 1])
                    and not set(t.never) & set(w[max(0, e + 1 - width):s + width])):
                found.add((t.label, len(held) / len(tokens), len(tokens), s, e - s + 1))
    over = lambda a, b: a[3] < b[3] + b[4] and b[3] < a[3] + a[4]
    best = [b for b in found if not any(o[0] == b[0] and over(o, b) and (-o[1], -o[2], o[4], o[3]) < (-b[1], -b[2], b[4], b[3]) for o in found)]
    best = [b for b in best if not any(o[0] != b[0] and over(o, b) and (-o[1], -o[2]) < (-b[1], -b[2]) for o in best)]
    return {(b[0], b[1], b[3], b[4]) for b in best}


def test_whole_table(documents, texts):
    labelled = 0
    for r in X.scan(documents).collect():
        w = words(texts[r["doc_id"]])
        starts = [(i, label) for p, label in X.PHRASES.items() for i in range(len(w)) if w[i:i + len(p.split())] == p.split()]
        base = {label for _, label in starts}
        join = brute_blocks(texts[r["doc_id"]])
        assert (r["n_words"], r["n_base"]) == (len(w), len(starts))
        assert r["first_word"] == min((i for i, _ in starts), default=None)
        assert r["last_word"] == max((i for i, _ in starts), default=None)
        assert r["base_labels"] == ",".join(sorted(base)) and r["labels"] == ",".join(sorted(base | {x[0] for x in join}))
        assert {(t["label"], t["containment"], t["start"], t["length"]) for t in r["blocks"]} == join
        assert r["score"] == (1.0 if base else max((x[1] for x in join), default=0.0))
        labelled += bool(join)
    assert labelled > 20


VOCABULARY = [f"t{i}" for i in range(9)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.lists(st.sampled_from(VOCABULARY), min_size=1, max_size=7), st.sets(st.sampled_from(VOCABULARY), max_size=2),
                          st.sets(st.sampled_from(VOCABULARY + ["other"]), max_size=1)), min_size=1, max_size=5),
       st.lists(st.sampled_from(VOCABULARY + ["other"]), max_size=25), st.sampled_from([0.3, 0.5, 0.8, 1.0]), st.randoms())
def test_filters_lose_nothing(templates, text, containment, random):
    named = [X.Template(f"l{i % 3}", " ".join(t), tuple(must), tuple(never)) for i, (t, must, never) in enumerate(templates)]
    rank = {w.encode(): (random.randint(0, 3), w.encode()) for w in VOCABULARY}
    split = [w.encode() for w in text]
    got = X.standing(X.Index(named, rank, containment).blocks(split, set(split)))
    assert {(b.label, b.share(), b.start, b.length) for b in got} == brute_blocks(" ".join(text), named, containment)


def test_licenses_that_differ_in_a_word(spark):
    said = {
        "Licensed under CC BY 4.0": {"cc-by", "cc-by-4.0"},
        "Licensed under CC BY-NC 4.0": {"cc-by", "cc-by-nc-4.0"},
        "This work is licensed under a Creative Commons Attribution 4.0 International License": {"cc-by-4.0"},
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License": {"cc-by-nc-4.0"},
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License": {"cc-by-sa-4.0"},
        "This work is licensed under the GNU General Public License, version 2": {"gpl", "gpl-2.0"},
        "This work is licensed under the GNU General Public License, version 3": {"gpl", "gpl-3.0"},
        "This work is licensed under the GNU Lesser General Public License, version 3": {"gpl"},
        "He reserved a room; all his rights as a guest were kept.": set(),
        "The MIT team released the note under no license at all.": set(),
        "Released under\nthe MIT License.": {"mit"},
        "Licensed under the Apache License, Version 1.1": set(),
    }
    filler = "Nothing of that kind stands in these lines, whatever they say. "
    rows = [(i, filler * 3 + t + ". " + filler * 3) for i, t in enumerate(said)]
    got = {r["doc_id"]: r for r in X.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, (text, labels) in enumerate(said.items()):
        assert set(filter(None, got[i]["labels"].split(","))) == labels, text
        for b in got[i]["blocks"]:
            assert b["start"] == 3 * len(words(filler)) and b["length"] == len(words(text)) and b["containment"] == 1.0, text


def test_labels_of_phrases_are_not_of_templates(empty):
    import pytest
    with pytest.raises(ValueError):
        X.scan(empty, [X.Template("reserved", "all rights reserved")])


def test_many_notices_in_one_text(spark):
    text = "\n".join(["Released under the MIT License", "and then some other words", "Licensed under the Apache License, Version 2.0"] * 3000)
    r = X.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert r["labels"] == "apache-2.0,mit" and len(r["blocks"]) == 6000


def test_overlapping_places():
    w = [x.encode() for x in "cc by cc by cc cc by".split()]
    assert X.places(w, [b"cc", b"by"]) == [0, 2, 5]


def test_odd_rows(odd, empty, spark):
    got = X.digest(odd).collect()
    assert len(got) == odd.count()
    for r in got:
        assert r["labels"] == "" and r["score"] == 0 and r["first_word"] is None
        if r["doc_id"] in (1, 2, 3):
            assert r["n_words"] == 0
        if r["doc_id"] == 4:
            assert r["n_words"] == 60_000
    assert X.digest(empty).count() == 0
    far = spark.createDataFrame([(1, "x " * 500_000 + "ALL rights, RESERVED")], "doc_id long, text string")
    r = X.digest(far).first()
    assert (r["n_words"], r["first_word"], r["last_word"], r["labels"]) == (500_003, 500_000, 500_000, "reserved")


def test_wrapped_notices_and_long_templates(spark):
    gpl = ("# This program is free software: you can redistribute it and/or modify\n# it under the terms of the GNU General "
           "Public License as published by\n# the Free Software Foundation, either version 3")
    mit = ("Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated "
           "documentation files (the \"Software\"), to deal")
    bsd = ("Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the "
           "following conditions\nare met:")
    filler = "\n".join("some other words stand here" for _ in range(50))
    rows = [(i, f"{filler}\n{t}\n{filler}") for i, t in enumerate((gpl, mit, bsd))] + [(3, filler), (4, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: {t["label"]: t["containment"] for t in r["blocks"]} for r in X.scan(df).collect()}
    assert got == {0: {"gpl-notice": 1.0}, 1: {"mit-grant": 1.0}, 2: {"bsd": 1.0}, 3: {}, 4: {}}
    long = " ".join(f"term{i}" for i in range(150))
    for text in (long, long.replace(" ", "\n")):
        one = spark.createDataFrame([(1, f"{filler} {text} {filler}")], "doc_id long, text string")
        assert X.scan(one, [X.Template("long", long)]).first()["labels"] == "long"


def test_sql_states_wrapped_notices(spark, tmp_path):
    """The oracle on planted texts: wrapped, doubled, with deciding words missing or in the way."""
    import duckdb

    from barlens.llm import oracles
    parts = [t.text for t in X.TEMPLATES]
    texts = [f"some words before {a}\nand {b.replace(' ', chr(10))} after it" for a in parts for b in parts]
    texts += [t.replace(" a ", " ").replace("License", "Licence") for t in texts] + [None, "", "cc by cc by-nc"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    df.write.parquet(str(tmp_path / "documents"))
    c = duckdb.connect()
    c.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents/*.parquet')")
    got = X.digest(df)
    want = c.execute(f"SELECT {', '.join(got.columns)} FROM ({oracles.license_scan()})").fetchall()
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))
