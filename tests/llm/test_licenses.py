import re

from rankforge.llm.licenses import BASE, SHARE, TEMPLATES, license_labels, license_scan, template_rows

SCHEMA = "doc_id long, text string, words string, `row` string, label int"
TEXTS = [
    "Released under the MIT License.", "mit license mit license x general public LICENSE", None, "", " . ",
    "Licensed under CC BY-NC 4.0.", "licensed under cc by 4.0", "x " * 20000 + "Apache License, Version 2.0",
    "Licensed under the Apache License, Version 2.0. " * 3, "the of and to", "mit-licence license",
    "This work is licensed under the GNU General Public License, version 3.", "MITé license, Kit license",
    "Permission is hereby granted, free of charge, to all people obtaining a copy",
    "permission was hereby granted free of charge to any person obtaining a copy", "license mit", "apache  \n license",
    "mİt license", "Redistribution and use in source and binary forms, with or without", "general public",
    "license", "subject to the terms of the Mozilla Public License, v. 2.0"]


def brute(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    at = sorted((i, label) for p, label in BASE for i in range(len(w)) if w[i:i + len(p.split())] == p.split())
    based = sorted({x for _, x in at})
    own, best = set(), 0.0
    for _, label, words, key in template_rows(TEMPLATES):
        for i in range(len(w)):
            same = [i + j < len(w) and w[i + j] == x for j, x in enumerate(words)]
            if sum(same) >= SHARE * len(words) and all(same[j] for j in key):
                own.add(label)
                best = max(best, sum(same) / len(words))
    return (len(w), len(at), at[0][0] if at else None, at[-1][0] if at else None, ",".join(based),
            ",".join(sorted({*based, *own})), 1.0 if at else best)


def test_against_brute_force(spark):
    rows = [(i, t, "x", "y", 1) for i, t in enumerate(TEXTS)] + [(0, TEXTS[0], None, None, None), (None, "MIT License", "", "", 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted(map(tuple, license_labels(df).collect()), key=str)
    assert got == sorted([(r[0], *brute(r[1])) for r in rows], key=str)
    assert license_labels(spark.createDataFrame([], SCHEMA)).count() == 0


def test_finds_and_native_plan(spark):
    df = spark.createDataFrame([(1, "a. Licensed under CC BY-NC 4.0 b", "", "", 1)], SCHEMA)
    _, finds = license_scan(df)
    assert [(r.label, r.start, r.score) for r in finds.collect()] == [("cc-by-nc", 1, 1.0)]
    plan = license_labels(df)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
