import re

from llm_texts import prose

from lowfold.llm import licenses

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
NOTICES = [
    "Licensed under the Apache License, Version 2.0.",
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License, version 3.",
    "GPL v2 or later; also GNU\n * Lesser General Public License 2.1, MIT License MIT License",
    "# SPDX-License-Identifier: Apache-2.0",
    "shared as CC-BY-SA 4.0, see https://creativecommons.org/licenses/by-nc/3.0/ and cc   by!",
    "Mozilla Public License 2.0. All rights reserved. éMIT license, mit licensed, xcc by, apache. license",
    "Permission is hereby granted, free of charge, to any person obtaining a copy",
    "no words of that kind: licentious, apachean, MPLs, ccby",
]


#: Notices and the labels that the rules give them.
LABELS = {
    "/*\n *          Permission is hereby granted, free of charge,\n *            to any person obtaining a copy": "mit",
    "licensed under gpl v3": "gpl-3",
    "GPLv3": "gpl-3",
    "GPLv2+ and LGPLv2.1": "gpl-2-or-later,lgpl-2.1",
    "covered by the mpl 2.0": "mpl-2.0",
    "dual licensed under MIT or Apache-2.0": "apache-2.0,mit",
    "Licensed under the Apache License,\n          * Version 2.0": "apache,apache-2.0",
    "the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version": "gpl,gpl-2-or-later",
    "// under the terms of the GNU Lesser General Public\n//    License as published by the Free Software Foundation;\n//    either version 2.1 of the License, or\n//    (at your option) any later version": "lgpl-2.1-or-later",
    "GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.": "agpl-3-or-later",
    "SPDX-License-Identifier: MIT OR Apache-2.0": "apache-2.0,mit",
    "SPDX-License-Identifier: (GPL-2.0-or-later AND BSD-3-Clause)": "bsd-3-clause,gpl-2-or-later",
    "SPDX-License-Identifier: GPL-2.0-only": "gpl-2",
    "The Software shall be used for Good, not Evil.": "json",
    "a simple 2.0 example of gpl": "",
}


def test_labels(spark):
    rows = licenses.scan(spark.createDataFrame([(k, text) for k, text in enumerate(LABELS)], "doc_id BIGINT, text STRING")).orderBy("doc_id").collect()
    assert {r.text: r["__scan"].labels for r in rows} == LABELS
    assert all(tuple(r["__scan"]) == plain(r.text) for r in rows)


def test_each_keyword_stands_in_each_match():
    for r in licenses.RULES:
        for text in LABELS:
            hay = re.sub(licenses.GAP, " ", text.lower()).strip() + "\n" + text
            assert not re.search(r["expression"], text) or r["keyword"] in hay, (r, text)


def plain(text):
    """The same by loops over the text."""
    text = text or ""
    words = WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text))
    places, base = [], set()
    for phrase, label in licenses.PHRASES.items():
        parts = phrase.split()
        at = [k for k in range(len(words)) if words[k : k + len(parts)] == parts]
        places += at
        base |= {label} if at else set()
    hits = [(m.start(), m.end(), r["priority"], k, r["label"], r["confidence"]) for k, r in enumerate(licenses.RULES) for m in re.finditer(r["expression"], text, re.A)]
    strong = [a for a in hits if not any(b[0] <= a[0] and a[1] <= b[1] and b[2] >= a[2] and (b[:2] != a[:2] or b[2] > a[2] or b[3] < a[3]) for b in hits)]
    labels = base | {a[4] for a in strong}
    return (len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), max((a[5] for a in strong), default=0.0))


def test_rules():
    assert len(licenses.RULES) > 300 and all(re.compile(r["expression"]) for r in licenses.RULES)


def test_against_loops(spark, odd_docs, no_docs):
    texts = [*NOTICES, *(f"{prose(k, 50)}\n{n}\n{prose(k + 1, 50)}" for k, n in enumerate(NOTICES)), " ".join(NOTICES), (NOTICES[0] + " ") * 3000, *map("".join, zip(NOTICES, NOTICES[1:], strict=False))]
    docs = odd_docs.unionByName(spark.createDataFrame([(1000 + k, t, None, None, None, "c", "c", "c") for k, t in enumerate(texts)], odd_docs.schema))
    rows = licenses.scan(docs).collect()
    assert len(rows) == docs.count() and licenses.scan(docs).columns == [*docs.columns, "__scan"]
    for r in rows:
        if len(r.text or "") < 50_000:
            assert tuple(r["__scan"]) == plain(r.text), r.text
    many = next(r for r in rows if r.text and len(r.text) > 100_000 and "Apache" in r.text)["__scan"]
    assert (many.n_base, many.first_word, many.base_labels, many.labels) == (3000, 3, "apache", "apache,apache-2.0")
    assert licenses.scan(no_docs).count() == 0


def test_the_plan_is_native(spark, odd_docs, tmp_path):
    odd_docs.write.parquet(str(tmp_path / "docs"))
    plan = licenses.scan(spark.read.parquet(str(tmp_path / "docs")))._jdf.queryExecution().executedPlan().toString()
    assert not any(node in plan for node in ("EvalPython", "MapIn", "Exchange"))
