"""The license scan against a plain version."""

from __future__ import annotations

import re

from tidegauge.llm import licenses, queries


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(text):
    w = words(text)
    places, base = [], set()
    for phrase, label in licenses.BASE.items():
        p = phrase.split()
        at = [i for i in range(len(w)) if w[i : i + len(p)] == p]
        places += at
        base |= {label} if at else set()
    found = []
    for number, priority, confidence, label, keyword, before, after in licenses.rule_rows():
        for i, x in enumerate(w):
            if x != keyword:
                continue
            left = "".join(v + " " for v in w[max(0, i - licenses.REACH) : i])
            right = "".join(" " + v for v in w[i + 1 : i + 1 + licenses.REACH])
            m, n = re.search(before, left), re.search(after, right)
            if m and n:
                found.append((i - m[1].count(" "), i + n[1].count(" "), priority, number, label, confidence))
    kept = [
        a for a in found
        if not any(
            b[0] <= a[0] and b[1] >= a[1] and b[2] >= a[2]
            and ((b[0], b[1]) != (a[0], a[1]) or (-b[2], b[3]) < (-a[2], a[3]))
            for b in found if b is not a
        )
    ]
    labels = base | {k[4] for k in kept}
    score = max([0.0, *(k[5] for k in kept), *([licenses.BASE_SCORE] if places else [])])
    return (
        len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)),
        ",".join(sorted(labels)), score,
    )


def check(df, rows):
    columns = "doc_id n_words n_base first_word last_word base_labels labels score".split()
    got = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
    assert got == sorted(((d, *plain(t)) for d, t in rows), key=repr)
    return got


TEXTS = [
    None, "", " .. ", "MIT License", "the mit  license, mit-license MIT licensed", "Licensed under the Apache License, Version 2.0.",
    "This work is licensed under the GNU General Public License, version 3.", "GNU Lesser General Public License v2.1 or later",
    "SPDX-License-Identifier: GPL-3.0-or-later", "SPDX-License-Identifier: MIT", "Creative Commons Attribution-ShareAlike 4.0",
    "CC BY-NC-SA 3.0", "cc0 1.0 universal", "gplv3", "lgplv2.1", "(c) Copyright 2020 X. All rights reserved.", "3-clause BSD license",
    "the general public license general public license", "license", "Tous droits réservés", "mit " * 300 + "license " * 3,
    "word " * 40_000 + "apache license 2.0 " + "word " * 3, "GNU Affero General Public License version 3 or any later version",
    "version 2 of the GNU General Public License", "public domain dedication and license",
]


def test_rules():
    rows = licenses.rule_rows()
    assert len(rows) > 200 and len(licenses.keywords()) < len(rows)
    assert "gpl-3.0" in plain(TEXTS[6])[5] and "lgpl-2.1" in plain(TEXTS[7])[5] and plain(TEXTS[8])[5] == "gpl-3.0-or-later"


def test_odd_rows(spark, tmp_path):
    rows = [*enumerate(TEXTS), (3, TEXTS[3]), (None, "MIT license")]
    spark.createDataFrame([(*r, "z") for r in rows], "doc_id long, text string, labels string").repartition(4).write.parquet(
        f"{tmp_path}/documents.parquet"
    )
    check(queries.op2_licenses(spark, str(tmp_path)), rows)


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert queries.op2_licenses(spark, str(tmp_path)).collect() == []


def test_op2_query(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert any(g[2] for g in check(queries.op2_licenses(spark, sf), rows))
