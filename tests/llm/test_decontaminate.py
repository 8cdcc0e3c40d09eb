"""Decontamination against plain string search."""

from __future__ import annotations

import hashlib
import re

from tidegauge.llm import decontaminate, queries
from tidegauge.llm.decontaminate import SLACK, WINDOW


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(docs, items):
    windows = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - WINDOW + 1) if w else 0):
            windows.setdefault(tuple(w[i : i + WINDOW]), set()).add(item)
    lengths = sorted({len(w) for w in windows})
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                if (got := windows.get(tuple(w[i : i + n]))) is not None:
                    hit |= set(range(i, i + n))
                    found |= got
        digest = hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


def result(df):
    columns = "doc_id n_words n_hit n_items items_sha256 contaminated".split()
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def write(spark, path, docs, items):
    spark.createDataFrame(docs, "doc_id long, text string, n_words string").repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string, phrase string").write.parquet(f"{path}/benchmark.parquet")


def test_op1_query(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    want = plain(docs, items)
    assert result(queries.op1_decontaminate(spark, sf)) == want
    assert any(r[2] for r in want)


def test_odd_rows(spark, tmp_path):
    long = " ".join(f"t{i}" for i in range(20))
    items = [
        (1, long), (2, long.upper()), (3, "the"), (4, None), (5, " .,- "), (6, "a a a a a a a a a a a a a a a"), (7, "Élan vital"),
        (1, long), (8, "x y x y"), (9, " ".join(f"t{i}" for i in range(3, 16))), (12, "never seen here"),
    ]
    docs = [
        (0, None), (1, ""), (2, "..."), (3, f"before {long} after"), (4, "The THE the."), (5, "a " * 40), (6, "É élan vital; Élan Vital"),
        (7, "x y x y x y"), (8, long + " filler" * 400), (9, long + " filler" * 30_000 + " the"), (10, "t1 t0 t3 t2"),
        (11, " ".join(f"t{i}" for i in range(7, 20))), (12, " ".join(f"t{i}" for i in range(8, 20))), (3, "the"), (None, long),
        (13, "never here seen"), (14, "z never seen here"),
    ]
    write(spark, tmp_path, [(*d, "x") for d in docs], [(*i, "y") for i in items])
    got = queries.op1_decontaminate(spark, str(tmp_path))
    assert result(got) == plain(docs, items)
    tables = [spark.read.parquet(f"{tmp_path}/{t}.parquet") for t in ("documents", "benchmark")]
    near = {r.doc_id: r.n_near_items for r in decontaminate.contamination(*tables, near=True).collect()}
    assert near[13] >= 1 and near[1] == 0 and SLACK > 2


def test_empty_tables(spark, tmp_path):
    write(spark, f"{tmp_path}/a", [], [(1, "a b", "")])
    assert queries.op1_decontaminate(spark, f"{tmp_path}/a").collect() == []
    write(spark, f"{tmp_path}/b", [(1, "a b", "")], [])
    assert result(queries.op1_decontaminate(spark, f"{tmp_path}/b")) == plain([(1, "a b")], [])
