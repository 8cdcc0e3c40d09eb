"""Fingerprints against a plain version, and what they tell apart."""

from __future__ import annotations

import hashlib
import math
import re

import numpy as np
import pyarrow as pa
import xxhash

from tidegauge.llm import imatch, queries

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
NAMES = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
M64 = (1 << 64) - 1


def mixed(x, seed):
    x = (x ^ (seed * 0x9E3779B97F4A7C15 & M64)) * 0xFF51AFD7ED558CCD & M64
    x = (x ^ (x >> 33)) * 0xC4CEB9FE1A85EC53 & M64
    return x ^ (x >> 33)


def terms(text):
    return sorted(set(re.findall(WORD, re.sub("[A-Z]", lambda m: m[0].lower(), text))), key=lambda t: t.encode())


def fingerprint(text, lexicon):
    """Term by term, lexicon by lexicon."""
    own = [(t, xxhash.xxh3_64_intdigest(t)) for t in terms(text)]
    own = [x for x in own if x[0] in lexicon] or own
    out = []
    for k in range(imatch.LEXICONS):
        level = 0 if k == 0 else 1 + (k - 1) // imatch.SUBSETS
        kept = [h for _, h in own if level == 0 or mixed(h, k) >> (64 - level) == 0]
        total = sum(mixed((h + place * 0xD6E8FEB86659FD93) & M64, 101) for place, h in enumerate(kept)) & M64
        out.append(mixed(total, 102) % 65535 + 1 if kept else 0)
    if not any(out):
        out[0] = xxhash.xxh3_64_intdigest(text) % 65535 + 1
    return out


def like(a, b):
    if a == b:
        return 1.0
    n_all, m_all, n, m, sparse_levels = 0, 0, 0, 0, 0
    n_all, m_all = sum(x or y for x, y in zip(map(bool, a), map(bool, b))), sum(x == y != 0 for x, y in zip(a, b))
    last = None
    for level in range(imatch.LEVELS):
        at = slice(1 + level * imatch.SUBSETS, 1 + (level + 1) * imatch.SUBSETS)
        held, same = sum(bool(x or y) for x, y in zip(a[at], b[at])), sum(x == y != 0 for x, y in zip(a[at], b[at]))
        last = (held, same)
        if held <= imatch.SPARSE:
            n, m, sparse_levels = n + held, m + same, sparse_levels + 1
    if not sparse_levels:
        n, m = last
    return m / n if n else m_all / n_all


def plain(rows):
    """The query's rows for (doc_id, text) with distinct ids or none."""
    rows = [(i, t or "") for i, t in rows]
    signed = lambda t: (lambda h: h - (1 << 64) if h >> 63 else h)(xxhash.xxh64_intdigest(t, seed=42))
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, signed(r[1])))
    df = {}
    for _, t in rows:
        for w in terms(t):
            df[w] = df.get(w, 0) + 1
    lexicon = {w for w, n in df.items() if imatch.LOWEST <= math.log2(len(rows) / n) <= imatch.HIGHEST}
    out = []
    for k, (i, t) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        cut = len(t) // 4
        new = t[: len(t) - cut] + after[:cut]
        own, edited, following = (fingerprint(x, lexicon) for x in (t, new, after))
        text = lambda f: "".join(f"{x:04x}" for x in f)
        out.append((i, len(t), hashlib.sha256(new.encode()).hexdigest(), text(own), text(edited), like(own, edited), like(own, following)))
    return sorted(out, key=repr)


def result(df):
    return sorted((tuple(r) for r in df.select(NAMES).collect()), key=repr)


def write(spark, path, rows, parts=3):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, last string, bucket long")
    df.repartition(parts).write.parquet(f"{path}/documents.parquet")


def test_op12_query(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    out = result(queries.op12_fingerprints(spark, sf))
    assert out == plain(rows)
    texts = dict(rows)
    by_text = {}
    for doc, _, _, print_, *_ in out:
        by_text.setdefault(texts[doc], set()).add(print_)
    assert all(len(p) == 1 for p in by_text.values())
    near, other = np.array([r[5] for r in out]), np.array([r[6] for r in out])
    assert (near > other).mean() > 0.95 and np.median(near) > 0.3 and np.quantile(other, 0.9) < 0.1


def test_odd_rows(spark, tmp_path):
    texts = ["", None, " . ", "!?", "one", "One", "ﬁn É 日本 語", "a\x00b", "x" * 5, "abc def ghi jkl", "é" * 9, "long words " * 9000]
    rows = list(enumerate(texts)) + [(100 + i, f"w{i} w{i % 7} common text") for i in range(60)] + [(None, "no id"), (None, None), (-5, "below")]
    write(spark, tmp_path / "a", rows)
    assert result(queries.op12_fingerprints(spark, str(tmp_path / "a"))) == plain(rows)
    write(spark, tmp_path / "b", [])
    assert queries.op12_fingerprints(spark, str(tmp_path / "b")).collect() == []
    write(spark, tmp_path / "c", [(5, "only this one here")])
    assert result(queries.op12_fingerprints(spark, str(tmp_path / "c"))) == plain([(5, "only this one here")])
    twice = [(1, "same text here"), (1, "same text here"), (1, "another"), (2, "last one")]
    write(spark, tmp_path / "d", twice)
    assert result(queries.op12_fingerprints(spark, str(tmp_path / "d"))) == plain(twice)


def test_many_small_slices_give_the_same_rows(spark, tmp_path, monkeypatch):
    rows = [(i * 3 % 101, f"w{i % 13} v{i % 5} text {i}" * (i % 4)) for i in range(101)]
    write(spark, tmp_path, rows, 5)
    monkeypatch.setattr(imatch, "FOLLOWED_BYTES", 40)
    assert result(queries.op12_fingerprints(spark, str(tmp_path))) == plain(rows)


def test_the_lexicon_is_bounded_by_the_average_number_of_terms(spark, monkeypatch):
    docs = spark.createDataFrame([(f"a{i} b{i} c{i % 8} d{i % 32}",) for i in range(256)], "text string")
    assert len(imatch.lexicon(docs)) == 2 * 256 + 32
    monkeypatch.setattr(imatch, "MOST_TERMS", 128)  # 4 terms each: words of one document in 32 at least
    assert len(imatch.lexicon(docs)) == 32


def test_terms_of_sliced_and_empty_arrays():
    texts = pa.array(["zz", "B a", None, "  ", "a b.a"])
    words, text, term = imatch.terms_of(texts.slice(1))
    assert [(int(t), words[int(w)].as_py()) for t, w in zip(text, term, strict=True)] == [(0, "a"), (0, "b"), (3, "a"), (3, "b")]
    assert len(imatch.terms_of(pa.array([None, ""], pa.string()))[1]) == 0
