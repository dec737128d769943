import itertools
import re
from collections import Counter

import numpy as np
import pytest
from helpers import LONG, awkward_docs, rows_of

from windlass.llm import filter_audit as fa


SHOWN = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def brute(rows, labels):
    """Every order and step, row by row, of (doc_id, text, lang)."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    fails = []
    for i, text, lang in rows:
        t = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        f = set()
        if len(w) < 200:
            f.add("A")
        if 100 * len(set(w)) < 50 * len(w):
            f.add("B")
        if 100 * len(re.findall("[A-Z]", t)) > 3 * len(t):
            f.add("C")
        if re.search("[#$%&*|]", t):
            f.add("D")
        if any((u or "") == t and j is not None and (i is None or j < i) for j, u, _ in rows):
            f.add("E")
        fails.append((lang or "", f, i in good, i in toxic))
    out = {}
    shapley = Counter()
    for part in {f[0] for f in fails}:
        for order in itertools.permutations("ABCDE"):
            left = [f for f in fails if f[0] == part]
            gone = []
            for step, x in enumerate(order, 1):
                hit = [f for f in left if x in f[1]]
                left = [f for f in left if x not in f[1]]
                out[part, "".join(order), step] = [len(left), len(hit), sum(x in f[1] for f in gone),
                                                   sum(f[0] == part and f[1] == {x} for f in fails), sum(f[2] for f in hit),
                                                   sum(f[3] for f in hit)]
                shapley[part, x] += len(hit)
                gone += hit
    return sorted(((p, o, s, *v, shapley[p, o[s - 1]]) for (p, o, s), v in out.items()), key=repr)


def label_table(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows],
                                 "doc_id long, quality int, toxic int, mask string, good string")


def corpus(seed, n):
    r = np.random.default_rng(seed)
    rows = []
    for k in range(n):
        size = int(r.choice([0, 3, 199, 200, 260]))
        words = [f"w{x}" if r.random() < 0.97 else r.choice(["A#", "DE", "x|y", "é"]) for x in r.integers(0, r.choice([20, 900]), size)]
        rows.append((k, r.choice([" ", "\n", "  "]).join(words), r.choice(["en", "de"])))
    return rows + [(1_000 + k, rows[k % 7][1], "en" if k % 2 else None) for k in range(n // 3)]


def test_equals_brute_force(spark):
    rows = corpus(1, 60)
    labels = [(i, int(i % 3 == 0), int(i % 5 == 0)) for i, _, _ in rows if i % 2]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    got = fa.audit(docs, label_table(spark, labels))
    assert rows_of(got.select(*SHOWN)) == brute(rows, labels)


def test_awkward_rows(spark):
    rows = [(1, None, "en"), (2, "", None), (3, LONG, ""), (3, LONG, ""), (4, LONG, "en"), (None, LONG, "en"), (None, "once", "de"),
            (None, "Two", "de"), (None, "Two", "de"), (5, "a\x0bb\x1cc d e", "de"), (6, "$", "de"), (6, "%", "de")]
    labels = [(3, 1, 0), (3, 0, 1), (None, 1, 1), (4, None, None), (6, 1, None), (99, 1, 1)]
    got = fa.audit(awkward_docs(spark, rows), label_table(spark, labels))
    assert rows_of(got.select(*SHOWN)) == brute(rows, labels)
    assert rows_of(fa.audit(awkward_docs(spark, []), label_table(spark, []))) == []


def test_two_texts_of_one_hash_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(fa, "text_hash", lambda text: fa.F.length(text).cast("long"))
    rows = [(1, "aa"), (2, "bb"), (3, "aa"), (4, "cc"), (5, "d"), (6, "ee"), (7, "bb"), (8, "d"), (9, "fff")]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, lang string")
    got = {r["doc_id"]: bool(r["mask"] & 16) for r in fa.masks(docs).collect()}
    assert got == {1: False, 2: False, 3: True, 4: False, 5: False, 6: False, 7: True, 8: True, 9: False}


@pytest.mark.parametrize("counters", [1 << 16, 1 << 17])
def test_the_sketch_never_clears_a_repeat(spark, counters):
    r = np.random.default_rng(2)
    once, twice = r.integers(-2**62, 2**62, 30_000), r.integers(-2**62, 2**62, 4_000)
    hashes = spark.createDataFrame([(int(h),) for h in np.r_[once, twice, twice, twice[:50]]], "h long").repartition(6)
    maybe = Counter(x["h"] for x in hashes.filter(fa.may_repeat(hashes, "h", counters)).collect())
    assert all(maybe[int(h)] >= 2 for h in twice)
    assert sum(int(h) not in maybe for h in once) > (0.25 if counters == 1 << 16 else 0.6) * len(once)


def test_sketch_size_is_bounded():
    assert fa.counters_for(0) == 1 << fa.SLICE_BITS
    assert fa.counters_for(10**7) == 1 << 28 and fa.counters_for(10**12) == fa.MAX_COUNTERS
