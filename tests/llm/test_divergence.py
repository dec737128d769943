import re
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from helpers import LONG, awkward_docs, rows_of
from hypothesis import given, settings
from hypothesis import strategies as st

from windlass.llm import divergence as dv


WORD = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least=3, top=200):
    """(lang, source, part, item, value, rank) of (text, lang, source) rows."""
    n, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        words = Counter(WORD.findall((text or "").translate(LOWER)))
        groups.add((lang, source))
        n[lang, source].update(words)
        docs[lang].update(words.keys())
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, k in docs[lang].items() if k >= least]
        sources = [s for g, s in groups if g == lang]

        def ps(count, kept=kept):
            total = sum(count[t] for t in kept)
            return {t: 1 + int(Fraction(10**9 * (count[t] + 1), total + len(kept)) // 1) for t in kept}

        p = {s: ps(n[lang, s]) for s in sources}
        q = ps(sum((n[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = [(sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o) for o in sources if o != s]
            terms = [((p[s][t] - q[t]) ** 2 // q[t], t) for t in kept if n[lang, s][t] and p[s][t] > q[t]]
            for part, items, limit in (("pair", pairs, None), ("term", terms, top)):
                items.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, t, v, k) for k, (v, t) in enumerate(items[:limit], 1)]
    return sorted(out, key=repr)


def corpus(seed, n, vocabulary=60):
    r = np.random.default_rng(seed)
    words = ["".join(r.choice(list("abAbß中é"), r.integers(1, 30))) for _ in range(vocabulary)]
    weight = 1 / np.arange(1, vocabulary + 1)
    weight /= weight.sum()
    return [(" ".join(r.choice(words, r.integers(0, 40), p=weight)) + r.choice(["", "1", "-x", " Ünï"]),
             ["en", "de", None][r.integers(0, 3)], f"s{r.integers(0, 5)}" if k % 3 else "hot") for k in range(n)]


@pytest.mark.parametrize("options", [{}, dict(slice_bytes=50), dict(chunk_terms=7, source_block=2), dict(top_terms=3),
                                     dict(slice_bytes=300, chunk_terms=1, source_block=1, least_docs=1)])
def test_equals_brute_force(spark, options):
    rows = corpus(5, 150)
    docs = spark.createDataFrame(rows, "text string, lang string, source string").repartition(5)
    got = dv.audit(docs, **options).select("lang", "source", "part", "item", "value", "rank")
    assert rows_of(got) == brute(rows, options.get("least_docs", 3), options.get("top_terms", 200))


def test_awkward_rows(spark):
    rows = [(1, None, "en"), (2, "", "en"), (3, LONG, "en"), (3, LONG, "en"), (4, LONG, "en"), (5, "ab CD 12", None),
            (6, "ab", None), (7, "\x00ab", None), (8, "zzé", "xx"), (9, "a" * 20_000, "en")]
    want = brute([(t, lang, "s") for _, t, lang in rows])
    got = dv.audit(awkward_docs(spark, rows), slice_bytes=10_000)
    assert rows_of(got.select("lang", "source", "part", "item", "value", "rank")) == want
    assert rows_of(dv.audit(awkward_docs(spark, []))) == []


def test_a_language_without_kept_terms_has_pairs_of_zero(spark):
    rows = [("ab", "en", "a"), ("cd", "en", "b"), (None, "en", None), ("x", "de", "only")]
    got = dv.audit(spark.createDataFrame(rows, "text string, lang string, source string"))
    assert {(r["source"], r["item"], r["value"]) for r in got.collect()} == {
        (s, o, 0) for s in ("a", "b", "") for o in ("a", "b", "") if s != o}


def test_counts_beyond_a_long_times_scale_are_exact():
    """10^9 (n + 1) past 63 bits, as a common word of a very large corpus has."""
    big = 40_000_000_000
    rows = [("from", "s", None, 0, big + 3), ("to", "t", None, 0, 10), ("from", "s", "w", big, big + 3), ("from", "s", "x", 3, big + 3),
            ("to", "t", "w", 4, 10), ("to", "t", "x", 6, 10)]
    tile = pa.table({"lang": ["en"] * len(rows), "chunk": [0] * len(rows), "side": [r[0] for r in rows], "source": [r[1] for r in rows],
                     "term": [r[2] for r in rows], "n": [r[3] for r in rows], "total": [r[4] for r in rows], "kept": [2] * len(rows)})

    def p(n, total):
        return 1 + 10**9 * (n + 1) // (total + 2)
    want = sum((p(a, big + 3) - p(b, 10)) ** 2 // p(b, 10) for a, b in ((big, 4), (3, 6)))
    assert dv._pair_sums(tile)["value"].to_pylist() == [want]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(st.sampled_from("abAZé中 1_\x00߿"), max_size=40), min_size=1, max_size=6))
def test_pointer_sort_runs_are_words(texts):
    raw = [t.encode() for t in texts]
    data = np.frombuffer(b"".join(raw), np.uint8)
    edges = np.cumsum([0, *[len(t) for t in raw[:-1]]])
    terms, group, n, docs = dv._runs(data, edges, np.zeros(len(raw), np.int64))
    want, in_docs = Counter(), Counter()
    for t in texts:
        words = WORD.findall(t.translate(LOWER))
        want.update(words)
        in_docs.update(set(words))
    assert dict(zip(terms.to_pylist(), n.tolist())) == want
    assert dict(zip(terms.to_pylist(), docs.tolist())) == in_docs
