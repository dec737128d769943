import random
import re

import numpy as np
import xxhash
from helpers import LONG, awkward_docs
from hypothesis import given, settings
from hypothesis import strategies as st

from windlass.llm import simhash as sh
from windlass.llm.components import components


def brute_print(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    parts = [" ".join(words[i:i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(prints):
    """prints: (id, fp) with ids that compare; smallest reachable id of each row."""
    parent = {}

    def top(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, fa in prints:
        for b, fb in prints:
            if (fa ^ fb).bit_count() <= sh.MAX_BITS and top(a) != top(b):
                p, q = top(a), top(b)
                parent[max(p, q)] = min(p, q)
    return {i: top(i) for i, _ in prints}


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="aAéÉ b\n\t\x0b\x1c\x85\xa0.,", max_size=60))
def test_fingerprint_matches_definition(text):
    assert sh.fingerprint(text.encode()) == brute_print(text)


def test_long_and_empty_texts():
    assert sh.fingerprint(b"") == sh.fingerprint(b" \n ") == 0
    assert sh.fingerprint(LONG[:60_000].encode()) == brute_print(LONG[:60_000])


def near_prints(n, seed):
    """Random fingerprints with chains and clusters of near ones."""
    r = random.Random(seed)
    out = {r.getrandbits(64) for _ in range(n)}
    for x in list(out)[:n // 4]:
        for _ in range(r.randint(1, 6)):
            for b in r.sample(range(64), r.randint(1, 5)):
                x ^= 1 << b
            out.add(x)
    return sorted(out)


def linked(spark, prints, **options):
    signed = np.array(prints, dtype=np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    links = [(np.array([r.a, r.b], dtype=np.int64).view(np.uint64).tolist()) for r in sh.link_fingerprints(df, len(prints), **options).collect()]
    assert all((a ^ b).bit_count() <= sh.MAX_BITS for a, b in links)
    parent = {}

    def top(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        p, q = top(a), top(b)
        if p != q:
            parent[max(p, q)] = min(p, q)
    return {x: top(x) for x in prints}


def test_links_connect_what_brute_force_connects(spark):
    prints = near_prints(400, 1)
    assert linked(spark, prints) == brute_components([(x, x) for x in prints])


def test_hot_bucket_is_cut_into_tiles(spark):
    r = random.Random(5)
    base = r.getrandbits(64)
    prints = sorted({base ^ sum(1 << b for b in r.sample(range(64), r.randint(0, 6))) for _ in range(500)} | set(near_prints(60, 2)))
    want = brute_components([(x, x) for x in prints])
    assert linked(spark, prints, max_bucket=40, tile=25) == want
    assert linked(spark, prints) == want


def test_forest_gives_fewer_links_than_rows():
    prints = np.array(near_prints(300, 3), dtype=np.uint64)
    links = sh.forest(prints, sh.MAX_BITS)
    assert len(links) < len(prints)
    kept = sh.forest(np.zeros(1, np.uint64), 4)
    assert kept == []


@settings(max_examples=50, deadline=None)
@given(st.lists(st.tuples(st.integers(0, (1 << 64) - 1), st.integers(0, (1 << 64) - 1)), min_size=1, max_size=30))
def test_pivots_discard_no_linked_pair(pairs):
    flat = np.array([x for p in pairs for x in p], dtype=np.uint64)
    a, b = np.arange(0, len(flat), 2), np.arange(1, len(flat), 2)
    got = set(sh.near(flat, sh.pivot_table(flat), a, b, 4).tolist())
    assert got == {k for k, (x, y) in enumerate(pairs) if (x ^ y).bit_count() <= 4}


def test_block_choices_cover_every_linked_pair():
    r = random.Random(9)
    for rows in (10, 10 ** 6, 10 ** 9):
        choices = sh.block_choices(rows, 4)
        for _ in range(300):
            x = sum(1 << b for b in r.sample(range(64), 4))
            assert any(all((x >> shift) & ((1 << size) - 1) == 0 for shift, size in c) for c in choices)


def test_components_of_chains_and_hubs(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + k) for k in range(1, 60)] + [(300, 299), (299, 300), (7, 7)]
    got = {r.src: r.dst for r in components(spark.createDataFrame(links, "src long, dst long")).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, **{100 + k: 100 for k in range(1, 60)}, 300: 299}
    assert components(spark.createDataFrame([], "src long, dst long")).count() == 0


TEXT = " ".join(f"w{i * i % 97}x{i}" for i in range(400))
ROWS = [(5, TEXT, "en"), (3, TEXT.upper(), "en"), (9, TEXT.replace("w1x1 ", ""), "en"), (9, TEXT.replace("w1x1 ", ""), "en"),
        (12, None, None), (11, " \n", None), (20, "one two", "en"), (21, "ONE\ttwo", "en"), (30, LONG[:50_000], "en"), (None, TEXT, "en"),
        (None, "only null id here, far from the rest", "en")]


def test_frame(spark):
    got = sh.near_dedup(awkward_docs(spark, ROWS))
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    last = sh.LAST_ID
    keyed = [((last if i is None else i, k), brute_print(t)) for k, (i, t, _) in enumerate(ROWS)]  # each row by itself
    want = brute_components(keyed)
    rows = sorted(((ROWS[k[1]][0], f"{fp:016x}", None if want[k][0] == last else want[k][0]) for k, fp in keyed), key=repr)
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in got.collect()), key=repr) == rows
    assert sh.near_dedup(awkward_docs(spark, [])).count() == 0
    kept = sorted((r.doc_id for r in sh.drop_near_copies(awkward_docs(spark, ROWS)).collect()), key=repr)
    assert kept == sorted({(want[k][0], want[k]): ROWS[want[k][1]][0] for k, _ in keyed}.values(), key=repr)


def test_query_on_a_fixture_matches_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    prints = [(r.doc_id, brute_print(r.text)) for r in rows]
    want = brute_components(prints)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in sh.near_dedup(docs).collect()}
    assert got == {i: (f"{fp:016x}", want[i]) for i, fp in prints}
    kept = sh.drop_near_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(want.values()))
