import hashlib
import random
from collections import defaultdict

import numpy as np
from helpers import LONG, awkward_docs
from hypothesis import given, settings
from hypothesis import strategies as st

from windlass.llm import exact_dedup as ed


def brute(rows):
    groups = defaultdict(list)
    for i, t, _ in rows:
        groups[t or ""].append(i)
    out, used = [], set()
    for i, t, _ in rows:
        ids = [x for x in groups[t or ""] if x is not None]
        top = max(ids) if ids else None
        kept = i == top and (t or "") not in used
        if kept:
            used.add(t or "")
        out.append((i, top, len(groups[t or ""]), kept, hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=repr)


ROWS = [(1, "a", "en"), (2, "a", None), (3, "A", "en"), (4, None, "en"), (5, "", None), (6, LONG, "en"), (7, LONG, "de"),
        (8, "é", "fr"), (9, "e\u0301", "fr"), (None, "n", None), (None, "n", None), (None, "a", "en"), (12, "r", "en"),
        (12, "r", "en"), (12, "r", "en"), (11, "r", "en"), (13, " a", "en")]


def test_awkward_rows_match_brute_force(spark):
    got = ed.exact_dedup(awkward_docs(spark, ROWS))
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute(ROWS)


def test_empty_table(spark):
    assert ed.exact_dedup(awkward_docs(spark, [])).collect() == []
    assert ed.drop_copies(awkward_docs(spark, [])).count() == 0


def test_hot_copies(spark):
    rows = [(i, f"t{i % 700}" if i % 3 else "hot", "en") for i in range(30_000)]
    got = ed.exact_dedup(awkward_docs(spark, rows)).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows)


def test_drop_copies_keeps_columns_and_one_row_each(spark):
    docs = awkward_docs(spark, ROWS)
    kept = ed.drop_copies(docs)
    assert kept.columns == docs.columns
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr)
    want = [(2, "a"), (3, "A"), (5, ""), (7, LONG), (8, "é"), (9, "e\u0301"), (None, "n"), (12, "r"), (13, " a")]
    assert got == sorted(want, key=repr)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.booleans(), st.integers(0, 60)), max_size=300))
def test_filter_never_loses_a_live_key(ops):
    f, live = ed.CuckooFilter(4), []
    for insert, x in ops:
        h = int.from_bytes(hashlib.sha256(bytes([x])).digest()[:8], "little")
        if insert and len(live) < 10:
            if f.insert(h):
                live.append(h)
            else:
                return  # full: the caller rebuilds
        elif not insert and h in live:
            assert f.delete(h)
            live.remove(h)
        assert not live or f.contains(np.array(live, dtype=np.uint64)).all()
    assert f.size == len(live)


def test_filter_false_hits_are_rare_and_deletion_empties_it():
    r = np.random.default_rng(1)
    h = r.integers(0, 1 << 63, 3000, dtype=np.uint64)
    f = ed.CuckooFilter(1024)
    assert f.insert_many(h) and f.contains(h).all()
    assert f.contains(r.integers(0, 1 << 63, 20_000, dtype=np.uint64)).mean() < 0.01
    for x in h:
        assert f.delete(int(x))
    assert f.size == 0 and not f.table.any()


def frame(keys):
    import pandas as pd
    return pd.DataFrame([(hashlib.sha256(k).digest(), len(k), 0, 1, n, 1) for n, k in enumerate(keys)],
                        columns=["digest", "n_bytes", "xx", "n", "keep_id", "keep_rows"])


def test_overflow_resizes_from_stored_keys():
    index = ed.CuckooIndex(2)
    keys = [str(i).encode() for i in range(500)]
    random.Random(3).shuffle(keys)
    for lo in range(0, 500, 50):
        index.insert_batch(frame(keys[lo:lo + 50]))
    assert index.resizes > 0
    assert sum(len(e) for e in index.store.values()) == 500
    assert index.filter.contains(index.hashes([hashlib.sha256(k).digest() for k in keys])).all()


def test_false_hit_is_settled_by_the_stored_content():
    index = ed.CuckooIndex(2)
    one, two = b"\1" * 32, b"\2" * 24 + b"\1" * 8  # equal filter hashes, different content
    import pandas as pd
    index.insert_batch(pd.DataFrame([(one, 1, 0, 1, 1, 1), (two, 1, 0, 1, 2, 1)],
                                    columns=["digest", "n_bytes", "xx", "n", "keep_id", "keep_rows"]))
    entries = sorted(e[0] for es in index.store.values() for e in es)
    assert entries == sorted([one, two])
    index.delete(one, 1)
    assert [e[0] for es in index.store.values() for e in es] == [two]
    assert index.filter.contains(index.hashes([two])).all()


def test_live_index_insert_and_delete(spark):
    docs = lambda rows: spark.createDataFrame(rows, "doc_id long, text string")
    index = ed.build_index(ed.content_keys(docs([(1, "a"), (2, "a"), (3, "b")])))
    index = ed.update_index(index, inserted=docs([(9, "c"), (10, "a")]), deleted=docs([(3, "b"), (2, "a"), (5, "zz")]))
    got = {bytes(r.digest): r.n for r in index.collect()}
    assert got == {hashlib.sha256(b"a").digest(): 2, hashlib.sha256(b"c").digest(): 1}


def test_deletions_choose_the_kept_document_again(spark):
    docs = lambda rows: spark.createDataFrame(rows, "doc_id long, text string")
    index = ed.build_index(ed.content_keys(docs([(1, "a"), (2, "a"), (3, "b"), (4, "c"), (4, "c"), (7, "c"), (5, "d")])))
    left = docs([(1, "a"), (4, "c"), (4, "c"), (5, "d"), (6, "a")])
    index = ed.update_index(index, inserted=docs([(6, "a"), (8, "a")]),
                            deleted=docs([(2, "a"), (8, "a"), (3, "b"), (7, "c"), (99, "d")]), remaining=left)
    assert sorted(map(tuple, index.collect())) == sorted(map(tuple, ed.build_index(ed.content_keys(left)).collect()))
    got = {bytes(r.digest): (r.n, r.keep_id, r.keep_rows) for r in index.collect()}
    assert got == {hashlib.sha256(k).digest(): v for k, v in ((b"a", (2, 6, 1)), (b"c", (2, 4, 2)), (b"d", (1, 5, 1)))}
