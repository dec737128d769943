import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pytest
from helpers import LONG, awkward_docs
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from windlass.llm import packing as pk

FILE = P.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def reference():
    t = Tokenizer.from_file(FILE)
    t.encode_special_tokens = True
    return lambda text: t.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=" \n\t'steáèÉß日ΣÀ×÷1234.,!?<|>\x85\xa0abcdefghABC%$&*", max_size=60) | st.text(max_size=30))
def test_ids_equal_the_tokenizer(reference, text):
    tok = pk.word_tokenizer(FILE)
    assert np.frombuffer(tok.encode([text])[0], tok.dtype).tolist() == reference(text)


def test_words_of_real_texts(spark, reference):
    tok = pk.word_tokenizer(FILE)
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    for text, raw in zip(texts, tok.encode(texts), strict=True):
        assert np.frombuffer(raw, tok.dtype).tolist() == reference(text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=60))
def test_tree_places_as_plain_first_fit_decreasing(sizes):
    room, bins, want = 20, [], [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        at = next((b for b, used in enumerate(bins) if used + sizes[i] <= room), len(bins))
        if at == len(bins):
            bins.append(0)
        bins[at] += sizes[i]
        want[i] = at
    assert pk.first_fit_decreasing(sizes, room) == want


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 300), max_size=40))
def test_group_holds_every_token_once_without_padding(lengths):
    sequences = pk.pack_group(lengths, 64)
    seen = defaultdict(list)
    for seq in sequences:
        size = sum(p[2] for p in seq)
        assert size == 64 or size & (size - 1) == 0
        for i, start, n in seq:
            assert n > 0
            seen[i].append((start, n))
    for i, n in enumerate(lengths):
        at = 0
        for start, size in sorted(seen[i]):
            assert start == at
            at += size
        assert at == n


def test_frame_round_trip(spark, reference):
    r = random.Random(1)
    words = "the of then thing erin other 2024 é, über".split()
    rows = [(i, " ".join(r.choices(words, k=r.choice([1, 5, 300, 3000]))), "en") for i in range(60)]
    rows += [(100, None, None), (101, "", None), (None, "x y", None), (102, LONG, "en")]
    out = pk.pack_documents(awkward_docs(spark, rows), FILE, group_docs=20).collect()
    of, sequences = {i: [*reference(t or ""), 1] for i, t, _ in rows}, defaultdict(list)
    pieces = defaultdict(list)
    for p in out:
        assert p.doc_tokens == len(of[p.doc_id])
        part = of[p.doc_id][p.start:p.start + p.length]
        assert len(part) == p.length and p.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())
        pieces[p.doc_id].append((p.start, p.length))
        sequences[p.sequence_id].append((p.offset, p.length, p.padded_length))
    assert set(pieces) == set(of)
    for i, found in pieces.items():
        assert [s for s, _ in sorted(found)] == [sum(n for _, n in sorted(found)[:k]) for k in range(len(found))]
        assert sum(n for _, n in found) == len(of[i])
    for found in sequences.values():
        found.sort()
        assert [o for o, _, _ in found] == [sum(n for _, n, _ in found[:k]) for k in range(len(found))]
        used = sum(n for _, n, _ in found)
        assert used <= 2048 and found[0][2] == used  # nothing is padded


def test_repeated_rows_are_packed_each(spark):
    out = pk.pack_documents(awkward_docs(spark, [(1, "a b c", "en")] * 5), FILE).collect()
    assert sum(p.length for p in out) == 5 * 4
    assert pk.pack_documents(awkward_docs(spark, []), FILE).count() == 0
