import hashlib
import random
import struct

import public_tokenizers as P
import pytest
import tiktoken
from helpers import LONG, awkward_docs
from hypothesis import given, settings
from hypothesis import strategies as st

from windlass.llm import bpe

FILE = P.path("byte_bpe_multi_50k.tiktoken")
LETTERS = " \n\t'sdtreaèüß日本1234567.,!?́\U0001f600\x1c\x85\xa0abcdefgh ABCäöñ"


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.load_ranks(FILE), special_tokens={})


def ids(raw):
    return list(struct.unpack(f"<{len(raw) // 4}I", raw))


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=LETTERS, max_size=60) | st.text(max_size=30))
def test_text_ids_equal_tiktoken(reference, text):
    enc = bpe.text_encoder(FILE, P.PATTERN)
    assert ids(enc.encode(text)) == reference.encode_ordinary(text)


def test_last_tokens_describe_every_prefix(reference):
    enc = bpe.text_encoder(FILE, P.PATTERN).encoder
    for word in (b"thentioner", "équement".encode(), b"aaaaaaaaaaaaaaaa", b" 20231224"):
        table = enc.extend(word, [])
        for end in range(1, len(word) + 1):
            assert enc.read_off(table[:end]) == enc.merge(word[:end])


def test_may_follow_is_what_merging_both_gives():
    enc = bpe.text_encoder(FILE, P.PATTERN).encoder
    r = random.Random(2)
    tokens = [i for i in range(256, 50_000) if enc.stands_alone(i)]
    for _ in range(3000):
        a, b = r.choice(tokens), r.choice(tokens)
        assert enc.may_follow(a, b) == (enc.merge(enc.bytes_of[a] + enc.bytes_of[b]) == [a, b])


def test_appends_and_edits(reference):
    enc = bpe.text_encoder(FILE, P.PATTERN).encoder
    r = random.Random(4)
    for _ in range(150):
        text, it = "", bpe.IncrementalText(enc, P.PATTERN)
        for _ in range(8):
            more = "".join(r.choice(LETTERS) for _ in range(r.randint(0, 12)))
            at = r.randint(0, len(text))
            gone = r.randint(0, len(text) - at)
            if r.random() < 0.3:
                text += more
                it.append(more)
            else:
                text = text[:at] + more + text[at + gone:]
                it.replace(at, gone, more)
            assert it.text == text and it.ids() == reference.encode_ordinary(text)


def test_full_tables_change_nothing(reference, monkeypatch):
    monkeypatch.setattr(bpe, "MAX_KNOWN", 3)
    enc = bpe.TextEncoder(bpe.load_ranks(FILE), P.PATTERN)
    for text in ("the quick brown fox jumps over it", "le petit prince est ici, la nuit"):
        assert ids(enc.encode(text)) == reference.encode_ordinary(text)


def test_frame(spark, reference):
    rows = [(1, "Hello world, été!", "en"), (1, "Hello world, été!", "en"), (2, None, None), (None, "", "x"), (5, LONG, "en")]
    out = bpe.encode_decode(awkward_docs(spark, rows), FILE, P.PATTERN, with_ids=True)
    got = sorted(((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256, r.ids, bytes(r.decoded)) for r in out.collect()), key=repr)
    want = []
    for i, t, _ in rows:
        x, raw = reference.encode_ordinary(t or ""), (t or "").encode()
        want.append((i, len(x), hashlib.sha256(struct.pack(f"<{len(x)}I", *x)).hexdigest(), hashlib.sha256(raw).hexdigest(), x, raw))
    assert got == sorted(want, key=repr)
    assert bpe.encode_decode(awkward_docs(spark, []), FILE, P.PATTERN).count() == 0
