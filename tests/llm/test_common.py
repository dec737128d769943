from windlass.llm import common, lang_id, packing
from windlass.llm.common import KnownValues, join_small


def test_known_values_are_bounded_and_right():
    calls = []
    known = KnownValues(lambda k: calls.append(k) or k.upper(), entries=8, longest=5)
    words = ["a", "b", "c", "a", "long word", "long word", "d", "e", "a", "f", "g", "h", "i", "a"]
    assert [known[w] for w in words] == [w.upper() for w in words]
    assert len(known) <= 4 and len(known.old) <= 4
    assert calls.count("long word") == 2  # never held
    assert calls.count("a") == 1  # used often, so it goes from generation to generation


def test_join_small_spreads_a_key_beyond_the_small_side(spark, monkeypatch):
    rows = spark.createDataFrame([(i, "hot" if i % 3 else f"k{i}", i) for i in range(300)], "id long, k string, x long")
    few = spark.createDataFrame([("hot", 1), ("k3", 2), ("none", 3)], "k string, y int")
    want = sorted((i, "hot" if i % 3 else f"k{i}", 1 if i % 3 else 2 if i == 3 else None) for i in range(300))
    for limit in (10, 0):
        monkeypatch.setattr(common, "SMALL_SIDE", limit)
        for spread in (None, "id"):
            got = join_small(rows, few, ["k"], spread)
            assert got.columns == ["k", "id", "x", "y"]
            assert sorted((r["id"], r["k"], r["y"]) for r in got.collect()) == want


def test_language_sample_holds_a_hot_row_once(spark, monkeypatch):
    monkeypatch.setattr(lang_id, "SAMPLE_PER_LANGUAGE", 20)
    rows = [(7, "the same text", "en")] * 400 + [(i, f"text {i}", "en") for i in range(300)] + [(i, f"texte {i}", "fr") for i in range(9)]
    train = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(6)
    got = lang_id.training_sample(train).collect()
    by = {lang: [r for r in got if r["lang"] == lang] for lang in ("en", "fr")}
    assert len(by["en"]) == 20 and len(by["fr"]) == 9
    assert len({(r["doc_id"], r["text"]) for r in got}) == len(got)


def test_groups_follow_the_bytes_of_long_documents(spark, monkeypatch):
    import public_tokenizers
    monkeypatch.setattr(packing, "GROUP_BYTES", 2_000)
    docs = spark.createDataFrame([(i, "ab cd " * 200) for i in range(40)], "doc_id long, text string")
    out = packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))
    groups = {r["sequence_id"] >> 32 for r in out.collect()}
    assert len(groups) > 10  # one group for 40 short ones
    assert out.groupBy("doc_id").sum("length").count() == 40


def test_words_go_from_generation_to_generation(monkeypatch):
    import public_tokenizers
    monkeypatch.setattr(packing, "MAX_KNOWN", 12)
    path = public_tokenizers.path("word_bpe_49k.json")
    texts = ["the cat sat", "a dog ran far away today", "the " + "x" * 500, "one two three four five six seven", "the cat sat again", ""]
    tok, plain = packing.WordTokenizer(path), packing.WordTokenizer(path)
    monkeypatch.setattr(packing, "MAX_KNOWN", 10**6)
    want = [plain.encode([t])[0] for t in texts]
    monkeypatch.setattr(packing, "MAX_KNOWN", 12)
    assert [tok.encode([t])[0] for t in texts] == want
    assert all(len(w) <= packing.LONG_WORD for w in (*tok.known, *tok.old))
