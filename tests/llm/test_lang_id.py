import zlib

import numpy as np
from helpers import LONG, awkward_docs

from windlass.llm import lang_id as li


def brute_counts(text):
    raw = b" " + bytes(b if 97 <= b <= 122 or b >= 128 else 32 for b in text.lower().encode()) + b" "
    out = np.zeros(li.FEATURES)
    for i in range(len(raw) - 2):
        if raw[i:i + 3] != b"   ":
            code = raw[i] << 16 | raw[i + 1] << 8 | raw[i + 2]
            out[(code * 2654435761 & 0xFFFFFFFF) >> 20] += 1
    return out


def test_trigrams_match_definition():
    for text in ("", "a", "Hello, world!  x", "ÉTÉ à la mer 12", "日本"):
        assert (li.trigram_counts(text) == brute_counts(text)).all()


def test_weighted_vectors_have_length_one():
    v = li.weighted(np.stack([brute_counts("some text"), np.zeros(li.FEATURES)]), np.ones(li.FEATURES))
    assert np.allclose((v * v).sum(1), [1, 0])


def test_centroids_are_unit_and_few():
    x = li.weighted(np.stack([brute_counts(t) for t in ("aa bb", "aa bc", "xx yy", "xx yz")]), np.ones(li.FEATURES))
    c = li.spherical_k_means(x, 4)
    assert c.shape[0] == 4 and np.allclose((c * c).sum(1), 1)
    assert li.spherical_k_means(x[:1], 4).shape[0] == 1


def test_held_out_accuracy_on_the_test_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = li.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in out if r.held_out]
    assert {r.doc_id for r in held} == {r.doc_id for r in out if zlib.crc32(str(r.doc_id).encode()) % 4 == 2}
    assert np.mean([r.lang == r.lang_pred for r in held]) >= 0.99
    assert np.mean([r.rejected for r in out]) <= 0.01
    assert all(0 <= r.score <= 1 for r in out)


def test_language_is_no_input_of_a_prediction(spark):
    rows = [(i, f"the river and the house {i} of the town" if i % 2 else f"der fluss und das haus {i} in der stadt",
             "en" if i % 2 else "de") for i in range(80)]
    held = [i for i in range(80) if zlib.crc32(str(i).encode()) % 4 == 2]
    lied = [(i, t, "xx" if i in held else lang) for i, t, lang in rows]
    one = {r.doc_id: (r.lang_pred, r.score) for r in li.identify(awkward_docs(spark, rows)).collect()}
    two = {r.doc_id: (r.lang_pred, r.score) for r in li.identify(awkward_docs(spark, lied)).collect()}
    assert one == two and all(one[i][0] == lang for i, _, lang in rows)


def test_awkward_rows(spark):
    base = [(i, "the river and the house of the town is old", "en") for i in range(40)]
    rows = base + [(100, None, "en"), (101, "", "en"), (102, "12 !? %", None), (103, "é", None), (104, LONG, None), (None, "the town", "en"),
                   (100, None, "en"), (105, "日本語", None)]
    docs = awkward_docs(spark, rows)
    out = li.identify(docs)
    assert out.columns == ["doc_id", "held_out", "lang_pred", "score", "rejected"]
    got = out.collect()
    assert len(got) == len(rows)
    und = [r for r in got if r.lang_pred == "und"]
    assert sorted(r.doc_id for r in und) == [100, 100, 101, 102] and all(r.score == 0 and r.rejected for r in und)
    assert not any(r.rejected for r in got if r.doc_id is not None and r.doc_id < 40)
    kept = li.keep_known(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted((r.doc_id for r in got if not r.rejected), key=repr)


FOREIGN = ["Москва является столицей России и крупнейшим городом страны. ", "東京は日本の首都であり、世界で最も人口の多い都市の一つです。",
           "Helsinki on Suomen pääkaupunki ja maan suurin kaupunki, joka sijaitsee Suomenlahden rannalla. ",
           "Amsterdam is de hoofdstad van Nederland en een van de grootste steden van het land. ",
           "Warszawa jest stolicą Polski i największym miastem kraju, położonym nad Wisłą. ",
           "Lisboa é a capital de Portugal e a maior cidade do país, situada na foz do rio Tejo. ",
           "Roma è la capitale d'Italia e la città più popolosa del paese, situata sul fiume Tevere. "]


def test_texts_of_unlearned_languages_are_rejected(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text", "lang")
    texts = [t * k for t in FOREIGN for k in (1, 3, 30)] + [t[:12] for t in FOREIGN[:5]]
    more = spark.createDataFrame([(-1 - i, t, None) for i, t in enumerate(texts)], docs.schema)
    got = li.identify(docs.unionByName(more)).select("doc_id", "rejected").collect()
    assert [texts[-1 - r.doc_id] for r in got if r.doc_id < 0 and not r.rejected] == []
    assert 0 < sum(r.rejected for r in got if r.doc_id >= 0) <= 0.005 * docs.count()


def test_every_class_has_an_edge():
    counts = {k: np.zeros((li.LONGEST + 1, li.STEPS + 1), dtype=int) for k in ("de", "en", "fr")}
    counts["en"][5, 300], counts["en"][9, 700], counts["de"][4, 250], counts["de"][6, 400] = 50, 50, 1, 40
    edge = lambda lang, size: li.edge_of(li.pooled(counts, lang, size))
    assert edge("en", 5) == 0.3 and edge("en", 9) == 0.7  # own
    assert edge("de", 4) == 0.25 and edge("de", 8) == 0.4  # the lengths next to it
    assert edge("fr", 5) == 0.3 and edge("fr", 12) == 0.7 and edge("xx", 6) == 0.4  # other languages
    assert li.edge_of(li.pooled({"en": counts["en"] // 50}, "de", 0)) == 0.3  # too few in all


def test_nothing_to_learn_from(spark):
    assert li.identify(awkward_docs(spark, [])).count() == 0
    got = li.identify(awkward_docs(spark, [(1, "text", None), (2, None, "en")])).collect()
    assert {(r.lang_pred, r.score, r.rejected) for r in got} == {("und", 0.0, True)}
