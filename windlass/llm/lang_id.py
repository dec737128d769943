"""Language identification by the nearest of several centroids per language.

A text becomes a vector of hashed letter trigrams (over its lower-cased UTF-8
bytes, non-letters of ASCII as blanks), weighted by TF-IDF and scaled to length
one. Document frequencies come from all training documents. Each language's
centroids are found by spherical k-means over a bounded sample of its training
documents (``SAMPLE_PER_LANGUAGE``, by hash of the id), in one task per
language. A text gets the language of the centroid with the largest cosine.

Rejection by distance: among all training documents rightly predicted as a
language and of a length class, a low quantile of the cosine is the edge; a text
whose cosine is below it lies too far from every centroid and is marked
rejected, as are texts without a letter. Every language and length class has an
edge: a thin class takes in the lengths next to it, then the other languages.

Texts are read where they are scored and never shuffled; what moves are
counts per feature, the sample's vectors and one row of numbers per document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from windlass.llm.common import join_small, unwrapped, wrapped, write_table

FEATURES = 4096
SAMPLE_PER_LANGUAGE = 600
CENTROIDS = 4
EDGE = 0.001  # quantile of the cosine among training documents
LEAST_TRAINED = 30  # training documents that an edge needs; thin classes are pooled
LONGEST = 12  # the last length class: log2 of the number of trigrams
NEAR = 2  # length classes to either side that a thin class takes in before other languages
STEPS = 1000  # cosines are counted in steps of 1 / STEPS

_BLANK = bytes(b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def trigram_counts(text: str) -> np.ndarray:
    """Counts of hashed trigrams with at least one letter; the text is framed by blanks."""
    raw = np.frombuffer(b" " + text.lower().encode().translate(_BLANK) + b" ", dtype=np.uint8).astype(np.uint32)
    if len(raw) < 3:
        return np.zeros(FEATURES)
    code = (raw[:-2] << np.uint32(16)) | (raw[1:-1] << np.uint32(8)) | raw[2:]
    code = code[code != 0x202020]
    return np.bincount((code * np.uint32(2654435761)) >> np.uint32(20), minlength=FEATURES).astype(np.float64)


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF rows of length one (all zero stays)."""
    v = np.log1p(counts) * idf
    norm = np.sqrt((v * v).sum(axis=1, keepdims=True))
    return (v / np.where(norm > 0, norm, 1)).astype(np.float32)


def spherical_k_means(x: np.ndarray, k: int, rounds: int = 10) -> np.ndarray:
    """Unit centroids by cosine; fewer than ``k`` if there are fewer rows."""
    k = min(k, len(x))
    c = x[np.linspace(0, len(x) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        own = (x @ c.T).argmax(axis=1)
        for j in range(k):
            if (own == j).any():
                total = x[own == j].sum(axis=0)
                c[j] = total / max(float(np.sqrt((total * total).sum())), 1e-12)
    return c


def training_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                  held_out: int = 2) -> DataFrame:
    """(doc_id, text, lang, held_out): held out is crc32 of the id as text, modulo 4, equal to ``held_out``."""
    ident = F.col(id_col).cast("long")
    return docs.select(ident.alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                       F.col(lang_col).cast("string").alias("lang"),
                       F.coalesce(F.crc32(ident.cast("string")) % 4 == held_out, F.lit(False)).alias("held_out"))


def document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """Documents that hold each feature, and documents, over all rows (column text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, n = np.zeros(FEATURES, dtype=np.int64), 0
        for b in batches:
            for text in b.column(0):
                found += trigram_counts(text.as_py()) > 0
                n += 1
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, FEATURES)), pa.array(np.r_[n, found])],
                                             names=["feature", "n"])

    total = np.zeros(FEATURES + 1, dtype=np.int64)
    for r in texts.mapInArrow(run, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n")).collect():
        total[r["feature"] + 1] = r["n"]
    return total[1:], int(total[0])


class Centroids:
    """Unit centroids with their languages, in order of language, and the feature weights."""

    def __init__(self, langs: list[str], matrix: np.ndarray, idf: np.ndarray):
        self.langs, self.matrix, self.idf = langs, matrix, idf

    def predict(self, counts: np.ndarray) -> tuple[list[str], np.ndarray]:
        """Language and cosine (0 to 1) of each row of counts; ties to the first language."""
        cos = np.clip(weighted(counts, self.idf) @ self.matrix.T, 0.0, 1.0)
        best = cos.argmax(axis=1)
        return [self.langs[k] for k in best], cos[np.arange(len(best)), best].astype(np.float64)


def training_sample(train: DataFrame) -> DataFrame:
    """(doc_id, lang, text): up to ``SAMPLE_PER_LANGUAGE`` different rows of each language, those
    of the smallest hashes. A bound on the hash, from the language's estimated number of
    different rows, leaves about twice as many before any row is shuffled, and equal
    rows are combined first, so no task sees more of a language or of a repeated row."""
    rows = train.select("doc_id", "lang", "text", F.xxhash64("doc_id", "text").alias("h"))
    share = rows.groupBy("lang").agg(
        (F.lit(2.0 * SAMPLE_PER_LANGUAGE) / F.greatest(F.approx_count_distinct("h", 0.02), F.lit(1))).alias("share"))
    place = F.pmod("h", F.lit(1 << 40)) / F.lit(float(1 << 40))
    some = join_small(rows, share, ["lang"]).filter((F.col("share") > 0.5) | (place < F.col("share")))
    once = some.groupBy("lang", "doc_id", "h").agg(F.first("text").alias("text"))
    order = Window.partitionBy("lang").orderBy(F.pmod("h", F.lit(1 << 40)), "h", "doc_id")
    return once.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= SAMPLE_PER_LANGUAGE).select(
        "doc_id", "lang", "text")


def fit(rows: DataFrame) -> Centroids | None:
    """Centroids from ``training_rows``; None if no row has a language and a letter."""
    train = rows.filter(~F.col("held_out") & F.col("lang").isNotNull() & F.col("text").isNotNull())
    found, n = document_frequencies(train.select("text"))
    if not n:
        return None
    idf = np.log((1 + n) / (1 + found)) + 1
    sample = training_sample(train)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 500):
                part = b.slice(lo, 500)
                x = weighted(np.stack([trigram_counts(t) for t in part.column(2).to_pylist()]), idf)
                some = x.any(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array([v.tobytes() for v in x], pa.binary())],
                    names=["doc_id", "lang", "v"]).filter(pa.array(some))

    def cluster(df: pd.DataFrame) -> pd.DataFrame:
        df = df.sort_values(["doc_id", "v"]).drop_duplicates(["doc_id", "v"]).head(SAMPLE_PER_LANGUAGE)
        x = np.stack([np.frombuffer(v, dtype=np.float32) for v in df["v"]])
        c = spherical_k_means(x, CENTROIDS)
        return pd.DataFrame({"lang": df["lang"].iloc[0], "k": np.arange(len(c)), "c": [v.tobytes() for v in c]})

    learned = (sample.mapInArrow(vectors, "doc_id long, lang string, v binary").groupBy("lang")
               .applyInPandas(cluster, "lang string, k int, c binary").orderBy("lang", "k").collect())
    if not learned:
        return None
    return Centroids([r["lang"] for r in learned],
                     np.stack([np.frombuffer(r["c"], dtype=np.float32) for r in learned]), idf)


def predict(rows: DataFrame, centroids: Centroids | None) -> DataFrame:
    """``rows``, whose last column is the text, with lang_pred, score and n_grams in its
    place; ``und`` without a letter or a model."""
    fields = rows.schema.fields[:-1]
    names = [*rows.columns[:-1], "lang_pred", "score", "n_grams"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 500):
                part = b.slice(lo, 500)
                texts = part.column(b.num_columns - 1).to_pylist()
                counts = np.stack([trigram_counts(t) if t else np.zeros(FEATURES) for t in texts])
                if centroids is None:
                    langs, scores = ["und"] * len(texts), np.zeros(len(texts))
                else:
                    langs, scores = centroids.predict(counts)
                for k, t in enumerate(texts):
                    if not t or not has_letter(t):
                        langs[k], scores[k] = "und", 0.0
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array(langs), pa.array(scores),
                     pa.array(counts.sum(axis=1).astype(np.int64))], names=names)

    schema = T.StructType([*fields, T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType()), T.StructField("n_grams", T.LongType())])
    return rows.mapInArrow(run, schema).withColumn("size", F.least(F.floor(F.log2(F.col("n_grams") + 1)).cast("int"),
                                                                   F.lit(LONGEST)))


def edge_of(counts: np.ndarray) -> float:
    """The lower end of the step that holds the ``EDGE`` quantile."""
    return int(np.searchsorted(np.cumsum(counts), max(EDGE * counts.sum(), 1))) / STEPS


def pooled(counts: dict[str, np.ndarray], lang: str, size: int) -> np.ndarray | None:
    """Cosine counts that a class takes its edge from: its own language's of the nearest
    lengths, at most ``NEAR`` away, else those of all languages; None without any."""
    every = sum(counts.values())
    own = [(counts[lang], w) for w in range(NEAR + 1)] if lang in counts else []
    for of, w in own + [(every, w) for w in range(LONGEST + 1)]:
        found = of[max(size - w, 0):size + w + 1].sum(axis=0)
        if found.sum() >= LEAST_TRAINED:
            return found
    return every.sum(axis=0) if every.any() else None


def edges(scored: DataFrame, centroids: Centroids | None) -> DataFrame:
    """(lang_pred, size, edge) of every learned language and length class: the cosine below
    which a text is too far, from all training rows whose language is predicted."""
    known = scored.filter(~F.col("held_out") & (F.col("lang") == F.col("lang_pred")))
    step = F.floor(F.col("score") * STEPS).cast("int").alias("step")
    counts: dict[str, np.ndarray] = {}
    # at most STEPS + 1 rows of each language and length class, whatever the number of documents
    for r in known.groupBy("lang_pred", "size", step).agg(F.count(F.lit(1)).alias("n")).collect():
        of = counts.setdefault(r["lang_pred"], np.zeros((LONGEST + 1, STEPS + 1), dtype=np.int64))
        of[r["size"], r["step"]] = r["n"]
    rows = [(lang, size, edge_of(pooled(counts, lang, size)))
            for lang in sorted(set(centroids.langs)) for size in range(LONGEST + 1)] if counts else []
    return scored.sparkSession.createDataFrame(rows, "lang_pred string, size int, edge double")


def judged(scored: DataFrame, limits: DataFrame) -> DataFrame:
    """``scored`` with the column rejected; the limits are a few rows per language. What has no edge is rejected."""
    far = F.coalesce(F.col("score") < F.col("edge"), F.lit(True))
    return join_small(scored, limits, ["lang_pred", "size"]).withColumn("rejected", far | (F.col("lang_pred") == "und"))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score, rejected.

    Learns from the rows that are not held out and have a language; language,
    source and id are no inputs of a prediction. Null, empty and letterless texts
    are ``und`` with score 0 and rejected, as is everything if nothing could be
    learned. Ties go to the language first in order. Null ids are never held out;
    repeated rows are predicted each; other columns are not read; an empty table
    gives no rows.
    """
    scored, centroids = _scored(docs, id_col, text_col, lang_col)
    return judged(scored, edges(scored, centroids)).select("doc_id", "held_out", "lang_pred", "score", "rejected")


def _scored(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> tuple[DataFrame, Centroids | None]:
    rows = training_rows(docs, id_col, text_col, lang_col)
    centroids = fit(rows)
    return write_table(predict(rows.select("doc_id", "held_out", "lang", "text"), centroids), "lang-scores"), centroids


def keep_known(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs``, all columns, that :func:`identify` doesn't reject. Texts are
    judged again on the way through instead of being joined with the verdicts."""
    scored, centroids = _scored(docs, id_col, text_col, lang_col)
    rows = predict(wrapped(docs, text=F.col(text_col).cast("string")), centroids)
    return unwrapped(judged(rows, edges(scored, centroids)).filter("not rejected"))
