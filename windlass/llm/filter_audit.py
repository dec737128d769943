"""Filter interaction audit: what each of five filters removes in every order of them.

A document's failures are a mask of five bits, so all 120 orders follow from the
counts of the 32 masks per part, which add up over any split of the data. Four
bits need the document alone. The fifth, "identical to a smaller id's text",
needs the whole table, and a counting-Bloom prepass keeps most texts out of that:

1. every task counts the hashes of its texts in a sketch of 2-bit counters (0, 1,
   2 or more; ``PROBES`` of them per text) and emits the counters it touched; they
   are added up slice by slice;
2. a text with a counter of 1 is the only one of its hash, so it is unique and
   clear; no text that repeats can look so;
3. only the others are shuffled whole, combined before the shuffle, for the smallest
   id of each full text; these ids go back to the rows by hash (by full text where
   two texts share a hash).

The sketch has about ``COUNTERS_PER_TEXT`` counters per text, up to ``MAX_COUNTERS``
(64 MB); it is the only thing broadcast whatever the input. Beyond that many texts
it clears fewer of them and more are shuffled; the result is the same.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from windlass.llm.common import join_small, write_table

# fixed values of the audit: the filters and their limits
FILTERS = "ABCDE"
LEAST_WORDS = 200
DISTINCT_PERCENT = 50
CAPITAL_PERCENT = 3
SYMBOLS = "[#$%&*|]"

PROBES = 4
COUNTERS_PER_TEXT = 16
SLICE_BITS = 16  # 65,536 counters a slice, 16 KB
MAX_COUNTERS = 1 << 28
FLUSH = 1 << 20  # counters touched that a task holds before it emits them


def own_failures(text: Column) -> Column:
    """Bits 1, 2, 4, 8 for the conditions A to D on a text."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    plain = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "")
    capitals = F.length(text) - F.length(plain)
    return (F.when(F.size(words) < LEAST_WORDS, 1).otherwise(0)
            + F.when(100 * F.size(F.array_distinct(words)) < DISTINCT_PERCENT * F.size(words), 2).otherwise(0)
            + F.when(F.lit(100).cast("long") * capitals > F.lit(CAPITAL_PERCENT).cast("long") * F.length(text), 4).otherwise(0)
            + F.when(text.rlike(SYMBOLS), 8).otherwise(0)).cast("int")


def text_hash(text: Column) -> Column:
    return F.xxhash64(text)


def probes(hashes: np.ndarray, counters: int) -> np.ndarray:
    """(PROBES x texts) counters of a 64-bit hash; ``counters`` is a power of two."""
    h = hashes.view(np.uint64)
    step = (h >> np.uint64(32)) | np.uint64(1)
    return np.stack([(h + np.uint64(k) * step) & np.uint64(counters - 1) for k in range(PROBES)]).astype(np.int64)


def _touched(counters: int):
    """mapInArrow body: hashes -> (slice, counters touched once, counters touched again)."""

    def emit(rows: list[np.ndarray]) -> pa.RecordBatch:
        # probes of one text may meet: a counter counts texts, so once per text
        at, n = np.unique(np.concatenate(rows), return_counts=True)
        part = at >> SLICE_BITS
        starts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
        ends = np.r_[starts[1:], len(at)]
        inner = (at & ((1 << SLICE_BITS) - 1)).astype(np.uint16)
        more = n > 1
        return pa.RecordBatch.from_arrays(
            [pa.array(part[starts], pa.int64()),
             pa.array([inner[a:b][~more[a:b]].tobytes() for a, b in zip(starts, ends)], pa.binary()),
             pa.array([inner[a:b][more[a:b]].tobytes() for a, b in zip(starts, ends)], pa.binary())],
            names=["slice", "once", "again"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for rb in batches:
            if not rb.num_rows:
                continue
            at = np.sort(probes(rb.column(0).to_numpy(), counters), axis=0)
            own = np.ones(at.shape, bool)
            own[1:] = at[1:] != at[:-1]
            held.append(at[own])
            size += len(held[-1])
            if size >= FLUSH:
                yield emit(held)
                held, size = [], 0
        if held:
            yield emit(held)

    return run


def _merge(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One slice added up: per counter the bits 'some' and 'more than one'."""
    some, more = (np.zeros(1 << SLICE_BITS, bool) for _ in range(2))
    for rb in batches:
        for once, again in zip(rb.column("once"), rb.column("again")):
            a, b = (np.frombuffer(x.as_buffer(), np.uint16) for x in (once, again))
            more[a] |= some[a]
            some[a] = True
            some[b] = more[b] = True
    yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int64()),
                                      pa.array([np.packbits(some & ~more).tobytes()], pa.binary())], names=["slice", "single"])


def counting_sketch(hashes: DataFrame, counters: int) -> DataFrame:
    """(slice, single): of the merged sketch, the counters that exactly one text touched."""
    touched = hashes.mapInArrow(_touched(counters), "slice long, once binary, again binary")
    return touched.groupBy("slice").applyInArrow(_merge, "slice long, single binary")


def counters_for(texts: int) -> int:
    """The power of two that gives each text ``COUNTERS_PER_TEXT`` counters, within the bounds."""
    wanted = max(texts * COUNTERS_PER_TEXT, 1 << SLICE_BITS)
    return min(1 << math.ceil(math.log2(wanted)), MAX_COUNTERS)


def may_repeat(rows: DataFrame, hashes: str, counters: int):
    """Column: whether a row's text may occur again. False is certain."""
    spark = rows.sparkSession
    sketch = write_table(counting_sketch(rows.select(hashes), counters), "audit-sketch").toArrow()
    single = np.zeros(counters // 8, np.uint8)
    for part, bits in zip(sketch["slice"].to_pylist(), sketch["single"]):
        at = part << SLICE_BITS >> 3
        single[at:at + (1 << SLICE_BITS >> 3)] = np.frombuffer(bits.as_buffer(), np.uint8)
    shared = spark.sparkContext.broadcast(single)

    @F.pandas_udf("boolean")
    def maybe(h: pd.Series) -> pd.Series:
        at = probes(h.to_numpy(), counters)
        alone = (shared.value[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1
        return pd.Series(~alone.any(axis=0))

    return maybe(F.col(hashes))


def first_ids(maybe: DataFrame) -> DataFrame:
    """Of ``maybe`` (doc_id, h, text; every row that may repeat): per hash (h, texts, first,
    n), its different full texts, their smallest id and rows, where there is more than one row."""
    exact = maybe.groupBy("h", "text").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n"))
    return (exact.groupBy("h").agg(F.count(F.lit(1)).alias("texts"), F.min("first").alias("first"), F.sum("n").alias("n"))
            .filter("n > 1"))


def _identical(first: str):
    """Whether a smaller id has the row's text; a null id is larger than every id."""
    return F.col(first).isNotNull() & (F.col("doc_id").isNull() | (F.col("doc_id") > F.col(first)))


def masks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(doc_id, part, mask): per row of ``docs`` the filters it fails, as bits from A on."""
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("")).alias("part"),
                       F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("h", text_hash(F.col("text")))
    facts = write_table(rows.select("doc_id", "part", "h", own_failures(F.col("text")).alias("mask")), "audit-facts")
    maybe = may_repeat(facts, "h", counters_for(facts.count()))
    firsts = write_table(first_ids(rows.select("doc_id", "h", "text").filter(maybe)), "audit-firsts")
    last = F.col("mask") + F.when(_identical("first"), 16).otherwise(0)
    shared = firsts.filter("texts > 1").select("h")
    plain = facts
    if not shared.isEmpty():  # different texts of one 64-bit hash: by full text
        plain = facts.join(shared, "h", "left_anti")
        few = rows.join(shared, "h", "left_semi")
        own = few.groupBy("text").agg(F.min("doc_id").alias("first"))
        by_text = few.join(own, "text").withColumn("mask", own_failures(F.col("text"))).select(
            "doc_id", "part", last.cast("int").alias("mask"))
    out = join_small(plain, firsts.filter("texts = 1").select("h", "first"), ["h"], "doc_id").select(
        "doc_id", "part", last.cast("int").alias("mask"))
    return out if shared.isEmpty() else out.unionByName(by_text)


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          lang_col: str = "lang") -> DataFrame:
    """Per part (lang), order of the filters A to E and step, with counts of rows:

    kept (after this step), removed (by it), redundant (fail its filter but were removed
    earlier), unique_fails (fail its filter only), good_lost and toxic_lost (removed
    here, with quality 1 and with toxic 1 in ``labels``), shapley (removed by its
    filter, summed over all 120 orders).

    A fails under 200 words; B if distinct words are less than half of them; C if
    capitals A-Z are over 3 % of the code points; D if it holds one of ``#$%&*|``; E if
    a smaller id has the same text, in whatever part. Words are maximal runs without
    space, tab, line feed, vertical tab, form feed and carriage return.

    Null text counts as empty, null lang as ''. Repeated rows are rows of their own; rows
    of one id and text don't fail E by each other; a null id is larger than every id.
    A document with several labels is good (toxic) if one of them says so. Other
    columns are not read, whatever their names. An empty table gives no rows.
    """
    said = (labels.groupBy(F.col("doc_id").cast("long").alias("doc_id"))
            .agg(F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
                 F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic")))
    counts = (masks(docs, id_col, text_col, lang_col).join(said, "doc_id", "left").groupBy("part", "mask")
              .agg(F.count(F.lit(1)).alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic"))
              .na.fill(0, ["good", "toxic"]))
    held = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("held"))  # 32 at most
    orders = ["".join(o) for o in itertools.permutations(FILTERS)]
    bits = [1 << FILTERS.index(f) for o in orders for f in o]
    befores = [sum(1 << FILTERS.index(f) for f in o[:k]) for o in orders for k in range(len(FILTERS))]
    steps = (held.select("part", "held", F.explode(F.sequence(F.lit(0), F.lit(len(bits) - 1))).alias("at"))
             .withColumn("bit", F.get(F.lit(bits), "at")).withColumn("before", F.get(F.lit(befores), "at")))

    def total(where, what="n", times=None):
        rows = F.filter("held", lambda x: where(x["mask"]))
        return F.aggregate(rows, F.lit(0).cast("long"),
                           lambda s, x: s + (x[what] if times is None else x[what] * times(x["mask"])))

    def fails(m):
        return m.bitwiseAND(F.col("bit")) != 0

    def earlier(m):
        return m.bitwiseAND(F.col("before")) != 0

    def here(m):
        return fails(m) & ~earlier(m)

    # a filter removes a row in the orders where it is the first of those the row fails
    times = math.factorial(len(FILTERS))
    return steps.select(
        "part", F.get(F.lit(orders), F.floor(F.col("at") / len(FILTERS)).cast("int")).alias("filter_order"),
        (F.col("at") % len(FILTERS) + 1).cast("int").alias("step"),
        total(lambda m: ~fails(m) & ~earlier(m)).alias("kept"), total(here).alias("removed"),
        total(lambda m: fails(m) & earlier(m)).alias("redundant"), total(lambda m: m == F.col("bit")).alias("unique_fails"),
        total(here, "good").alias("good_lost"), total(here, "toxic").alias("toxic_lost"),
        total(fails, times=lambda m: F.floor(F.lit(times) / F.bit_count(m)).cast("long")).alias("shapley"))


ORACLE_SQL = """
WITH docs AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
facts AS (
  SELECT doc_id, part,
         (len(words) < 200)::INT AS fa, (100 * len(list_distinct(words)) < 50 * len(words))::INT AS fb,
         (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text))::INT AS fc,
         regexp_matches(text, '[#$%&*|]')::INT AS fd,
         (doc_id > min(doc_id) OVER (PARTITION BY text))::INT AS fe
  FROM docs),
said AS (
  SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
counts AS (
  SELECT part, fa + 2 * fb + 4 * fc + 8 * fd + 16 * fe AS mask, count(*) AS n,
         sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
  FROM facts LEFT JOIN said USING (doc_id) GROUP BY ALL),
f AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) v(f, bit)),
orders AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM f a, f b, f c, f d, f e WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31
    AND len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
steps AS (
  SELECT filter_order, step::INTEGER AS step, bits[step] AS bit, coalesce(list_sum(bits[1:step - 1]), 0)::INT AS before
  FROM orders, range(1, 6) r(step)),
by_step AS (
  SELECT part, filter_order, step, bit,
         sum(n) FILTER (mask & (bit | before) = 0) AS kept,
         sum(n) FILTER (mask & bit <> 0 AND mask & before = 0) AS removed,
         sum(n) FILTER (mask & bit <> 0 AND mask & before <> 0) AS redundant,
         sum(n) FILTER (mask = bit) AS unique_fails,
         sum(good) FILTER (mask & bit <> 0 AND mask & before = 0) AS good_lost,
         sum(toxic) FILTER (mask & bit <> 0 AND mask & before = 0) AS toxic_lost
  FROM counts, steps GROUP BY ALL),
shares AS (SELECT part, bit, sum(coalesce(removed, 0)) AS shapley FROM by_step GROUP BY ALL)
SELECT part, filter_order, step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
       coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
       coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
       shapley::BIGINT AS shapley
FROM by_step JOIN shares USING (part, bit)
"""
