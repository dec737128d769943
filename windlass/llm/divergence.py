"""Source divergence audit: which sources of a language use words unlike the others.

Words are counted by a token-start pointer sort. A task takes slices of whole
documents (about ``SLICE_BYTES`` of text) as Arrow string buffers, marks every
byte where a word starts, and sorts these pointers by multikey quicksort with
symbols of 8 bytes: a pass sorts by the symbol at one depth, and only pointers
whose words go on past it take part in the next pass, within runs that still
tie. Equal runs are the terms of the slice; each gives the occurrences and the
number of documents per (lang, source). Only these runs are shuffled, dealt by
(lang, term), and all later steps keep that dealing.

Probabilities are integers of 10^9ths and every division is an integer one.
Pairs of sources are summed over chunks of terms: a task holds ``CHUNK_TERMS``
terms of ``SOURCE_BLOCK`` x ``SOURCE_BLOCK`` sources of a language and gives one
partial sum per pair. Terms that neither source has differ by a constant, which
is multiplied, not summed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from windlass.llm.common import join_small, width, write_table

LEAST_DOCS = 3  # documents of its language that a kept term is in
SCALE = 1_000_000_000
TOP_TERMS = 200
SLICE_BYTES = 8_000_000
CHUNK_TERMS = 4_096
SOURCE_BLOCK = 128
TERM_SALT = 16  # parts of a group whose best terms are found apart
PARTIAL_ROWS = 400_000  # partial counts per partition
BYTES_PER_RUN = 12  # of text, about, to a partial count

_BYTES = np.arange(256)
_LETTER = ((_BYTES >= 0x41) & (_BYTES <= 0x5A)) | ((_BYTES >= 0x61) & (_BYTES <= 0x7A)) | (_BYTES >= 0x80)
_LOWER = np.where((_BYTES >= 0x41) & (_BYTES <= 0x5A), _BYTES + 32, _BYTES).astype(np.uint8)

PARTIAL = "lang string, source string, term string, n long, docs long"


def words(data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start pointers and lengths of the words in ``data`` (bytes of texts that begin at
    ``edges``); no word goes on from one text into the next."""
    inside = _LETTER[data]
    if not inside.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    before = np.empty_like(inside)
    before[0], before[1:] = False, inside[:-1]
    cuts = edges[edges < len(data)]
    before[cuts] = False
    after = np.empty_like(inside)
    after[-1], after[:-1] = False, inside[1:]
    after[cuts[cuts > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    return starts, np.flatnonzero(inside & ~after) + 1 - starts


def _symbols(padded: np.ndarray, at: np.ndarray, left: np.ndarray) -> np.ndarray:
    """The 8 bytes from each pointer as one big-endian number, zero past the word's end."""
    eight = np.lib.stride_tricks.as_strided(padded, (len(padded) - 7, 8), (1, 1), writeable=False)
    key = np.ascontiguousarray(eight[at]).view(">u8").ravel().astype(np.uint64)
    over = np.uint64(8) * (8 - np.minimum(left, 8)).astype(np.uint64)
    return (key >> over) << over


def sort_pointers(lowered: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Multikey quicksort of word pointers: (run of each word, a word of each run). Words
    are equal exactly if their runs are."""
    padded = np.concatenate([lowered, np.zeros(8, np.uint8)])
    run = np.zeros(len(starts), np.int64)
    first: list[np.ndarray] = []
    done, depth, at = 0, 0, np.arange(len(starts))
    while len(at):
        left = lengths[at] - depth
        symbol, ends, on = _symbols(padded, starts[at] + depth, left), left <= 8, at[:0]
        # words that end within this symbol and words that go on past it never tie
        for last, part in ((True, ends), (False, ~ends)):
            rows, key = at[part], symbol[part]
            order = np.argsort(key) if depth == 0 else np.lexsort((key, run[rows]))
            rows, key, tie = rows[order], key[order], run[rows[order]]
            new = np.ones(len(rows), bool)
            new[1:] = (key[1:] != key[:-1]) | (tie[1:] != tie[:-1])
            run[rows] = np.cumsum(new) - 1 + (done if last else 0)
            if last:
                first.append(rows[new])
                done += int(new.sum())
            else:
                on = rows
        at, depth = on, depth + 8
    return run, np.concatenate(first) if first else np.zeros(0, np.int64)


def _gather(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> pa.StringArray:
    """The words at some pointers as an Arrow string array."""
    offsets = np.zeros(len(starts) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    flat = np.arange(offsets[-1], dtype=np.int64) + np.repeat(starts - offsets[:-1], lengths)
    return pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data[flat])))


def _runs(data: np.ndarray, edges: np.ndarray, group: np.ndarray) -> tuple[pa.StringArray, np.ndarray, np.ndarray, np.ndarray]:
    """(term, group, occurrences, documents) of a slice of texts that begin at ``edges``."""
    lowered = _LOWER[data]
    starts, lengths = words(data, edges)
    run, first = sort_pointers(lowered, starts, lengths)
    doc = np.searchsorted(edges, starts, "right") - 1
    # equal runs by document, then by group: a document has one group
    in_doc, n = np.unique(run * len(edges) + doc, return_counts=True)
    term, owner = in_doc // len(edges), group[in_doc % len(edges)]
    groups = int(group.max()) + 1 if len(group) else 1
    key, back = np.unique(term * groups + owner, return_inverse=True)
    count = np.zeros(len(key), np.int64)
    np.add.at(count, back, n)
    which = first[key // groups]
    return _gather(lowered, starts[which], lengths[which]), key % groups, count, np.bincount(back, minlength=len(key))


def _long_text(data: np.ndarray, limit: int) -> tuple[pa.StringArray, np.ndarray]:
    """(term, occurrences) of one text beyond a slice, cut between words; what is held at
    once grows with its distinct words."""
    held: dict[str, int] = {}
    at = 0
    while at < len(data):
        end = min(at + limit, len(data))
        while end < len(data) and _LETTER[data[end]] and _LETTER[data[end - 1]]:
            end += 1
        terms, _, n, _ = _runs(data[at:end], np.zeros(1, np.int64), np.zeros(1, np.int64))
        for t, k in zip(terms.to_pylist(), n.tolist()):
            held[t] = held.get(t, 0) + k
        at = end
    return pa.array(list(held), pa.string()), np.array(list(held.values()), np.int64)


def _counter(limit: int):
    """mapInArrow body: (lang, source, text) -> partial counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: dict[tuple, int] = {}
        texts: list[np.ndarray] = []
        group: list[int] = []
        held = 0

        def rows(terms, owner, n, docs):
            pairs = list(names)
            lang, source = (pa.array([p[k] for p in pairs], pa.string()) for k in (0, 1))
            owner = pa.array(owner)
            return pa.RecordBatch.from_arrays([lang.take(owner), source.take(owner), terms, pa.array(n), pa.array(docs)],
                                              names=["lang", "source", "term", "n", "docs"])

        def settle():
            if held:
                edges = np.cumsum([0, *[len(t) for t in texts[:-1]]])
                yield rows(*_runs(np.concatenate(texts), edges, np.array(group)))

        for rb in batches:
            lang, source, text = (rb.column(k) for k in range(3))
            text = text.cast(pa.large_string())
            offsets = np.frombuffer(text.buffers()[1], np.int64, len(text) + 1 + text.offset)[text.offset:]
            buffer = text.buffers()[2]
            data = np.frombuffer(buffer, np.uint8) if buffer is not None else np.zeros(0, np.uint8)
            for k, pair in enumerate(zip(lang.to_pylist(), source.to_pylist())):
                one = data[offsets[k]:offsets[k + 1]]
                if not len(one):
                    continue
                owner = names.setdefault(pair, len(names))
                if len(one) > limit:
                    terms, n = _long_text(one, limit)
                    if len(terms):
                        yield rows(terms, np.full(len(terms), owner), n, np.ones(len(terms), np.int64))
                    continue
                texts.append(one.copy())
                group.append(owner)
                held += len(one)
                if held >= limit:
                    yield from settle()
                    texts, group, held = [], [], 0
        yield from settle()

    return run


def _p(count, total, kept):
    """1 + floor(10^9 * (count + 1) / (total + kept)), as a long."""
    return (F.lit(1) + F.expr(f"({SCALE}BD * CAST({count} + 1 AS DECIMAL(20,0))) div CAST({total} + {kept} AS DECIMAL(20,0))")).cast("long")


def _pair_sums(table: pa.Table) -> pa.Table:
    """Partial sums of all pairs of a tile: rows without a term name a source with its total,
    rows with one a count."""
    named = table.filter(pc.is_null(table["term"]))
    sides = []
    counts = table.filter(pc.is_valid(table["term"]))
    terms = counts["term"].combine_chunks().dictionary_encode() if len(counts) else None
    term = terms.indices.to_numpy() if terms is not None else np.zeros(0, np.int64)
    width_ = len(terms.dictionary) if terms is not None else 0
    kept = int(named["kept"][0].as_py())
    for side in ("from", "to"):
        mine = named.filter(named["side"].to_numpy() == side)
        sources = mine["source"].to_pylist()
        total = mine["total"].to_numpy().astype(np.int64)
        place = {s: i for i, s in enumerate(sources)}
        n = np.zeros((len(sources), width_), np.int64)
        if width_:
            own = counts["side"].to_numpy() == side
            rows = np.array([place[s] for s in counts["source"].filter(pa.array(own)).to_pylist()], np.int64)
            n[rows, term[own]] = counts["n"].to_numpy()[own]
        if kept:
            base = 1 + SCALE // (total + kept)
            # (n + 1) * 10^9 beyond 63 bits: by Python integers, which are exact
            wide = n.max(initial=0) >= (1 << 63) // SCALE - 1
            num = (n.astype(object) + 1) * SCALE if wide else (n + 1) * SCALE
            p = (1 + num // (total + kept)[:, None]).astype(np.int64)
        else:
            base, p = np.ones(len(sources), np.int64), n
        sides.append((sources, base, p))
    (left, lbase, lp), (right, rbase, rp) = sides
    lang, chunk = table["lang"][0].as_py(), table["chunk"][0].as_py()
    out_s, out_t, out_v = [], [], []
    for j, t in enumerate(right):
        none = (lbase - rbase[j]) ** 2 // rbase[j]
        value = ((lp - rp[j]) ** 2 // rp[j]).sum(1) - width_ * none if width_ else np.zeros(len(left), np.int64)
        if chunk == 0 and kept:
            value = value + kept * none
        keep = [i for i, s in enumerate(left) if s != t]
        out_s += [left[i] for i in keep]
        out_t += [t] * len(keep)
        out_v += value[keep].tolist()
    return pa.table({"lang": pa.array([lang] * len(out_s), pa.string()), "source": pa.array(out_s, pa.string()),
                     "item": pa.array(out_t, pa.string()), "value": pa.array(out_v, pa.int64())})


def term_counts(texts: DataFrame, size: int, slice_bytes: int = SLICE_BYTES, least_docs: int = LEAST_DOCS) -> DataFrame:
    """(lang, source, term, n, all_n): occurrences of the kept terms in each source and in
    the whole language. ``texts`` (lang, source, text), of about ``size`` bytes in all."""
    partial = texts.mapInArrow(_counter(slice_bytes), PARTIAL)
    parts = width(texts.sparkSession, size // BYTES_PER_RUN, PARTIAL_ROWS)
    by_term = Window.partitionBy("lang", "term")
    return (partial.repartition(parts, "lang", "term").groupBy("lang", "term", "source")
            .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
            .withColumn("all_docs", F.sum("docs").over(by_term)).withColumn("all_n", F.sum("n").over(by_term))
            .filter(F.col("all_docs") >= least_docs).select("lang", "source", "term", "n", "all_n"))


def audit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", *,
          least_docs: int = LEAST_DOCS, top_terms: int = TOP_TERMS, slice_bytes: int = SLICE_BYTES,
          chunk_terms: int = CHUNK_TERMS, source_block: int = SOURCE_BLOCK) -> DataFrame:
    """Per (lang, source): its divergence from every other source of the language (part
    'pair', all ranks) and its most over-used terms (part 'term', ranks to ``top_terms``).

    A term is a maximal run of ASCII letters and characters beyond ASCII, A-Z
    lower-cased; a language keeps the V terms that are in at least ``least_docs`` of
    its documents. With n occurrences of N kept ones, p = 1 + floor(10^9 (n + 1) /
    (N + V)), and a difference from q is floor((p - q)^2 / q): for pairs q is the
    other source's and the differences of all kept terms are added up (0 if V is
    0), for terms it is the language's and only p > q counts.

    Null text, lang and source are read as ''. Every group that occurs has its pairs,
    also without a term; a language of one source has none. Repeated rows are
    documents of their own. Other columns are not read, whatever their names. Ties
    go by the item's UTF-8 bytes. An empty table gives no rows.
    """
    empty = F.lit("")
    texts = docs.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), empty).alias(n)
                          for c, n in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))])
    groups = write_table(texts.groupBy("lang", "source").agg(F.sum(F.octet_length("text").cast("long")).alias("bytes")),
                         "divergence-sizes")
    size = groups.agg(F.sum("bytes")).first()[0] or 0
    groups = groups.select("lang", "source")
    counts = write_table(term_counts(texts, size, slice_bytes, least_docs), "divergence-counts")
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    kept = (counts.groupBy("lang", "term").agg(F.first("all_n").alias("n")).groupBy("lang")
            .agg(F.count(F.lit(1)).alias("kept"), F.sum("n").alias("lang_total")))
    sources = groups.groupBy("lang").agg(F.ceil(F.count(F.lit(1)) / F.lit(source_block)).alias("blocks"))
    langs = sources.join(kept, "lang", "left").na.fill(0, ["kept", "lang_total"]).withColumn(
        "chunks", F.greatest(F.ceil(F.col("kept") / F.lit(chunk_terms)), F.lit(1).cast("long")))
    known = write_table(groups.join(totals, ["lang", "source"], "left").na.fill(0, ["total"]).join(langs, "lang")
                        .withColumn("block", F.pmod(F.xxhash64("source"), F.col("blocks"))), "divergence-groups")
    rows = join_small(counts, known, ["lang", "source"], "term")

    # pairs: a tile is a chunk of terms and a block of sources on either side
    each = "transform(sequence(0, blocks - 1), o -> named_struct('a', {a}, 'b', {b}, 'side', '{side}'))"
    tiles = F.explode(F.expr("concat(" + each.format(a="block", b="o", side="from") + ", "
                             + each.format(a="o", b="block", side="to") + ")"))
    tile = ["lang", "chunk", F.col("at.a").alias("a"), F.col("at.b").alias("b"), F.col("at.side").alias("side"), "source",
            "term", "n", "total", "kept"]
    named = (known.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
             .withColumn("term", F.lit(None).cast("string")).withColumn("n", F.lit(0).cast("long")))
    held = rows.withColumn("chunk", F.pmod(F.xxhash64("term"), F.col("chunks")))
    both = (named.withColumn("at", tiles).select(*tile)
            .unionByName(held.withColumn("at", tiles).select(*tile)))
    pairs = (both.groupBy("lang", "chunk", "a", "b")
             .applyInArrow(_pair_sums, "lang string, source string, item string, value long")
             .groupBy("lang", "source", "item").agg(F.sum("value").alias("value")))

    # terms: the best of parts of a group first, so that no task sorts a whole group
    over = (rows.withColumn("p", _p("n", "total", "kept")).withColumn("q", _p("all_n", "lang_total", "kept"))
            .filter("p > q").select("lang", "source", F.col("term").alias("item"),
                                    F.expr("((p - q) * (p - q)) div q").alias("value")))
    best = [F.desc("value"), F.asc("item")]
    salt = F.pmod(F.xxhash64("item"), F.lit(TERM_SALT))
    some = over.withColumn("salt", salt).withColumn(
        "nth", F.row_number().over(Window.partitionBy("lang", "source", "salt").orderBy(*best))).filter(
        F.col("nth") <= top_terms).drop("salt", "nth")
    order = Window.partitionBy("lang", "source").orderBy(*best)
    terms = some.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top_terms)
    ranked = pairs.withColumn("rank", F.row_number().over(order))
    shown = ["lang", "source", "part", "item", "value", "rank"]
    return (ranked.withColumn("part", F.lit("pair")).select(*shown)
            .unionByName(terms.withColumn("part", F.lit("term")).select(*shown)))


ORACLE_SQL = """
WITH docs AS (
  SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms
  FROM documents),
words AS (SELECT d, lang, source, unnest(terms) AS term FROM docs),
per_lang AS (
  SELECT lang, term, count(*) AS n FROM words GROUP BY lang, term HAVING count(DISTINCT d) >= 3),
langs AS (SELECT lang, count(*) AS v, sum(n) AS total FROM per_lang GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM docs),
held AS (SELECT lang, source, term, count(*) AS n FROM words SEMI JOIN per_lang USING (lang, term) GROUP BY ALL),
totals AS (SELECT lang, source, sum(n) AS total FROM held GROUP BY ALL),
p AS (
  SELECT g.lang, g.source, l.term, coalesce(h.n, 0) AS n,
         (1 + (1000000000::HUGEINT * (coalesce(h.n, 0) + 1)) // (coalesce(t.total, 0) + k.v))::BIGINT AS p
  FROM groups g JOIN per_lang l USING (lang) JOIN langs k USING (lang)
  LEFT JOIN totals t ON t.lang = g.lang AND t.source = g.source
  LEFT JOIN held h ON h.lang = g.lang AND h.source = g.source AND h.term = l.term),
sums AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
q AS (
  SELECT l.lang, l.term, (1 + (1000000000::HUGEINT * (l.n + 1)) // (k.total + k.v))::BIGINT AS q
  FROM per_lang l JOIN langs k USING (lang)),
terms AS (
  SELECT p.lang, p.source, p.term AS item, ((p.p - q.q) * (p.p - q.q) // q.q)::BIGINT AS value
  FROM p JOIN q USING (lang, term) WHERE p.n > 0 AND p.p > q.q),
ranked AS (
  SELECT 'pair' AS part, *, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, encode(item)) AS rank FROM pairs
  UNION ALL
  SELECT 'term' AS part, *, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, encode(item)) AS rank FROM terms)
SELECT lang, source, part, item, value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= 200
"""
