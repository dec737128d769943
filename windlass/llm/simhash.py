"""SimHash near-dedup with pivot distance tables.

Fingerprints. A text's words (A-Z lower-cased) give overlapping shingles; each
is hashed with XXH64, and a bit of the 64-bit fingerprint is set if more than
half of the hashes have it set.

Links. Two fingerprints link at up to ``max_bits`` differing bits. Equal
fingerprints are one row from here on, so copies cost nothing. Distinct ones
are compared by their pivot table: the Hamming distances to 32 fixed reference
fingerprints. By the triangle inequality the distances of a linked pair to any
pivot differ by at most ``max_bits``; a pair is discarded at the first pivot
where they differ by more, and survivors are verified on the fingerprints.

A single pivot keeps about 57 % of random pairs, so pivots discard well but
divide work badly. Which pairs meet at all is therefore settled by bit blocks:
with ``b`` blocks and ``m`` allowed bits, a linked pair agrees on some ``b - m``
blocks, so each fingerprint is dealt to one bucket per choice of ``b - m``
blocks, and no linked pair is missed. ``b`` grows with the number of
fingerprints and keeps a bucket at a few rows.

Large buckets. Within a bucket only a spanning forest of the links is kept: a
fingerprint once reached is never compared with those reached before it, so a
bucket full of near copies is walked, not squared, and gives fewer links than
rows. A bucket beyond ``MAX_BUCKET`` rows is passed on unread and cut into
tiles of bounded size, each pair of parts meeting in one task.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windlass.llm.common import join_small, one_row_each, whole_text, width, wrapped, write_table
from windlass.llm.components import components

SHINGLE = 4
MAX_BITS = 4
SEED = 42
PIVOTS = np.random.default_rng(7).integers(0, 1 << 63, 32, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
SMALL = 64  # buckets up to this size are compared side by side
MAX_BUCKET = 20_000  # larger ones are cut into tiles
TILE = 8_000
BUCKET_ROWS_PER_PARTITION = 1_000_000
FILL = 32  # fingerprints per bucket to stay below
LAST_ID = (1 << 63) - 1  # stands for a null id; larger than every id

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_LANES = np.uint64(0x0101010101010101)


def shingle_hashes(text: bytes, shingle: int = SHINGLE) -> np.ndarray:
    """XXH64 of every shingle; words are runs of other bytes than blank and \\t to \\r."""
    words = text.translate(_LOWER).split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    flat = b" ".join(words)
    if len(words) <= shingle:
        return np.array([xxhash.xxh64_intdigest(flat, SEED)], dtype=np.uint64)
    ends = list(itertools.accumulate(map(len, words), lambda a, n: a + n + 1))
    starts = [0, *(e + 1 for e in ends)]
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(flat[a:b], SEED) for a, b in zip(starts, ends[shingle - 1:])),  # noqa: B905
                       dtype=np.uint64, count=len(words) - shingle + 1)


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """64-bit SimHash; a text without words has fingerprint zero."""
    h = shingle_hashes(text, shingle)
    n = len(h)
    if not n:
        return 0
    rows = np.zeros((-(-n // 255), 255), dtype=np.uint64)  # 255 ones fit a byte lane
    rows.reshape(-1)[:n] = h
    out = 0
    for bit in range(8):
        lanes = ((rows >> np.uint64(bit)) & _LANES).sum(axis=1, dtype=np.uint64)
        counts = lanes.astype("<u8").view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
        for lane in range(8):
            if 2 * int(counts[lane]) > n:
                out |= 1 << (8 * lane + bit)
    return out


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, xx, fp) of every row: fp the fingerprint's bits as a signed long, xx a hash of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1).cast(pa.binary())
            fps = np.array([fingerprint(t.as_py(), shingle) for t in texts], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(fps)], names=["doc_id", "xx", "fp"])

    text = whole_text(text_col)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("xx")).mapInArrow(
        run, "doc_id long, xx long, fp long")


def pivot_table(fps: np.ndarray) -> np.ndarray:
    """Hamming distances (pivots x fingerprints)."""
    return np.stack([np.bitwise_count(fps ^ p) for p in PIVOTS]).astype(np.int8) if len(fps) else np.zeros((len(PIVOTS), 0), np.int8)


def near(fps: np.ndarray, table: np.ndarray, a: np.ndarray, b: np.ndarray, max_bits: int) -> np.ndarray:
    """Of the pairs (a, b), the positions of those that link: discarded pivot by pivot, then verified."""
    left = np.arange(len(b))
    a = np.broadcast_to(a, b.shape)
    for distances in table:
        if not len(left):
            return left
        left = left[np.abs(distances[a[left]] - distances[b[left]]) <= max_bits]
    return left[np.bitwise_count(fps[a[left]] ^ fps[b[left]]) <= max_bits]


def forest(fps: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Links that connect all linked fingerprints of one bucket: fewer than its rows."""
    table = pivot_table(fps)
    waiting, links = np.arange(len(fps)), []
    while len(waiting) > 1:
        reached, waiting = [int(waiting[0])], waiting[1:]
        while reached and len(waiting):
            x = reached.pop()
            found = near(fps, table, np.int64(x), waiting, max_bits)
            if len(found):
                ys = waiting[found]
                links.extend((x, int(y)) for y in ys)
                reached.extend(ys.tolist())
                waiting = np.delete(waiting, found)
    return links


def _side_by_side(bucket: np.ndarray, fps: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Links within many small buckets at once; rows are sorted by bucket."""
    table, pairs, step = pivot_table(fps), [], 1
    alive = np.flatnonzero(bucket[1:] == bucket[:-1])
    while len(alive):
        found = alive[near(fps, table, alive, alive + step, max_bits)]
        pairs.extend((int(x), int(x) + step) for x in found)
        step += 1
        alive = alive[alive + step < len(bucket)]
        alive = alive[bucket[alive] == bucket[alive + step]]
    root: dict[int, int] = {}

    def top(x):
        while (up := root.get(x, x)) != x:
            root[x] = root.get(up, up)
            x = up
        return x

    kept = []
    for x, y in pairs:
        p, q = top(x), top(y)
        if p != q:
            root[q] = p
            kept.append((x, y))
    return kept


def bucket_links(bucket: np.ndarray, fps: np.ndarray, max_bits: int) -> np.ndarray:
    """Linked fingerprints (k x 2) within whole buckets, given sorted by bucket."""
    starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
    sizes = np.diff(np.r_[starts, len(bucket)])
    out = []
    small = np.repeat((sizes <= SMALL) & (sizes > 1), sizes)
    if small.any():
        rows = np.flatnonzero(small)
        out.extend((rows[x], rows[y]) for x, y in _side_by_side(bucket[rows], fps[rows], max_bits))
    for k in np.flatnonzero(sizes > SMALL):
        base = starts[k]
        out.extend((base + x, base + y) for x, y in forest(fps[base:base + sizes[k]], max_bits))
    return fps[np.array(out, dtype=np.int64).reshape(-1, 2)]


LINK, DEFERRED = 0, 1


def _linker(max_bits: int, limit: int | None):
    """Streams rows (bucket, fp) sorted by bucket; yields (kind, a, b): links of
    fingerprints, or the rows of a bucket beyond ``limit``."""

    def batch(kind: int, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(a), kind, np.int32)), pa.array(a.view(np.int64)),
                                           pa.array(b.view(np.int64))], names=["kind", "a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_b = held_f = np.zeros(0, np.int64)
        passing = None  # the bucket whose rows go on unread

        def settle(b, f):
            links = bucket_links(b, f.view(np.uint64), max_bits)
            if len(links):
                yield batch(LINK, links[:, 0].copy(), links[:, 1].copy())

        for rb in batches:
            b, f = rb.column(0).to_numpy(), rb.column(1).to_numpy()
            if passing is not None:
                over = b == passing
                if over.any():
                    yield batch(DEFERRED, b[over].copy(), f[over].copy())
                    b, f = b[~over], f[~over]
                if not len(b):
                    continue
                passing = None
            held_b, held_f = np.concatenate([held_b, b]), np.concatenate([held_f, f])
            if not len(held_b):
                continue
            cut = int(np.searchsorted(held_b, held_b[-1]))  # the last bucket may go on in the next batch
            if limit is not None and len(held_b) - cut > limit:
                passing = held_b[-1]
                yield batch(DEFERRED, held_b[cut:].copy(), held_f[cut:].copy())
                done_b, done_f, held_b, held_f = held_b[:cut], held_f[:cut], held_b[:0], held_f[:0]
            elif cut >= 50_000 or cut > len(held_b) // 2:
                done_b, done_f, held_b, held_f = held_b[:cut], held_f[:cut], held_b[cut:], held_f[cut:]
            else:
                continue
            yield from settle(done_b, done_f)
        yield from settle(held_b, held_f)

    return run


def block_choices(rows: int, max_bits: int) -> list[list[tuple[int, int]]]:
    """Choices of bit blocks (shift, width) one of which every linked pair agrees on."""
    for blocks in range(max_bits + 1, 64):
        if rows <= FILL * 2 ** (64 * (blocks - max_bits) // blocks) or blocks == max_bits + 4:
            break
    edges = [64 * k // blocks for k in range(blocks + 1)]
    parts = [(edges[k], edges[k + 1] - edges[k]) for k in range(blocks)]
    return [list(c) for c in itertools.combinations(parts, blocks - max_bits)]


def link_fingerprints(distinct: DataFrame, rows: int, max_bits: int = MAX_BITS, max_bucket: int = MAX_BUCKET,
                      tile: int = TILE) -> DataFrame:
    """(a, b): links that connect all of the distinct fingerprints (column fp)
    at up to ``max_bits`` bits. ``rows`` is their number."""
    spark = distinct.sparkSession
    choices = block_choices(rows, max_bits)
    keys = []
    for k, choice in enumerate(choices):
        key = F.lit(0).cast("long")
        for shift, size in choice:
            key = F.shiftleft(key, size).bitwiseOR(
                F.shiftrightunsigned("fp", shift).bitwiseAND(F.lit((1 << size) - 1)))
        keys.append(F.shiftleft(key, 8).bitwiseOR(F.lit(k).cast("long")))
    dealt = distinct.select(F.explode(F.array(*keys)).alias("bucket"), "fp")
    parts = width(spark, rows * len(choices), BUCKET_ROWS_PER_PARTITION)
    out = write_table(dealt.repartition(parts, "bucket").sortWithinPartitions("bucket")
                      .mapInArrow(_linker(max_bits, max_bucket), "kind int, a long, b long"), "simhash-links")
    links = out.filter(F.col("kind") == LINK).select("a", "b")
    deferred = out.filter(F.col("kind") == DEFERRED).select(F.col("a").alias("bucket"), F.col("b").alias("fp"))
    if not deferred.isEmpty():
        sizes = deferred.groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / F.lit(tile)).alias("cuts"))
        mine = F.pmod(F.xxhash64("fp"), F.col("cuts"))
        tiles = (deferred.join(sizes, "bucket").withColumn("mine", mine)
                 .select("bucket", "fp", "mine", F.explode(F.sequence(F.lit(0).cast("long"), F.col("cuts") - 1)).alias("other"))
                 .select(F.xxhash64("bucket", F.least("mine", "other"), F.greatest("mine", "other")).alias("bucket"), "fp"))
        more = (tiles.repartition(max(parts, 2 * parts), "bucket").sortWithinPartitions("bucket")
                .mapInArrow(_linker(max_bits, None), "kind int, a long, b long").select("a", "b"))
        links = links.unionByName(more)
    return links


def near_dedup(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id.

    Documents link if their fingerprints differ in at most ``max_bits`` bits;
    component_id is the smallest id reachable over links, the own id included.
    Null text counts as empty; texts without words have fingerprint zero, which
    links like any other; texts with fewer words than a shingle are one shingle.
    A null id is larger than every id: component_id is null only if all of a
    component's ids are. Repeated rows stay repeated; rows that share an id but
    not a fingerprint are documents of their own. Other columns are not read; an
    empty table gives an empty result.
    """
    component = F.col("top")
    return _classes(docs, shingle, max_bits, id_col, text_col).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.when(component != LAST_ID, component).alias("component_id"))


def _classes(docs: DataFrame, shingle: int, max_bits: int, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, xx, fp, root, top): root names the component by a fingerprint of its
    own, top is its smallest id (``LAST_ID`` for null)."""
    prints = write_table(fingerprints(docs, shingle, id_col, text_col), "simhash-prints")
    own = F.coalesce("doc_id", F.lit(LAST_ID))
    groups = write_table(prints.groupBy("fp").agg(F.min(own).alias("low"), F.count(F.lit(1)).alias("n")), "simhash-groups",
                         prints.count())
    links = link_fingerprints(groups.select("fp"), groups.count(), max_bits)
    roots = components(links.select(F.col("a").alias("src"), F.col("b").alias("dst")))
    rooted = groups.join(roots.select(F.col("src").alias("fp"), F.col("dst").alias("up")), "fp", "left").select(
        "fp", "low", "n", F.coalesce("up", "fp").alias("root"))
    tops = rooted.groupBy("root").agg(F.min("low").alias("top"), F.sum("n").alias("rows"))
    # a row alone in its component needs no look-up
    shared = join_small(rooted, tops.filter("rows > 1"), ["root"], "fp").filter("top IS NOT NULL").select("fp", "root", "top")
    return prints.join(shared, "fp", "left").select(
        "doc_id", "xx", "fp", F.coalesce("root", "fp").alias("root"), F.coalesce("top", own).alias("top"))


def drop_near_copies(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, with one document of each component of
    :func:`near_dedup`: the one of the smallest id (of rows that share it, one)."""
    own = F.coalesce(F.col("doc_id"), F.lit(LAST_ID))
    first = _classes(docs, shingle, max_bits, id_col, text_col).filter(own == F.col("top"))
    kept = first.groupBy("root", "top").agg(F.min("xx").alias("xx")).select(F.col("top").alias("id"), "xx")
    rows = wrapped(docs, id=F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)), xx=F.xxhash64(whole_text(text_col)))
    return one_row_each(rows, kept, ["id", "xx"])
