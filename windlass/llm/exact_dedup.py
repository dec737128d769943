"""Exact dedup with a sharded cuckoo-filter index of live digests.

Every text is reduced in the JVM to its content key: SHA-256, UTF-8 length and
a 64-bit XXH64 of the whole text. Keys are dealt to shards by digest. A shard
is one task that holds

* a cuckoo filter (16-bit fingerprints, four per bucket) of its live digests,
* a bucketed store of the complete content keys.

A key the filter does not know is new: it is stored and its fingerprint is
inserted. A filter hit is only a hint: the key's bucket of the store is read
and the complete keys are compared, so a fingerprint collision never merges two
texts. When an insertion runs out of kicks the filter doubles and is filled
again from the stored keys; nothing is lost. A digest whose last document is
deleted leaves both the filter and the store.

Skew: copies are first combined within each Arrow batch, so a text that is a
third of the corpus reaches its shard as one row per batch, not one per copy.
Shards grow in number with the rows, so a shard stays at about
``KEYS_PER_SHARD`` keys at any size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from windlass.llm.common import one_row_each, whole_text, width, wrapped, write_table

SLOTS = 4  # fingerprints per bucket
MAX_KICKS = 200
KEYS_PER_SHARD = 200_000
NO_ID = -(1 << 63)  # stands for a null id inside the index; sorts below every id

INDEX_SCHEMA = "digest binary, n_bytes long, xx long, n long, keep_id long, keep_rows long"
_KEY_ARROW = pa.schema([("digest", pa.binary()), ("n_bytes", pa.int64()), ("xx", pa.int64()),
                        ("n", pa.int64()), ("keep_id", pa.int64()), ("keep_rows", pa.int64())])


class CuckooFilter:
    """Approximate set of 64-bit hashes with insertion and deletion."""

    def __init__(self, buckets: int = 1024):
        self.buckets = 1 << max(1, (buckets - 1).bit_length())
        self.table = np.zeros((self.buckets, SLOTS), dtype=np.uint16)
        self.size = 0

    @staticmethod
    def fingerprint(h: np.ndarray) -> np.ndarray:
        fp = (h & np.uint64(0xFFFF)).astype(np.uint16)
        return np.where(fp == 0, np.uint16(1), fp)

    def _places(self, h: np.ndarray):
        fp = self.fingerprint(h)
        mask = np.uint64(self.buckets - 1)
        first = (h >> np.uint64(16)) & mask
        return fp, first.astype(np.int64), self._other(first, fp).astype(np.int64)

    def _other(self, bucket, fp):
        spread = (np.asarray(fp).astype(np.uint64) * np.uint64(0x5BD1E995)) & np.uint64(0xFFFFFFFF)
        return np.asarray(bucket).astype(np.uint64) ^ (spread & np.uint64(self.buckets - 1))

    def contains(self, h: np.ndarray) -> np.ndarray:
        fp, a, b = self._places(h)
        return ((self.table[a] == fp[:, None]) | (self.table[b] == fp[:, None])).any(axis=1)

    def insert(self, h: int) -> bool:
        """False if no place was found within ``MAX_KICKS`` moves. The filter
        then no longer holds one of its fingerprints and must be rebuilt."""
        fp, a, b = self._places(np.array([h], dtype=np.uint64))
        fp, spots = int(fp[0]), (int(a[0]), int(b[0]))
        for at in spots:
            free = np.flatnonzero(self.table[at] == 0)
            if len(free):
                self.table[at, free[0]] = fp
                self.size += 1
                return True
        at = spots[1]
        for kick in range(MAX_KICKS):
            slot = (fp + kick) % SLOTS
            fp, self.table[at, slot] = int(self.table[at, slot]), fp
            at = int(self._other(at, fp))
            free = np.flatnonzero(self.table[at] == 0)
            if len(free):
                self.table[at, free[0]] = fp
                self.size += 1
                return True
        return False

    def insert_many(self, h: np.ndarray) -> bool:
        """Fill free slots of first buckets in bulk, then the rest one by one."""
        fp, first, _ = self._places(h)
        order = np.argsort(first, kind="stable")
        fp, first = fp[order], first[order]
        new = np.r_[True, first[1:] != first[:-1]] if len(first) else np.zeros(0, bool)
        rank = np.arange(len(first)) - np.maximum.accumulate(np.where(new, np.arange(len(first)), 0))
        taken = (self.table[first] != 0).sum(axis=1)  # slots fill from the left; deletions compact
        slot = taken + rank
        fits = slot < SLOTS
        self.table[first[fits], slot[fits]] = fp[fits]
        self.size += int(fits.sum())
        return all(self.insert(int(x)) for x in h[order][~fits])

    def delete(self, h: int) -> bool:
        fp, a, b = self._places(np.array([h], dtype=np.uint64))
        for at in (int(a[0]), int(b[0])):
            row = self.table[at]
            found = np.flatnonzero(row == fp[0])
            if len(found):
                rest = np.delete(row, found[0])
                rest = rest[rest != 0]
                self.table[at] = 0
                self.table[at, :len(rest)] = rest
                self.size -= 1
                return True
        return False


class CuckooIndex:
    """One shard: the filter, and the bucketed store of complete content keys."""

    def __init__(self, buckets: int = 1024):
        self.filter = CuckooFilter(buckets)
        self.store: dict[int, list[list]] = {}  # filter hash -> entries [digest, n_bytes, xx, n, keep_id, keep_rows]
        self.resizes = 0

    @staticmethod
    def hashes(digests) -> np.ndarray:
        """64 bits of each digest, from its tail (shards are dealt by all of it)."""
        return np.frombuffer(b"".join(d[-8:].rjust(8, b"\0") for d in digests), dtype=np.uint64)

    def _grow(self) -> None:
        """Double the filter and refill it from the stored keys, one fingerprint per live digest."""
        live = np.array([h for h, entries in self.store.items() for _ in entries], dtype=np.uint64)
        size = self.filter.buckets
        while True:
            size *= 2
            self.filter, self.resizes = CuckooFilter(size), self.resizes + 1
            if self.filter.insert_many(live):
                return

    def _verified(self, h: int, digest: bytes, n_bytes: int, xx: int):
        for entry in self.store.get(h, ()):
            if entry[0] == digest:
                if (entry[1], entry[2]) != (n_bytes, xx):
                    raise ValueError(f"two texts share the SHA-256 {digest.hex()}")
                return entry
        return None

    def insert_batch(self, rows: pd.DataFrame) -> None:
        """``rows``: content keys with n, keep_id, keep_rows; a digest at most once."""
        if not len(rows):
            return
        digests = rows["digest"].tolist()
        hs = self.hashes(digests)
        hit = self.filter.contains(hs)
        fresh = []
        for h, maybe, row in zip(hs.tolist(), hit.tolist(), rows.itertuples(index=False), strict=True):
            digest, n_bytes, xx, n, keep_id, keep_rows = row
            entry = self._verified(h, digest, n_bytes, xx) if maybe else None
            if entry is None:
                self.store.setdefault(h, []).append([digest, n_bytes, xx, n, keep_id, keep_rows])
                fresh.append(h)
                continue
            entry[3] += n
            if keep_id > entry[4]:
                entry[4], entry[5] = keep_id, keep_rows
            elif keep_id == entry[4]:
                entry[5] += keep_rows
        if fresh and not self.filter.insert_many(np.array(fresh, dtype=np.uint64)):
            self._grow()

    def delete(self, digest: bytes, n: int) -> None:
        """Take ``n`` documents off a live digest; unknown digests are ignored."""
        h = int(self.hashes([digest])[0])
        if not self.filter.contains(np.array([h], dtype=np.uint64))[0]:
            return
        for entry in self.store.get(h, ()):
            if entry[0] == digest:
                entry[3] -= n
                if entry[3] <= 0:
                    self.store[h].remove(entry)
                    if not self.store[h]:
                        del self.store[h]
                    self.filter.delete(h)
                return

    def batches(self, rows: int = 20_000) -> Iterator[pa.RecordBatch]:
        chunk: list[list] = []
        for entries in self.store.values():
            chunk.extend(entries)
            if len(chunk) >= rows:
                yield _record_batch(chunk)
                chunk = []
        if chunk:
            yield _record_batch(chunk)


def _record_batch(entries: list[list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=f.type) for c, f in zip(zip(*entries, strict=True), _KEY_ARROW, strict=True)],
        schema=_KEY_ARROW)


def _combined(df: pd.DataFrame) -> pd.DataFrame:
    """One row per digest: n summed, the largest keep_id and the rows that carry it."""
    codes, _ = pd.factorize(df["digest"])
    k = int(codes.max()) + 1 if len(codes) else 0
    ids = df["keep_id"].to_numpy(np.int64)
    top = np.full(k, NO_ID, dtype=np.int64)
    np.maximum.at(top, codes, ids)
    at_top = ids == top[codes]
    first = np.full(k, -1, dtype=np.int64)
    first[codes[::-1]] = np.arange(len(codes))[::-1]
    out = df.iloc[first].copy()
    out["n"] = np.bincount(codes, weights=df["n"].to_numpy(float), minlength=k).astype(np.int64)
    out["keep_id"] = top
    out["keep_rows"] = np.bincount(codes[at_top], weights=df["keep_rows"].to_numpy(float)[at_top],
                                   minlength=k).astype(np.int64)
    return out


def _combine_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        if b.num_rows:
            yield pa.RecordBatch.from_pandas(_combined(b.to_pandas()), schema=_KEY_ARROW, preserve_index=False)


def _index_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    index = CuckooIndex()
    for b in batches:
        if b.num_rows:
            index.insert_batch(_combined(b.to_pandas()))
    yield from index.batches()


def content_keys(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, digest, n_bytes, xx) of every row; no text leaves the JVM scan."""
    text = whole_text(text_col)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.unhex(F.sha2(text, 256)).alias("digest"),
                       F.octet_length(text).cast("long").alias("n_bytes"), F.xxhash64(text).alias("xx"))


def build_index(keys: DataFrame, rows: int | None = None) -> DataFrame:
    """The live index of ``content_keys``: one row per distinct text (``INDEX_SCHEMA``).

    ``rows`` (default: counted) sets the number of shards.
    """
    spark = keys.sparkSession
    shards = width(spark, keys.count() if rows is None else rows, KEYS_PER_SHARD)
    # repeated rows of one (id, text) first become one, so ties of the largest id are counted right
    once = keys.groupBy("digest", "n_bytes", "xx", F.coalesce("doc_id", F.lit(NO_ID)).alias("keep_id")).agg(
        F.count(F.lit(1)).alias("n"))
    rows_in = once.select("digest", "n_bytes", "xx", "n", "keep_id", F.col("n").alias("keep_rows"))
    return (rows_in.mapInArrow(_combine_batches, INDEX_SCHEMA)
            .repartition(shards, "digest").mapInArrow(_index_shard, INDEX_SCHEMA))


def update_index(index: DataFrame, inserted: DataFrame | None = None, deleted: DataFrame | None = None,
                 remaining: DataFrame | None = None) -> DataFrame:
    """Apply documents (``doc_id``, ``text``) to a live index and return the new one.

    Deletions take documents off their digest; a digest with none left leaves
    the index. The index knows digests, not their members, so the digests that
    deletions touch are built again from ``remaining``, the documents that are
    live after the update. Without it only ``n`` is lowered: ``keep_id`` may name
    a deleted document, and the deletion of an id that was never indexed takes
    off another document of equal text. Deletions of texts that are not in the
    index change nothing.
    """
    spark = index.sparkSession
    ops = index.withColumn("step", F.lit(0))
    if inserted is not None:
        ops = ops.unionByName(build_index(content_keys(inserted)).withColumn("step", F.lit(1)))
    if deleted is not None:
        ops = ops.unionByName(build_index(content_keys(deleted)).withColumn("step", F.lit(2)))
    shards = width(spark, index.count(), KEYS_PER_SHARD)

    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        live = CuckooIndex()
        gone = []
        for b in batches:
            df = b.to_pandas()
            gone.extend(df.loc[df.step == 2, ["digest", "n"]].itertuples(index=False))
            rows = df[df.step < 2].drop(columns="step")
            if len(rows):
                live.insert_batch(_combined(rows))
        for digest, n in gone:
            live.delete(digest, int(n))
        yield from live.batches()

    updated = ops.repartition(shards, "digest").mapInArrow(shard, INDEX_SCHEMA)
    if deleted is None or remaining is None:
        return updated
    touched = write_table(content_keys(deleted).select("digest").distinct(), "exact-touched")
    again = build_index(content_keys(remaining).join(touched, "digest", "left_semi"))
    return updated.join(touched, "digest", "left_anti").select(*index.columns).unionByName(again)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the largest id stays. Null text counts as the
    empty text. A null id sorts below every id; a group of null ids only keeps
    one row and reports a null keep_id. Rows repeated with the same id and text
    all count in group_size and exactly one of them is kept. Other columns of
    the input are not read. An empty table gives an empty result.
    """
    keys = write_table(content_keys(docs, id_col, text_col), "exact-keys")
    return _verdicts(keys, build_index(keys))


def _verdicts(keys: DataFrame, index: DataFrame) -> DataFrame:
    """Only texts with several rows need the join; the side of copies may be hot,
    and a plain join lets Spark split it."""
    groups = index.filter("n > 1").select("digest", "n", F.col("keep_id").alias("top"), "keep_rows")
    groups = write_table(groups, "exact-groups")
    joined = keys.select("doc_id", "digest").join(groups, "digest", "left")
    is_top = F.coalesce(F.coalesce("doc_id", F.lit(NO_ID)) == F.col("top"), F.lit(True))
    tied = is_top & (F.coalesce("keep_rows", F.lit(1)) > 1)
    cols = [F.col("doc_id"),
            F.when(F.col("n").isNull(), F.col("doc_id")).when(F.col("top") != NO_ID, F.col("top")).alias("keep_id"),
            F.coalesce("n", F.lit(1)).cast("long").alias("group_size")]
    sha = F.lower(F.hex("digest")).alias("text_sha256")
    single = joined.filter(~tied).select(*cols, is_top.alias("kept"), sha)
    # rows repeated with the same id and text: the first of each run stays (rows of one run are equal)
    repeated = groups.filter("keep_rows > 1")
    again = (keys.select("doc_id", "digest").join(repeated, "digest")
             .filter(F.coalesce("doc_id", F.lit(NO_ID)) == F.col("top")))
    copy = F.row_number().over(Window.partitionBy("digest", "doc_id").orderBy("digest"))
    tied_rows = again.withColumn("copy", copy).select(*cols, (F.col("copy") == 1).alias("kept"), sha)
    return single.unionByName(tied_rows)


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that :func:`exact_dedup` keeps."""
    verdict = exact_dedup(docs, id_col, text_col).filter("kept")
    kept = verdict.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), F.col("text_sha256").alias("sha"))
    rows = wrapped(docs, id=F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)), sha=F.sha2(whole_text(text_col), 256))
    return one_row_each(rows, kept, ["id", "sha"])
