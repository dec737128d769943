"""Packing of tokenised documents into fixed-length training sequences.

Documents are dealt at random to groups of about ``GROUP_DOCS``, or fewer where they
are long (``GROUP_BYTES``); each group is packed by itself in one task:

1. A document longer than a sequence gives full sequences and one rest.
2. Rests and short documents are placed first-fit decreasing: longest first,
   each into the first open sequence with room. A tournament tree over the free
   room of the sequences finds that one in logarithmic time.
3. What is still open is closed up: the emptiest sequences are taken apart and
   cut to fill the gaps of the fullest, so at most one sequence of a group
   stays short. Its length is written as a sum of powers of two, as sequences
   of such lengths need no padding.

The token ids travel with the document (16 bits each where the vocabulary
allows), so texts are tokenised once. Groups are dealt by a hash of the row's
place, not by its content, so no source, text or repeated id makes a group
large; their number grows with the rows.
"""

from __future__ import annotations

import functools
import json
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windlass.llm.common import whole_text, width

SEQUENCE = 2048
END_ID = 1
GROUP_DOCS = 1000
GROUP_BYTES = 32_000_000  # of text in a group, about; long documents make more groups
MAX_KNOWN = 1_400_000  # words a worker keeps, in two generations of half as many
LONG_WORD = 64  # characters; longer words are encoded each time and never kept

PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
          "padded_length long")


# characters whose words need no normalisation beyond str.lower(), and their pre-tokens
_LETTERS = "a-zA-Z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"
_SIGNS = "!-/:-@\\[-`{-~"
_PLAIN = re.compile(f"[{_LETTERS}0-9{_SIGNS}]*").fullmatch
_PARTS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[0-9]|[{_SIGNS}]+").findall
WORD_END = b"\xff"  # stands for the word-end mark; no byte of UTF-8


class WordTokenizer:
    """Ids of whole texts with a tokenizer that drops white space.

    Its pre-tokenizer never joins across a space and its normaliser treats
    characters one by one there, so the ids of a text are those of its
    space-separated words in a row. Words are looked up. Unknown ones of plain
    Latin characters are merged by ``tiktoken`` with the file's own merges (the
    word-end mark as a byte of its own); all others go to ``tokenizers``.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.dtype = np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32
        self.known: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        suffix = model["end_of_word_suffix"]
        byte_of = {c: b for b, c in _byte_alphabet().items()}

        def raw(token: str) -> bytes:
            end = token.endswith(suffix) and token != suffix
            return bytes(byte_of[c] for c in (token[:-len(suffix)] if end else token)) + WORD_END * end

        ranks = {bytes([b]): b for b in range(256)}
        ranks |= {bytes([b]) + WORD_END: 256 + b for b in range(255)}
        for a, b in (m if isinstance(m, list) else m.split(" ") for m in model["merges"]):
            ranks.setdefault(raw(a) + raw(b), len(ranks))
        ids = {raw(t): i for t, i in model["vocab"].items() if all(c in byte_of for c in t.removesuffix(suffix))}
        self.id_of = np.zeros(len(ranks) + 1, dtype=self.dtype)
        for token, rank in ranks.items():
            self.id_of[rank] = ids.get(token, 0)
        self.merges = tiktoken.Encoding("words", pat_str=".+", mergeable_ranks=ranks, special_tokens={})

    def _words(self, words: list[str]) -> None:
        known, merge, other = self.known, self.merges._encode_single_piece, []
        plain, flat, ends = [], [], []
        for w in words:
            if _PLAIN(w):
                for part in _PARTS(w.lower()):
                    flat.extend(merge(part.encode() + WORD_END))
                plain.append(w)
                ends.append(len(flat))
            else:
                other.append(w)
        blob, at, wide = self.id_of[np.array(flat, dtype=np.int64)].tobytes(), 0, self.dtype().itemsize
        for w, end in zip(plain, ends, strict=True):
            known[w] = blob[at:end * wide]
            at = end * wide
        for w, e in zip(other, self.tokenizer.encode_batch_fast(other, add_special_tokens=False), strict=True):
            known[w] = np.array(e.ids, dtype=self.dtype).tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.known) >= MAX_KNOWN // 2:  # what is used goes on into the new generation
            self.old, self.known = self.known, {}
        split = [t.replace("\n", " ").split(" ") for t in texts]
        missing = set().union(*split).difference(self.known) if split else set()
        old = self.old
        self.known.update([(w, old[w]) for w in missing if w in old])
        missing = [w for w in missing if w not in old]
        for lo in range(0, len(missing), 10_000):
            self._words(missing[lo:lo + 10_000])
        ids = self.known.__getitem__
        out = [b"".join(map(ids, words)) for words in split]
        for w in missing:
            if len(w) > LONG_WORD:
                del self.known[w]
        return out


def _byte_alphabet() -> dict[int, str]:
    """The printable stand-ins of byte-level vocabularies: printable Latin-1 bytes
    stand for themselves, the others for the characters from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(0x100 + k) for k, b in enumerate(hidden)}


@functools.lru_cache(maxsize=2)
def word_tokenizer(path: str) -> WordTokenizer:
    """One per Python worker; its table of words serves all tasks the worker runs."""
    return WordTokenizer(path)


class RoomTree:
    """Tournament tree over the free room of bins: finds the first bin with room for an item."""

    def __init__(self, bins: int, room: int):
        self.leaves = 1 << max(0, (bins - 1).bit_length())
        self.tree = [room] * (2 * self.leaves)

    def place(self, size: int) -> int:
        """Put ``size`` into the first bin that has room, and return its number."""
        tree, at = self.tree, 1
        if tree[1] < size:
            raise ValueError("no bin has room")
        while at < self.leaves:
            at *= 2
            if tree[at] < size:
                at += 1
        bin_no = at - self.leaves
        tree[at] -= size
        at //= 2
        while at:
            top = max(tree[2 * at], tree[2 * at + 1])
            if tree[at] == top:
                break
            tree[at] = top
            at //= 2
        return bin_no


def first_fit_decreasing(sizes: list[int], room: int) -> list[int]:
    """Bin of each item; ties in size go by position."""
    order = sorted(range(len(sizes)), key=lambda i: (-sizes[i], i))
    tree, out = RoomTree(max(1, len(sizes)), room), [0] * len(sizes)
    for i in order:
        out[i] = tree.place(sizes[i])
    return out


def close_up(bins: list[list[list[int]]], room: int) -> list[list[list[int]]]:
    """Fill the gaps of the fullest bins with cuts from the emptiest; pieces are [item, start, length].
    Of the bins returned, all are full but those at the end, whose lengths are powers of two."""
    used = [sum(p[2] for p in b) for b in bins]
    order = sorted(range(len(bins)), key=lambda i: (-used[i], i))
    lo, hi = 0, len(order) - 1
    while lo < hi:
        target, donor = order[lo], order[hi]
        gap = room - used[target]
        if not gap:
            lo += 1
            continue
        piece = bins[donor][-1]
        take = min(gap, piece[2])
        bins[target].append([piece[0], piece[1], take])
        piece[1] += take
        piece[2] -= take
        if not piece[2]:
            bins[donor].pop()
        used[target] += take
        used[donor] -= take
        if not used[donor]:
            hi -= 1
    full = [bins[i] for i in order if used[i] == room]
    rest = [p for i in order if 0 < used[i] < room for p in bins[i]]
    left = sum(p[2] for p in rest)
    while left:
        size = 1 << (left.bit_length() - 1)
        part, need = [], size
        while need:
            piece = rest[0]
            take = min(need, piece[2])
            part.append([piece[0], piece[1], take])
            piece[1] += take
            piece[2] -= take
            need -= take
            if not piece[2]:
                rest.pop(0)
        full.append(part)
        left -= size
    return full


def pack_group(lengths: list[int], room: int = SEQUENCE) -> list[list[list[int]]]:
    """Sequences of pieces [document index, start, length] that hold every token once."""
    sequences, items = [], []
    for i, n in enumerate(lengths):
        whole = n - n % room
        sequences.extend([[i, start, room]] for start in range(0, whole, room))
        if n > whole:
            items.append([i, whole, n - whole])
    placed = first_fit_decreasing([it[2] for it in items], room)
    bins: list[list[list[int]]] = [[] for _ in range(max(placed, default=-1) + 1)]
    for it, b in zip(items, placed, strict=True):
        bins[b].append(it)
    return sequences + close_up(bins, room)


def padded(length: int, room: int) -> int:
    return length if length & (length - 1) == 0 else room


def pack_documents(docs: DataFrame, tokenizer_file: str, id_col: str = "doc_id", text_col: str = "text",
                   room: int = SEQUENCE, end_id: int = END_ID, group_docs: int = GROUP_DOCS) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset, padded_length (of its sequence).

    Null and empty texts have one token, the end id. Each token of each row lies
    in exactly one piece, repeated rows each by themselves (so a doc_id given on
    several rows has the pieces of all of them). Null ids pass through; other
    columns are not read; an empty table gives an empty result. Offsets in a
    sequence run without gaps from 0.
    """
    spark = docs.sparkSession
    rows, size = docs.agg(F.count(F.lit(1)), F.sum(F.octet_length(whole_text(text_col)).cast("long"))).first()
    groups = max(1, round(rows / group_docs), -(-(size or 0) // GROUP_BYTES))

    def tokenised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, place = word_tokenizer(tokenizer_file), 0
        part = TaskContext.get().partitionId()
        for b in batches:
            for lo in range(0, b.num_rows, 500):
                c = b.slice(lo, 500)
                end = np.array([end_id], dtype=tok.dtype).tobytes()
                ids = [x + end for x in tok.encode(c.column(1).to_pylist())]
                deal = np.random.default_rng([part, place]).integers(0, groups, c.num_rows)
                place += c.num_rows
                yield pa.RecordBatch.from_arrays(
                    [pa.array(deal, pa.int64()), c.column(0), pa.array(ids, pa.binary()),
                     pa.array([tok.dtype().itemsize] * c.num_rows, pa.int32())],
                    names=["grp", "doc_id", "ids", "wide"])

    def packed(df: pd.DataFrame) -> pd.DataFrame:
        df = df.sort_values(["doc_id", "ids"], kind="stable", na_position="first")
        group, wide = int(df["grp"].iloc[0]), int(df["wide"].iloc[0])
        blobs, doc_ids = df["ids"].tolist(), df["doc_id"].tolist()
        lengths = [len(x) // wide for x in blobs]
        out = []
        for k, seq in enumerate(pack_group(lengths, room)):
            offset, size = 0, padded(sum(p[2] for p in seq), room)
            for i, start, n in seq:
                ids = np.frombuffer(blobs[i], dtype=f"<u{wide}", count=n, offset=start * wide).astype("<u4")
                out.append((doc_ids[i], start, n, zlib.crc32(ids.tobytes()), lengths[i], (group << 32) + k, offset, size))
                offset += n
        res = pd.DataFrame(out, columns=[c.split()[0] for c in PIECES.split(", ")])
        res["doc_id"] = res["doc_id"].astype("Int64")
        return res

    parts = width(spark, groups, 5)
    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), whole_text(text_col).alias("text"))
            .mapInArrow(tokenised, "grp long, doc_id long, ids binary, wide int")
            .repartition(parts, "grp").groupBy("grp").applyInPandas(packed, PIECES))
