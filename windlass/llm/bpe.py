"""Byte-level BPE by prefix dynamic programming.

For every prefix of a piece of text, its BPE encoding has one last token. The
table of these last tokens describes the encodings of all prefixes: the
encoding of the whole is read off backwards. The last token of a prefix is the
one token that (a) ends the prefix, (b) encodes to itself, and (c) follows the
last token of what comes before it without the two being merged differently,
that is, encoding both together gives the same two tokens. Exactly one token
passes, so the table is built left to right, and appending bytes never changes
an entry already there. After an edit only the entries from the edit on, inside
the pieces it touches, are computed again (:class:`IncrementalText`).

Text is cut into pieces by the tokenizer's pattern, each encoded separately; a
piece that is itself in the vocabulary is that one token.

As a Spark job there is no exchange: rows stream through Arrow batches. Each
Python worker keeps bounded tables of pieces it has met; they are only a
shortcut and are emptied when full.
"""

from __future__ import annotations

import base64
import functools
import hashlib
from array import array
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windlass.llm.common import KnownValues, whole_text

MAX_KNOWN = 600_000  # entries of each of a worker's shortcut tables
NEVER = 1 << 40  # above every rank


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


class PrefixEncoder:
    """BPE of single pieces by the last-token table of their prefixes."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {i: t for t, i in ranks.items()}
        matcher = ahocorasick.Automaton()  # finds all tokens that end at each byte
        for token, i in ranks.items():
            matcher.add_word(token.decode("latin-1"), (len(token), i))
        matcher.make_automaton()
        self._tokens_in = matcher.iter
        self._built: dict[int, tuple | None] = {}
        self._pairs: dict[tuple[int, int], bool] = {}

    def merge(self, data: bytes) -> list[int]:
        """BPE by its definition: merge the adjacent pair of lowest rank, leftmost first. Short inputs only."""
        parts = [data[i:i + 1] for i in range(len(data))]
        ranks = self.ranks
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                r = ranks.get(parts[i] + parts[i + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return [ranks[p] for p in parts]

    def _spines(self, token: int):
        """How a token is built, as seen from its two edges: for each edge the
        parts that touch it one after the other, each with the rank of the merge
        that ends it. None if the token's bytes don't encode to itself."""
        if token in self._built:
            return self._built[token]
        ranks, data = self.ranks, self.bytes_of[token]
        parts = [data[i:i + 1] for i in range(len(data))]
        left, right = [], []
        while len(parts) > 1:
            options = [(r, i) for i in range(len(parts) - 1)
                       if (r := ranks.get(parts[i] + parts[i + 1])) is not None]
            if not options:
                break
            rank, at = min(options)
            if at == 0:
                left.append((parts[0], rank))
            if at == len(parts) - 2:
                right.append((parts[-1], rank))
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        spines = None
        if parts == [data]:
            spines = left + [(data, NEVER)], right + [(data, NEVER)]
        self._built[token] = spines
        return spines

    def stands_alone(self, token: int) -> bool:
        return self._spines(token) is not None

    def may_follow(self, left: int, right: int) -> bool:
        """Whether two tokens stay apart when their bytes are encoded together:
        at no time do the parts that touch the seam merge before one of them is
        used up by a merge on its own side (of equal ranks the left one is first)."""
        known = self._pairs.get((left, right))
        if known is not None:
            return known
        if len(self._pairs) >= MAX_KNOWN:
            self._pairs.clear()
        before, after = self._spines(left)[1], self._spines(right)[0]
        i = j = 0
        apart = True
        while True:
            (a, a_end), (b, b_end) = before[i], after[j]
            rank = self.ranks.get(a + b)
            if rank is not None and rank < a_end and rank <= b_end:
                apart = False
                break
            if a_end is NEVER and b_end is NEVER:
                break
            if a_end <= b_end:
                i += 1
            else:
                j += 1
        self._pairs[left, right] = apart
        return apart

    def extend(self, data: bytes, last: list[int]) -> list[int]:
        """Fill the table of ``data``: ``last[i]`` is the last token of ``data[:i + 1]``.
        Entries already in ``last`` hold for a prefix of ``data`` and stay."""
        known, done = self._pairs, len(last)
        text = data.decode("latin-1")
        for end, (size, token) in self._tokens_in(text):
            if end < done:
                continue
            start = end + 1 - size
            if end > done:
                raise ValueError("the vocabulary lacks single bytes")
            if start:
                apart = known.get((last[start - 1], token))
                if apart is None:
                    apart = self.stands_alone(token) and self.may_follow(last[start - 1], token)
                if not apart:
                    continue
            elif not self.stands_alone(token):
                continue
            last.append(token)
            done += 1
        if done < len(data):
            raise ValueError("the vocabulary lacks single bytes")
        return last

    def read_off(self, last: list[int]) -> list[int]:
        """The encoding that a table of last tokens stands for."""
        out, at = [], len(last)
        while at:
            token = last[at - 1]
            out.append(token)
            at -= len(self.bytes_of[token])
        return out[::-1]

    def encode_piece(self, data: bytes) -> list[int]:
        token = self.ranks.get(data)
        return [token] if token is not None else self.read_off(self.extend(data, []))

    def decode(self, ids) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


class IncrementalText:
    """A text with the last-token tables of its pieces, for exact appends and edits."""

    def __init__(self, encoder: PrefixEncoder, pattern: str, text: str = ""):
        self.encoder, self.pattern = encoder, regex.compile(pattern)
        self.pieces: list[str] = []
        self.tables: list[list[int]] = []
        self._set(0, [], self.pattern.findall(text))

    @property
    def text(self) -> str:
        return "".join(self.pieces)

    def ids(self) -> list[int]:
        out: list[int] = []
        for piece, table in zip(self.pieces, self.tables, strict=True):
            token = self.encoder.ranks.get(piece.encode())
            out.extend([token] if token is not None else self.encoder.read_off(table))
        return out

    def _set(self, at: int, old: list[str], new: list[str]) -> None:
        """Replace pieces ``old`` at index ``at``; a table is reused as far as its piece's bytes stay."""
        tables = []
        for k, piece in enumerate(new):
            data, start = piece.encode(), []
            if k < len(old):
                before = old[k].encode()
                same = next((i for i, (a, b) in enumerate(zip(before, data)) if a != b),  # noqa: B905
                            min(len(before), len(data)))
                start = self.tables[at + k][:same]
            tables.append(self.encoder.extend(data, start))
        self.pieces[at:at + len(old)] = new
        self.tables[at:at + len(old)] = tables

    def append(self, more: str) -> None:
        self.replace(sum(map(len, self.pieces)), 0, more)

    def replace(self, start: int, removed: int, inserted: str) -> None:
        """Replace ``removed`` characters at ``start``. Pieces are cut anew from
        the one before the edit until the new cuts meet the old ones again."""
        at = first = 0
        while at < len(self.pieces) and first + len(self.pieces[at]) < start:
            first += len(self.pieces[at])
            at += 1
        while at and first:  # the piece before may look ahead into the edit
            at -= 1
            first -= len(self.pieces[at])
            if not self.pieces[at].isspace():
                break
        old_text = "".join(self.pieces[at:])
        cut = start - first
        new_text = old_text[:cut] + inserted + old_text[cut + removed:]
        shift = len(inserted) - removed
        ends, pos = {}, 0
        for k, piece in enumerate(self.pieces[at:]):
            ends[pos] = k
            pos += len(piece)
        new, pos = [], 0
        for m in self.pattern.finditer(new_text):
            if pos >= cut + len(inserted) and pos - shift in ends and pos - shift >= cut + removed:
                break
            new.append(m[0])
            pos = m.end()
        else:
            self._set(at, self.pieces[at:], new)
            return
        self._set(at, self.pieces[at:at + ends[pos - shift]], new)


class TextEncoder:
    """Ids of whole texts as little-endian unsigned 32-bit integers."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.encoder = PrefixEncoder(ranks)
        self.split = regex.compile(pattern).findall
        # white space next to a space: then cutting at that space might cut a piece
        self.crowded = regex.compile(r"\s | \s|^\s|\s$").search
        self._piece = KnownValues(lambda piece: array("I", self.encoder.encode_piece(piece.encode())).tobytes(), MAX_KNOWN)
        self._spaced = KnownValues(lambda word: self._pieces(" " + word), MAX_KNOWN)

    def _pieces(self, text: str) -> bytes:
        return b"".join(map(self._piece.__getitem__, self.split(text)))

    def encode(self, text: str) -> bytes:
        """A single space between other characters always starts a piece, so
        such texts are looked up word by word."""
        if self.crowded(text):
            return self._pieces(text)
        first, *words = text.split(" ")
        return self._pieces(first) + b"".join(map(self._spaced.__getitem__, words))


@functools.lru_cache(maxsize=2)
def text_encoder(rank_file: str, pattern: str) -> TextEncoder:
    """One per Python worker; its tables serve all tasks the worker runs."""
    return TextEncoder(load_ranks(rank_file), pattern)


def encode_decode(docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
                  with_ids: bool = False) -> DataFrame:
    """Per row: doc_id, n_tokens, ids_sha256 (ids as little-endian unsigned 32-bit
    integers), decoded_sha256 (bytes got by decoding the ids); with ``with_ids``
    also ids (array) and decoded (binary).

    Null text counts as empty and has no tokens. Texts of any length are encoded
    whole. Null ids pass through, repeated rows give repeated results, other
    columns are not read, an empty table gives an empty result. The rank file
    must be readable under the same path on every executor.
    """
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    if with_ids:
        schema += ", ids array<long>, decoded binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            enc = text_encoder(rank_file, pattern)
            n, ids_sha, dec_sha, all_ids, all_dec = [], [], [], [], []
            for text in b.column(1):
                raw = enc.encode(text.as_py())
                ids = array("I", raw)
                decoded = enc.encoder.decode(ids)
                n.append(len(ids))
                ids_sha.append(hashlib.sha256(raw).hexdigest())
                dec_sha.append(hashlib.sha256(decoded).hexdigest())
                if with_ids:
                    all_ids.append(ids.tolist())
                    all_dec.append(decoded)
            cols = [b.column(0), pa.array(n, pa.int64()), pa.array(ids_sha), pa.array(dec_sha)]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                cols += [pa.array(all_ids, pa.list_(pa.int64())), pa.array(all_dec, pa.binary())]
                names += ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), whole_text(text_col).alias("text")).mapInArrow(run, schema)
