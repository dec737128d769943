"""Document scores by masked pseudo-likelihood.

Tokens are the bytes of the UTF-8 text, all 256 of them. A small network sees two
places on either side of a masked one and predicts the byte in between; a
document's score is the sum over all its places of the log-probability of what is
really there, given both sides.

The output is a two-level softmax: first the class of the byte (``byte_classes``:
a letter is a class of its own, all capitals are one, all digits one, ...), then the
byte within its class, both from the same hidden layer. What the network sees of the
places around is their classes, not their bytes.

Training. Windows of all documents are counted: within each task, then by
replica and window, so what is gathered grows with the corpus and no document
is left out. Each replica holds a random share of the documents, of about
``REPLICA_BYTES`` of text, and trains the network on its counts with numpy; after each
round the replicas' weights are averaged in Spark (weighted by their windows) and the
next round starts from there.

Scoring. The hidden layer depends only on the four classes around a place (24 bits),
so a worker evaluates each surrounding it meets once and looks it up afterwards; the
sums are those of evaluating the network everywhere. Texts are scored where they are
read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windlass.llm.byte_classes import EDGE, SIZE, TABLE, positions, segment_sums
from windlass.llm.common import whole_text, write_table

SIDE = 2  # places seen on each side
HIDDEN = 32
LEAST_REPLICAS = 8
REPLICA_BYTES = 64_000_000  # of text, about; a replica has no more different windows
ROUNDS = 3
PASSES = 2  # over a replica's counts, per round
BATCH = 2048
RATE = 0.01
BITS = 6  # per class in a window code
MAX_HELD = 2_600_000  # counted windows that a counting task holds
CHUNK_BYTES = 500_000  # of text that a task works on at once
MAX_KNOWN = 200_000  # surroundings a worker keeps; emptied when full

CLASS = np.frombuffer(TABLE, dtype=np.uint8).astype(np.int64)  # of each byte
MEMBERS = [np.flatnonzero(CLASS == c) for c in range(SIZE)]  # bytes of each class
SHARED = [c for c in range(SIZE) if len(MEMBERS[c]) > 1]  # classes of more than one byte
SHAPES = [(2 * SIDE, SIZE, HIDDEN), (HIDDEN,), (HIDDEN, SIZE), (SIZE,), (HIDDEN, 256), (256,)]


def places(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes and classes of all texts in a row, with ``SIDE`` edge marks (class 0) around
    each; the places of the texts' bytes in that row and the texts' lengths."""
    mark = bytes(SIDE)
    raw = b"".join(mark + t + mark for t in texts)
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    starts = np.r_[0, np.cumsum(lengths + 2 * SIDE)[:-1]].astype(np.int64) + SIDE
    at = positions(starts, lengths)
    data = np.frombuffer(raw, dtype=np.uint8)
    row = np.zeros(len(data), dtype=np.uint8)  # edge marks stay class 0, whatever byte 0 is
    row[at] = CLASS[data[at]]
    return data, row, at, lengths


def log_softmax(z: np.ndarray) -> np.ndarray:
    z = z - z.max(axis=1, keepdims=True)
    return z - np.log(np.exp(z).sum(axis=1, keepdims=True))


class WindowNetwork:
    """Embedding table per place of the window, one hidden layer, softmax over the classes and
    over the bytes of each class."""

    def __init__(self, weights: list[np.ndarray] | None = None, seed: int = 5):
        if weights is None:
            r = np.random.default_rng(seed)
            weights = [r.normal(0, 0.3, s) if len(s) > 1 else np.zeros(s) for s in SHAPES]
        self.weights = [np.asarray(w, dtype=np.float32) for w in weights]

    def hidden(self, around: np.ndarray) -> np.ndarray:
        tables, bias = self.weights[:2]
        total = tables[0][around[:, 0]] + bias
        for k in range(1, 2 * SIDE):
            total += tables[k][around[:, k]]
        return np.tanh(total)

    def class_logs(self, hidden: np.ndarray) -> np.ndarray:
        z = hidden @ self.weights[2] + self.weights[3]
        z[:, EDGE] = -1e30  # the edge of a text is seen, never predicted
        return log_softmax(z)

    def byte_logs(self, hidden: np.ndarray, c: int) -> np.ndarray:
        """Log-probabilities of the bytes of class ``c``, given the class, in order of the byte."""
        return log_softmax(hidden @ self.weights[4][:, MEMBERS[c]] + self.weights[5][MEMBERS[c]])

    def log_probs(self, around: np.ndarray) -> np.ndarray:
        """Log-probabilities of all 256 bytes."""
        h = self.hidden(around)
        out = self.class_logs(h)[:, CLASS]
        for c in SHARED:
            out[:, MEMBERS[c]] += self.byte_logs(h, c)
        return out

    def train(self, around: np.ndarray, target: np.ndarray, weight: np.ndarray, seed: int) -> None:
        """Adam on weighted cross-entropy, ``PASSES`` over the rows in random order."""
        r = np.random.default_rng(seed)
        first = [np.zeros_like(w) for w in self.weights]
        second = [np.zeros_like(w) for w in self.weights]
        step = 0
        share = (weight / weight.mean()).astype(np.float32)
        is_shared = np.isin(CLASS, SHARED)
        peers = (CLASS[:, None] == CLASS[None, :]) & is_shared[:, None]  # bytes of the same class
        for _ in range(PASSES):
            order = r.permutation(len(target))
            for lo in range(0, len(order), BATCH):
                rows = order[lo:lo + BATCH]
                x, y, w = around[rows], target[rows], share[rows]
                w = w / max(float(w.sum()), 1e-9)
                h = self.hidden(x)
                p = np.exp(self.class_logs(h))
                p[np.arange(len(rows)), CLASS[y]] -= 1
                p *= w[:, None]
                some = np.flatnonzero(is_shared[y])  # rows whose class does not say the byte
                z = np.where(peers[y[some]], h[some] @ self.weights[4] + self.weights[5], -np.inf)
                q = np.exp(z - z.max(axis=1, keepdims=True)) if len(some) else np.zeros((0, 256), np.float32)
                q /= np.maximum(q.sum(axis=1, keepdims=True), 1e-9)
                q[np.arange(len(some)), y[some]] -= 1
                q = (q * w[some, None]).astype(np.float32)
                back = p @ self.weights[2].T
                back[some] += q @ self.weights[4].T
                back *= 1 - h * h
                tables = np.zeros_like(self.weights[0])
                for k in range(2 * SIDE):
                    pick = np.zeros((len(rows), SIZE), dtype=np.float32)
                    pick[np.arange(len(rows)), x[:, k]] = 1
                    tables[k] = pick.T @ back
                step += 1
                slopes = (tables, back.sum(axis=0), h.T @ p, p.sum(axis=0), h[some].T @ q, q.sum(axis=0))
                for k, g in enumerate(slopes):
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.999 * second[k] + 0.001 * g * g
                    self.weights[k] -= RATE * (first[k] / (1 - 0.9 ** step)) / (
                        np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)

    def vector(self) -> np.ndarray:
        return np.concatenate([w.ravel() for w in self.weights]).astype(np.float64)

    @classmethod
    def from_vector(cls, flat: np.ndarray) -> WindowNetwork:
        edges = np.cumsum([0, *(int(np.prod(s)) for s in SHAPES)])
        return cls([flat[a:b].reshape(s) for a, b, s in zip(edges[:-1], edges[1:], SHAPES, strict=True)])


def surroundings(row: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Code of the classes around each place, nearest on the left lowest."""
    code = np.zeros(len(at), dtype=np.int64)
    for k, offset in enumerate((-1, 1, -2, 2)):
        code |= row[at + offset].astype(np.int64) << (BITS * k)
    return code


def unpack(codes: np.ndarray) -> np.ndarray:
    return np.stack([(codes >> (BITS * k)) & ((1 << BITS) - 1) for k in range(2 * SIDE)], axis=1)


def _chunks(b: pa.RecordBatch, column: int, size: int = CHUNK_BYTES):
    """Slices of a batch of about ``size`` bytes of text, with their texts as bytes."""
    ends = np.cumsum(pc.binary_length(b.column(column).cast(pa.large_binary())).to_numpy(zero_copy_only=False))
    lo = 0
    while lo < b.num_rows:
        done = int(ends[lo - 1]) if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, done + size, "right")))
        part = b.slice(lo, hi - lo)
        yield part, part.column(column).cast(pa.binary()).to_pylist()
        lo = hi


def _added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Counts by key of several (keys, counts), sorted by key."""
    keys, n = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[first], np.add.reduceat(n, first)


def replicas_for(size: int) -> int:
    return max(LEAST_REPLICAS, -(-size // REPLICA_BYTES))


def window_counts(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", replicas: int = LEAST_REPLICAS) -> DataFrame:
    """(replica, code, n) over all documents; code holds the surroundings and, above them, the byte itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        waiting = 0  # rows in held

        def out():
            keys, n = _added(held)
            for lo in range(0, len(keys), 50_000):
                k = keys[lo:lo + 50_000]
                yield pa.RecordBatch.from_arrays([pa.array(k >> 32), pa.array(k & 0xFFFFFFFF), pa.array(n[lo:lo + 50_000])],
                                                 names=["replica", "code", "n"])
            held.clear()

        for b in batches:
            for part, texts in _chunks(b, 1):
                data, row, at, lengths = places(texts)
                code = surroundings(row, at) | (data[at].astype(np.int64) << (BITS * 2 * SIDE))
                code |= np.repeat(part.column(0).to_numpy(), lengths) << 32
                code.sort()
                first = np.flatnonzero(np.r_[True, code[1:] != code[:-1]]) if len(code) else code
                if len(first):
                    held.append((code[first], np.diff(np.r_[first, len(code)])))
                    waiting += len(first)
                if waiting > MAX_HELD:
                    held[:] = [_added(held)]
                    waiting = len(held[0][0])
                    if waiting > 3 * MAX_HELD // 4:  # hardly a window repeats: no use in holding them
                        yield from out()
                        waiting = 0
        if held:
            yield from out()

    replica = F.pmod(F.xxhash64(F.col(id_col).cast("long"), whole_text(text_col)), F.lit(replicas))
    rows = docs.select(replica.alias("replica"), whole_text(text_col).alias("text"))
    return rows.mapInArrow(run, "replica long, code long, n long").groupBy("replica", "code").agg(F.sum("n").alias("n"))


def _trainer(start: list[np.ndarray], k: int):
    def trained(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.sort_by("code")
        code, n = table["code"].to_numpy(), table["n"].to_numpy()
        own = WindowNetwork([w.copy() for w in start])
        own.train(unpack(code), code >> (BITS * 2 * SIDE), n.astype(np.float64), seed=1000 * k + int(key[0].as_py()))
        flat = own.vector()
        return pa.table({"place": np.arange(len(flat)), "w": flat * float(n.sum()), "n": np.full(len(flat), float(n.sum()))})

    return trained


def fit(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", rounds: int = ROUNDS) -> WindowNetwork:
    """Train on all documents. The replicas' weights are averaged in Spark: one vector of about
    150 KB comes to the driver per round, however many replicas there are."""
    size = docs.agg(F.sum(F.octet_length(whole_text(text_col)).cast("long"))).first()[0] or 0
    counts = write_table(window_counts(docs, text_col, id_col, replicas_for(size)), "lm-windows")
    network = WindowNetwork()
    for k in range(rounds):
        parts = (counts.groupBy("replica").applyInArrow(_trainer(network.weights, k), "place long, w double, n double")
                 .groupBy("place").agg((F.sum("w") / F.sum("n")).alias("w")).collect())
        if not parts:
            return network
        flat = np.zeros(len(parts))
        flat[[p["place"] for p in parts]] = [p["w"] for p in parts]
        network = WindowNetwork.from_vector(flat)
    return network


class KnownSurroundings:
    """The network's outputs for surroundings met so far."""

    def __init__(self, network: WindowNetwork):
        self.network = network
        self.slot = np.full(1 << (BITS * 2 * SIDE), -1, dtype=np.int32)
        self.logs = np.empty((MAX_KNOWN, SIZE), dtype=np.float32)
        self.hidden = np.empty((MAX_KNOWN, HIDDEN), dtype=np.float32)
        self.used = 0

    def _slots(self, around: np.ndarray) -> np.ndarray:
        slots = self.slot[around]
        if (slots < 0).any():
            new = np.unique(around[slots < 0])
            if self.used + len(new) > len(self.logs):
                self.slot[:], self.used = -1, 0
                new = np.unique(around)
            for lo in range(0, len(new), 20_000):
                part = new[lo:lo + 20_000]
                to = slice(self.used, self.used + len(part))
                self.hidden[to] = self.network.hidden(unpack(part))
                self.logs[to] = self.network.class_logs(self.hidden[to])
                self.slot[part] = np.arange(self.used, self.used + len(part))
                self.used += len(part)
            slots = self.slot[around]
        return slots

    def look_up(self, around: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Log-probabilities of the bytes ``target`` in the surroundings ``around``; no more
        places at a time than the table holds surroundings."""
        step = len(self.logs)
        parts = [self._some(around[lo:lo + step], target[lo:lo + step]) for lo in range(0, len(around), step)]
        return np.concatenate(parts) if parts else np.zeros(0)

    def _some(self, around: np.ndarray, target: np.ndarray) -> np.ndarray:
        slots, kind = self._slots(around), CLASS[target]
        out = self.logs[slots, kind].astype(np.float64)
        for c in SHARED:
            rows = np.flatnonzero(kind == c)
            if len(rows):
                used, back = np.unique(slots[rows], return_inverse=True)
                place = np.searchsorted(MEMBERS[c], target[rows])
                for lo in range(0, len(used), 20_000):
                    part = (back >= lo) & (back < lo + 20_000)
                    logs = self.network.byte_logs(self.hidden[used[lo:lo + 20_000]], c)
                    out[rows[part]] += logs[back[part] - lo, place[part]]
        return out


def score_with(docs: DataFrame, network: WindowNetwork, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, score, mean_log_prob) under a fitted network."""
    weights = network.weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = KnownSurroundings(WindowNetwork(weights))
        for b in batches:
            for part, texts in _chunks(b, 1):
                data, row, at, lengths = places(texts)
                logs = known.look_up(surroundings(row, at), data[at])
                total = segment_sums(logs, lengths)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(lengths), pa.array(total), pa.array(total / np.maximum(lengths, 1))],
                    names=["doc_id", "n_tokens", "score", "mean_log_prob"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), whole_text(text_col).alias("text")).mapInArrow(
        run, "doc_id long, n_tokens long, score double, mean_log_prob double")


def pseudo_likelihood(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_tokens (bytes), score (summed conditional
    log-probabilities, natural logarithm), mean_log_prob.

    Null text counts as empty; empty texts have no tokens and score 0. Texts of
    any length are scored whole. Null ids pass through, repeated rows are scored
    each and count each in training, other columns are not read, an empty table
    gives no rows.
    """
    return score_with(docs, fit(docs, text_col, id_col), id_col, text_col)
