"""Language-model scores from a weighted backoff automaton, counted and applied chunk by chunk.

The automaton has a state for every word (and one for the beginning of a text) and a root. A state has an
arc for each word seen behind it, weighted with the smoothed probability, and a failure arc to the root, weighted
with what the state leaves to unseen words; the root has an arc for every word. A text runs through it from left to
right and adds up the logarithms on its way.

The whole automaton grows with the corpus and is never in one place. Documents are dealt into chunks; a chunk
sends its distinct n-grams to be summed over the corpus and gets the totals of just these back, which is the part
of the automaton that its own documents can reach.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabweave.llm.common import byte_texts, total_bytes

CHUNK_BYTES = 12 << 20
BUCKET_BYTES = 16 << 20  # text per bucket of n-grams
STATE_WEIGHT = 0.4  # share of the counted successors in an arc; the rest is left to the root
_END = xxhash.xxh64_intdigest(b"\x00end")
_ODD = np.uint64(0x9E3779B97F4A7C15)
_LOW = np.uint64(48)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(29))


def word_keys(text: bytes) -> np.ndarray:
    """A 64-bit key per token: the words in lower case (A-Z only), then the end."""
    words = text.lower().split()
    keys = np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=np.uint64, count=len(words) + 0)
    return np.append(keys, np.uint64(_END))


class Chunk:
    """The n-grams of a chunk's documents: distinct keys, falling into buckets in order, and where they occur."""

    def __init__(self, texts: list[bytes], bits: int):
        tokens = [word_keys(t) for t in texts]
        self.lengths = np.array([len(t) for t in tokens], dtype=np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)[:-1]]).astype(np.int64)
        words = np.concatenate(tokens)
        before = np.empty_like(words)
        before[1:] = words[:-1]
        before[self.starts] = np.uint64(_END)  # a text begins where another one ends
        cut = np.uint64(max(0, 16 - bits))
        self.keys, self.at = [], []
        for keys in (_mix(words), _mix(_mix(before) * _ODD + words)):
            distinct, at = np.unique(keys >> cut, return_inverse=True)
            self.keys.append(distinct)
            self.at.append(at)
        self.bits = bits

    def counts(self, train: np.ndarray) -> list[np.ndarray]:
        """Occurrences of each distinct n-gram in the training documents."""
        weights = np.repeat(train.astype(np.float64), self.lengths)
        return [np.bincount(at, weights, len(k)).astype("<u4") for k, at in zip(self.keys, self.at, strict=True)]

    def buckets(self, order: int) -> list[tuple[int, int, int]]:
        """(bucket, from, to) over the distinct keys of one order."""
        keys = self.keys[order]
        shift = np.uint64(min(48, 64 - self.bits))
        own = (keys >> shift).astype(np.int64)
        edges = np.concatenate([[0], np.flatnonzero(np.diff(own)) + 1, [len(own)]])
        return [(int(own[a]), int(a), int(b)) for a, b in zip(edges[:-1], edges[1:], strict=True) if b > a]


def _pack(keys: np.ndarray) -> bytes:
    """The lower 48 bits of each key."""
    return np.ascontiguousarray(keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def _unpack(data: bytes) -> np.ndarray:
    wide = np.zeros((len(data) // 6, 8), dtype=np.uint8)
    wide[:, :6] = np.frombuffer(data, dtype=np.uint8).reshape(-1, 6)
    return wide.view("<u8").ravel()


def _ngram_rows(bits: int):
    def run(group: pa.Table) -> pa.Table:
        chunk = Chunk(byte_texts(group["text"].combine_chunks()), bits)
        counts = chunk.counts(group["train"].to_numpy())
        number = group["chunk"][0].as_py()
        rows = [
            (order, bucket, number, _pack(chunk.keys[order][a:b]), counts[order][a:b].tobytes())
            for order in (0, 1)
            for bucket, a, b in chunk.buckets(order)
        ]
        columns = list(zip(*rows, strict=True))
        types = (pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
        return pa.table([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["order", "bucket", "chunk", "keys", "counts"])

    return run


def _sum_bucket(group: pa.Table) -> pa.Table:
    """Totals of a bucket's n-grams, given back to each chunk in the order in which it sent them."""
    keys = [_unpack(k) for k in group["keys"].to_pylist()]
    counts = np.concatenate([np.frombuffer(c, dtype="<u4") for c in group["counts"].to_pylist()])
    distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
    sums = np.bincount(at, counts.astype(np.float64), len(distinct)).astype(np.int64)
    back = np.split(sums[at], np.cumsum([len(k) for k in keys])[:-1])
    unigrams = group["order"][0].as_py() == 0
    # The first row also says how many words and tokens the bucket has.
    extra = [0] * group.num_rows
    types, tokens = extra.copy(), extra.copy()
    if unigrams:
        types[0], tokens[0] = int(np.count_nonzero(sums)), int(sums.sum())
    return pa.table(
        {
            "chunk": group["chunk"],
            "order": group["order"],
            "bucket": group["bucket"],
            "totals": pa.array([b.astype("<u4" if b.max(initial=0) < 2**32 else "<u8").tobytes() for b in back], pa.binary()),
            "wide": pa.array([int(b.max(initial=0) >= 2**32) for b in back], pa.int32()),
            "types": pa.array(types, pa.int64()),
            "tokens": pa.array(tokens, pa.int64()),
        }
    )


def _score_chunk(bits: int, weight: float):
    def run(docs: pa.Table, totals: pa.Table) -> pa.Table:
        chunk = Chunk(byte_texts(docs["text"].combine_chunks()), bits)
        n, v = docs["tokens"][0].as_py(), docs["types"][0].as_py()
        parts: list[list[np.ndarray]] = [[], []]
        rows = sorted(totals.select(["order", "bucket", "totals", "wide"]).to_pylist(), key=lambda r: (r["order"], r["bucket"]))
        for row in rows:
            parts[row["order"]].append(np.frombuffer(row["totals"], dtype="<u8" if row["wide"] else "<u4"))
        words, pairs = (np.concatenate(p).astype(np.float64) for p in parts)
        automaton = Automaton(words, pairs, n, v, weight)
        base, score = automaton.traverse(chunk)
        known = (words > 0)[chunk.at[0]]
        return pa.table(
            {
                "doc_id": docs["doc_id"],
                "held_out": pa.array(~docs["train"].to_numpy()),
                "n_tokens": pa.array(chunk.lengths),
                "n_known": pa.array(np.add.reduceat(known.astype(np.int64), chunk.starts)),
                "train_tokens": pa.array(np.full(len(chunk.lengths), n, dtype=np.int64)),
                "base_score": pa.array(base),
                "score": pa.array(score),
            }
        )

    return run


class Automaton:
    """Arcs and failure arcs for the words and pairs of one chunk."""

    def __init__(self, words: np.ndarray, pairs: np.ndarray, tokens: int, types: int, weight: float):
        self.root = (words + 0.5) / (tokens + 0.5 * (types + 1))
        self.words, self.pairs, self.weight = words, pairs, weight

    def traverse(self, chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
        """log10 probabilities of all documents: by the root alone, and by the automaton.

        The state in front of a token is the word before it, so the steps of all documents are looked up
        together; they are added up in reading order.
        """
        word, pair = chunk.at
        state = np.empty_like(word)
        state[1:] = word[:-1]
        # The end is the last token of every text, and its state is where the next one begins.
        state[chunk.starts] = word[chunk.starts + chunk.lengths - 1]
        root = self.root[word]
        seen = self.words[state]
        # Failure arc: a state that was never seen leaves everything to the root.
        failure = np.where(seen > 0, 1.0 - self.weight, 1.0)
        step = failure * root + np.where(seen > 0, self.weight * self.pairs[pair] / np.maximum(seen, 1), 0.0)
        return np.add.reduceat(np.log10(root), chunk.starts), np.add.reduceat(np.log10(step), chunk.starts)


def score_corpus(
    docs: DataFrame,
    train: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    weight: float = STATE_WEIGHT,
    chunk_bytes: int = CHUNK_BYTES,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for every row.

    The model learns from rows where ``train`` holds and scores all. ``base_score`` is the add-half unigram model, which
    is also the root of the automaton. A null text is empty and consists of the end token. Null or repeated ids
    are rows like any other; an empty table gives no rows; other columns are not read. Without training rows
    every token has the same probability.

    The texts move once, into chunks; both passes read that exchange. Each chunk sends every distinct n-gram once,
    48 bits under a bucket number, and gets one total per n-gram back. Chunks and buckets grow in number, not in
    size. Words and pairs are told apart by hashes that get longer with the number of buckets.
    """
    size = total_bytes(docs, text_col)
    chunks = max(1, -(-size // chunk_bytes))
    bits = max(0, (max(1, -(-size // bucket_bytes)) - 1).bit_length())
    text = F.col(text_col).cast("string")
    dealt = docs.select(
        F.pmod(F.xxhash64(F.col(id_col).cast("long"), text), F.lit(chunks)).alias("chunk"),
        F.col(id_col).cast("long").alias("doc_id"),
        text.alias("text"),
        F.coalesce(train, F.lit(False)).alias("train"),
    ).repartition("chunk")
    sent = dealt.groupBy("chunk").applyInArrow(
        _ngram_rows(bits), "order int, bucket long, chunk long, keys binary, counts binary"
    )
    summed = sent.groupBy("order", "bucket").applyInArrow(
        _sum_bucket, "chunk long, order int, bucket long, totals binary, wide int, types long, tokens long"
    )
    sums = summed.agg(F.struct(F.sum("types").alias("types"), F.sum("tokens").alias("tokens")).alias("s"))
    known = dealt.withColumn("sums", sums.scalar()).select("chunk", "doc_id", "text", "train", "sums.*")
    return (
        known.groupBy("chunk")
        .cogroup(summed.select("chunk", "order", "bucket", "totals", "wide").groupBy("chunk"))
        .applyInArrow(
            _score_chunk(bits, weight),
            "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
        )
    )
