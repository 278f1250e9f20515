"""Repeated passages by prefix-free parsing.

Rolling-hash triggers cut every text into phrases: the trigger of a position is the smallest hash of a short window
among those inside the 200 bytes that begin there, so equal 200-byte strings have the same trigger at the same
place. A phrase is a trigger with all 200-byte strings that belong to it; phrases overlap so that no string
is lost, and none is a prefix of another phrase of its trigger's place. The dictionary holds each phrase once; the parse
is the list of phrases of all texts.

A phrase that occurs twice is repeated as a whole, which settles most of a repetitive corpus without looking inside.
Only triggers that begin different phrases need the order of the dictionary: their phrases are sorted by suffix, and
neighbours that share 200 bytes are repeated. Back in the parse, the marks become byte ranges of the texts.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabweave.llm.common import byte_texts, give_back, small_slices
from tabweave.storage import stage

LENGTH = 200
LONGEST = 0xFFFF  # places keep the strings of a phrase in 16 bits
TRIGGER = 48
CROWDED = 4_000  # phrases of one trigger beyond this are compared as single strings, spread over tasks
_SEGMENT = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTES = np.array([(pow(0xD1342543DE82EF95, i + 1, 1 << 64) ^ (i * 0x2545F4914F6CDD1D % (1 << 64))) | 1 for i in range(256)], dtype=np.uint64)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(29))


_made: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """base to the power 0 to n - 1, modulo 2 ** 64."""
    if base not in _made or len(_made[base]) < n:
        out = np.full(max(n, 4096), base, dtype=np.uint64)
        out[0] = 1
        _made[base] = np.multiply.accumulate(out)
    return _made[base][:n]


class _Rolling:
    """Hashes of any range of a byte array, by differences of one running sum."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(_BYTES[data] * _powers(_BASE, n + 1)[:n], out=self.sums[1:])
        self.back = _powers(_INVERSE, n + 1)

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return _mix((self.sums[stop] - self.sums[start]) * self.back[start])


def phrases(texts: list[bytes], length: int = LENGTH, trigger: int = TRIGGER) -> dict[str, np.ndarray]:
    """The parse of some texts: ``doc`` (position in the list), ``start``, ``strings`` (200-byte strings in the phrase),
    ``offset`` (of the trigger in the phrase), ``mark`` (hash of the trigger), ``phrase`` (hash of the phrase)."""
    parts = [
        part
        for first, segment, starts in _segments(texts, length)
        for part in [_parse(first, segment, starts, length, trigger)]
        if part is not None
    ]
    names = ("doc", "start", "strings", "offset", "mark", "phrase")
    if not parts:
        return {n: np.zeros(0, dtype=np.uint64 if n in ("mark", "phrase") else np.int64) for n in names}
    return {n: np.concatenate([p[n] for p in parts]) for n in names}


def _segments(texts: list[bytes], length: int) -> Iterator[tuple[list[int], list[bytes], list[int]]]:
    """Runs of about one MB; a longer text comes in pieces that share all but one byte of a string."""
    docs, held, starts, size = [], [], [], 0
    for i, text in enumerate(texts):
        at = 0
        while len(text) - at >= length:
            piece = text[at : at + _SEGMENT]
            if size and size + len(piece) > _SEGMENT:
                yield docs, held, starts
                docs, held, starts, size = [], [], [], 0
            docs.append(i)
            held.append(piece)
            starts.append(at)
            size += len(piece)
            at += len(piece) - length + 1
    if held:
        yield docs, held, starts


def _parse(docs: list[int], held: list[bytes], starts: list[int], length: int, trigger: int) -> dict[str, np.ndarray] | None:
    data = np.frombuffer(b"".join(held), dtype=np.uint8)
    n, width = len(data), length - trigger + 1
    rolling = _Rolling(data)
    # Few arrays of this size are held at once: two workers of an executor do this side by side.
    marks = _mix((rolling.sums[trigger:] - rolling.sums[:-trigger]) * rolling.back[: n - trigger + 1])
    # The place in the lower bits makes the leftmost of equal hashes the smallest.
    place_bits = np.uint64((1 << 22) - 1)
    padded = np.full(-(-len(marks) // width) * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    np.bitwise_and(marks, ~place_bits, out=padded[: len(marks)])
    padded[: len(marks)] |= np.arange(len(marks), dtype=np.uint64)
    padded = padded.reshape(-1, width)
    strings = n - length + 1
    owner = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()[:strings]
    np.minimum.accumulate(padded, axis=1, out=padded)
    np.minimum(owner, padded.ravel()[width - 1 : width - 1 + strings], out=owner)
    del padded
    owner &= place_bits
    owner = owner.view(np.int64)
    sizes = np.array([len(h) for h in held], dtype=np.int64)
    ends = np.cumsum(sizes)
    piece = np.repeat(np.arange(len(held), dtype=np.int32), sizes)[:strings]
    inside = np.ones(strings, dtype=bool)
    for end in ends.tolist():
        inside[end - length + 1 : end] = False
    new = np.ones(strings, dtype=bool)
    new[1:] = (owner[1:] != owner[:-1]) | (piece[1:] != piece[:-1]) | (inside[1:] != inside[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], strings) - 1
    valid = inside[first]
    first, last = first[valid], last[valid]
    if not len(first):
        return None
    place, piece = owner[first], piece[first]
    offset, count = place - first, last - first + 1
    shape = (offset << 16 | count).astype(np.uint64)
    return {
        "doc": np.array(docs, dtype=np.int64)[piece],
        "start": first - (ends - sizes)[piece] + np.array(starts, dtype=np.int64)[piece],
        "strings": count,
        "offset": offset,
        "mark": marks[place],
        "phrase": _mix(rolling.of(first, last + length) + shape * np.uint64(_BASE)),
    }


def _place(start, strings, offset):
    """Start, number of strings and trigger offset in one long, 16 bits each for the last two."""
    return start << 32 | strings << 16 | offset


def _placed(place: int) -> tuple[int, int, int]:
    """What :func:`_place` put together."""
    return place >> 32, place >> 16 & 0xFFFF, place & 0xFFFF


def _parse_rows(length: int):
    """Every phrase of the parse, without its bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in small_slices(whole, "text", 2 << 20):
                found = phrases(byte_texts(batch.column("text")), length)
                if len(found["doc"]):
                    rows = pa.array(found["doc"])
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column("row").take(rows),
                            pa.array(found["mark"].view(np.int64)),
                            pa.array(found["phrase"].view(np.int64)),
                            pa.array(_place(found["start"], found["strings"], found["offset"])),
                        ],
                        ["row", "mark", "phrase", "place"],
                    )
        _made.clear()  # workers live on between tasks
        give_back()

    return run


def _strings_of(phrase: bytes, strings: int, length: int) -> np.ndarray:
    """Hashes of the strings of one phrase."""
    at = np.arange(strings)
    return _Rolling(np.frombuffer(phrase, dtype=np.uint8)).of(at, at + length)


def _string_keys(phrase: bytes, strings: int, offset: int, length: int) -> np.ndarray:
    """Equal for strings of one trigger that have the trigger at the same place and the same bytes."""
    distance = (offset - np.arange(strings)).astype(np.uint64)
    return _mix(_strings_of(phrase, strings, length) + distance * np.uint64(_BASE))


_ENTRY = "mark long, key long, phrase long, n long, row long, place long, bytes binary"


def _dictionary_rows(length: int):
    """The dictionary's phrases with their bytes; of a crowded trigger one row per string instead."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in small_slices(whole, "text", 4 << 20):
                texts = byte_texts(batch.column("text"))
                numbers = batch.column("row").to_pylist()
                rows = []
                for i, entries in enumerate(batch.column("entries").to_pylist()):
                    for e in entries:
                        start, strings, offset = _placed(e["place"])
                        data = texts[i][start : start + strings - 1 + length]
                        owner = (e["phrase"], e["n"], numbers[i])
                        if not e["crowded"]:
                            rows.append((e["mark"], 0, *owner, e["place"], data))
                            continue
                        found = _string_keys(data, strings, offset, length).view(np.int64).tolist()
                        for at, key in enumerate(found):
                            rows.append((e["mark"], key, *owner, _place(start + at, 1, 0), None))
                if rows:
                    types = (*[pa.int64()] * 6, pa.binary())
                    columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
                    yield pa.RecordBatch.from_arrays(columns, ["mark", "key", "phrase", "n", "row", "place", "bytes"])

    return run


def _shared_strings(length: int):
    """Of rows in the order of trigger and key, the strings that another phrase has as well.

    The rows of a trigger are held together, at most ``CROWDED`` phrases; rows of single strings pass one by one.
    Phrases that occur twice take part but are settled already, so nothing is said of them.
    """

    def settle(rows: list[dict]) -> list[tuple[int, int, int]]:
        if len(rows) < 2 or all(r["n"] > 1 for r in rows):
            return []
        # The suffix array of the phrases: suffixes by the distance to the trigger, then by their bytes. Those that
        # share a string are neighbours.
        suffixes, shared = [], []
        for i, row in enumerate(rows):
            data, (_, strings, offset) = row["bytes"], _placed(row["place"])
            suffixes += [(offset - at, data[at : at + length], i, at) for at in range(strings)]
            shared.append(np.zeros(strings, dtype=bool))
        suffixes.sort()
        for (near, string, i, at), (next_near, next_string, j, next_at) in zip(suffixes, suffixes[1:], strict=False):
            if near == next_near and string == next_string:
                shared[i][at] = shared[j][next_at] = True
        out = []
        for row, marked in zip(rows, shared, strict=True):
            if row["n"] == 1:
                start = _placed(row["place"])[0]
                out += [(row["row"], start + a, start + b) for a, b in _runs(marked)]
        return out

    def single(row: dict) -> list[tuple[int, int, int]]:
        start = _placed(row["place"])[0]
        return [(row["row"], start, start + 1)] if row["n"] == 1 else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        told = False
        for batch in batches:
            out: list[tuple[int, int, int]] = []
            for row in batch.to_pylist():
                if held and (held[0]["mark"], held[0]["key"]) != (row["mark"], row["key"]):
                    out += settle(held) if held[0]["bytes"] is not None else []
                    held, told = [], False
                if row["bytes"] is not None or not held:
                    held.append(row)
                    continue
                if not told:
                    out += single(held[0])
                    told = True
                out += single(row)
            yield _range_rows(out)
        if held and held[0]["bytes"] is not None:
            yield _range_rows(settle(held))

    return run


def _runs(marked: np.ndarray) -> list[tuple[int, int]]:
    """(from, to) of the runs of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], marked.astype(np.int8), [0]])))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))


def _range_rows(rows: list[tuple[int, int, int]]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * 3
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["row", "from", "to"])


def _cut(length: int, extra: list[str]):
    """Strings to byte spans, and the bytes that are left."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in small_slices(whole, "text", 8 << 20):
                texts, kept, spans = byte_texts(batch.column("text")), [], []
                column = batch.column("ranges")
                for i, text in enumerate(texts):
                    mine = _spans(column[i].values, length) if column[i].is_valid else []
                    spans.append([{"from": a, "to": b} for a, b in mine])
                    edges = [0, *[e for span in mine for e in span], len(text)]
                    kept.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)) if mine else text)
                span_type = pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())]))
                sizes = [len(t) for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id"),
                        pa.array(sizes, pa.int64()),
                        pa.array(spans, span_type),
                        pa.array(kept, pa.binary()),
                        *[batch.column(c) for c in extra],
                        *([_left(batch.column("text"), kept, spans)] if extra else []),
                    ],
                    ["doc_id", "n_bytes", "spans", "kept", *extra, *(["left"] if extra else [])],
                )

    return run


def _left(texts: pa.Array, kept: list[bytes], spans: list[list[dict]]) -> pa.Array:
    """The kept bytes as text; texts without spans stay as they are. Bytes of characters that a span cuts through are no text."""
    whole = texts.cast(pa.binary()).to_pylist()
    out = [k.decode("utf-8", errors="ignore").encode() if s else w for w, k, s in zip(whole, kept, spans, strict=True)]
    return pa.array(out, pa.binary()).view(pa.string())


def _spans(ranges: pa.StructArray, length: int) -> list[tuple[int, int]]:
    """Byte spans of ranges of strings, in order, those that touch or overlap as one."""
    start = ranges.field("from").to_numpy(zero_copy_only=False)
    order = np.argsort(start, kind="stable")
    start, stop = start[order], ranges.field("to").to_numpy(zero_copy_only=False)[order] + (length - 1)
    furthest = np.maximum.accumulate(stop)
    new = np.ones(len(start), dtype=bool)
    new[1:] = start[1:] > furthest[:-1]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(start)) - 1
    return list(zip(start[first].tolist(), furthest[last].tolist(), strict=True))


def repeated_spans(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, carry: Sequence[str] = ()
) -> DataFrame:
    """``doc_id, n_bytes, spans, kept`` for every row: the byte ranges that repeat and the bytes without them.

    A byte is in a span if a string of ``length`` bytes covers it that also begins anywhere else, in the same text or
    another; spans are (from, to) in bytes, in order, and do not touch. All is judged on the input. A null text is
    empty. Repeated rows are texts like any other, so all of their strings repeat; null ids are no different.
    Texts shorter than ``length`` have no spans; an empty table gives no rows. Other columns are not read, except those
    named in ``carry``, which are returned in a struct ``carried`` next to ``left``, the kept bytes as text, which is
    the text itself, null included, where nothing repeats. ``length`` is at least that of a trigger and at most ``LONGEST``.

    The rows are written to the shared folder first and numbered there; everything is placed by that number, so
    neither ids nor texts can make two rows meet. Phrases move as numbers, about one per 64 bytes. What belongs to a
    trigger is counted with hash aggregates, combined on the map side; only triggers with different phrases have
    phrases moved with their bytes, each distinct one once. Texts move once: both joins with them read the same
    exchange.
    """
    if not TRIGGER <= length <= LONGEST:
        raise ValueError(f"length must be between {TRIGGER} and {LONGEST}, not {length}")
    extra = ["carried"] if carry else []
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(text_col).cast("string").alias("text"),
        *([F.struct(*[F.col(f"`{c}`") for c in carry]).alias("carried")] if carry else []),
    )
    # Never null, so that no join adds a filter of its own and both read the same exchange.
    given = stage(rows, "numbered-texts").withColumn("row", F.coalesce("row", F.lit(0).cast("long")))
    parsed = given.select("row", "text").mapInArrow(_parse_rows(length), "row long, mark long, phrase long, place long")
    # Written, so that the join reads plain exchanges and a frequent trigger can be split over tasks.
    triggers = stage(
        parsed.groupBy("mark")
        .agg(F.count(F.lit(1)).alias("n"), F.min("phrase").alias("least"), F.max("phrase").alias("most"))
        .where("n > 1")
        .select("mark", (F.col("least") != F.col("most")).alias("differs")),
        "repeated-triggers",
    )
    repeated = stage(parsed.join(triggers, "mark"), "repeated-phrases")
    differing = repeated.where("differs")
    dictionary = stage(
        differing.groupBy("mark", "phrase").agg(
            F.count(F.lit(1)).alias("n"), F.min(F.struct("row", "place")).alias("one")
        ),
        "phrase-dictionary",
    )
    twice = dictionary.where("n > 1").select("mark", "phrase")
    settled = repeated.where("NOT differs").unionByName(differing.join(twice, ["mark", "phrase"]))
    start = F.shiftright("place", 32)
    strings = F.shiftright("place", 16).bitwiseAND(F.lit(0xFFFF).cast("long"))
    known = settled.select("row", start.alias("from"), (start + strings).alias("to"))

    crowded = dictionary.groupBy("mark").agg((F.count(F.lit(1)) > CROWDED).alias("crowded"))
    entries = (
        dictionary.join(crowded, "mark")
        .select("one.row", F.struct("one.place", "mark", "phrase", "n", "crowded").alias("entry"))
        .groupBy("row")
        .agg(F.collect_list("entry").alias("entries"))
    )
    order = ["mark", "key"]
    found = (
        given.join(entries, "row")
        .mapInArrow(_dictionary_rows(length), _ENTRY)
        .repartition(*order)
        .sortWithinPartitions(*order)
        .mapInArrow(_shared_strings(length), "row long, from long, to long")
    )
    ranges = known.unionByName(found).groupBy("row").agg(F.collect_list(F.struct("from", "to")).alias("ranges"))
    joined = given.join(ranges, "row", "left")
    carried = f", carried {given.schema['carried'].dataType.simpleString()}, left string" if carry else ""
    return joined.mapInArrow(
        _cut(length, extra),
        f"doc_id long, n_bytes long, spans array<struct<from:bigint,to:bigint>>, kept binary{carried}",
    )


def cut_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """The rows of ``docs``, all columns, with the repeated bytes gone from their texts.

    Bytes of characters that a span cuts through go as well. A text without spans, null included, stays as it is.
    """
    found = repeated_spans(docs, id_col, text_col, length, carry=[c for c in docs.columns if c != text_col])
    return found.select(*[F.col("left" if c == text_col else f"carried.`{c}`").alias(c) for c in docs.columns])
