"""Byte-level BPE encoding and decoding with the tokenization automaton."""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tabweave.llm.automaton import MergeAutomaton
from tabweave.llm.common import Slots, gathered, give_back, small_slices

CACHED = 24 << 20  # bytes of words and tokens that a worker keeps, in each of two generations

# Fixed value: the pattern that splits text into words before the merges.
_WORDS = regex.compile(
    r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
)


def _byte_of_character() -> dict[str, int]:
    """The vocabulary file writes printable bytes as themselves and the others as characters from 256 on."""
    printable = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


def _as_bytes():
    byte_of = _byte_of_character()
    return lambda s: bytes(byte_of[c] for c in s)


class ByteBpe:
    """Encoder of one vocabulary file in the ``tokenizers`` format."""

    def __init__(self, content: str):
        spec = json.loads(content)
        model = spec["model"]
        as_bytes = _as_bytes()
        tokens = {as_bytes(t): i for t, i in model["vocab"].items()}
        merges = [tuple(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        symbols = {t: i for t, i in tokens.items() if len(t) == 1}
        self.automaton = MergeAutomaton(symbols, ((as_bytes(a), as_bytes(b)) for a, b in merges), tokens)
        self.special = {}
        for added in spec.get("added_tokens", []):
            if added["lstrip"] or added["rstrip"] or added["single_word"]:
                raise ValueError("added tokens that depend on their surroundings are not supported")
            self.special[added["content"]] = added["id"]
        longest_first = sorted(self.special, key=len, reverse=True)
        self._split = regex.compile("|".join(map(regex.escape, longest_first))) if longest_first else None
        # Ids of parts and of the words that they are made of: those met lately, and those met before them.
        self._parts, self._older = Slots(), Slots()
        self._words, self._older_words = Slots(), Slots()

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (null is empty), one text behind the other, and their number per text.

        A single space or line break between two other characters always separates words, so the parts between them
        are looked up whole. A part begins behind its space, or with its line break; a line break is put before
        every text, and its id is dropped again. Texts with other white space or with added tokens are split by the pattern.
        """
        texts = pa.compute.fill_null(texts.cast(pa.string()), "")
        led = pa.compute.binary_join_element_wise("\n", texts, "")
        split = pa.compute.split_pattern(pa.compute.utf8_ltrim(pa.compute.replace_substring(led, "\n", " \n"), " "), " ")
        parts = split.flatten().dictionary_encode()
        distinct = parts.dictionary.to_numpy(zero_copy_only=False).tolist()
        slots = self._slots_of(distinct)
        slots = slots[parts.indices.to_numpy(zero_copy_only=False)]
        counts = pa.compute.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
        odd = np.add.reduceat(slots < 0, np.cumsum(counts) - counts) > 0 if len(counts) else np.zeros(0, dtype=bool)
        if self._split is not None:
            odd |= pa.compute.match_substring_regex(texts, self._split.pattern).to_numpy(zero_copy_only=False)
        length = np.where(np.repeat(odd, counts), 0, self._parts.length[slots])
        ids, of_text = gathered(self._parts.ids, self._parts.start[slots], length, counts)
        keep = np.ones(len(ids), dtype=bool)
        plain = np.flatnonzero(~odd)
        keep[(np.cumsum(of_text) - of_text)[plain]] = False
        ids, of_text = ids[keep], of_text - ~odd
        at = np.cumsum(of_text) - of_text
        apart = np.flatnonzero(odd).tolist()
        if apart:
            found = [self._by_pattern(texts[i].as_py()) for i in apart]
            ids = np.insert(ids, np.repeat(at[apart], [len(f) for f in found]), np.concatenate(found))
            of_text[apart] = [len(f) for f in found]
        return ids, of_text

    def encode(self, text: str) -> np.ndarray:
        """Ids of a whole text; strings of added tokens in it become these tokens."""
        return self.ids(pa.array([text], pa.string()))[0]

    def _slots_of(self, parts: list[str]) -> np.ndarray:
        """The slots of some distinct parts, learned where they are new; -1 for those that the pattern must split."""
        if self._parts.bytes > CACHED:
            self._parts, self._older = Slots(), self._parts
        known, older = self._parts, self._older
        found = np.fromiter(map(known.slot.get, parts, repeat(-1)), dtype=np.int64, count=len(parts))
        missing = np.flatnonzero(found < 0).tolist()
        again = [p for i in missing if (p := parts[i]) in older.slot]
        known.add(again, [older.ids_of(p) for p in again])
        new = [p for i in missing if (p := parts[i]) not in older.slot and _separate(p)]
        pieces = [_pieces(p) for p in new]
        self._learn({w for p in pieces for w in p})
        ids_of = self._words.ids_of
        known.add(new, [ids_of(p[0]) if len(p) == 1 else np.concatenate(list(map(ids_of, p))) for p in pieces])
        found[missing] = [known.slot.get(parts[i], -1) for i in missing]
        return found

    def _learn(self, words: set[str]) -> None:
        """Have the ids of some words at hand."""
        if self._words.bytes > CACHED // 2:
            self._words, self._older_words = Slots(), self._words
        known, older = self._words, self._older_words
        again = [w for w in words if w not in known.slot and w in older.slot]
        known.add(again, [older.ids_of(w) for w in again])
        new = [w for w in words if w not in known.slot]
        known.add(new, self.automaton.encode_many([w.encode() for w in new]))

    def _by_pattern(self, text: str) -> np.ndarray:
        """Ids of a text whose words the pattern finds, and of the added tokens between."""
        out, at = [np.zeros(0, dtype="<u4")], 0
        matches = [*self._split.finditer(text)] if self._split else []
        for match in [*matches, None]:
            words = _WORDS.findall(text[at : match.start() if match else len(text)])
            self._learn(set(words))
            out += map(self._words.ids_of, words)
            if match:
                out.append(np.array([self.special[match.group()]], dtype="<u4"))
                at = match.end()
        return np.concatenate(out)


_MARKS = ".,;:!?"


def _separate(part: str) -> bool:
    """Whether a part is what the pattern finds between its separators, whatever stands around it."""
    inner = part[1:] if part.startswith("\n") else part
    # Behind a line break that begins a text or ends one, nothing stands.
    return bool(inner) and not inner[0].isspace() and not inner[-1].isspace()


def _pieces(part: str) -> list[str]:
    """The words of a part, with the space or line break before it."""
    if part.startswith("\n"):
        return ["\n", *_words_of(part[1:], "")]
    return _words_of(part, " ")


def _words_of(part: str, prefix: str) -> list[str]:
    stem = part.rstrip(_MARKS)
    if stem.isalpha():  # marks behind a letter are a word of their own
        return [prefix + stem] if stem == part else [prefix + stem, part[len(stem) :]]
    return _WORDS.findall(prefix + part)


class Labels:
    """What the arcs of a vocabulary spell: the bytes of every token."""

    def __init__(self, content: str):
        spec = json.loads(content)
        as_bytes = _as_bytes()
        self.labels = {i: as_bytes(t) for t, i in spec["model"]["vocab"].items()}
        self.labels |= {added["id"]: added["content"].encode() for added in spec.get("added_tokens", [])}

    def decode(self, ids: np.ndarray) -> str:
        """The labels of the ids one behind the other; bytes that are not UTF-8 become the replacement character."""
        return b"".join(map(self.labels.__getitem__, ids.tolist())).decode("utf-8", errors="replace")


@lru_cache(maxsize=2)
def load(content: str) -> ByteBpe:
    return ByteBpe(content)


@lru_cache(maxsize=2)
def load_labels(content: str) -> Labels:
    """Decoding needs no automaton, and may run in workers of its own beside those that encode."""
    return Labels(content)


def encode(
    docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False
) -> DataFrame:
    """``doc_id, ids``: ids as little-endian unsigned 32-bit integers in a binary column.

    ``with_text`` adds ``text``, decoded from the ids as :func:`decode` does, without a second set of workers.

    ``vocabulary`` is the path of a vocabulary file, read on the driver; its content, one file of some MB,
    travels with the tasks, which compile it once per worker. A null text is empty and has no ids. Null or repeated
    ids are rows like any other; an empty table gives no rows; other columns are not read.
    """
    content = Path(vocabulary).read_text(encoding="utf-8")
    fields = ["doc_id", "ids", *["text"] * with_text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, labels = load(content), load_labels(content) if with_text else None
        for whole in batches:
            for batch in small_slices(whole, "text", 1 << 20):
                ids, counts = codec.ids(batch.column(1))
                ends = np.concatenate([[0], 4 * np.cumsum(counts)]).astype(np.int32)
                found = pa.Array.from_buffers(
                    pa.binary(), len(counts), [None, pa.py_buffer(ends), pa.py_buffer(ids.astype("<u4").tobytes())]
                )
                texts = [pa.array(map(labels.decode, np.split(ids, np.cumsum(counts)[:-1])), pa.string())] if labels else []
                yield pa.RecordBatch.from_arrays([batch.column(0), found, *texts], fields)
        give_back()

    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return given.mapInArrow(run, "doc_id long, ids binary" + ", text string" * with_text)


def decode(encoded: DataFrame, vocabulary: str, ids_col: str = "ids") -> DataFrame:
    """The rows of ``encoded`` with their decoded ``text`` in place of one of that name; null ids give null."""
    content = Path(vocabulary).read_text(encoding="utf-8")
    names = [c for c in encoded.columns if c != "text"]
    given = encoded.select(*[F.col(f"`{c}`") for c in names])
    at = names.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = load_labels(content)
        for whole in batches:
            for batch in small_slices(whole, ids_col, 4 << 20):
                texts = [None if b is None else codec.decode(np.frombuffer(b, dtype="<u4")) for b in batch.column(at).to_pylist()]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*names, "text"])

    return given.mapInArrow(run, StructType([*given.schema.fields, StructField("text", StringType())]))
