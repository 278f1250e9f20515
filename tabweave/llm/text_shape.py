"""The shape of a text as numbers: kinds of characters, repeated and marked words, lines, hashed trigrams.

Counts are sums over pieces of bounded size, so that a long text needs no more memory than a short one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE = 512 << 10  # bytes that are counted at once
WINDOW = 64  # words in which distinct ones are counted
LONG_WORD = 24  # bytes
TRIGRAMS = 64  # buckets of hashed byte trigrams

# Kinds of bytes; a byte beyond ASCII is part of a letter.
LOWER, UPPER, DIGIT, BLANK, NEWLINE, SENTENCE_MARK, OTHER_MARK, CONTROL, BEYOND = range(9)
_KIND = np.full(256, OTHER_MARK, dtype=np.uint8)
_KIND[:32], _KIND[127], _KIND[128:] = CONTROL, CONTROL, BEYOND
for _members, _kind in ((b"\t\x0b\x0c\r ", BLANK), (b"\n", NEWLINE), (b".,;:!?'\"()-", SENTENCE_MARK)):
    _KIND[list(_members)] = _kind
_KIND[ord("0") : ord("9") + 1], _KIND[ord("a") : ord("z") + 1], _KIND[ord("A") : ord("Z") + 1] = DIGIT, LOWER, UPPER

WORD_COUNTS = ("words", "repeated", "distinct", "upper", "bare", "marked", "odd_end", "long")
COUNTED = 9 + len(WORD_COUNTS) + 2 + TRIGRAMS
FEATURES = 4 + 9 + 7 + 2 + 1 + TRIGRAMS

_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def _hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, powers: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """A rolling hash of each range, the same wherever the range lies."""
    up, down = powers
    running = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)])])
    return (running[end] - running[start]) * down[start]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    steps = []
    for factor in (_FACTOR, _INVERSE):
        row = np.full(n, factor, dtype=np.uint64)
        row[:1] = 1
        steps.append(np.cumprod(row, dtype=np.uint64))
    return steps[0], steps[1]


def _new_values(group: np.ndarray, value: np.ndarray) -> np.ndarray:
    """The group of each distinct value in each group."""
    order = np.lexsort((value, group))
    g, v = group[order], value[order]
    new = np.ones(len(g), dtype=bool)
    new[1:] = (g[1:] != g[:-1]) | (v[1:] != v[:-1])
    return g[new]


def count_texts(data: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """One line of counts per text; ``data`` holds the bytes of all texts, one behind the other."""
    texts = len(lengths)
    out = np.zeros((texts, COUNTED), dtype=np.int64)
    if not len(data):
        return out
    owner = np.repeat(np.arange(texts), lengths)
    kind = _KIND[data]
    out[:, :9] = np.bincount(owner * 9 + kind, minlength=texts * 9).reshape(texts, 9)
    powers = _powers(len(data) + 1)
    edge = np.concatenate([[True], owner[1:] != owner[:-1], [True]])  # before each byte, and behind the last
    blank = np.concatenate([[True], (kind == BLANK) | (kind == NEWLINE), [True]])
    inside = ~blank[1:-1]
    start = np.flatnonzero(inside & (blank[:-2] | edge[:-1]))
    end = np.flatnonzero(inside & (blank[2:] | edge[1:])) + 1
    mine = owner[start]
    word = _hashes(data, start, end, powers)
    number = np.arange(len(start)) - np.searchsorted(mine, mine)
    same = np.zeros(len(start), dtype=bool)
    same[1:] = (word[1:] == word[:-1]) & (mine[1:] == mine[:-1])
    window = np.cumsum(np.concatenate([[0], (number % WINDOW == 0)[1:]])) if len(start) else number
    first_of_window = mine[number % WINDOW == 0]

    def within(chosen: np.ndarray) -> np.ndarray:
        running = np.concatenate([[0], np.cumsum(chosen)])
        return running[end] - running[start]

    lower, upper = within(kind == LOWER), within(kind == UPPER)
    letters = within((kind == DIGIT) | (kind == BEYOND)) + lower + upper
    ending = kind[end - 1]
    chosen = (
        None,
        same,
        None,
        (upper > 0) & (lower == 0) & (end - start > 1),
        letters == 0,
        (letters > 0) & (ending == SENTENCE_MARK),
        (letters > 0) & ((ending == OTHER_MARK) | (ending == CONTROL)),
        end - start > LONG_WORD,
    )
    for i, flag in enumerate(chosen):
        if flag is not None:
            out[:, 9 + i] = np.bincount(mine[flag], minlength=texts)
    out[:, 9] = np.bincount(mine, minlength=texts)
    out[:, 11] = np.bincount(first_of_window[_new_values(window, word)], minlength=texts)
    # Lines with a word: they begin behind a line feed or a text's start, and end before one.
    feed = np.concatenate([[True], kind == NEWLINE, [True]])
    opens = np.flatnonzero(~feed[1:-1] & (feed[:-2] | edge[:-1]))
    closes = np.flatnonzero(~feed[1:-1] & (feed[2:] | edge[1:])) + 1
    running = np.concatenate([[0], np.cumsum(inside)])
    used = running[closes] > running[opens]
    line = _hashes(data, opens[used], closes[used], powers)
    out[:, 17] = np.bincount(owner[opens[used]], minlength=texts)
    out[:, 18] = out[:, 17] - np.bincount(_new_values(owner[opens[used]], line), minlength=texts)
    if len(data) > 2:
        whole = data.astype(np.uint32)
        mixed = (whole[:-2] << 16 | whole[1:-1] << 8 | whole[2:]) * np.uint32(0x9E3779B1)
        one = owner[:-2] == owner[2:]
        place = owner[:-2] * TRIGRAMS + (mixed >> np.uint32(26)) % TRIGRAMS
        out[:, 19:] = np.bincount(place[one].astype(np.int64), minlength=texts * TRIGRAMS).reshape(texts, TRIGRAMS)
    return out


def _pieces(data: np.ndarray) -> Iterator[np.ndarray]:
    """A long text in pieces that end behind white space where there is some in the second half of a piece."""
    at = 0
    while at < len(data):
        stop = min(at + PIECE, len(data))
        if stop < len(data):
            kind = _KIND[data[at + PIECE // 2 : stop]]
            gaps = np.flatnonzero((kind == BLANK) | (kind == NEWLINE))
            stop = at + PIECE // 2 + int(gaps[-1]) + 1 if len(gaps) else stop
        yield data[at:stop]
        at = stop


def count_column(column: pa.Array) -> np.ndarray:
    """Counts of every text of an Arrow column of texts, null as empty."""
    values = pa.compute.fill_null(column.cast(pa.binary()), b"")
    lengths = pa.compute.binary_length(values).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(lengths)
    buffer = values.buffers()[2]
    data = np.frombuffer(buffer, dtype=np.uint8) if buffer is not None else np.zeros(0, dtype=np.uint8)
    if len(values):
        skipped = int(np.frombuffer(values.buffers()[1], dtype=np.int32)[values.offset])
        data = data[skipped : skipped + int(ends[-1])]
    out = np.zeros((len(lengths), COUNTED), dtype=np.int64)
    first = 0
    while first < len(lengths):
        begin = int(ends[first] - lengths[first])
        if lengths[first] > PIECE:
            for piece in _pieces(data[begin : int(ends[first])]):
                out[first] += count_texts(piece, np.array([len(piece)]))[0]
            first += 1
            continue
        last = max(int(np.searchsorted(ends, begin + PIECE, side="right")), first + 1)
        out[first:last] = count_texts(data[begin : int(ends[last - 1])], lengths[first:last])
        first = last
    return out


def features_of(counts: np.ndarray) -> np.ndarray:
    """Counts as features of about equal size: a constant, logarithms of lengths, and roots of shares."""
    c = counts.astype(np.float64)
    kinds, words, lines, grams = c[:, :9], c[:, 9:17], c[:, 17:19], c[:, 19:]

    def share(part: np.ndarray, of: np.ndarray) -> np.ndarray:
        return np.sqrt(part / np.maximum(of, 1)[:, None])

    size = kinds.sum(axis=1)
    columns = [
        np.ones((len(c), 1)),
        np.log1p(size)[:, None] / 10,
        np.log1p(words[:, :1]) / 10,
        (words[:, :1] == 0).astype(np.float64),
        share(kinds, size),
        share(words[:, 1:], words[:, 0]),
        share(lines[:, 1:], lines[:, 0]),
        np.log1p(words[:, :1] / np.maximum(lines[:, :1], 1)) / 10,
        np.log1p((size[:, None] - kinds[:, [BLANK, NEWLINE]].sum(axis=1, keepdims=True)) / np.maximum(words[:, :1], 1)) / 10,
        share(grams, grams.sum(axis=1)),
    ]
    return np.concatenate(columns, axis=1)
