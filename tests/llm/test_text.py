"""Quality rules, language id, language model, BPE and packing against plain versions."""

import math
import random
import re
import time
import zlib
from collections import Counter, defaultdict
from functools import lru_cache
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from helpers import SCHEMA, corpus, frame, prose, result
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tabweave.llm import automaton, bpe, langid, ngram_lm, packing, quality
from tabweave.llm.automaton import MergeAutomaton
from tabweave.llm.bpe import ByteBpe, decode, encode, load_labels
from tabweave.llm.bpe import load as load_bytes
from tabweave.llm.common import fold
from tabweave.llm.langid import fit_languages, predict_languages
from tabweave.llm.ngram_lm import score_corpus
from tabweave.llm.packing import cut_pieces, differencing, load, pack, pack_block
from tabweave.llm.quality import base_measures, quality_rules

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
SPACES = r"[^\x20\x09-\x0D]+"


def plain_measures(text):
    words = re.findall(SPACES, text or "")
    lines = [x for x in (text or "").split("\n") if re.search(SPACES, x)]
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {i + j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(8)}
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


@given(st.text(alphabet="ab #|é\n\t\x0b\x1c ", max_size=120))
@settings(max_examples=200, deadline=None)
def test_base_measures(text):
    assert base_measures(text.encode()) == plain_measures(text)


def quality_corpus():
    rng = random.Random(4)
    rows = [(10_000 + i, prose(rng, 120), "en", "s", 0) for i in range(200)]
    rows += [(20_000 + i, " | ".join(prose(rng, 120).split()), "en", "s", 0) for i in range(60)]
    labels = [(10_000 + i, 1, 0) for i in range(100)] + [(20_000 + i, 0, 0) for i in range(30)]
    return rows + corpus(), labels


def test_quality_rules(spark):
    rows, labels = quality_corpus()
    marked = spark.createDataFrame([*labels, (None, 1, 0), (5, None, 0)], "doc_id long, quality int, toxic int")
    found = quality_rules(frame(spark, rows, clashing=True), marked).collect()
    assert len(found) == len(rows)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert Counter((r.doc_id, *(r[n] for n in names)) for r in found) == Counter(
        (r[0], *plain_measures(r[1])) for r in rows
    )
    for r in found:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.kept and r.base_failed)
    by_id = {r.doc_id: r for r in found if r.doc_id is not None}
    assert all(by_id[10_000 + i].kept for i in range(100, 200))
    assert not any(by_id[20_000 + i].kept for i in range(60))


def test_quality_scores_are_mean_log_ratios(spark):
    rows, labels = quality_corpus()
    marked = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    trusted = quality.sample_labels(marked)
    fit = {i for i, good, f in zip(trusted.ids, trusted.good, trusted.fit, strict=True) if good and f}
    raw, target = Counter(), Counter()
    for doc_id, text, *_ in rows:
        buckets = quality.buckets_of((text or "").encode()).tolist()
        raw.update(buckets)
        if doc_id in fit:
            target.update(buckets)

    def share(counts, b):
        return (counts[b] + 1) / (sum(counts.values()) + quality.BUCKETS)

    found = {r.doc_id: r.score for r in quality_rules(frame(spark, rows), marked).collect()}
    for doc_id, text, *_ in rows[:260:40]:
        buckets = quality.buckets_of(text.encode()).tolist()
        expected = sum(math.log(share(target, b) / share(raw, b)) for b in buckets) / len(buckets)
        assert found[doc_id] == pytest.approx(expected)


def test_all_labels_count(spark, monkeypatch):
    """Documents beyond the first 20,000 labelled ids of a class fit the target and the threshold, too."""
    labels = spark.range(24_000).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    last = [r.doc_id for r in labels.orderBy(F.xxhash64("doc_id", F.lit(7)), "doc_id").select("doc_id").collect()[20_000:]][:80]
    rng = random.Random(4)
    texts = [(i, " ".join(rng.choice(["river", "stone", "house", "bird"]) for _ in range(30))) for i in last]
    texts += [(-1 - i, " ".join(rng.choice(["win", "cash", "now", "click"]) for _ in range(30))) for i in range(40)] + [(None, "none")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    bad = spark.createDataFrame([(-1 - i, 0, 1) for i in range(40)], "doc_id long, quality int, toxic int")
    found = {}
    for sent in (1_000_000, 0):
        monkeypatch.setattr(quality, "_SENT", sent, raising=False)
        found[sent] = {r.doc_id: (r.score, r.kept) for r in quality_rules(docs, labels.unionByName(bad)).collect()}
    assert found[0] == found[1_000_000] and len(found[0]) == 121
    assert min(found[0][i][0] for i in last) > max(found[0][-1 - i][0] for i in range(40))
    assert sum(found[0][i][1] for i in last) > 60
    assert not any(found[0][-1 - i][1] for i in range(40))


def test_quality_without_labels_or_rows(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    found = quality_rules(frame(spark, corpus()), none).collect()
    assert all(r.kept != r.base_failed and r.score == 0 for r in found)
    assert result(quality_rules(spark.createDataFrame([], SCHEMA), none)) == []


def languages(seed=1):
    rng = random.Random(seed)
    sets = {"aa": ["the", "and", "house", "river", "stone"], "bb": ["die", "und", "haus", "fluss", "stein"], "cc": ["le", "et", "maison", "fleuve", "pierre"]}
    rows = []
    for i in range(150):
        lang = rng.choice(sorted(sets))
        rows.append((i, " ".join(rng.choice(sets[lang]) for _ in range(rng.randint(3, 30))).title(), lang, "s", 0))
    return rows


def test_languages(spark):
    rows = languages()
    extra = [(900, None, "aa", "", 0), (901, "12 34 ½ --", "aa", "", 0), (902, "", None, "", 0), (903, "housen stonely rivering", None, "", 0), (None, "und die", "bb", None, None)]
    docs = frame(spark, rows + extra, clashing=True)
    model = fit_languages(docs.where(fold("doc_id", 5) != 0))
    found = {r.doc_id: r for r in predict_languages(docs, model).collect()}
    assert len(found) == len(rows) + len(extra)
    assert all(found[r[0]].lang_pred == r[2] for r in rows)
    assert [found[i].lang_pred for i in (900, 901, 902)] == ["und"] * 3
    assert found[903].lang_pred == "aa"  # no word is known, the n-grams are
    assert all(0 <= r.score <= 1 for r in found.values())


def test_language_of_known_words_is_their_log_frequency(spark):
    rows = languages()
    model = fit_languages(frame(spark, rows))
    counts = defaultdict(Counter)
    for _, text, lang, *_ in rows:
        counts[lang].update(text.lower().split())
    total = np.zeros(3)
    for word in ["the", "haus", "the"]:
        for i, lang in enumerate(model.languages):
            c = counts[lang]
            total[i] += math.log((c[word] + 0.5) / (sum(c.values()) + 0.5 * (len(c) + 1)))
    assert model._total(["the", "haus", "the"]) == pytest.approx(total)


def test_language_cache_turns_over(spark, monkeypatch):
    monkeypatch.setattr(langid, "CACHED", 12)
    monkeypatch.setattr(langid, "STEP", 10)
    model = fit_languages(frame(spark, languages()))
    words = [f"ho{c}use" for c in "abcdefghijklmnopqrstuvwxyz"] * 2
    alone = sum(model._total([w]) for w in words)
    assert model._total(words) == pytest.approx(alone)


def test_languages_without_training(spark):
    empty = spark.createDataFrame([], SCHEMA)
    found = predict_languages(frame(spark, languages()), fit_languages(empty)).collect()
    assert {r.lang_pred for r in found} == {"und"}
    assert result(predict_languages(empty, fit_languages(frame(spark, languages())))) == []


def plain_scores(rows, weight):
    train = [zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 5 != 1 for r in rows]
    lower = [re.sub("[A-Z]", lambda m: m[0].lower(), r[1] or "") for r in rows]
    tokens = [[*re.findall(SPACES, t), None] for t in lower]
    words, pairs = Counter(), Counter()
    for t, learn in zip(tokens, train, strict=True):
        if learn:
            words.update(t)
            pairs.update(zip([None, *t[:-1]], t, strict=True))
    n, v = sum(words.values()), len(words)

    def root(w):
        return (words[w] + 0.5) / (n + 0.5 * (v + 1))

    out = []
    for r, t, learn in zip(rows, tokens, train, strict=True):
        score = 0.0
        for u, w in zip([None, *t[:-1]], t, strict=True):
            arc = (1 - weight) * root(w) + weight * pairs[u, w] / words[u] if words[u] else root(w)
            score += math.log10(arc)
        out.append((r[0], not learn, len(t), sum(words[w] > 0 for w in t), n, sum(math.log10(root(w)) for w in t), score))
    return out


@pytest.mark.parametrize("sizes", [(1 << 20, 1 << 20), (900, 500)])
def test_language_model(spark, sizes):
    rows = corpus() + [(500 + i, "A b C " * i, "", "", 0) for i in range(9)]
    docs = frame(spark, rows, clashing=True)
    found = score_corpus(docs, train=fold("doc_id", 5) != 1, chunk_bytes=sizes[0], bucket_bytes=sizes[1]).collect()
    expected = plain_scores(rows, ngram_lm.STATE_WEIGHT)

    def rounded(rows):
        return sorted([(*r[:5], round(r[5], 6), round(r[6], 6)) for r in map(tuple, rows)], key=repr)

    assert rounded(found) == rounded(expected)


def test_language_model_without_rows_or_training(spark):
    assert result(score_corpus(spark.createDataFrame([], SCHEMA), train=F.lit(True))) == []
    found = score_corpus(frame(spark, corpus()), train=F.lit(False)).collect()
    assert {r.n_known for r in found} == {0} and {r.train_tokens for r in found} == {0}


@pytest.fixture(scope="module")
def codec():
    return ByteBpe(Path(BYTE_BPE).read_text(encoding="utf-8"))


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(BYTE_BPE)


@given(st.text(max_size=80) | st.text(alphabet="abehitno '\n\t s<|>.é ", max_size=120))
@settings(max_examples=400, deadline=None)
def test_encoding_equals_the_library(codec, library, text):
    ids = library.encode(text, add_special_tokens=False).ids
    assert codec.encode(text).tolist() == ids
    assert load_labels(Path(BYTE_BPE).read_text(encoding="utf-8")).decode(np.array(ids, dtype="<u4")) == library.decode(ids, skip_special_tokens=False)


@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), max_size=12), st.text(alphabet="abc", max_size=40))
@settings(max_examples=400, deadline=None)
def test_automaton_equals_merging_in_order(choices, word):
    """Random merge lists, runs of one symbol included, against merging the earliest rule first, leftmost first."""
    tokens, merges = {b"a": 0, b"b": 1, b"c": 2}, []
    for i, j in choices:
        known = list(tokens)
        a, b = known[i % len(known)], known[j % len(known)]
        if a + b not in tokens:
            tokens[a + b] = len(tokens)
            merges.append((a, b))
    parts = [bytes([c]) for c in word.encode()]
    for a, b in merges:
        at, out = 0, []
        while at < len(parts):
            if parts[at : at + 2] == [a, b]:
                out.append(a + b)
                at += 2
            else:
                out.append(parts[at])
                at += 1
        parts = out
    automaton = MergeAutomaton({t: i for t, i in tokens.items() if len(t) == 1}, merges, tokens)
    assert automaton.encode(word.encode()) == [tokens[p] for p in parts]


def test_bpe_of_a_table(spark, library):
    rows = corpus()
    encoded = encode(frame(spark, rows, clashing=True), BYTE_BPE)
    found = Counter((r.doc_id, bytes(r.ids), r.text) for r in decode(encoded, BYTE_BPE).collect())
    texts = [r[1] or "" for r in rows]
    ids = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert found == Counter((r[0], np.array(i, dtype="<u4").tobytes(), t) for r, i, t in zip(rows, ids, texts, strict=True))
    assert Counter((r.doc_id, bytes(r.ids), r.text) for r in encode(frame(spark, rows), BYTE_BPE, with_text=True).collect()) == found
    assert result(encode(spark.createDataFrame([], SCHEMA), BYTE_BPE, with_text=True)) == []


@pytest.mark.parametrize("letter", ["H\u0331", "J\u030c", "T\u0308", "W\u030a", "Y\u030a"])
def test_letters_composed_in_lower_case_only(letter):
    """The vocabulary composes before it lowers, so these capitals keep their mark apart."""
    tokens = load(Path(WORD_BPE).read_text(encoding="utf-8"))
    texts = [f"{letter}amor", f"Plain WORDS, {letter} {letter.lower()}x{letter}! Ä É"]
    encoded = Tokenizer.from_file(WORD_BPE).encode_batch(texts, add_special_tokens=False)
    ids, counts = tokens.ids(pa.array(texts))
    assert [part.tolist() for part in np.split(ids, np.cumsum(counts)[:-1])] == [e.ids for e in encoded]


TEXTS = st.lists(
    st.one_of(
        st.none(),
        st.text(alphabet=list("abcXYZ 012,.;!?'<|>-\n\t\u00e9\u0301\u03a3\u00df\u00a0\u4e2d\x0b\x1c"), max_size=40),
        st.lists(st.sampled_from(["the", " ", "  ", "\n", "ing.", "0", "<|endoftext|>", "<|", "'S", "H\u0331", "x" * 70, "\u0391\u03a3.", "9 0"]), max_size=9).map("".join),
    ),
    min_size=1,
    max_size=8,
)


@given(TEXTS)
@settings(max_examples=300, deadline=None)
def test_columns_of_texts_equal_the_library(texts):
    """Both vocabularies, with words remembered from earlier examples."""
    for path, codec in ((WORD_BPE, load), (BYTE_BPE, load_bytes)):
        ids, counts = codec(Path(path).read_text(encoding="utf-8")).ids(pa.array(texts, pa.string()))
        expected = [e.ids for e in plain_library(path).encode_batch([t or "" for t in texts], add_special_tokens=False)]
        assert [part.tolist() for part in np.split(ids, np.cumsum(counts)[:-1])] == expected


@lru_cache
def plain_library(path):
    return Tokenizer.from_file(path)


def test_memories_are_bounded_by_bytes(monkeypatch):
    """Whatever is forgotten is learned again."""
    monkeypatch.setattr(packing, "CACHED", 3_000)
    monkeypatch.setattr(bpe, "CACHED", 3_000)
    monkeypatch.setattr(automaton, "ARCS", 50)
    rng = random.Random(1)
    texts = [prose(rng, 60, 900) + " \u00e9. " + "z" * 80 for _ in range(40)]
    for path, codec in ((WORD_BPE, packing.WordTokens), (BYTE_BPE, bpe.ByteBpe)):
        made = codec(Path(path).read_text(encoding="utf-8"))
        expected = [e.ids for e in plain_library(path).encode_batch(texts, add_special_tokens=False)]
        for _ in range(2):
            for text, ids in zip(texts, expected, strict=True):
                assert made.ids(pa.array([text]))[0].tolist() == ids
        held = made._known if path == WORD_BPE else made._parts
        assert held.bytes < 3_000 + 60 * 200


@pytest.mark.parametrize("pattern", ["x", "ab", "abcdefghij\u00e9"])
def test_long_words_take_time_in_proportion(pattern):
    """A megabyte without a space, read byte by byte and never backwards."""
    codec = load_bytes(Path(BYTE_BPE).read_text(encoding="utf-8"))
    seconds = []
    for size in (100_000, 1_000_000):
        word = (pattern * size)[:size].encode()
        begun = time.process_time()
        found = codec.automaton.encode(word)
        seconds.append(time.process_time() - begun)
        assert sum(codec.automaton.length[t] for t in found) == len(word)
    assert seconds[1] < 25 * seconds[0] + 1


def test_words_side_by_side_equal_words_alone():
    codec = load_bytes(Path(BYTE_BPE).read_text(encoding="utf-8"))
    rng = random.Random(3)
    words = ["".join(rng.choice(" abcdetheing\u00e9\u4e2d.,09") for _ in range(rng.randrange(1, 90))).encode() for _ in range(2_000)]
    found = codec.automaton.encode_many([b"", *words])
    assert [f.tolist() for f in found] == [[], *map(codec.automaton.encode, words)]


def test_packing(spark):
    rows = corpus()
    pieces = cut_pieces(frame(spark, rows, clashing=True), WORD_BPE, with_ids=True)
    found = pack(pieces).collect()
    tokenizer = Tokenizer.from_file(WORD_BPE)
    ids = [[*e.ids, 2] for e in tokenizer.encode_batch([r[1] or "" for r in rows], add_special_tokens=False)]
    expected = Counter((r[0], len(i)) for r, i in zip(rows, ids, strict=True))
    starts = Counter((r.doc_id, r.doc_tokens) for r in found if r.start == 0)
    assert starts == expected
    by_doc = defaultdict(set)
    for r in found:
        part = np.frombuffer(r.ids, dtype="<u4").tolist()
        assert len(part) == r.length and zlib.crc32(r.ids) == r.ids_crc32
        by_doc[r.doc_id, r.doc_tokens].add((r.start, tuple(part)))
    for r, i in zip(rows, ids, strict=True):
        parts = by_doc[r[0], len(i)]
        for start, part in parts:
            assert any(tuple(j[start : start + len(part)]) == part for q, j in zip(rows, ids, strict=True) if q[0] == r[0])
    assert sum(r.length for r in found) == sum(map(len, ids))
    sequences = defaultdict(list)
    for r in found:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 4096
    empty = pack(cut_pieces(spark.createDataFrame([], SCHEMA), WORD_BPE))
    assert result(empty) == []


@given(st.lists(st.integers(1, 64), max_size=80), st.integers(1, 9))
@settings(max_examples=200, deadline=None)
def test_differencing(sizes, windows):
    found = differencing(sizes, windows)
    assert sorted(i for _, items in found for i in items) == list(range(len(sizes)))
    assert all(total == sum(sizes[i] for i in items) for total, items in found) and len(found) <= windows
    packed = pack_block(sizes, 64)
    assert all(total <= 64 for total, _ in packed)


def test_windows_come_out_nearly_equal():
    rng = random.Random(8)
    sizes = [rng.randint(1, 512) for _ in range(2_000)]
    totals = [t for t, _ in differencing(sizes, 130)]
    assert max(totals) - min(totals) <= 0.02 * max(totals)
    packed = pack_block(sizes, 4096)
    assert sum(sizes) / (4096 * len(packed)) > 0.97
