"""The registered queries over the smallest tables: against their SQL, or against plain versions."""

import glob
import hashlib
import math
import os
import re
import zlib
from collections import Counter, defaultdict

import corpus_pipeline
import duckdb
import numpy as np
import public_tokenizers
import pytest
from test_dedup import components, normal, plain_fingerprint, plain_spans
from test_text import plain_measures, plain_scores
from tokenizers import Tokenizer

import __spark_entry__ as entry_module
from tabweave.llm import quality
from tabweave.llm.ngram_lm import STATE_WEIGHT
from tabweave.llm.queries import oracle_sql, queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        connection.execute(f"CREATE VIEW {os.path.basename(path).removesuffix('.parquet')} AS SELECT * FROM '{path}'")
    return connection


@pytest.fixture(scope="module")
def documents(tables):
    return tables.execute("SELECT doc_id, text, lang, source, n_chars FROM documents ORDER BY doc_id").fetchall()


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_against_sql(spark, tables, name):
    result = queries()[name](spark, SF_DIR)
    columns = sorted(result.columns)
    relation = tables.execute(oracle_sql()[name])
    names = [d[0] for d in relation.description]
    assert sorted(names) == columns
    expected = sorted(tuple(map(str, (r[names.index(c)] for c in columns))) for r in relation.fetchall())
    assert sorted(tuple(map(str, r)) for r in result.select(*columns).collect()) == expected


def test_all_queries_and_the_pipeline_are_registered():
    names = entry_module.queries()
    assert "pipeline" in names
    assert {int(m[1]) for n in names if (m := re.match(r"op(\d+)_", n))} == set(range(1, 14))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "near_dedup", "repeated_passages", "packing"]


def test_simhash(spark, documents):
    fps = [plain_fingerprint(r[1]) for r in documents]
    member = components(fps)
    expected = {r[0]: (format(f, "016x"), documents[m][0]) for r, f, m in zip(documents, fps, member, strict=True)}
    found = queries()["op1_simhash"](spark, SF_DIR).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in found} == expected


def test_language_model(spark, documents):
    found = {r.doc_id: r for r in queries()["op2_lm_score"](spark, SF_DIR).collect()}
    for doc_id, held_out, n_tokens, n_known, train_tokens, base, score in plain_scores(documents, STATE_WEIGHT):
        r = found[doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held_out, n_tokens, n_known, train_tokens)
        assert r.base_score == pytest.approx(base) and r.score == pytest.approx(score)
    held_out = [r for r in found.values() if r.held_out]
    assert sum(r.score for r in held_out) > sum(r.base_score for r in held_out)


def test_quality(spark, documents, tables):
    found = {r.doc_id: r for r in queries()["op3_quality"](spark, SF_DIR).collect()}
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert {i: tuple(r[n] for n in names) for i, r in found.items()} == {r[0]: plain_measures(r[1]) for r in documents}
    labels = dict(tables.execute("SELECT doc_id, quality FROM labels").fetchall())
    good = [found[i] for i, q in labels.items() if q == 1 and not found[i].base_failed]
    bad = [found[i] for i, q in labels.items() if q == 0 and not found[i].base_failed]
    assert sum(r.kept for r in good) >= 0.97 * len(good) and sum(r.kept for r in bad) <= 0.1 * len(bad)


def test_language_of_held_out_documents(spark, documents):
    found = {r.doc_id: r for r in queries()["op4_langid"](spark, SF_DIR).collect()}
    lang = {r[0]: r[2] for r in documents}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in found.items())
    held_out = [r for r in found.values() if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held_out) >= 0.97 * len(held_out)


def test_quality_of_held_out_documents(spark, documents, tables):
    found = {r.doc_id: r for r in queries()["op11_quality_classifier"](spark, SF_DIR).collect()}
    assert set(found) == {r[0] for r in documents}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in found.items())
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in found.values())
    labels = dict(tables.execute("SELECT doc_id, quality FROM labels").fetchall())
    known = [(found[i].score, q) for i, q in labels.items() if i in found]
    good, bad = ([s for s, q in known if q == label] for label in (1, 0))
    assert sum((g > b) + 0.5 * (g == b) for g in good for b in bad) >= 0.95 * len(good) * len(bad)
    assert sum((s >= 0.3) == (q == 1) for s, q in known) >= 0.9 * len(known)


def check_sequences(rows):
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        ends = np.cumsum([length for _, length in sorted(places)])
        assert [o for o, _ in sorted(places)] == [0, *ends[:-1].tolist()] and ends[-1] <= 4096
    return len(sequences)


def check_pieces(rows, texts):
    """Pieces cover the ids of each document, told apart by its id."""
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = {i: [*e.ids, 2] for i, e in zip(texts, tokenizer.encode_batch([t or "" for t in texts.values()], add_special_tokens=False), strict=True)}
    pieces = defaultdict(list)
    for r in rows:
        part = np.array(ids[r.doc_id][r.start : r.start + r.length], dtype="<u4")
        assert zlib.crc32(part.tobytes()) == r.ids_crc32 and r.doc_tokens == len(ids[r.doc_id])
        pieces[r.doc_id].append((r.start, r.length))
    for doc_id, found in pieces.items():
        ends = np.cumsum([length for _, length in sorted(found)])
        assert [s for s, _ in sorted(found)] == [0, *ends[:-1].tolist()] and ends[-1] == len(ids[doc_id])
    assert set(pieces) == set(ids)
    return sum(map(len, ids.values()))


def test_packing(spark, documents):
    rows = queries()["op5_packing"](spark, SF_DIR).collect()
    total = check_pieces(rows, {r[0]: r[1] for r in documents})
    assert check_sequences(rows) <= 1.03 * math.ceil(total / 4096) + 1


def test_bpe(spark, documents):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected = {}
    for doc_id, text, *_ in documents:
        ids = library.encode(text or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        digest = hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
        expected[doc_id] = (len(ids), digest, hashlib.sha256(back.encode()).hexdigest())
    found = queries()["op6_bpe"](spark, SF_DIR).collect()
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in found} == expected


def test_sharding(spark, documents):
    rows = queries()["op8_sharding"](spark, SF_DIR).collect()
    expected = {r[0]: (len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in documents}
    assert {r.doc_id: (r["size"], r.text_crc32) for r in rows} == expected and {r.law for r in rows} == {"bytes"}
    slots = defaultdict(list)
    total = Counter()
    for r in rows:
        slots[r.shard].append(r.slot)
        total[r.shard] += r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    # Boundaries lie at the nearer edge of a document or group of copies.
    group = Counter(zlib.crc32((r[1] or "").encode()) for r in documents)
    largest = max(e[0] * min(group[e[1]], 3) for e in expected.values())
    assert max(total.values()) - sum(total.values()) / 16 <= largest


def test_pipeline(spark, documents, tables):
    """Every stage against a plain version of it, on what the stage before it kept."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    by_stage = {}
    for name, function in corpus_pipeline.STAGES:
        columns = docs.columns
        docs = function(spark, docs, SF_DIR)
        docs = corpus_pipeline.stage(docs, name)
        by_stage[name] = docs.collect()
        assert name == "packing" or docs.columns == columns

    # Quality: the base rules, and the mean log ratio with the threshold between the held-out classes.
    trusted = quality.sample_labels(spark.read.parquet(f"{SF_DIR}/labels.parquet"))
    fit = {int(i): bool(f) for i, f in zip(trusted.ids, trusted.fit, strict=True)}
    good = {int(i): bool(g) for i, g in zip(trusted.ids, trusted.good, strict=True)}
    raw, target = Counter(), Counter()
    buckets = {r[0]: quality.buckets_of((r[1] or "").encode()).tolist() for r in documents}
    for doc_id, found in buckets.items():
        raw.update(found)
        if good.get(doc_id) and fit[doc_id]:
            target.update(found)
    n_raw, n_target = sum(raw.values()) + quality.BUCKETS, sum(target.values()) + quality.BUCKETS
    score = {
        i: sum(math.log((target[b] + 1) / n_target) - math.log((raw[b] + 1) / n_raw) for b in found) / len(found)
        for i, found in buckets.items()
        if found
    }
    measures = {r[0]: plain_measures(r[1]) for r in documents}
    failed = {i for i, m in measures.items() if m[0] < 20 or 100 * m[4] > 30 * m[0]}
    held_good = sorted(score[i] for i, g in good.items() if g and not fit[i] and i not in failed)
    held_bad = [score[i] for i, g in good.items() if not g and i not in failed]
    low = held_good[int(quality.LOST_GOOD * len(held_good))]
    cut = (low + max(b for b in held_bad if b < low)) / 2
    kept = [r for r in documents if r[0] not in failed and score[r[0]] >= cut]
    assert sorted(map(tuple, by_stage["quality"])) == sorted(kept)

    first = {}
    for r in kept:
        first.setdefault(normal(r[1]), r)
    kept = list(first.values())
    assert sorted(map(tuple, by_stage["exact_dedup"])) == sorted(kept)

    kept.sort()
    member = components([plain_fingerprint(r[1]) for r in kept])
    kept = [r for i, r in enumerate(kept) if member[i] == i]
    assert sorted(map(tuple, by_stage["near_dedup"])) == sorted(kept)

    texts = [r[1].encode() for r in kept]
    left = {}
    for r, text, spans in zip(kept, texts, plain_spans(texts, 200), strict=True):
        for a, b in reversed(spans):
            text = text[:a] + text[b:]
        left[r[0]] = text.decode(errors="ignore")
    assert {r.doc_id: r.text for r in by_stage["repeated_passages"]} == left
    assert all(r.n_chars == len(r.text) for r in by_stage["repeated_passages"])

    check_pieces(by_stage["packing"], left)
    check_sequences(by_stage["packing"])
