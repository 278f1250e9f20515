"""Exact groups, SimHash components and repeated spans against plain versions."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from helpers import SCHEMA, corpus, frame, prose, result
from pyspark.sql import functions as F

from tabweave.llm import repeated_spans as spans_module
from tabweave.llm.components import connected_components
from tabweave.llm.exact_dedup import drop_copies, exact_groups
from tabweave.llm.repeated_spans import cut_repeats, phrases, repeated_spans
from tabweave.llm.simhash import drop_near_duplicates, fingerprint, fingerprints, links_in_cell, near_duplicates, near_links


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


@pytest.mark.parametrize("clashing", [False, True])
def test_exact_groups(spark, clashing):
    rows = corpus()
    found = exact_groups(frame(spark, rows, clashing)).collect()
    assert len(found) == len(rows)
    groups = defaultdict(list)
    for doc_id, text, *_ in rows:
        groups[normal(text)].append(doc_id)
    expected = Counter()
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        sha = hashlib.sha256(text.encode()).hexdigest()
        for i in ids:
            expected[i, min(known) if known else None, len(ids), sha] += 1
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found) == expected
    kept = Counter(r.text_sha256 for r in found if r.kept)
    assert set(kept.values()) == {1} and len(kept) == len(groups)
    assert all(r.doc_id == r.keep_id for r in found if r.kept)


def test_exact_groups_of_long_common_beginnings(spark):
    start = "same beginning " * 3_000
    rows = [(i, start + tail, "", "", 0) for i, tail in enumerate(["a", "b", "a", "", start, start])]
    found = {r.doc_id: (r.keep_id, r.group_size) for r in exact_groups(frame(spark, rows)).collect()}
    assert found == {0: (0, 2), 1: (1, 1), 2: (0, 2), 3: (3, 1), 4: (4, 2), 5: (4, 2)}


def test_drop_copies_keeps_rows_whole(spark):
    rows = corpus()
    kept = drop_copies(frame(spark, rows)).collect()
    assert Counter(normal(r.text) for r in kept) == Counter({normal(t) for _, t, *_ in rows})
    assert {tuple(r) for r in kept} <= set(rows)


def plain_fingerprint(text, shingle=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    hashes = [
        xxhash.xxh64_intdigest(" ".join(words[i : i + shingle]).encode(), 42)
        for i in range(max(1, len(words) - shingle + 1))
    ]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def components(fps, bits=4):
    parent = list(range(len(fps)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


@pytest.mark.parametrize("clashing", [False, True])
def test_near_duplicates(spark, clashing):
    rows = corpus() + [(1000, "É " + "ABC def " * 9, "", "", 0), (1001, "É " + "abc DEF " * 9, "", "", 0)]
    fps = [plain_fingerprint(r[1]) for r in rows]
    assert fps == [fingerprint((r[1] or "").encode()) for r in rows]
    member = components(fps)
    least = {}
    for r, m in zip(rows, member, strict=True):
        if r[0] is not None:
            least[m] = min(least.get(m, r[0]), r[0])
    expected = Counter((r[0], f if f < 2**63 else f - 2**64, least.get(m)) for r, f, m in zip(rows, fps, member, strict=True))
    assert Counter(map(tuple, near_duplicates(frame(spark, rows, clashing)).collect())) == expected
    stay = drop_near_duplicates(frame(spark, rows, clashing)).collect()
    assert len(stay) == len(set(member))


def flipped(rng, fp, most):
    for bit in rng.sample(range(64), rng.randint(0, most)):
        fp ^= 1 << bit
    return fp


@pytest.mark.parametrize("seed", range(3))
def test_grid_finds_every_link(spark, seed):
    """Clusters around random centres, and crowded ones, where chains of links matter."""
    rng = random.Random(seed)
    centres = [rng.getrandbits(64) for _ in range(25)]
    fps = {flipped(rng, rng.choice(centres), 5) for _ in range(300)} | {flipped(rng, centres[0], 9) for _ in range(200)}
    fps = sorted(fps | {0, 2**64 - 1, 1, 0b1111})
    signed = [f if f < 2**63 else f - 2**64 for f in fps]
    links = near_links(spark.createDataFrame([(f,) for f in signed], "fp long").repartition(3))
    found = {r.node: r.component for r in connected_components(links).collect()}
    member = components(fps)
    by_mine, by_found = defaultdict(set), defaultdict(set)
    for f, m in zip(signed, member, strict=True):
        by_mine[m].add(f)
        by_found[found.get(f, f)].add(f)
    assert sorted(map(sorted, by_mine.values())) == sorted(map(sorted, by_found.values()))


def test_crowded_cell_leaves_fewer_links_than_members():
    rng = random.Random(9)
    fps = np.array(sorted({flipped(rng, 12345, 6) for _ in range(2_000)}), dtype=np.uint64)
    links = links_in_cell(fps)
    assert len(links) < len(fps)
    linked = components([int(f) for f in fps])
    parent = list(range(len(fps)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        parent[max(find(a), find(b))] = min(find(a), find(b))
    assert [find(i) for i in range(len(fps))] == linked


def test_components_of_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(200, 200), (139, 150), (150, 139)]
    found = dict(connected_components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert found == {i: 0 for i in range(41)} | {i: 100 for i in [*range(100, 140), 150]}


def plain_spans(texts, length):
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        marked = np.zeros(len(t), dtype=bool)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                marked[i : i + length] = True
        edges = np.flatnonzero(np.diff(np.concatenate([[0], marked.astype(np.int8), [0]])))
        out.append(list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True)))
    return out


@pytest.mark.parametrize("clashing", [False, True])
@pytest.mark.parametrize("crowded", [spans_module.CROWDED, 2])
def test_repeated_spans(spark, monkeypatch, clashing, crowded):
    monkeypatch.setattr(spans_module, "CROWDED", crowded)
    rows = corpus()
    texts = [(r[1] or "").encode() for r in rows]
    expected = Counter()
    for r, t, spans in zip(rows, texts, plain_spans(texts, 200), strict=True):
        left = t
        for a, b in reversed(spans):
            left = left[:a] + left[b:]
        expected[r[0], len(t), tuple(spans), left] += 1
    found = repeated_spans(frame(spark, rows, clashing)).collect()
    assert Counter((r.doc_id, r.n_bytes, tuple(map(tuple, r.spans)), bytes(r.kept)) for r in found) == expected
    assert sum(bool(k[2]) for k in expected) > 8


def test_texts_of_null_ids_whose_hashes_meet(spark):
    """Two texts without id that share 32 bits of their hash keep their own spans."""
    rng = random.Random(4)
    passage, alone = prose(rng, 60, 5_000), prose(rng, 60, 5_000)
    seen = {xxhash.xxh64_intdigest(f"{passage} {i}", 42) >> 32: i for i in range(1 << 17)}
    met = ((seen.get(xxhash.xxh64_intdigest(f"{alone} {i}", 42) >> 32), i) for i in range(1 << 18))
    i, j = next((i, j) for i, j in met if i is not None)
    rows = [(None, f"{passage} {i}", "", "", 0), (None, f"{alone} {j}", "", "", 0), (7, passage, "", "", 0)]
    texts = [r[1].encode() for r in rows]
    expected = {t: s for t, s in zip(texts, plain_spans(texts, 200), strict=True)}
    found = repeated_spans(frame(spark, rows), carry=["text"]).collect()
    assert {r.carried.text.encode(): list(map(tuple, r.spans)) for r in found} == expected
    assert [] in expected.values() and cut_repeats(frame(spark, rows)).where(F.col("text") == f"{alone} {j}").count() == 1


def test_spans_of_other_lengths_and_edits(spark):
    rng = random.Random(3)
    base = [prose(rng, 200, 5_000) for _ in range(4)]
    rows = []
    for i in range(60):
        text = list(rng.choice(base))
        for _ in range(rng.randrange(6)):
            text[rng.randrange(len(text))] = rng.choice("xyzé ")
        at = rng.randrange(len(text))
        rows.append((i, "".join(text[at:] + text[:at]), "", "", 0))
    texts = [r[1].encode() for r in rows]
    found = {r.doc_id: list(map(tuple, r.spans)) for r in repeated_spans(frame(spark, rows)).collect()}
    assert found == dict(enumerate(plain_spans(texts, 200)))


@pytest.mark.parametrize("length", [48, 700])
def test_spans_of_short_and_long_strings(spark, length):
    rng = random.Random(6)
    passage = prose(rng, 400, 5_000)
    rows = [(i, f"{prose(rng, 80, 5_000)} {passage[40 * i :]}", "", "", 0) for i in range(5)]
    found = {r.doc_id: list(map(tuple, r.spans)) for r in repeated_spans(frame(spark, rows), length=length).collect()}
    assert found == dict(enumerate(plain_spans([r[1].encode() for r in rows], length)))


@pytest.mark.parametrize("length", [0, 47, 65_536])
def test_lengths_that_have_no_place_are_refused(spark, length):
    with pytest.raises(ValueError, match="length"):
        repeated_spans(frame(spark, corpus()), length=length)


def test_long_texts_are_parsed_in_pieces(monkeypatch):
    """Every 200-byte string belongs to exactly one phrase, also across pieces."""
    rng = random.Random(1)
    texts = [prose(rng, 3_000).encode(), b"", b"a" * 5_000, prose(rng, 10).encode()]
    monkeypatch.setattr(spans_module, "_SEGMENT", 1_500)
    found = phrases(texts)
    covered = Counter()
    for doc, start, strings in zip(found["doc"].tolist(), found["start"].tolist(), found["strings"].tolist(), strict=True):
        for i in range(start, start + strings):
            covered[doc, i] += 1
    assert covered == Counter({(d, i): 1 for d, t in enumerate(texts) for i in range(len(t) - 199)})


def test_cut_repeats_keeps_columns_and_whole_characters(spark):
    rng = random.Random(2)
    shared = "é" * 150
    rows = [(1, f"{prose(rng, 20)}é{shared}", "fr", "s", 1), (2, f"{shared}{prose(rng, 20)}", "fr", "s", 2), (3, None, None, None, None)]
    cut = {r.doc_id: r for r in cut_repeats(frame(spark, rows)).collect()}
    assert cut[3].text is None and cut[1].source == "s"
    assert len(cut[1].text) < 250 and "�" not in cut[1].text


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    for operator in (exact_groups, drop_copies, near_duplicates, drop_near_duplicates, fingerprints, repeated_spans, cut_repeats):
        assert result(operator(empty)) == []


def test_texts_are_exchanged_once(spark):
    """Both joins with the texts read the same exchange: one scan of them feeds it, besides the one that parses."""
    keys = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        plan = repeated_spans(frame(spark, corpus()))._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    scans = [line for line in plan.split("\n") if "FileScan" in line and "numbered-texts" in line and "text#" in line]
    assert len(scans) == 1 and "ReusedExchange" in plan
