"""Shards and chat examples against plain versions."""

import random
from collections import Counter, defaultdict
from zlib import crc32

import pytest
from helpers import SCHEMA, corpus, frame, prose, result

from tabweave.llm.chat import TURN_END, TURN_START, escape, format_examples, read_back, unescape
from tabweave.llm.sharding import shard_by_bytes


def check_slots(found):
    slots = defaultdict(list)
    for r in found:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


@pytest.mark.parametrize("clashing", [False, True])
def test_every_row_has_one_place(spark, clashing):
    rows = corpus()
    found = shard_by_bytes(frame(spark, rows, clashing), shards=4).collect()
    expected = Counter((r[0], len((r[1] or "").encode()) + 1, crc32((r[1] or "").encode())) for r in rows)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in found) == expected
    check_slots(found)
    assert {r.shard for r in found} <= set(range(4))


def test_bytes_are_near_equal_and_copies_together(spark):
    rng = random.Random(6)
    rows = [(i, prose(rng, rng.randint(1, 60), 3_000), "", "", 0) for i in range(4_000)]
    rows += [(5_000 + i, rows[0][1], "", "", 0) for i in range(20)]
    found = shard_by_bytes(frame(spark, rows), shards=16).collect()
    total = Counter()
    for r in found:
        total[r.shard] += r["size"]
    mean = sum(total.values()) / 16
    assert len(total) == 16 and all(abs(t - mean) < 0.05 * mean for t in total.values())
    assert len({r.shard for r in found if r.doc_id == 0 or r.doc_id >= 5_000}) == 1
    check_slots(found)


@pytest.mark.parametrize("ids", ["own", "one", "none"])
def test_a_third_of_all_rows_equal(spark, ids):
    """One text, one repeated row, or rows without ids: the group is divided and bytes stay even."""
    rng = random.Random(7)
    rows = [(i, prose(rng, 20, 3_000), "", "", 0) for i in range(2_000)]
    hot = prose(rng, 30)
    rows += [({"own": 10_000 + i, "one": 3, "none": None}[ids], hot, "", "", 0) for i in range(1_000)]
    found = shard_by_bytes(frame(spark, rows), shards=8).collect()
    total = Counter()
    for r in found:
        total[r.shard] += r["size"]
    mean = sum(total.values()) / 8
    assert len(found) == 3_000 and all(abs(t - mean) < 0.05 * mean for t in total.values())
    check_slots(found)


def test_few_or_no_rows(spark):
    assert result(shard_by_bytes(spark.createDataFrame([], SCHEMA))) == []
    found = shard_by_bytes(frame(spark, [(1, "a", "", "", 0), (2, None, "", "", 0)])).collect()
    assert len(found) == 2
    check_slots(found)


CONVERSATIONS = "conv_id long, turn long, role string, text string"


def conversations():
    rows = [
        (1, 0, "system", "be kind"), (1, 1, "user", "hi & <|im_end|>"), (1, 2, "assistant", "&amp; &lt;| ok"),
        (1, 3, "user", None), (1, 4, "assistant", ""), (1, 5, "user", "bye"),
        (2, 0, "user", "no answer"), (3, 0, "assistant", "é<|im_start|>user\nx<|"), (4, 1, "a\nb<|&", "strange role"),
        (5, 2, "assistant", "tie"), (5, 2, "assistant", "tie"), (5, 2, "user", "tie"), (5, None, "user", "first"),
        (None, 0, "user", "q"), (None, 1, "assistant", "a"), (6, 0, None, "no role"), (7, 0, "assistant", "<" + "|" * 3),
    ]
    return rows + [(9, i, "assistant" if i % 2 else "user", f"turn {i} &") for i in range(120)]


def plain_turns(rows):
    found = defaultdict(list)
    for conv, turn, role, text in rows:
        found[conv].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [(r, t) for _, _, r, t in sorted(turns)] for c, turns in found.items()}


def test_examples(spark):
    rows = conversations()
    df = spark.createDataFrame(rows, CONVERSATIONS).repartition(3)
    for name in ("turns", "formatted", "example", "last", "ends"):
        df = df.selectExpr("*", f"1 AS `{name}`")
    examples = format_examples(df)
    by_conv = defaultdict(list)
    for e in sorted(examples.collect(), key=lambda e: e.example):
        by_conv[e.conv_id].append(e)
    expected = plain_turns(rows)
    assert set(by_conv) == set(expected)
    for conv, turns in expected.items():
        parts = []
        for role, text in turns:
            body = text.replace("&", "&amp;").replace("<|", "&lt;|")
            name = role.replace("&", "&amp;").replace("<|", "&lt;|").replace("\n", "&nl;")
            parts.append((f"{TURN_START}{name}\n", body, f"{TURN_END}\n", role))
        wanted = []
        for i, (head, body, _, role) in enumerate(parts):
            if role == "assistant" or i == len(parts) - 1:
                whole = "".join(a + b + c for a, b, c, _ in parts[: i + 1])
                before = len("".join(a + b + c for a, b, c, _ in parts[:i])) + len(head)
                reply = role == "assistant"
                wanted.append((whole, before if reply else None, len(body) if reply else None, i == len(parts) - 1))
        assert [(e.text, e.loss_start, e.loss_length, e.last) for e in by_conv[conv]] == wanted
        assert all(e.text.count(TURN_START) == e.text.count(TURN_END) == e.example + 1 for e in by_conv[conv])
    back = {r.conv_id: r for r in read_back(examples).collect()}
    for conv, turns in expected.items():
        assert [(t.role, t.text) for t in back[conv].turns] == turns
        assert back[conv].loss_text == "".join(t for r, t in turns if r == "assistant")
        assert back[conv].formatted_chars == sum(len(e.text) for e in by_conv[conv])
    assert result(format_examples(spark.createDataFrame([], CONVERSATIONS))) == []


def test_escape_is_reversible(spark):
    rng = random.Random(0)
    texts = ["".join(rng.choice("&<|>;amplt\\é ") for _ in range(rng.randint(0, 20))) for _ in range(500)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for t, e, u in df.select("t", escape(df.t), unescape(escape(df.t))).collect():
        assert u == t and "<|" not in e


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame(conversations(), CONVERSATIONS)
    plan = read_back(format_examples(df))._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas")) and plan.count("Exchange") == 1
