"""Conversation repair against every sequence of edits, and the query against a plain copy of its contract."""

import hashlib
import heapq
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from clickloom.llm import dialogue as d
from clickloom.llm.queries import QUERIES

TESTDATA = "/root/testdata"
SCHEMA = "conv_id bigint, turn bigint, role string, text string, audit string, key string, tag int"
SPACE = " \t\n\x0b\x0c\r"


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        bare = text.strip(SPACE)
        kind = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
        seen.add((role, text))
        out.append(kind)
    return out


def cheapest(rows, kinds):
    """(cost, audit, repaired rows): the least of all ways, found from the cheapest, audits as text."""
    ways = [(0, "", 0, "", ())]
    done = set()
    while ways:
        cost, audit, at, roles, kept = heapq.heappop(ways)
        if at == len(rows) and re.fullmatch("(s?(ua)+)?", roles):
            return cost, audit, kept
        if (at, roles[-1:]) in done:
            continue
        done.add((at, roles[-1:]))

        def go(more, letter, step, row=None):
            now = roles + (row[0][:1] if row else "")
            if row is None or re.fullmatch("s?(ua)*u?", now):
                heapq.heappush(ways, (cost + more, audit + letter, at + step, now, kept + ((row,) if row else ())))

        for role in ("user", "assistant"):
            go(2, "I", 0, (role, ""))
        if at < len(rows):
            _, role, text = rows[at]
            go(3, "D", 1)
            if kinds[at] in ("", "truncated"):
                stays = kinds[at] == "truncated"
                go(stays, "K", 1, (role, text)) if role[:1] in ("s", "u", "a") else None
                for other in ("user", "assistant"):
                    go(2 + stays, "R", 1, (other, text))


def brute(rows):
    """The contract's columns for one conversation's rows after damage."""
    rows = ordered(rows)
    kinds = faults(rows)
    cost, audit, kept = cheapest(rows, kinds)
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest()
    return (gaps, *(kinds.count(k) for k in ("blank", "duplicate", "truncated")), illegal, int(cost), audit, sha)


def damaged(rows):
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        harm = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        out[conv] += [] if harm == 0 else [
            (turn, "user" if harm == 4 else role, "" if harm == 1 else re.sub("[.!?]", "", text) if harm == 2 else text)
        ] * (2 if harm == 3 else 1)
    return out


def repaired(spark, rows, **options):
    frame = spark.createDataFrame([(*r, "x", "y", 3) for r in rows], SCHEMA)
    found = d.repair(frame, **options)
    hashes = {r.conv_id: r.sha256 for r in d.digests(d.repaired(frame, found, **options)).collect()}
    empty = hashlib.sha256(b"").hexdigest()
    return {r.conv_id: (*r[1:], hashes.get(r.conv_id, empty)) for r in found.collect()}


def drawn(seed, conversations, most):
    draw = random.Random(seed)
    rows = []
    for conv in range(conversations):
        for _ in range(draw.randrange(1, most)):
            turn = draw.choice([None, *range(12)])
            role = draw.choice(["system", "user", "user", "assistant", "assistant", "tool", "", "u"])
            rows.append((conv or None, turn, role, draw.choice(["Yes.", "no", "", " \t", "So?", "Über\n", "ok!\n", "a.b", "w"])))
    return rows


@pytest.mark.parametrize("step", [d.STEP, 3])
def test_equals_the_least_of_all_ways(spark, monkeypatch, step):
    monkeypatch.setattr(d, "STEP", step)
    rows = drawn(5, 60, 14)
    groups = defaultdict(list)
    for conv, *row in rows:
        groups[conv].append(tuple(row))
    got = repaired(spark, rows)
    assert got == {conv: brute(own) for conv, own in groups.items()}


def test_runs_combine_like_one_run():
    draw = random.Random(2)
    rows = tuple((draw.choice("suax"), draw.random() < 0.2, draw.randrange(2)) for _ in range(200))
    for size in (1, 7, 64):
        fold = d.Fold()
        for at in range(0, len(rows), size):
            fold.add(d.table_of(rows[at : at + size]))
        assert d.cheapest(fold.result()) == d.cheapest(d.table_of(rows))


def test_one_conversation_over_many_tasks(spark):
    """A hot conversation is in several partitions; its repair is that of its rows in a row."""
    rows = [(1, k, ["user", "assistant", "tool"][k % 3], f"{k % 700} is.") for k in range(3000)] + [(2, 0, "system", "Go.")]
    got = repaired(spark, rows)
    fold, seen = d.Fold(), set()
    for _, _, role, text in rows[:3000]:
        fold.add(d.table_of(((role[:1], (role, text) in seen, 0),)))
        seen.add((role, text))
    assert got[1][5:7] == d.cheapest(fold.result())
    assert got[1][2] == 3000 - len(seen)
    assert got[2][5:7] == (3, "D")


def test_many_equal_rows(spark):
    got = repaired(spark, [(1, 0, "user", "Yes.")] * 500 + [(1, 1, "assistant", "No.")])
    assert got[1][:7] == (0, 0, 499, 0, 499, 1497, "K" + "D" * 499 + "K")


def test_no_rows(spark):
    assert repaired(spark, []) == {}


def test_long_text(spark):
    text = "words and " * 200_000 + "end."
    got = repaired(spark, [(1, 0, "user", text), (1, 1, "assistant", " " * 1_000_000)])
    assert got[1][:7] == (0, 1, 0, 0, 0, 5, "KDI")
    assert got[1][7] == hashlib.sha256(f"user:{text}\nassistant:".encode()).hexdigest()


def test_query_equals_its_contract(spark, tmp_path):
    rows = drawn(9, 120, 9)
    frame = spark.createDataFrame([(*r, "x", "y", 3) for r in rows], SCHEMA)
    frame.write.parquet(str(tmp_path / "conversations.parquet"))
    check(QUERIES["op13_conversation_repair"](spark, str(tmp_path)), rows)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_on_whole_tables(spark, sf):
    table = spark.read.parquet(f"{TESTDATA}/{sf}/conversations.parquet")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    check(QUERIES["op13_conversation_repair"](spark, f"{TESTDATA}/{sf}"), rows)


def check(result, rows):
    assert result.columns == "conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256".split()
    got = {r.conv_id: tuple(r)[1:] for r in result.collect()}
    want = {conv: brute(own) for conv, own in damaged(rows).items()}
    assert got == want
