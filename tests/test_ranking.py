"""Pruned ranking and struck pairs against every score computed."""

import subprocess
import sys
from pathlib import Path

import duckdb
import numpy as np
import pytest

import __spark_entry__ as entry_module
from clickloom import operators as ops
from clickloom import plans

COLUMNS = "id int, features array<float>"


def drawn(seed, n, spread, whole=False):
    """Factors whose lengths differ much, some of them zero or negative, as 32-bit numbers."""
    draw = np.random.default_rng(seed)
    rows = draw.normal(0, 1, (n, 4)) * np.exp(spread * draw.normal(0, 1, (n, 1)))
    rows[::17] = 0
    rows = np.round(rows) if whole else rows
    return [(int(i * 7 % n), [float(x) for x in np.float32(r)]) for i, r in enumerate(rows)]


def best(visitors, items, k, seen=()):
    out, struck = {}, set(seen)
    for v, f in visitors:
        scores = []
        for i, g in items:
            total = 0.0
            for a, b in zip(f, g):
                total += a * b
            if (v, i) not in struck:
                scores.append((-total, i))
        out[v] = [(i, -s) for s, i in sorted(scores)[:k]]
    return out


def ranked(spark, visitors, items, k, *per_block, seen=None, met=None):
    sides = (spark.createDataFrame(rows, COLUMNS) for rows in (visitors, items))
    struck = seen and spark.createDataFrame(seen, "id int, itemid int")
    rows = ops.rank_items(*sides, k, *per_block, seen=struck, met=met).collect()
    return {r.id: [tuple(x) for x in r.ranked] for r in rows}


@pytest.mark.parametrize("per_block", [(4096, 4096), (13, 30), (40, 7), (1, 100)])
@pytest.mark.parametrize("whole", [False, True])
def test_pruning_changes_nothing(spark, per_block, whole):
    visitors, items = drawn(1, 61, 0.5, whole), drawn(2, 211, 1.0, whole)
    met = {}
    assert ranked(spark, visitors, items, 5, *per_block, met=met) == best(visitors, items, 5)
    assert met["all"] == 61 * -(-211 // per_block[1]) and met["scored"] <= met["all"]


def test_short_items_are_not_met(spark):
    """Lengths fall tenfold from block to block, so that hardly a visitor needs the second one."""
    draw = np.random.default_rng(0)
    items = [(i, (draw.random(4) * 10.0 ** -(i // 20)).tolist()) for i in range(200)]
    visitors = [(v, draw.random(4).tolist()) for v in range(50)]
    items, visitors = ([(i, [float(x) for x in np.float32(f)]) for i, f in side] for side in (items, visitors))
    met = {}
    assert ranked(spark, visitors, items, 3, 10, 20, met=met) == best(visitors, items, 3)
    assert met["all"] == 500 and met["scored"] <= 150


@pytest.mark.parametrize("per_block", [(4096, 4096), (9, 20), (61, 3)])
def test_seen_pairs_are_struck_out(spark, per_block):
    visitors, items = drawn(3, 61, 0.3, True), drawn(4, 120, 0.6, True)
    draw = np.random.default_rng(5)
    seen = [(int(v), int(i)) for v, i in zip(draw.integers(-5, 70, 900), draw.integers(-5, 130, 900))]
    seen += [(7, i) for i, _ in items]  # one that has seen everything
    seen += [(8, i) for i, _ in items[3:]] + seen[:50] + [(None, 3), (4, None)]
    want = best(visitors, items, 6, seen)
    assert want[7] == [] and len(want[8]) <= 3
    assert ranked(spark, visitors, items, 6, *per_block, seen=seen) == want


def test_recommending_leaves_out_what_was_seen(spark, events):
    log = events(*((n, n % 6, "view", (n * n) % 11) for n in range(120)))
    model = plans.fit_recommender(ops.ratings(log))
    users = spark.createDataFrame([("0",), ("5",), ("99",)], "visitorid string")
    seen = log.select("visitorid", "itemid").unionByName(log.limit(1).selectExpr("9 AS visitorid", "NULL AS itemid"))
    had = {(r.visitorid, r.itemid) for r in seen.collect()}
    every = {r.id for r in model.itemFactors.collect()}
    plain = {r.visitorid: [x.itemid for x in r.recommendations] for r in ops.recommend(model, users, 20).collect()}
    for row in ops.recommend(model, users, 20, exclude_seen=seen).collect():
        if row.visitorid == "99":
            assert row.recommendations == []
            continue
        own = {i for v, i in had if v == int(row.visitorid)}
        assert own and {x.itemid for x in row.recommendations} == every - own
        assert [x.itemid for x in row.recommendations] == [i for i in plain[row.visitorid] if i not in own]


FRESH = """
import sys
from clickloom.session import get_session
import __spark_entry__ as entry

spark = get_session(
    "fresh", **{"spark.master": "local[2]", "spark.sql.shuffle.partitions": "2", "spark.ui.enabled": "false", "spark.checkpoint.dir": sys.argv[2]}
)
entry.rank_unseen(spark, sys.argv[1]).write.parquet(sys.argv[3])
"""


def test_a_sessions_first_query_ranks(tmp_path):
    """In a process of its own, as attributes have small ids only there."""
    db = duckdb.connect()
    events = tmp_path / "events.parquet"
    db.sql(f"""COPY (SELECT i AS event_id, TIMESTAMP '2024-01-01' + to_seconds(i) AS ts, i % 23 AS user_id,
               CASE i % 5 WHEN 0 THEN 'purchase' WHEN 1 THEN 'click' ELSE 'view' END AS event_type, 1.5::DOUBLE AS value,
               '{{"k": ' || (i * i + i // 7) % 61 || '}}' AS props FROM range(900) r(i)) TO '{events}' (FORMAT parquet)""")
    args = [tmp_path, tmp_path / "shared", tmp_path / "ranked"]
    subprocess.run([sys.executable, "-c", FRESH, *map(str, args)], cwd=Path(__file__).parents[1], check=True, timeout=240)
    db.sql(f"CREATE VIEW events AS SELECT * FROM '{events}'")
    want = db.sql(f"SELECT visitorid, itemid, rating FROM ({entry_module.oracle_sql()['rank_unseen']})").fetchall()
    got = db.sql(f"SELECT visitorid, itemid, rating FROM '{args[2]}/*.parquet'").fetchall()
    assert len(want) > 200 and sorted(got) == sorted(want)
