import random
import re

import pytest

from clickloom.llm import decontaminate as d

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(text, items, width=10):
    doc, hit, found = words(text), set(), set()
    for item, content in items:
        own = words(content)
        if not own:
            continue
        size = min(width, len(own))
        windows = {tuple(own[i : i + size]) for i in range(len(own) - size + 1)}
        for i in range(len(doc) - size + 1):
            if tuple(doc[i : i + size]) in windows:
                hit.update(range(i, i + size))
                found.add(item)
    return len(doc), len(hit), sorted(str(i) for i in found if i is not None), None in found


def result(documents, benchmark, **options):
    rows = d.contamination(documents, benchmark, **options).collect()
    return sorted(
        (r.doc_id, r.n_words, sum(r.hits[1::2]) - sum(r.hits[::2]), r["items"], r.unnamed) for r in rows
    )


@pytest.mark.parametrize("block_strings", [100_000, 7])
def test_matches_brute_force(documents, benchmark_items, block_strings):
    draw = random.Random(4)
    vocabulary = ["the", "of", "Über", "a1", "cat", "dog", "sat", "mat"]

    def text(n):
        return draw.choice([" ", ", ", "\n"]).join(draw.choice(vocabulary) for _ in range(n))

    items = [(k, text(n)) for k, n in enumerate([0, 1, 3, 9, 10, 11, 25, 40])] + [(90, None), (None, "the cat"), (7, "mat mat")]
    texts = [text(draw.randrange(0, 200)) for _ in range(40)] + [f"{text(5)} {items[7][1].upper()} {text(5)}", None, ""]
    docs = list(enumerate(texts)) + [(3, texts[3]), (3, texts[5])]
    got = result(documents(*docs), benchmark_items(*items), block_strings=block_strings)
    assert got == sorted((i, *brute(t, items)) for i, t in docs)


def test_words_across_texts_do_not_join(documents, benchmark_items):
    got = result(documents((1, "a b c d e"), (2, "f g h i j")), benchmark_items((1, "a b c d e f g h i j")))
    assert got == [(1, 5, 0, [], False), (2, 5, 0, [], False)]


def test_long_text(documents, benchmark_items):
    item = " ".join(f"w{k}" for k in range(12))
    text = "filler words here " * 60_000 + item
    assert result(documents((1, text)), benchmark_items((5, item))) == [(1, 180_012, 12, ["5"], False)]


def test_empty_tables(documents, benchmark_items):
    assert result(documents(), benchmark_items((1, "a b"))) == []
    assert result(documents((1, "a b")), benchmark_items()) == [(1, 2, 0, [], False)]


@pytest.mark.parametrize("block_strings", [100_000, 1])
def test_filter_keeps_columns(documents, benchmark_items, block_strings):
    docs = documents((1, "one two three"), (2, None), (3, "two"), (3, "two"), (4, "four more"), (None, "none five"))
    kept = d.without_contaminated(docs, benchmark_items((1, "three"), (None, "five"), (2, "four"), (3, None)), block_strings=block_strings)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3, 3]


@pytest.mark.parametrize("block_strings", [100_000, 30])
def test_matches_sql_with_null_ids(spark, benchmark_items, documents, block_strings, monkeypatch, tmp_path):
    """The registered query against its SQL, on items without ids among others, in one block and in several."""
    import duckdb

    from clickloom.llm import queries

    items = [(k if k % 3 else None, f"alpha beta gamma w{k} w{k + 1} delta") for k in range(40)]
    docs = [(k, f"start alpha beta gamma w{k} w{k + 1} delta then alpha beta gamma w{k + 2} w{k + 3} delta") for k in range(45)] + [(90, None)]
    documents(*docs).write.parquet(str(tmp_path / "documents.parquet"))
    benchmark_items(*items).write.parquet(str(tmp_path / "benchmark.parquet"))
    whole = queries.contamination
    monkeypatch.setattr(queries, "contamination", lambda a, b: whole(a, b, block_strings=block_strings))
    got = queries.op1_decontaminate(spark, str(tmp_path))
    db = duckdb.connect()
    for table in ("documents", "benchmark"):
        db.sql(f"CREATE VIEW {table} AS SELECT * FROM '{tmp_path}/{table}.parquet/*.parquet'")
    columns = ", ".join(sorted(got.columns))
    want = db.sql(f"SELECT {columns} FROM ({queries.ORACLE_SQL['op1_decontaminate']})").fetchall()
    assert sorted(map(tuple, got.select(*sorted(got.columns)).collect())) == sorted(want)
    assert any(r.contaminated for r in got.collect())
