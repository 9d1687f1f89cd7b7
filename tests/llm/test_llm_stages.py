"""Each pipeline stage on rows that are out of the ordinary: its defined cases."""

import pytest

import corpus_pipeline as pipeline

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, row string, found string, kept string, hits int"
PROSE = " ".join(f"Word{k} of the sentence, number {k}." for k in range(30))
OTHER = " ".join(f"Another{k} thing that was said, and {k} more." for k in range(30))


@pytest.fixture
def stage(spark, tmp_path):
    """Run a stage on rows (doc_id, text) with columns of clashing names."""

    def run(function, *rows, items=((1, "passage one two three four five six seven eight nine ten"),), labels=()):
        spark.createDataFrame(list(items), "item_id bigint, text string").write.mode("overwrite").parquet(str(tmp_path / "benchmark.parquet"))
        spark.createDataFrame(list(labels), "doc_id bigint, quality int, toxic int").write.mode("overwrite").parquet(str(tmp_path / "labels.parquet"))
        docs = spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t), "r", "f", "k", 7) for i, t in rows], SCHEMA)
        out = function(spark, docs, str(tmp_path))
        if function is not pipeline.encoding:
            assert out.columns == docs.columns
            assert all((r.row, r.found, r.kept, r.hits) == ("r", "f", "k", 7) for r in out.collect())
        return sorted(((r.doc_id, r.text) for r in out.collect()), key=str)

    return run


def ordered(*rows):
    return sorted(rows, key=str)


LONG = PROSE * 400


def test_quality_rules(stage):
    rows = (1, PROSE), (2, None), (3, ""), (4, " \n\t"), (None, PROSE), (1, OTHER), (5, "too short"), (6, "same words again " * 20), (7, OTHER + LONG[:50])
    assert stage(pipeline.quality_rules, *rows) == ordered((1, PROSE), (None, PROSE), (1, OTHER), (7, OTHER + LONG[:50]))
    assert stage(pipeline.quality_rules) == []
    assert stage(pipeline.quality_rules, (1, PROSE), labels=[(1, None, 0), (None, 1, 0), (9, 1, 0)]) == [(1, PROSE)]


def test_line_dedup(stage):
    line = "a line that is repeated"
    rows = (2, f"{line}\nown of two"), (1, f"{line}\n{line}"), (3, None), (4, ""), (5, f"  {line.upper()} "), (1, line), (None, f"x\n{line}"), (6, "short\nshort"), (7, "short")
    want = (2, "own of two"), (1, f"{line}\n{line}"), (3, ""), (4, ""), (5, ""), (1, line), (None, "x"), (6, "short\nshort"), (7, "short")
    assert stage(pipeline.line_dedup, *rows) == ordered(*want)
    assert stage(pipeline.line_dedup) == []
    assert stage(pipeline.line_dedup, (1, LONG)) == [(1, LONG)]


def test_near_dedup(stage):
    near = PROSE + " tail"
    rows = (4, PROSE), (2, near), (2, near), (3, None), (5, None), (6, ""), (None, PROSE), (None, PROSE), (7, "two words"), (8, "TWO words"), (9, LONG)
    want = (2, near), (2, near), (3, None), (5, None), (6, ""), (None, PROSE), (None, PROSE), (7, "two words")
    assert stage(pipeline.near_dedup, *rows) == ordered(*want)  # the long text repeats the words of its group
    assert stage(pipeline.near_dedup) == []


def test_decontamination(stage):
    passage = "passage one two three four five six seven eight nine ten"
    rows = (1, f"before {passage} after"), (2, None), (3, ""), (None, PROSE), (None, passage.upper()), (4, PROSE), (4, PROSE), (5, LONG + passage), (6, "left alone")
    items = (1, passage), (None, "left alone"), (3, None), (4, "")
    assert stage(pipeline.decontamination, *rows, items=items) == ordered((2, None), (3, ""), (None, PROSE), (4, PROSE), (4, PROSE))
    assert stage(pipeline.decontamination, *rows, items=()) == ordered(*rows)
    assert stage(pipeline.decontamination) == []


def test_encoding(stage):
    rows = (1, PROSE), (2, None), (3, ""), (None, "é \0 中"), (1, "again"), (4, "x" * 100_000)
    assert stage(pipeline.encoding, *rows) == ordered(*((i, t or "") for i, t in rows))
    assert stage(pipeline.encoding) == []
