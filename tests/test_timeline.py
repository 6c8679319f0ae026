import random

import pytest

from callweave.operators import timeline as T

SCHEMA = "file string, pos long, start double, end double, text string, audio double"


def filled(rows):
    out, before = [], 0.0
    rows = [r for r in rows if (r[4] or "").strip()]
    for i, (f, p, s, e, _, audio) in enumerate(rows):
        s = before if s is None else s
        if e is None:
            later = next((q[2] for q in rows[i + 1 :] if q[2] is not None), None)
            e = later if later is not None and later > s else audio if audio is not None and audio > s else s
        before = e
        out.append((f, p, s, e))
    return out


def repaired(rows, tolerance=0.5):
    out, offset, before = [], 0.0, 0.0
    for f, p, s, e in rows:
        reset = s + offset < before - tolerance
        if reset:
            offset = before - s
        s += offset
        e = before = max(e + offset, s)
        out.append((f, p, round(s, 6), round(e, 6), reset))
    return out


def series(seed, n=150):
    rng = random.Random(seed)
    rows = []
    for file, audio in (("a", 400.0), ("b", 20.0), ("c", None)):
        t = 0.0
        for pos in range(n):
            t += rng.random() * 2 if rng.random() > 0.06 else -t * 0.9
            s = round(t, 3) if rng.random() > 0.45 else None
            e = round(t + rng.random() * 3, 3) if rng.random() > 0.5 else None
            rows.append((file, pos, s, e, rng.choice([" x ", "  ", None, "　"]) if rng.random() < 0.2 else " z", audio))
    return rows


@pytest.mark.parametrize("block", [1, 3, 40, 1000])
def test_repairs_like_the_folds(spark, block):
    rows = series(block)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    fills = [x for f in "abc" for x in filled([r for r in rows if r[0] == f])]
    got = T.fill_times(df, "audio", block)
    assert sorted((r.file, r.pos, r.start, r.end) for r in got.collect()) == sorted(fills)
    again = T.repair_restarts(got, block_rows=block)
    expected = [x for f in "abc" for x in repaired([r for r in fills if r[0] == f])]
    assert sorted((r.file, r.pos, round(r.start, 6), round(r.end, 6), r.reset) for r in again.collect()) == sorted(expected)


def test_chain_of_missing_times(spark):
    rows = [("f", 0, 0.0, None, "a", 10.0), ("f", 1, None, None, "b", 10.0), ("f", 2, 5.0, 6.0, "c", 10.0)]
    got = [(r.start, r.end) for r in T.fill_times(spark.createDataFrame(rows, SCHEMA), "audio").orderBy("pos").collect()]
    assert got == [(0.0, 5.0), (5.0, 10.0), (5.0, 6.0)]
    moved = T.prepare(spark.createDataFrame(rows, SCHEMA), "audio").orderBy("pos").collect()
    assert [(r.start, r.end, r.reset) for r in moved] == [(0.0, 5.0, False), (5.0, 10.0, False), (10.0, 11.0, True)]


def test_text_keeps_its_leading_space_and_blank_chunks_go(spark):
    rows = [("f", 0, 0.0, 1.0, " a \n", None), ("f", 1, 1.0, 2.0, " \t　", None), ("f", 2, 2.0, 3.0, None, None)]
    assert [r.text for r in T.fill_times(spark.createDataFrame(rows, SCHEMA)).collect()] == [" a"]


def test_restart_only_beyond_the_tolerance(spark):
    rows = [("f", 0, 0.0, 2.0, "a", None), ("f", 1, 1.5, 3.0, "b", None), ("f", 2, 2.25, 4.0, "c", None)]
    assert [r.reset for r in T.repair_restarts(spark.createDataFrame(rows, SCHEMA)).orderBy("pos").collect()] == [False, False, True]


def test_empty_series(spark):
    assert T.prepare(spark.createDataFrame([], SCHEMA), "audio").count() == 0


def test_coverage(spark):
    chunks = spark.createDataFrame([("a", 8.0, False), ("a", 5.0, True), ("b", 9.5, False), ("c", 1.0, False)], "file string, end double, reset boolean")
    audio = spark.createDataFrame([("a", 10.0), ("b", 10.0), ("c", None), ("d", 4.0), ("e", 0.0)], "file string, audio_seconds double")
    got = {r.file: (r.transcript_end, r.ratio, r.short_transcript, r.cause) for r in T.coverage(chunks, audio).collect()}
    assert got == {"a": (8.0, 0.8, True, "restarted clock"), "b": (9.5, 0.95, False, None), "c": (1.0, None, False, None), "d": (0.0, 0.0, True, "missing end"), "e": (0.0, None, False, None)}
