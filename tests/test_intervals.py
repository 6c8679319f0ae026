import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from callweave.operators import intervals as I


def merged(rows, gap=0):
    out = []
    for s, e in sorted(rows):
        if out and s <= out[-1][1] + gap:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [tuple(x) for x in out]


@pytest.mark.parametrize("spread,length", [(60_000, 2000), (2_000_000, 12), (300, 5)])
def test_continuous_periods_like_a_plain_merge(spark, spread, length):
    rng = random.Random(spread)
    rows = []
    for _ in range(6000):
        file = rng.choice(["hot"] * 5 + ["b", None, f"c{rng.randint(0, 40)}"])
        start = rng.randint(0, spread)
        rows.append((file, rng.choice(["x", None]), start, rng.choice([None, start, start - 4, start + 1, start + rng.randint(1, length)]), 7, True, "k"))
    # columns of names that the operator uses itself
    df = spark.createDataFrame(rows, "file string, label string, start long, end long, pid int, last boolean, kind string").repartition(5)
    got = sorted((r.file or "", r.label or "", r.kind, r.start, r.end) for r in I.continuous_periods(df, ["file", "label"]).collect())
    groups = defaultdict(list)
    for f, l, s, e, *_ in rows:
        if e is not None and e > s:
            groups[f or "", l or ""].append((s, e))
    expected = []
    for key, own in groups.items():
        periods = merged(own)
        expected += [(*key, "period", s, e) for s, e in periods] + [(*key, "gap", a[1], b[0]) for a, b in zip(periods, periods[1:])]
    assert got == sorted(expected)


def test_continuous_periods_of_one_entity_over_many_partitions(spark):
    rows = [("a", i * 10, i * 10 + (25 if i % 7 else 5)) for i in range(3000)] + [("a", 5, 20_000)]
    df = spark.createDataFrame(rows, "file string, start long, end long").repartition(9)
    got = sorted((r.start, r.end) for r in I.continuous_periods(df, ["file"]).where("kind = 'period'").collect())
    assert got == merged([r[1:] for r in rows])


def test_continuous_periods_edges(spark):
    empty = spark.createDataFrame([], "file string, start double, end double")
    assert I.continuous_periods(empty, ["file"]).count() == 0
    nan = float("nan")
    df = spark.createDataFrame([("a", 0.0, 1.0), ("a", 1.0, 2.0), ("a", 0.0, 1.0), ("a", nan, 5.0), ("a", 1.0, nan), ("a", None, 3.0), ("a", 4.0, 4.0), ("a", 2.5, 3.0)], "file string, start double, end double")
    got = sorted((r.kind, r.start, r.end) for r in I.continuous_periods(df, ["file"]).collect())
    assert got == [("gap", 2.0, 2.5), ("period", 0.0, 2.0), ("period", 2.5, 3.0)]


def test_union_is_idempotent_and_both_forms_agree(spark):
    rng = random.Random(3)
    rows = [(rng.choice("abc"), s := rng.randint(0, 500) / 10, s + rng.randint(-2, 30) / 10) for _ in range(400)]
    df = spark.createDataFrame(rows, "file string, start double, end double")
    once = I.union(df, ["file"], 0.1)
    twice = I.union(once, ["file"], 0.1)
    same = lambda d: sorted((r.file, r.start, r.end) for r in d.collect())
    assert same(once) == same(twice) == same(I.continuous_periods(df, ["file"], 0.1).where("kind = 'period'").drop("kind"))


def test_union_keeps_empty_intervals_if_asked(spark):
    df = spark.createDataFrame([("a", 1.0, 1.0), ("a", 3.0, 2.0), ("a", 5.0, 6.0)], "file string, start double, end double")
    assert I.union(df, ["file"]).count() == 1
    assert I.union(df, ["file"], keep_empty=True).count() == 3


def test_difference_and_coverage_make_up_the_whole(spark):
    rng = random.Random(5)
    rows = [("f", s := rng.randint(0, 2000), s + rng.randint(1, 60)) for _ in range(60)]
    cover = [("f", s := rng.randint(0, 2000), s + rng.randint(1, 60)) for _ in range(60)]
    make = lambda r: I.union(spark.createDataFrame(r, "file string, start long, end long"), ["file"])
    left = I.difference(make(rows), make(cover), ["file"], least=0, gap=0)
    inside = {t for _, s, e in rows for t in range(s, e)} - {t for _, s, e in cover for t in range(s, e)}
    assert {t for r in left.collect() for t in range(r.start, r.end)} == inside


def test_difference_drops_short_pieces_before_merging(spark):
    whole = spark.createDataFrame([("f", 0.0, 10.0)], "file string, start double, end double")
    covered = spark.createDataFrame([("f", 1.0, 1.05), ("f", 1.9, 5.0)], "file string, start double, end double")
    got = [(r.start, r.end) for r in I.difference(whole, covered, ["file"], 1.0, 0.1).orderBy("start").collect()]
    assert got == [(0.0, 1.0), (5.0, 10.0)]


def test_split_pieces(spark):
    df = spark.createDataFrame([("f", 0.0, 45.0, 1), ("f", 50.0, 70.0, 2), ("f", 80.0, 80.0, 3)], "file string, start double, end double, n int")
    got = sorted((r.n, r.start, r.end) for r in I.split(df, 20.0).collect())
    assert got == [(1, 0.0, 20.0), (1, 20.0, 40.0), (1, 40.0, 45.0), (2, 50.0, 70.0)]


def test_crop_clip_and_centre(spark):
    df = spark.createDataFrame([(0.2, 3.0, None), (5.0, 9.0, 9.2)], "s double, e double, a double")
    lo, hi = I.crop_window(F.col("s"), F.col("e"), F.col("a"))
    assert [tuple(r) for r in df.select(lo, hi).collect()] == [(0.0, 3.5), (4.5, 9.2)]
    words = spark.createDataFrame([(0.0, 1.0), (3.5, 9.0), (4.0, 5.0), (2.0, 2.0)], "start double, end double").withColumns({"crop_start": F.lit(10.0), "crop_end": F.lit(14.0)})
    assert sorted((r.start, r.end) for r in I.clip_to_crop(words).collect()) == [(10.0, 11.0), (13.5, 14.0)]
    edge = spark.createDataFrame([(0.0, 2.0, 1.0, 3.0), (2.0, 4.0, 1.0, 3.0), (2.1, 4.0, 1.0, 3.0)], "start double, end double, missing_start double, missing_end double")
    assert I.centred_in(edge).count() == 2


def test_gaps_are_split_as_a_query(spark, small, monkeypatch):
    from callweave.plans import queries

    got = queries.QUERIES["split_gaps_20"](spark, small).collect()
    gaps = queries.speech_gaps(spark, small).collect()
    assert got and abs(sum(r.end - r.start for r in got) - sum(r.end - r.start for r in gaps)) < 1e-3
    monkeypatch.setattr(queries, "turns", lambda *_: spark.createDataFrame([("f", "A", 0.0, 45.0)], "file string, label string, start double, end double"))
    monkeypatch.setattr(queries, "chunks", lambda *_: spark.createDataFrame([], "file string, start double, end double"))
    assert sorted((r.file, r.start, r.end) for r in queries.QUERIES["split_gaps_20"](spark, small).collect()) == [("f", 0.0, 20.0), ("f", 20.0, 40.0), ("f", 40.0, 45.0)]
