import random

from callweave.config import Config
from callweave.models import from_table
from callweave.operators import recovery as R

WORD = "file string, pos long, start double, end double, text string"


def kept(original, recovered):
    have, out = [(w, (s + e) / 2) for _, _, s, e, w in original], []
    for r in recovered:
        centre = (r[2] + r[3]) / 2
        if not any(w == r[4] and abs(m - centre) <= 0.5 for w, m in have):
            have.append((r[4], centre))
            out.append(r)
    return out


def test_new_words_like_the_greedy_rule(spark):
    rng = random.Random(4)
    make = lambda n: [("f", i, s := rng.randint(0, 400) / 8, s + 0.25, rng.choice("가나다")) for i in range(n)]
    original, recovered = make(30), make(200)
    df = R.new_words(spark.createDataFrame(original, WORD), spark.createDataFrame(recovered, WORD))
    assert sorted(map(tuple, df.collect())) == sorted(kept(original, recovered))
    merged = R.merge_recovered(spark.createDataFrame(original, WORD), spark.createDataFrame(recovered, WORD)).orderBy("pos").collect()
    assert [r.start for r in merged] == sorted(r.start for r in merged) and len(merged) == 30 + len(kept(original, recovered))


def test_same_word_is_told_by_letters_and_digits(spark):
    one = spark.createDataFrame([("f", 0, 0.0, 1.0, " Hello, ")], WORD)
    two = spark.createDataFrame([("f", 0, 0.2, 1.0, "hello!"), ("f", 1, 5.0, 6.0, "hello")], WORD)
    assert [r.pos for r in R.new_words(one, two).collect()] == [1]


def test_recovery_ends_when_nothing_is_new(spark):
    chunks = spark.createDataFrame([("f", 0, 0.0, 1.0, "a")], WORD)
    turns = spark.createDataFrame([("f", 0.0, 30.0)], "file string, start double, end double")
    audio = spark.createDataFrame([("f", 31.0)], "file string, audio_seconds double")
    words = spark.createDataFrame([("f", 0.2, 0.9, "a"), ("f", 10.0, 10.5, "b"), ("f", 25.0, 25.5, "c")], "file string, start double, end double, text string")
    out = R.recover(chunks, turns, audio, from_table(words), Config(missing_speech_retry_loops=3))
    assert [(r.text, round(r.start, 6)) for r in out.orderBy("pos").collect()] == [("a", 0.0), ("b", 10.0), ("c", 25.0)]
    windows = R.retry_windows(R.missing_speech(turns, chunks), audio).orderBy("missing_start").collect()
    assert [tuple(round(x, 3) for x in r[1:]) for r in windows] == [(1.15, 21.15, 0.65, 21.65), (21.15, 30.0, 20.65, 30.5)]


def test_improbable_words_are_dropped(spark):
    rows = [(0.0, 1.0, 0.3), (0.0, 1.0, 0.35), (0.0, 1.0, None)]
    df = spark.createDataFrame(rows, "start double, end double, probability double").selectExpr("*", "0D missing_start", "5D missing_end", "0D crop_start", "5D crop_end")
    assert R.accept_retry(df).count() == 2


def test_repeats_of_a_frequent_word_and_numbers_over_blocks(spark, monkeypatch):
    rng = random.Random(5)
    words = [("f", i, t, t + 0.2, rng.choice(["네", "네", "예"])) for i, t in enumerate(rng.choice([k * 0.3, rng.uniform(0, 900)]) for k in range(1500))]
    words += [("g", 0, None, None, "네"), ("g", 1, -5.0, -4.0, "네"), ("g", 2, -5.0, -4.0, "아")]
    schema = "file string, pos long, start double, end double, text string"
    original = spark.createDataFrame([("f", i, 40.0 * i, 40.0 * i + 1, "음") for i in range(30)] + [("g", 0, None, None, "가"), ("g", 1, 3.0, 4.0, "나")], schema)
    kept: dict = {}
    for f, pos, s, e, w in words:
        if s is not None:
            same = kept.setdefault((f, w), [])
            if all(abs((s + e) / 2 - m) > 0.5 for m, _ in same):
                same.append(((s + e) / 2, pos))
    recovered = spark.createDataFrame(words, schema).where("start is not null")
    fresh = R.new_words(original, recovered)
    assert sorted((r.file, r.text, r.pos) for r in fresh.collect()) == sorted((f, w, p) for (f, w), same in kept.items() for _, p in same)
    monkeypatch.setattr(R, "NUMBERED_SECONDS", 7.0)
    rows = R.merge_recovered(original, recovered).collect()
    for f in ("f", "g"):
        own = sorted((r for r in rows if r.file == f), key=lambda r: r.pos)
        assert [r.pos for r in own] == list(range(len(own)))
        keys = [(r.start is not None, r.start or 0, r.end or 0, r.recovered) for r in own]
        assert keys == sorted(keys)
