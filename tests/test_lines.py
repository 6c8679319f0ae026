from callweave.config import Config
from callweave.operators import lines as L

SCHEMA = "file string, pos long, start double, end double, text string, speaker string"


def frame(spark, rows):
    return spark.createDataFrame([("f", i, s, e, t, sp) for i, (s, e, t, sp) in enumerate(rows)], SCHEMA)


def texts(df):
    return [r.text for r in df.orderBy("line").collect()]


def test_pause_of_exactly_the_gap_goes_on(spark):
    df = frame(spark, [(0.0, 1.0, " a", "x"), (2.0, 3.0, " b", "x"), (4.5, 5.0, "c", "x"), (5.0, 6.0, "d", "x")])
    assert texts(L.merge_lines(df.drop("speaker"))) == ["a b", "c d"]


def test_length_limit(spark):
    rows = [(float(i), float(i) + 1, " " + "가" * 99, "x") for i in range(4)]
    df = frame(spark, rows).drop("speaker")
    assert [len(t) for t in texts(L.merge_lines(df))] == [299, 99]
    assert [len(t) for t in texts(L.merge_lines(df, Config(speaker_merge_max_chars=299)))] == [299, 99]
    assert [len(t) for t in texts(L.merge_lines(df, Config(speaker_merge_max_chars=298)))] == [199, 199]
    assert [len(t) for t in texts(L.merge_lines(df, Config(speaker_merge_max_chars=0)))] == [399]


def test_speakers_part_lines_and_prefix_documents(spark):
    df = frame(spark, [(0.0, 1.0, " a", "x"), (1.0, 2.0, " b", "y"), (2.0, 3.0, " c", "y"), (3.0, 4.0, " d", "x")])
    lines = L.merge_lines(df)
    assert [(r.speaker, r.text) for r in lines.orderBy("line").collect()] == [("x", "a"), ("y", "b c"), ("x", "d")]
    assert L.document(lines).first().text == "x: a\ny: b c\nx: d\n"


def test_turns_and_subtitles(spark):
    rows = [("f", 0, 0, 500, "a", "1"), ("f", 1, 1500, 1800, "b", "1"), ("f", 2, 2801, 3000, "c", "1"), ("f", 3, 3000, 3661001, " ", None)]
    df = spark.createDataFrame(rows, "file string, pos long, start long, end long, word string, speaker string")
    turns = L.word_turns(df)
    assert [(r.start, r.end, r.words) for r in turns.orderBy("turn").collect()] == [(0, 1800, ["a", "b"]), (2801, 3000, ["c"]), (3000, 3661001, [" "])]
    cues = [r.text for r in L.cues(turns).orderBy("cue").collect()]
    assert cues[0] == "1\n00:00:00,000 --> 00:00:01,800\n[Speaker 1] a b\n\n"
    assert cues[2] == "3\n00:00:03,000 --> 01:01:01,001\n[UNASSIGNED] \n\n"
    assert L.speaker_text(turns).first().text == "Speaker 1: a b\nSpeaker 1: c\n"
