import datetime
import io
import os
import wave

import pytest
from pyspark.sql import functions as F

from callweave import models
from callweave.config import Config
from callweave.functions import numbers as N
from callweave.operators import masking, quality, selection
from callweave.plans import pipeline
from callweave.sources import files, sinks
from callweave.streaming import timelines


def test_path_order_and_samples(spark):
    names = ["a-b.wav", "a/b.wav", "a/a/z.wav", "b.wav", "a.wav"]
    df = spark.createDataFrame([(n,) for n in names], "file string")
    expected = sorted(names, key=lambda n: n.split("/"))
    numbered = selection.numbered(df.repartition(3), selection.path_order(F.col("file")))
    assert [r.file for r in numbered.orderBy("index").collect()] == expected and numbered.agg(F.max("index")).first()[0] == 4
    assert sorted(r.file for r in selection.first_files(df, 2).collect()) == sorted(expected[:2])
    assert selection.first_files(df, 99).count() == 5
    with pytest.raises(ValueError):
        selection.first_files(df, 0)
    parts = [sorted(r.file for r in selection.shard(df, (i, 2)).collect()) for i in (0, 1)]
    assert parts == [sorted(expected[0::2]), sorted(expected[1::2])]
    assert selection.numbered(df.limit(0), F.col("file")).count() == 0


def test_shards():
    assert selection.parse_shard("1/3") == (1, 3)
    for text in ("3/3", "-1/3", "a/3", "1", "0/0", "1/2/3"):
        with pytest.raises(ValueError):
            selection.parse_shard(text)
    assert selection.shard_labels(["0", "1"], 2) == [(0, "0", "0/4"), (1, "0", "1/4"), (2, "1", "2/4"), (3, "1", "3/4")]


def test_resume_and_collisions(spark):
    sources = spark.createDataFrame([("a",), ("b",), ("c",)], "file string")
    done = spark.createDataFrame([("a", "x"), ("b", " \n"), ("c", None)], "file string, text string")
    assert sorted(r.file for r in selection.unfinished(sources, done).collect()) == ["b", "c"]
    both = spark.createDataFrame([("a", "x"), ("b", "x")], "file string, text string")
    assert sorted(r.file for r in selection.unfinished(sources, done, both).collect()) == ["b", "c"]
    twice = spark.createDataFrame([("d/a.wav",), ("d/a.WAV",), ("d/b.wav",)], "file string")
    assert [r.output for r in selection.collisions(twice).collect()] == ["d/a"]


def test_codes_and_summaries(spark):
    def worst(codes):
        return quality.worst_code(spark.createDataFrame(list(enumerate(codes)), "shard int, code int")).first().code

    assert [worst(c) for c in ([0, 1, 0], [0, 2, 1], [0, -9, 2, 137], [])] == [1, 2, -9, 0]
    parts = spark.createDataFrame([(3, 1, 1, 1, None), (None, None, None, None, None), (2, 2, 0, 0, 1)], "total long, succeeded long, skipped long, failed long, short_transcripts long")
    row = quality.roll_up(parts).withColumn("t", quality.counts_text()).first()
    assert (row.total, row.failed, row.short_transcripts, row.missing) == (5, 1, 1, 1) and "실제보다 적음" in row.t
    lost = quality.roll_up(parts.where("total is null")).withColumn("t", quality.counts_text()).first()
    assert lost.total is None and lost.missing == 1 and lost.t
    documents = spark.createDataFrame([('{"coverage":{"ratio":0.5,"short_transcript":true}}',), ('{"coverage":{"ratio":null,"short_transcript":true}}',), ("no",)], "d string")
    assert [r[0] for r in documents.select(F.coalesce(quality.recorded_short(F.col("d")), F.lit(False))).collect()] == [True, False, False]


def test_numbers(spark):
    df = spark.createDataFrame([(0.0005, 0, 3661.0019), (0.0015, 10_000, 360000.0), (2.5, 100_000, 0.0)], "s double, n long, t double")
    rows = df.select(N.milliseconds(F.col("s")), N.generation_limit(F.col("n")), N.srt_clock(F.col("t")), N.time_limit(F.col("n"))).collect()
    assert [r[0] for r in rows] == [0, 2, 2500]
    assert [r[1] for r in rows] == [256, 12288, 12288]
    assert [r[2] for r in rows] == ["01:01:01,001", "100:00:00,000", "00:00:00,000"]
    assert [r[3] for r in rows] == [600.0, 600.0, 5000.0]
    assert Config.from_environment({"SPEAKER_MERGE_MAX_GAP": "2.5"}).speaker_merge_max_gap == 2.5
    with pytest.raises(ValueError):
        Config(overlap_tie_tolerance=-1)


def test_files(spark, tmp_path):
    os.makedirs(tmp_path / "in/sub")
    (tmp_path / "in/a.txt").write_bytes("가\r\n나".encode())
    (tmp_path / "in/sub/b.TXT").write_bytes(b"x\n")
    (tmp_path / "in/bad.txt").write_bytes(b"\xff\xfe\x00")
    good, bad = files.texts(spark, str(tmp_path / "in"))
    assert {r.file: r.text for r in good.collect()} == {"a.txt": "가\r\n나", "sub/b.TXT": "x\n"} and [r.file for r in bad.collect()] == ["bad.txt"]
    assert files.any_file(spark, str(tmp_path / "in"), ".txt") and not files.any_file(spark, str(tmp_path / "in"), ".wav")
    with wave.open(str(tmp_path / "in/s.WAV"), "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(2)
        w.setframerate(8000)
        w.writeframes(b"\0\0" * 4000)
    (tmp_path / "in/t.wav").write_bytes(b"no")
    sounds = files.audio(spark, str(tmp_path / "in")).select("file", files.wav_seconds("content").alias("s"))
    assert {r.file: r.s for r in sounds.collect()} == {"s.WAV": 0.5, "t.wav": None}
    out = sinks.write_files(good, str(tmp_path / "out"), ".md")
    assert {r.file: r.error for r in out.collect()} == {"a.txt": None, "sub/b.TXT": None}
    assert (tmp_path / "out/sub/b.md").read_bytes() == b"x\n" and (tmp_path / "out/a.md").read_bytes() == "가\r\n나".encode()
    away = spark.createDataFrame([("../../x", "t")], "file string, text string")
    assert sinks.write_files(away, str(tmp_path / "out"), ".md").first().error


def test_timestamp_documents(spark):
    rows = [
        ("ok", '{"version":1,"file":"f","unit":"word","coverage":null,"chunks":[{"start":0,"end":1.5,"text":" a"}]}'),
        ("version", '{"version":2,"unit":"word","chunks":[{"start":0,"end":1,"text":"a"}]}'),
        ("unit", '{"version":1,"unit":"line","chunks":[{"start":0,"end":1,"text":"a"}]}'),
        ("no chunks", '{"version":1,"unit":"word","chunks":[]}'),
        ("time", '{"version":1,"unit":"word","chunks":[{"start":null,"end":1,"text":"a"}]}'),
        ("blank text", '{"version":1,"unit":"word","chunks":[{"start":0,"end":1,"text":" "}]}'),
        ("not a document", "nonsense"),
    ]
    good, bad = files.check_documents(spark.createDataFrame(rows, "file string, text string"))
    assert [r.file for r in good.collect()] == ["ok"]
    assert all(r.file == r.reason for r in bad.collect()) and bad.count() == 6
    summaries = files.summaries(spark.createDataFrame([("a", '{"total":3,"succeeded":1,"skipped":1,"failed":1}'), ("b", '{"total":3}'), ("c", "x")], "file string, text string"))
    assert {r.file: (r.total, r.short_transcripts) for r in summaries.collect()} == {"a": (3, None), "b": (None, None), "c": (None, None)}


def test_state(spark):
    made = lambda v: F.struct(F.create_map(F.lit("model"), F.lit(v)).alias("settings"), F.lit(1).cast("long").alias("size"), F.lit(None).cast("timestamp").alias("modified"))
    base = spark.createDataFrame([("a", "x"), ("b", "x"), ("c", "x")], "file string, coverage string")
    state = base.where("file <> 'c'").select("file", made("m1").alias("fingerprint"), F.when(F.col("file") == "a", "complete").otherwise("started").alias("status"), F.lit("old").alias("coverage"))
    finished = base.select("file", made("m1").alias("fingerprint"), F.lit("new").alias("coverage"))
    got = {r.file: (r.status, r.coverage) for r in sinks.completed_state(state, finished).collect()}
    assert got == {"a": ("complete", "old"), "b": ("complete", "new"), "c": ("complete", "new")}


class Refusing:
    schema = "masked_text string"

    def load(self):
        return "model"

    def call(self, model, row):
        if "x" in row["text"]:
            raise RuntimeError("no")
        return {"masked_text": row["text"] + model}


def test_a_models_failures_are_rows(spark):
    import sys

    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    df = spark.createDataFrame([("a", "x"), ("b", "y")], "file string, text string")
    got = {r.file: (r.masked_text, r.error) for r in models.apply_model(df, Refusing()).collect()}
    assert got["b"] == ("ymodel", None) and got["a"][0] is None and "RuntimeError" in got["a"][1]
    assert models.stop_tokens([1, 2], 2, None, [3]) == [1, 2, 3]
    assert models.model_source("org/name", lambda p: False) == ("hub", "org/name")
    with pytest.raises(FileNotFoundError):
        models.model_source("./nowhere", lambda p: False)


def pipeline_tables(spark):
    raw = spark.createDataFrame([("f", 0, 0.0, 1.0, " 저는"), ("f", 1, 1.0, None, " 홍길동입니다"), ("f", 2, 4.0, 5.0, " 네"), ("g", 0, None, None, " ")], "file string, pos long, start double, end double, text string")
    audio = spark.createDataFrame([("f", 5.0), ("g", 9.0)], "file string, audio_seconds double")
    turns = spark.createDataFrame([("f", 0.0, 3.0, "S1"), ("f", 3.5, 5.0, "S0")], "file string, start double, end double, label string")
    return {"raw": raw, "audio": audio, "turns": turns}


def test_pipeline(spark):
    registry = masking.Registry(("홍길동",), ())
    report = pipeline.run(pipeline.standard(registry), pipeline_tables(spark), soft=("spoken",), needs={"masked_spoken": "spoken"})
    assert report.code == quality.PARTIAL and report.stopped is None
    assert report.summaries["chunks"] == {"total": 2, "succeeded": 1, "skipped": 0, "failed": 1, "short_transcripts": 1}
    assert report.tables["spoken"].first().text == "화자1: 저는 홍길동입니다\n화자2: 네\n"
    assert report.tables["masked_spoken"].first().masked_text == "화자1: 저는 [이름]입니다\n화자2: 네\n"
    assert pipeline.redaction_info(report.tables["masked"], registry).first().info.name == ["홍길동"]
    stopped = pipeline.run(pipeline.standard(registry), pipeline_tables(spark), stop_on_partial=True)
    assert stopped.stopped == "chunks" and list(stopped.summaries) == ["chunks"]


def test_pipeline_goes_on_behind_a_soft_stage(spark):
    def broken(tables):
        raise RuntimeError("gone")

    stages = pipeline.standard(masking.Registry())
    stages[2] = ("spoken", broken)
    report = pipeline.run(stages, pipeline_tables(spark), soft=("spoken",), needs={"masked_spoken": "spoken"})
    assert report.code == quality.BROKEN and "masked" in report.summaries and "masked_spoken" not in report.summaries


def test_stream_repairs_like_the_batch(spark, tmp_path):
    rows = [("f", i, s, e, " a", False) for i, (s, e) in enumerate([(0.0, 1.0), (1.0, 2.0), (0.0, 1.0), (1.0, 1.5), (0.2, 0.9)])]
    folder = str(tmp_path / "stream")
    for n, part in enumerate((rows[:2], rows[2:4], rows[4:])):
        spark.createDataFrame(part, "file string, pos long, start double, end double, text string, x boolean").coalesce(1).write.mode("append").parquet(folder)
        stream = spark.readStream.schema("file string, pos long, start double, end double, text string, x boolean").parquet(folder)
        query = timelines.repaired(stream).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
        query.awaitTermination()
    got = [(r.pos, r.start, r.end, r.reset) for r in spark.read.parquet(str(tmp_path / "out")).orderBy("pos").collect()]
    assert got == [(0, 0.0, 1.0, False), (1, 1.0, 2.0, False), (2, 2.0, 3.0, True), (3, 3.0, 3.5, False), (4, 3.5, 4.2, True)]


def test_sessions_close_at_pauses(spark):
    at = datetime.datetime(2024, 1, 1)
    df = spark.createDataFrame([("f", at + datetime.timedelta(seconds=s), d) for s, d in ((0, 0.5), (1.5, 0.5), (3.2, 0.4), (9.0, 1.0))], "file string, at timestamp, seconds double")
    got = sorted((r.start, r.chunks) for r in timelines.paused_lines(df).collect())
    assert [n for _, n in got] == [2, 1, 1]


def test_written_tables_are_removed(spark):
    from urllib.parse import urlparse

    from callweave import storage

    df = storage.written(spark.range(5).toDF("id"))
    path = urlparse(storage._written[-1][1]).path
    assert os.path.isdir(path) and df.count() == 5 and path.startswith(urlparse(storage.shared_folder(spark)).path)
    storage.release()
    assert not os.path.exists(path)


class InBatches:
    """Takes batches; one that holds a blank text is refused."""

    schema = "masked_text string"

    def load(self):
        return "m"

    def call_batch(self, model, rows):
        if any(not r["text"] for r in rows):
            raise ValueError("blank in the batch")
        return [{"masked_text": f"{model}{len(rows)}"} for _ in rows]

    def call(self, model, row):
        if not row["text"]:
            raise ValueError("blank")
        return {"masked_text": "one"}


def test_batches_of_a_model_and_rows_at_fault(spark):
    df = spark.createDataFrame([("a", "x"), ("b", "y")], "file string, text string").coalesce(1)
    assert {r.masked_text for r in models.apply_model(df, InBatches()).collect()} == {"m2"}
    mixed = df.union(spark.createDataFrame([("c", "")], "file string, text string")).coalesce(1)
    got = {r.file: (r.masked_text, r.error) for r in models.apply_model(mixed, InBatches()).collect()}
    assert got["c"] == (None, "ValueError: blank") and got["a"][1] is None and got["b"][1] is None


def test_pieces_of_wav_files(spark):
    def sound(frames, rate=1000):
        out = io.BytesIO()
        with wave.open(out, "wb") as w:
            w.setnchannels(1)
            w.setsampwidth(2)
            w.setframerate(rate)
            w.writeframes(b"".join(i.to_bytes(2, "little") for i in range(frames)))
        return out.getvalue()

    rows = [(sound(2000), 0.5, 0.75), (sound(2000), 1.9, 9.0), (sound(2000), -1.0, 0.01), (sound(10), 5.0, 6.0), (b"no", 0.0, 1.0), (None, 0.0, 1.0), (sound(10), None, 1.0), (sound(10), 0.008, 0.002)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, c binary, s double, e double")
    got = [r.p for r in df.select("i", files.crop_wav("c", "s", "e").alias("p")).orderBy("i").collect()]
    lengths = []
    for data in got:
        if data is None:
            lengths.append(None)
            continue
        with wave.open(io.BytesIO(data)) as w:
            lengths.append((w.getnframes(), int.from_bytes(w.readframes(1), "little")))
    assert lengths == [(250, 500), (100, 1900), (10, 0), None, None, None, None, None]
