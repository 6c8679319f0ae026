"""The queries of the core, each over its whole tables.

Tables are delivered with repeated rows; what an operator takes is each file, chunk or turn once.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import models
from ..config import Config
from ..functions import numbers
from ..functions import text as T
from ..operators import intervals, lines, masking, quality, recovery, redaction, selection, speakers, timeline
from ..session import shared_folder, table
from ..sources import files, sinks
from ..storage import remove_later


def _ms(column: str):
    return F.round(F.col(column) * 1000).cast("long")


def _micro(*names: str) -> dict:
    return {n: F.round(n, 6) for n in names}


# --- inputs ---


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "raw_chunks").select("file", "pos", "start", "end", "text").distinct()


def recordings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "stt_timestamps").drop("loaded_at").dropDuplicates(["file"])


def audio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "stt_timestamps").groupBy("file").agg(F.max("coverage.audio_seconds").alias("audio_seconds"))


def chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(file, pos, start, end, text, speaker); a null end is the start."""
    rows = recordings(spark, sf_dir).select("file", F.posexplode(F.arrays_zip("chunks", "speaker")).alias("pos", "c"))
    return rows.select("file", F.col("pos").cast("long").alias("pos"), F.col("c.chunks.start").alias("start"), F.coalesce("c.chunks.end", "c.chunks.start").alias("end"), F.col("c.chunks.text").alias("text"), F.col("c.speaker").alias("speaker"))


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "turns").where("start is not null and end is not null").select("file", "start", "end", "label").distinct()


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "text_files").where("text is not null").select("file", "text").distinct()


def registry(spark: SparkSession, sf_dir: str) -> masking.Registry:
    return masking.Registry.read(table(spark, sf_dir, "registry"))


# --- intervals ---


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periods and gaps of the speaker labels of each file, and of the chunks of each recording."""
    by_label = table(spark, sf_dir, "turns").select(F.lit("turns").alias("origin"), "file", "label", _ms("start").alias("start"), _ms("end").alias("end"))
    timed = table(spark, sf_dir, "stt_timestamps").select("file", F.explode("chunks").alias("c"))
    timed = timed.select(F.lit("stt_timestamps").alias("origin"), "file", F.lit("").alias("label"), _ms("c.start").alias("start"), _ms("c.end").alias("end"))
    found = intervals.continuous_periods(by_label.unionByName(timed), ["origin", "file", "label"])
    return found.select("origin", "file", "label", "kind", F.col("start").alias("start_ms"), F.col("end").alias("end_ms"))


def interval_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.union(turns(spark, sf_dir), ["file"], 0.1)


def interval_union_keep_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.union(turns(spark, sf_dir), ["file"], 0.1, keep_empty=True)


def interval_union_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same union by range sort, for entities of any size."""
    return intervals.continuous_periods(turns(spark, sf_dir), ["file"], 0.1).where("kind = 'period'").select("file", "start", "end")


def word_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.padded_coverage(chunks(spark, sf_dir), ["file"]).withColumns(_micro("start", "end"))


def speech_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recovery.missing_speech(turns(spark, sf_dir), chunks(spark, sf_dir)).withColumns(_micro("start", "end"))


def split_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns cut into pieces of two seconds at most."""
    return intervals.split(turns(spark, sf_dir).groupBy("file", "label").agg(F.min("start").alias("start"), F.max("end").alias("end")), 2.0).withColumns(_micro("start", "end"))


def split_gaps_20(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Speech without words cut into pieces of the longest retry at most."""
    missing = recovery.missing_speech(turns(spark, sf_dir), chunks(spark, sf_dir))
    return intervals.split(missing, Config().missing_speech_max_retry_seconds).withColumns(_micro("start", "end"))


def retry_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    missing = recovery.missing_speech(turns(spark, sf_dir), chunks(spark, sf_dir))
    return recovery.retry_windows(missing, audio(spark, sf_dir)).withColumns(_micro("missing_start", "missing_end", "crop_start", "crop_end"))


# --- timelines ---


def normalize_null_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = raw(spark, sf_dir).join(audio(spark, sf_dir), "file", "left")
    return timeline.fill_times(rows, "audio_seconds").select("file", "pos", "start", "end")


def repair_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = timeline.spoken(raw(spark, sf_dir)).where("start is not null and end is not null")
    return timeline.repair_restarts(rows).select("file", "pos", "start", "end", "reset").withColumns(_micro("start", "end"))


def prepared_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filled, repaired: per file the chunks, the restarts and the end."""
    rows = timeline.prepare(raw(spark, sf_dir).join(audio(spark, sf_dir), "file", "left"), "audio_seconds")
    return rows.groupBy("file").agg(F.count(F.lit(1)).alias("chunks"), F.count_if("reset").alias("resets"), F.round(F.max("end"), 6).alias("transcript_end"))


def coverage_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timeline.coverage(chunks(spark, sf_dir), audio(spark, sf_dir)).select("file", "transcript_end", "audio_seconds", "ratio", "short_transcript", "cause").withColumns(_micro("ratio"))


def timeline_mismatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timeline.mismatch(chunks(spark, sf_dir), turns(spark, sf_dir))


# --- speakers ---


def label_speakers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return speakers.label_speakers(turns(spark, sf_dir)).select("file", "label", "speaker").distinct()


def speaker_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return speakers.speaker_count(turns(spark, sf_dir))


def pick_speaker_tolerance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return speakers.pick_speakers(chunks(spark, sf_dir).drop("speaker"), turns(spark, sf_dir), Config(overlap_tie_tolerance=0.3)).select("file", "pos", "speaker")


def _in_ms(df: DataFrame) -> DataFrame:
    return df.withColumns({"start": _ms("start"), "end": _ms("end")})


def pick_speaker_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    return speakers.pick_by_overlap(_in_ms(chunks(spark, sf_dir).drop("speaker")), _in_ms(turns(spark, sf_dir))).select("file", "pos", "speaker", "overlap_ms")


def nearest_speaker(spark: SparkSession, sf_dir: str) -> DataFrame:
    return speakers.nearest_speakers(_in_ms(chunks(spark, sf_dir).drop("speaker")), _in_ms(turns(spark, sf_dir))).select("file", "pos", "speaker")


def _assigned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks with the speaker column as delivered, trimmed and in lower case."""
    return chunks(spark, sf_dir).withColumn("speaker", F.lower(F.trim("speaker")))


def smooth_speakers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return speakers.smooth(_assigned(spark, sf_dir), Config(speaker_smooth_max_seconds=1.5, speaker_smooth_max_gap=0.5)).select("file", "pos", "speaker", "absorbed")


def mapped_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all recordings with the speaker by overlap, else the nearest; times in ms."""
    words = chunks(spark, sf_dir).select("file", "pos", F.trim("text").alias("word"), "start", "end", F.lit("pass1").alias("source"))
    return speakers.map_words(words, _in_ms(turns(spark, sf_dir)))


# --- lines ---


def plain_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.merge_lines(chunks(spark, sf_dir).drop("speaker"))


def speaker_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.merge_lines(_assigned(spark, sf_dir))


def plain_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.document(lines.merge_lines(chunks(spark, sf_dir).drop("speaker")))


def _word_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = _assigned(spark, sf_dir).select("file", "pos", "speaker", _ms("start").alias("start"), _ms("end").alias("end"), F.trim("text").alias("word"))
    return lines.word_turns(words)


def speaker_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _word_turns(spark, sf_dir).withColumn("words", F.array_join("words", " "))


def srt_cues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.cues(_word_turns(spark, sf_dir))


def speaker_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.speaker_text(_word_turns(spark, sf_dir))


# --- recovery ---


def dedupe_recovered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw chunks as recovered words beside those of the stored documents."""
    original = chunks(spark, sf_dir).select("file", "pos", "start", "end", "text")
    fresh = timeline.spoken(raw(spark, sf_dir)).where("start is not null and end is not null")
    return recovery.new_words(original, fresh).select("file", "pos", "start", "end")


def merged_recovered(spark: SparkSession, sf_dir: str) -> DataFrame:
    original = chunks(spark, sf_dir).select("file", "pos", "start", "end", "text")
    fresh = timeline.spoken(raw(spark, sf_dir)).where("start is not null and end is not null")
    return recovery.merge_recovered(original, fresh).groupBy("file").agg(F.count(F.lit(1)).alias("words"), F.count_if("recovered").alias("recovered"))


# --- masking and redaction ---


def mask_known(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with the registry's numbers and names masked."""
    masked = masking.mask_known(F.col("text"), registry(spark, sf_dir))
    rows = texts(spark, sf_dir).select("file", masked.alias("masked"))
    return rows.select("file", F.md5("masked").alias("masked_md5"), *(n.cast("long").alias(f"{kind}_tags") for kind, n in masking.tag_counts(F.col("masked")).items()))


def mask_phones_spoken(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with speakers in which a registered number stands, with how often."""
    numbers_only = masking.Registry((), registry(spark, sf_dir).phones)
    rows = table(spark, sf_dir, "diarization").where("text is not null").select("file", "text").distinct().withColumn("masked", masking.mask_known(F.col("text"), numbers_only))
    count = lambda c: F.regexp_count(F.col(c), F.lit(r"\[전화번호\]"))
    return rows.select("file", (count("masked") - count("text")).cast("long").alias("masks")).where("masks > 0")


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = texts(spark, sf_dir).withColumnRenamed("text", "source_text")
    masked = table(spark, sf_dir, "anonymization").where("text is not null").select("file", "anon_id", F.col("text").alias("masked_text"))
    return masked.join(source, "file").select("anon_id", "source_text", "masked_text")


def redacted_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tags of all lines that differ, with the values they stand for, or the reason why there is none."""
    return redaction.replacements(redaction.line_pairs(_pairs(spark, sf_dir), ["anon_id"]), ["anon_id"], registry(spark, sf_dir))


def redaction_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return redaction.entries(redacted_lines(spark, sf_dir), ["anon_id"])


def redaction_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return redaction.summary(redaction_entries(spark, sf_dir), ["anon_id"])


def info_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    return redaction.info(redaction_entries(spark, sf_dir), ["anon_id"])


def shape_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All values of the delivered records with whether they have the shape of each kind."""
    rows = table(spark, sf_dir, "anonymization_info").select(F.explode(F.array(*(F.struct(F.lit(k).alias("kind"), F.col(f"info.{k}").alias("v")) for k in T.TAGS))).alias("i"))
    values = rows.select("i.kind", F.explode("i.v").alias("value")).where("value is not null").distinct()
    tag = F.create_map(*(F.lit(x) for pair in T.TAGS.items() for x in pair))[F.col("kind")]
    return values.select("kind", "value", T.looks_like(tag, F.col("value")).alias("shaped"), T.plausible(tag, F.col("value")).alias("plausible"), T.phone_digits(F.col("value")).alias("digits"))


def line_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines and tokens of masked texts."""
    rows = table(spark, sf_dir, "anonymization").where("text is not null").select("anon_id", F.posexplode(T.lines(F.col("text"))).alias("i", "line"))
    return rows.groupBy("anon_id").agg(F.count(F.lit(1)).alias("lines"), F.sum(F.size(T.tokens(F.col("line")))).alias("tokens"))


def canonical_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw(spark, sf_dir).where("text is not null").select("file", "pos", T.canonical(F.col("text")).alias("canonical"))


# --- runs ---


def _results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per recording: failed without a text, skipped if a masked text is there, and whether it is short."""
    sources = recordings(spark, sf_dir).select(F.regexp_replace("file", r"\.wav$", ".txt").alias("file"), F.coalesce("coverage.short_transcript", F.lit(False)).alias("short_transcript"))
    plain = texts(spark, sf_dir).select(F.col("file").alias("_t")).distinct()
    done = table(spark, sf_dir, "anonymization").where("text is not null").select(F.col("file").alias("_a")).distinct()
    rows = sources.join(plain, F.col("file") == F.col("_t"), "left").join(done, F.col("file") == F.col("_a"), "left")
    return rows.select("file", F.when(F.col("_t").isNull(), "failed").when(F.col("_a").isNotNull(), "skipped").otherwise("succeeded").alias("status"), "short_transcript")


def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.run_summary(_results(spark, sf_dir))


def _by_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    shard = F.regexp_extract("file", r"team-(\d+)", 1).cast("int")
    return quality.run_summary(_results(spark, sf_dir).withColumn("shard", shard), ["shard"])


def stage_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summaries of teams as shards; those of teams 7 and 9 can't be read."""
    gone = F.col("shard").isin(7, 9)
    names = (*quality.COUNTS, "short_transcripts")
    parts = _by_shard(spark, sf_dir).select("shard", *(F.when(~gone, F.col(c)).alias(c) for c in names))
    return quality.roll_up(parts).withColumn("report", quality.counts_text())


def exit_severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Teams as shards: 1 if a file failed, -9 for the last team."""
    codes = _by_shard(spark, sf_dir).select("shard", F.when(F.col("shard") == 40, -9).when(F.col("failed") > 0, 1).otherwise(0).alias("code"))
    worst = quality.worst_code(codes)
    return worst.select("code", quality.merge_code(F.lit(0), F.col("code")).alias("merged"), quality.code_text(F.col("code")).alias("said"))


def qc_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = mapped_words(spark, sf_dir)
    final = lines.word_turns(words.select("file", "pos", "speaker", "start", "end", "word"))
    return quality.total_counters(quality.word_counters(words, final))


def token_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Generation and time limits with characters in the place of tokens."""
    rows = table(spark, sf_dir, "documents").where("n_chars is not null").select("doc_id", numbers.generation_limit(F.col("n_chars")).alias("max_new_tokens"))
    return rows.withColumn("max_seconds", numbers.time_limit(F.col("max_new_tokens") * 10))


def sample_first_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = table(spark, sf_dir, "documents").where("source is not null").select(F.concat_ws("/", "source", F.col("doc_id").cast("string")).alias("file"))
    return selection.first_files(paths, 100)


def shard_modulo(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = table(spark, sf_dir, "stt_timestamps").select("file").distinct()
    return selection.shard(paths, selection.parse_shard("1/3"))


def resume_antijoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = table(spark, sf_dir, "anonymization").select("file", "text")
    return selection.unfinished(table(spark, sf_dir, "text_files").select("file").distinct(), done)


def timestamp_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written and read again: per file the chunks and the state of its coverage."""
    rows = chunks(spark, sf_dir)
    state = timeline.coverage(rows, audio(spark, sf_dir))
    good, _ = files.check_documents(sinks.timestamp_documents(rows, state))
    return good.select("file", F.size("document.chunks").alias("chunks"), F.col("document.coverage.transcript_end").alias("transcript_end"), F.col("document.coverage.short_transcript").alias("short_transcript"))


def recorded_short(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stored documents say of their transcripts."""
    stored = recordings(spark, sf_dir).select("file", F.to_json(F.struct("coverage"), {"ignoreNullFields": "false"}).alias("d"))
    return stored.select("file", quality.recorded_short(F.col("d")).alias("short_transcript"))


# --- retried speech ---


def _retried(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw chunks in the place of what a model hears in the retry windows, timed within their crops."""
    missing = recovery.missing_speech(turns(spark, sf_dir), chunks(spark, sf_dir))
    windows = recovery.retry_windows(missing, audio(spark, sf_dir))
    return models.from_table(_given(spark, sf_dir))(windows)


def _given(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timeline.spoken(raw(spark, sf_dir)).where("start is not null and end is not null")


def clipped_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Retried words within their crops, in the recording's time."""
    return intervals.clip_to_crop(_retried(spark, sf_dir)).select("file", "start", "end", "text", "crop_start").withColumns(_micro("start", "end", "crop_start"))


def centred_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Those whose centre lies in the missing piece."""
    return intervals.centred_in(intervals.clip_to_crop(_retried(spark, sf_dir))).select("file", "start", "end", "text", "missing_start").withColumns(_micro("start", "end", "missing_start"))


def probable_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw chunks as words of a made-up probability within a crop of their whole recording: those that aren't improbable."""
    rows = _given(spark, sf_dir).withColumns({"probability": F.when(F.col("pos") % 5 != 0, F.col("pos") % 100 / 100), "crop_start": F.lit(0.0), "crop_end": F.lit(1e6), "missing_start": F.lit(5.0), "missing_end": F.lit(1e6)})
    return recovery.accept_retry(rows).select("file", "pos", "start", "end", "probability")


def new_exact_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As dedupe_recovered, with texts compared as they are."""
    original = chunks(spark, sf_dir).select("file", "pos", "start", "end", "text")
    return recovery.new_words(original, _given(spark, sf_dir), same_text=lambda c: c).select("file", "pos", "start", "end")


def recovered_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words per file after one pass of retries."""
    original = chunks(spark, sf_dir).select("file", "pos", "start", "end", "text")
    after = recovery.recover(original, turns(spark, sf_dir), audio(spark, sf_dir), models.from_table(_given(spark, sf_dir)))
    return after.groupBy("file").agg(F.count(F.lit(1)).alias("words"), F.max("pos").alias("last_pos"))


def diarized_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with speakers from chunks and turns: labelled, assigned by overlap, smoothed, merged."""
    named = speakers.label_speakers(turns(spark, sf_dir)).select("file", "start", "end", F.col("speaker").alias("label"))
    assigned = speakers.smooth(speakers.pick_speakers(chunks(spark, sf_dir).drop("speaker"), named))
    return lines.document(lines.merge_lines(assigned.select("file", "pos", "start", "end", "text", "speaker")))


# --- files ---


def _put(df: DataFrame, suffix: str) -> str:
    """Writes texts (file, text) as files into a folder of their own and gives its path."""
    folder = f"{shared_folder(df.sparkSession).rstrip('/')}/callweave-files-{uuid.uuid4().hex}"
    failed = sinks.write_files(df, folder, suffix).where("error is not null").count()
    if failed:
        raise OSError(f"{failed} files couldn't be written to {folder}")
    remove_later(df.sparkSession, folder)
    return folder


def text_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts written as files, found and read again."""
    folder = _put(texts(spark, sf_dir), ".txt")
    good, _ = files.texts(spark, folder)
    sizes = files.scan(spark, folder, ".TXT").select("file", "length")
    return good.join(sizes, "file").select("file", F.md5("text").alias("text_md5"), "length")


def bad_encodings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of texts in two encodings those that aren't UTF-8."""
    raw_bytes = texts(spark, sf_dir).select("file", F.encode("text", "UTF-16BE").alias("content"), F.col("text").alias("t"))
    return raw_bytes.select("file", F.is_valid_utf8(F.encode("t", "UTF-8").cast("string")).alias("utf8"), F.is_valid_utf8(F.concat(F.col("content"), F.unhex(F.lit("FF"))).cast("string")).alias("other"))


def wav_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lengths by the headers of WAV files at 1,000 frames a second."""
    frames = F.round(F.col("audio_seconds") * 1000).cast("long")

    def little(value) -> F.Column:  # four bytes, the lowest first
        text = F.lpad(F.hex(value), 8, "0")
        return F.concat(*(F.substring(text, i, 2) for i in (7, 5, 3, 1)))

    plain = "57415645666D7420" + "10000000" + "0100" + "0100" + "E8030000" + "D0070000" + "0200" + "1000" + "64617461"
    header = F.unhex(F.concat(F.lit("52494646"), little(frames * 2 + 36), F.lit(plain), little(frames * 2)))
    return audio(spark, sf_dir).select("file", files.wav_seconds(F.coalesce(header, F.unhex(F.lit("00")))).alias("seconds"))


def summary_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Summaries of shards as documents and read again; those of failed shards lack a count and can't be read."""
    parts = _by_shard(spark, sf_dir).withColumn("total", F.when(F.col("failed") == 0, F.col("total")))
    names = [*quality.COUNTS, "short_transcripts"]
    documents = parts.select(F.concat(F.lit("shard-"), F.col("shard")).alias("file"), F.to_json(F.struct(*names)).alias("text"))
    return files.summaries(documents)


def info_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records of what was masked as JSON documents."""
    documents = info_document(spark, sf_dir).withColumn("file", F.concat(F.col("anon_id").cast("string"), F.lit(".txt")))
    return redaction.info_json(documents)


def state_after_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state of finished files: complete ones stay if what they depend on is the same, others are replaced."""
    sized = recordings(spark, sf_dir).select("file", F.size("chunks").cast("long").alias("size"))
    stamp = lambda size: sinks.fingerprint({"language": "korean"}, size, F.lit(None).cast("timestamp"))
    old = sized.where(F.col("size") % 3 != 0).select("file", stamp(F.col("size") - F.col("size") % 2).alias("fingerprint"), F.when(F.col("size") % 5 == 0, "open").otherwise("complete").alias("status"), F.lit("old").alias("coverage"))
    finished = sized.where(F.col("size") % 7 != 0).select("file", stamp(F.col("size")).alias("fingerprint"), F.lit("new").alias("coverage"))
    return sinks.completed_state(old, finished).select("file", F.col("fingerprint.size").alias("size"), "status", "coverage")


def kept_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored results without those of files that failed in this run."""
    failed = _results(spark, sf_dir).where("status = 'failed'").select("file")
    return sinks.without_failed(table(spark, sf_dir, "diarization").select("file").distinct(), failed)


def matched_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recordings and their texts with speakers, by the changed suffix."""
    return selection.matched(table(spark, sf_dir, "stt_timestamps"), table(spark, sf_dir, "diarization"), ".txt")


def job_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second of three shards of all recordings with their outputs."""
    return selection.jobs(table(spark, sf_dir, "stt_timestamps"), ".json", which=(1, 3))


def output_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources of texts and recordings that would write the same output."""
    every = table(spark, sf_dir, "stt_timestamps").select("file").union(table(spark, sf_dir, "text_files").select("file")).distinct()
    return selection.collisions(every).select("output", F.array_join("files", "|").alias("files"))


def shard_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Workers on the devices that teams stand for."""
    teams = [r[0] for r in table(spark, sf_dir, "stt_timestamps").select(F.regexp_extract("file", r"^[^/]+", 0).alias("t")).distinct().orderBy("t").collect()]
    return spark.createDataFrame(selection.shard_labels(teams, 3), "shard int, gpu string, label string")


# --- models ---


def masking_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Why documents can't be given to the model, with characters in the place of tokens."""
    return table(spark, sf_dir, "documents").select("doc_id", models.input_error(F.col("text"), F.length("text") * 8).alias("error"))


def stop_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What ended made-up outputs: the last token, or a limit."""
    n = F.col("n_chars")
    stops = F.array(*map(F.lit, models.stop_tokens([2, 5], 2, None, [0])))
    return table(spark, sf_dir, "documents").where("n_chars is not null").select("doc_id", models.output_error(F.col("text"), n % 11, n, F.lit(700), stops).alias("reason"))


def prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prompts of all texts by their kind."""
    plain = texts(spark, sf_dir).select("file", "text", F.lit("plain").alias("kind"))
    spoken = table(spark, sf_dir, "diarization").where("text is not null").select("file", "text", F.lit("diarized").alias("kind")).distinct()
    templates = {k: f"{said}: {{text}} [{{text}}]" for k, said in models.PROMPT_KINDS.items()}
    return models.with_prompt(plain.unionByName(spoken), templates, F.col("kind")).select("file", "kind", F.md5("prompt").alias("prompt_md5"))


def progress_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What documents show behind their last return."""
    return table(spark, sf_dir, "documents").where("text is not null").select("doc_id", F.md5(T.after_last_return(F.col("text"))).alias("shown_md5"))


def speech_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.speech_status(audio(spark, sf_dir), turns(spark, sf_dir).where("label <> 'SPEAKER_00'"))


QUERIES = {f.__name__: f for f in (
    p5_found, interval_union, interval_union_keep_empty, interval_union_sorted, word_coverage, speech_gaps, split_gaps,
    split_gaps_20, retry_windows,
    normalize_null_times, repair_timeline, prepared_chunks, coverage_report, timeline_mismatch, clipped_words, centred_words, probable_words,
    new_exact_words, recovered_counts, diarized_text, text_round_trip, bad_encodings, wav_lengths, summary_round_trip, info_texts,
    state_after_run, kept_results, matched_results, job_list, output_collisions, shard_labels, masking_errors, stop_reasons,
    prompts, progress_lines, speech_status, label_speakers, speaker_count,
    pick_speaker_tolerance, pick_speaker_max, nearest_speaker, smooth_speakers, mapped_words, plain_lines, speaker_lines, plain_text,
    speaker_turns, srt_cues, speaker_text, dedupe_recovered, merged_recovered, mask_known, mask_phones_spoken, redacted_lines,
    redaction_entries, redaction_summary, info_document, shape_check, line_tokens, canonical_text, run_summary, stage_counts,
    exit_severity, qc_totals, token_budget, sample_first_n, shard_modulo, resume_antijoin, timestamp_documents, recorded_short,
)}

from .oracles import ORACLES  # noqa: E402, F401
