"""Speech transcripts as clean speaker turns.

Per recording: the timed segments are put in the order of a sweep line over their starts, labels are read from the
speaker column or the front of the text and reduced to one writing, hesitation sounds, sound notes, time marks and
labels are taken out, text that a caption rolls over from the one before is dropped by the longest
suffix-prefix overlap, and a turn ends where the speaker changes or, if wanted, at a pause that is long for the
recording (a calibrated quantile of its pauses).

A recording is one row, so nothing is shuffled but the result, where repeated deliveries of a file collapse.

Defined results: null arrays and empty arrays give no turns; a null or blank text isn't speech; segments without a
start are left out; `speaker` shorter than `chunks` counts as null; segments doubled with equal start, end and text
count once; of segments with equal starts the one listed first comes first. A segment before any label belongs to
a speaker of its own.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words that name a speaker in front of a colon.
ROLES = "화자 ?[0-9０-９]{1,3}|화자_[0-9]{1,3}|화자미상|speaker[ _-]?[0-9]{1,3}|spk[ _-]?[0-9]{1,3}|agent|customer|manager|engineer|operator|client|caller|상 ?담 ?원|고 ?객|팀 ?장|기 ?사|상담사|직원|손님"
_front = re.compile(rf"^\s*(?:[\[(<【{{]\s*(?P<a>{ROLES})\s*[\])>】}}]\s*[:：]?|(?P<b>{ROLES})\s*[:：])\s*", re.IGNORECASE)
#: Marks of time.
_time = re.compile(
    r"<\|\s*[\d.]+\s*\|>"
    r"|[\[(<{]\s*\d{1,2}:\d{2}(?::\d{2})?(?:[.,]\d{1,3})?\s*[\])>}]"
    r"|(?<![\d:])\d{1,2}:\d{2}(?::\d{2})?(?:[.,]\d{1,3})?\s*-->(?:\s*\d{1,2}:\d{2}(?::\d{2})?(?:[.,]\d{1,3})?)?"
    r"|(?<![\d:])\d{1,2}:\d{2}(?::\d{2})?(?:[.,]\d{1,3})?(?![\d:])"
)
#: Sound notes stand between marks like these; what holds a digit or is an "at" belongs to speech.
_note = re.compile(r"\[[^\]\d]{1,30}\]|【[^】\d]{1,30}】|\{[^}\d]{1,30}\}|<[^>\d]{1,30}>|※[^※\d]{1,30}※|\*[^*\d\s][^*\d]{0,29}\*|\((?!\s*a\s*t\s*\))[^)\d]{1,30}\)|[♪♫♬♩]+[^♪♫♬♩]{0,40}[♪♫♬♩]+|[♪♫♬♩]+")
#: Hesitation sounds.
HESITATIONS = r"아+|어+|음+|으+음*|으으+음*|에+|흠+|흐+음+|엄+|그+[—…~-]+|uh+|um+|uhm+|er+m*|hm+|mm+"
_hesitation = re.compile(rf"(?<![\w'])(?:{HESITATIONS})(?:[—–…~\-]+|\.{{2,}}|,)?(?![\w'])[.,…~—–-]*", re.IGNORECASE)
_unknown = {"", "화자미상", "unknown", "미상"}
_space = re.compile(r"\s+")
_digits = str.maketrans("０１２３４５６７８９", "0123456789")


@lru_cache(maxsize=50_000)
def speaker_key(label: str) -> str:
    """One writing for a label: letters and digits in lower case, leading zeros of its number aside; empty if unknown."""
    plain = re.sub(r"[\W_]+", "", label.translate(_digits).lower())
    plain = re.sub(r"^(?:spk|speaker)(?=\d)", "speaker", plain)
    plain = re.sub(r"\d+$", lambda m: str(int(m[0])), plain)
    return "" if plain in _unknown else plain


@lru_cache(maxsize=200_000)
def clean_text(text: str) -> tuple[str | None, str]:
    """(the label at the front, or None; the text without label, sound notes, time marks and hesitations)."""
    label = None
    text = _time.sub(" ", text)
    if found := _front.match(text):
        label = found["a"] or found["b"]
        text = text[found.end() :]
    text = _note.sub(" ", text)
    text = _hesitation.sub(" ", text)
    text = _space.sub(" ", text).strip()
    return label, text if re.search(r"\w", text) else ""


def rolled_over(before: str, text: str, least: int = 2) -> str:
    """text without the words at its front that end `before`: the longest overlap of at least `least` words."""
    a, b = before.split(), text.split()
    if len(b) < least or b[0] not in a:
        return text
    # the longest prefix of b that is a suffix of a, by the prefix function of b + separator + a
    joined = [*b, None, *a]
    reach = [0] * len(joined)
    for i in range(1, len(joined)):
        k = reach[i - 1]
        while k and joined[i] != joined[k]:
            k = reach[k - 1]
        reach[i] = k + (joined[i] == joined[k])
    k = reach[-1]
    return " ".join(b[k:]) if k >= least else text


def turns_of(chunks: list[dict] | None, speakers: list[str | None] | None, pause_quantile: float | None = None, least_pause: float = 1.0) -> list[tuple[str, float, float, str]]:
    """(speaker, start, end, text) of the turns of one recording."""
    listed = []
    for i, c in enumerate(chunks or []):
        if c is not None and c["start"] is not None:
            listed.append((c["start"], i, c["end"], c["text"] or "", speakers[i] if speakers and i < len(speakers) else None))
    listed.sort(key=lambda c: (c[0], c[1]))
    seen, current = set(), ""
    segments = []
    for start, _, end, text, label in listed:
        front, words = clean_text(text)
        own = speaker_key(label) if label is not None else speaker_key(front) if front else ""
        current = own or current
        if words and (start, end, text) not in seen:
            seen.add((start, end, text))
            segments.append((current, start, end if end is not None else start, words))
    most = float("inf")
    if pause_quantile is not None and len(segments) > 2:
        pauses = [b[1] - a[2] for a, b in zip(segments, segments[1:]) if b[1] > a[2]]
        if pauses:
            most = max(least_pause, float(np.quantile(pauses, pause_quantile)))
    names: dict[str, str] = {}
    turns: list[list] = []
    for key, start, end, words in segments:
        name = names.setdefault(key, f"화자{len(names) + 1}")
        if turns and turns[-1][0] == name and start - turns[-1][2] <= most:
            turn = turns[-1]
            # a caption that was on screen when the next began: what it repeats is dropped, a turn spoken twice isn't
            rest = rolled_over(turn[4], words) if start < turn[5] else words
            if rest:
                turn[3].append(rest)
            turn[2], turn[4], turn[5] = max(turn[2], end), words, end
        else:
            turns.append([name, start, end, [words], words, end])
    return [(t[0], t[1], t[2], " ".join(t[3])) for t in turns]


def speaker_turns(df: DataFrame, pause_quantile: float | None = None, keep: tuple[str, ...] = ("file",)) -> DataFrame:
    """(keep, turn, speaker, start_ms, end_ms, text): the clean turns of each row of (chunks, speaker).

    pause_quantile: split a speaker's turn at pauses above this quantile of the recording's pauses; None: never.
    """
    slim = df.select(*keep, F.col("chunks").alias("_chunks"), F.col("speaker").alias("_speaker"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in slim.schema.fields[:-2])

    def turned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = len(keep)
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                rows, out = [], []
                for i, (chunks, speakers) in enumerate(zip(part.column(n).to_pylist(), part.column(n + 1).to_pylist())):
                    for k, (name, start, end, text) in enumerate(turns_of(chunks, speakers, pause_quantile)):
                        rows.append(i)
                        out.append((k, name, round(start * 1000), round(end * 1000), text))
                columns = list(zip(*out)) if out else [[]] * 5
                kinds_ = (pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.string())
                taken = pa.array(rows, type=pa.int64())
                yield pa.RecordBatch.from_arrays([*(part.column(i).take(taken) for i in range(n)), *(pa.array(c, type=t) for c, t in zip(columns, kinds_))], names=[*keep, "turn", "speaker", "start_ms", "end_ms", "text"])

    return slim.mapInArrow(turned, f"{kinds}, turn int, speaker string, start_ms long, end_ms long, text string")
