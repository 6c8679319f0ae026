import pytest

from callweave.llm import queries
from callweave.llm import transcripts as T


def turns(rows, **options):
    """rows: (start, text, speaker) or (start, end, text, speaker)."""
    full = [r if len(r) == 4 else (r[0], r[0] + 0.5, r[1], r[2]) for r in rows]
    return T.turns_of([{"start": s, "end": e, "text": t} for s, e, t, _ in full], [r[3] for r in full], **options)


@pytest.mark.parametrize("label", ["화자1", "화자１", " 화자 1 ", "[화자1]", "<화자_1>", "화자1:", "화자01"])
def test_writings_of_a_label(label):
    assert T.speaker_key(label) == "화자1"


def test_writings_of_other_labels():
    assert {T.speaker_key(x) for x in ("SPEAKER_00", "Speaker 00", "spk-00", "SPK0", "[speaker 0]", "speaker_0", "SPEAKER_00:")} == {"speaker0"}
    assert {T.speaker_key(x) for x in ("상담원", "상담원 :", "(상담원)", "상 담 원")} == {"상담원"}
    assert {T.speaker_key(x) for x in ("", " ", "화자미상", "[화자미상]")} == {""}


@pytest.mark.parametrize("text", ["음", " 음...", "어—", "um", "Umm,", "으으음", "에...", "(기침)", "♪♪", "[ 키보드 소리 ]", "<noise>", "{침묵}", "【박수】", "※헛기침※", "*한숨*", "(00:00:33.7)", "[36:31]", "00:54:26,919 -->", "57:19", "<|2230.10|>", ".", "", "어— 57:19", "화자1:"])
def test_not_speech(text):
    assert T.clean_text(text)[1] == ""


@pytest.mark.parametrize("text,clean", [(" 네", "네"), ("네네네", "네네네"), ("예,", "예,"), ("그래서 음 좋아요", "그래서 좋아요"), ("(02)0123-4567", "(02)0123-4567"), ("a(at)b.com", "a(at)b.com"), ("9시 40분", "9시 40분"), ("아니요", "아니요"), ("57:19 정정하신대요", "정정하신대요")])
def test_speech(text, clean):
    assert T.clean_text(text)[1] == clean


def test_turns_go_on_over_what_isnt_speech():
    found = turns([(0.0, "가", "A"), (1.0, "(기침)", "B"), (2.0, "나", "a"), (3.0, "다", "B:"), (4.0, "음", "A"), (5.0, "라", None)])
    # the last chunk has no label: it belongs to the speaker of the chunk before it, hesitating or not
    assert [(t[0], t[1], t[3]) for t in found] == [("화자1", 0.0, "가 나"), ("화자2", 3.0, "다"), ("화자1", 5.0, "라")]


def test_label_in_the_text_counts_only_without_another():
    found = turns([(0.0, " 고객: 가", None), (1.0, "나", "고객"), (2.0, "상담원: 다", None), (3.0, "라", "화자미상"), (4.0, "마", " ")])
    assert [(t[0], t[3]) for t in found] == [("화자1", "가 나"), ("화자2", "다 라 마")]


def test_order_doubles_and_missing_ends():
    found = turns([(5.0, None, "나", "A"), (0.0, 1.0, "가", "A"), (0.0, 1.0, "가", "A"), (None, 2.0, "x", "A")])
    assert found == [("화자1", 0.0, 5.0, "가 나")]
    assert T.turns_of(None, None) == [] and T.turns_of([], []) == [] and T.turns_of([None], [None]) == []


def test_speakers_are_numbered_by_their_first_speech():
    assert [t[0] for t in turns([(0.0, "음", "B"), (1.0, "가", "A"), (2.0, "나", "B")])] == ["화자1", "화자2"]


def test_rolling_captions():
    assert T.rolled_over("오늘 날씨가 참 좋습니다", "참 좋습니다 그래서 나갑니다") == "그래서 나갑니다"
    assert T.rolled_over("가 나", "나 다") == "나 다"
    found = turns([(0.0, 4.0, "오늘 날씨가 참 좋습니다", "A"), (2.0, 6.0, "참 좋습니다 그래서 나갑니다", "A")])
    assert found[0][3] == "오늘 날씨가 참 좋습니다 그래서 나갑니다"
    again = turns([(0.0, 1.0, "네 네 알겠습니다", "A"), (3.0, 4.0, "네 네 알겠습니다", "A")])
    assert again[0][3] == "네 네 알겠습니다 네 네 알겠습니다"


def test_pauses_split_only_if_asked():
    rows = [(float(i), i + 0.9, "말", "A") for i in range(20)] + [(40.0, 41.0, "끝", "A")]
    assert len(turns(rows)) == 1 and len(turns(rows, pause_quantile=0.9)) == 2


def test_queries(spark, small):
    rows = queries.p4_found(spark, small).collect()
    assert len(rows) == len({(r.file, r.start_ms) for r in rows}) > 0
    empty = spark.createDataFrame([], "file string, chunks array<struct<start:double,end:double,text:string>>, speaker array<string>, turn int")
    assert T.speaker_turns(empty).count() == 0
    nulls = spark.createDataFrame([("a", None, None, 1)], empty.schema)
    assert T.speaker_turns(nulls).count() == 0
