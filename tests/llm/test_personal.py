import pytest
from pyspark.sql import functions as F

from callweave.llm import personal as P
from callweave.llm import queries

NONE = P.Syllables({}, {}, {})


def found(text, kind):
    return [text[s:e] for k, s, e, _, _, _, _, sure, _ in P.candidates(text, NONE) if k == kind and (sure or kind == "birthdate")]


@pytest.mark.parametrize("text", ["010-1234-5678", "01012345678", "010 1234 5678", "010.1234.5678", "010 - 1234 - 5678", "+82 10-1234-5678", "+82-10-1234-5678", "(02)1234-5678", "０１０－１２３４－５６７８", "공일공에 공삼이육 팔이오오", "공일공 공이구오 일오이일"])
def test_phones(text):
    assert found(f"번호는 {text}로 주세요", "phone") == [text]


@pytest.mark.parametrize("text", ["a.b_c12@mail.example", "A-B7@voice.test", "ab12+call@example.net", "ab12 @ example.org", "ab12(at)example.com", "ab12 골뱅이 mail 점 example"])
def test_mail_addresses(text):
    assert found(f"메일은 {text} 이에요", "email") == [text]


@pytest.mark.parametrize("text", ["900101-1234567", "9001011234567", "900101 1234567", "900101–1234567", "９００１０１－１２３４５６７", "M12345678", "11-22-123456-70"])
def test_identity_numbers(text):
    assert found(f"번호는 {text} 입니다", "id_number") == [text]


@pytest.mark.parametrize("text", ["가온특별시 이든동 538-53 번지", "미르시 윤슬구 별내길 45번길 17", "다솜길 27-32", "너울군 여울면 참새동 7번지 지하 1층", "누리구 별내길 58번길 4 127동 1303호", "가온특별시 바람읍 은하수로 44, 116동 501호"])
def test_addresses(text):
    assert found(f"집이 {text} 이에요", "address") == [text]
    assert found(f"혹시 {text}로 배송해주세요", "address") == [text]


@pytest.mark.parametrize("text", ["송장번호 420720015508", "접수번호는 2024-0497-0462844", "모델명이 KX-0769-1373", "카드 끝자리가 9557", "오류 코드는 E613-9", "내선 312번", "5,855,736원", "골뱅이 무침 세트도 주문했어요", "다시 새로 3번 보내고 7월 19일 오후 7시", "강 건너편 매장은", "한 사람당 두 개까지만"])
def test_other_numbers_and_words(text):
    assert [c for c in P.candidates(text, NONE) if c[-2]] == []


def tables(spark, texts, info, names=(), phones=()):
    t = spark.createDataFrame([(f, x, "l", 1) for f, x in texts], "file string, text string, left string, kind int")
    i = spark.createDataFrame([(f, {"name": n, "birthdate": b, "phone": p}) for f, n, b, p in info], "file string, info struct<name:array<string>,birthdate:array<string>,phone:array<string>>")
    r = spark.createDataFrame([(1, list(names), list(phones))], "schema_version int, names array<string>, phone_numbers array<string>")
    return t, i, r


GIVEN = ["솔늘", "담든", "봄샘", "빛결", "휘율", "샘솔", "결든", "늘빛", "율담", "든봄"]


def corpus(spark):
    texts, info = [], []
    for i in range(120):
        family, given = "김이박최정"[i % 5], GIVEN[i % 10][0] + GIVEN[(i * 7) % 10][1]
        name = family + given
        filler = "고객님 주문을 다시 확인하고 이자율을 안내하느라 정확히 정리했습니다. 기사님이 상담원 연결을 도와드립니다. " * 3
        texts.append((f"f{i}", f"{filler}제 이름은 {name} 입니다. 생년월일은 1980.01.{i % 28 + 1:02d} 이에요. 방문 예정일은 2025.02.{i % 28 + 1:02d} 입니다. {given}님 계신가요?"))
        info.append((f"f{i}", [name, None] if i % 3 else None, [f"1980-01-{i % 28 + 1:02d}"] if i % 2 else [], None))
    return texts, info


def test_names_and_dates_by_their_information(spark):
    texts, info = corpus(spark)
    texts += [texts[0], ("empty", ""), ("null", None), (None, "제 이름은 김솔늘 입니다.")]
    t, i, r = tables(spark, texts, info)
    rows = P.mentions(t, i, r).collect()
    by = {}
    for m in rows:
        by.setdefault((m.file, m.kind), []).append(m)
    for f, text in texts[:120]:
        name, date = text.index("이름은 ") + 4, text.index("일은 1980") + 3
        assert sorted(m.start_pos for m in by[f, "name"]) == [name, text.rindex("님 계신") - 2], f
        assert [m.start_pos for m in by[f, "birthdate"]] == [date], f
    assert [m.start_pos for m in by[None, "name"]] == [6]
    assert len(rows) == len({(m.file, m.kind, m.start_pos) for m in rows})
    clean = {x.file: x.text for x in P.sanitised(t, P.mentions(t, i, r)).collect()}
    assert clean["f1"].endswith("제 이름은 [이름] 입니다. 생년월일은 [생년월일] 이에요. 방문 예정일은 2025.02.02 입니다. [이름]님 계신가요?")
    assert clean["null"] is None and clean["empty"] == "" and len(clean) == 123


def test_empty_tables(spark):
    t, i, r = tables(spark, [], [])
    assert P.mentions(t, i, r).count() == 0
    t, i, r = tables(spark, [("a", "010-1234-5678 김솔늘 님")], [])
    assert [(m.kind, m.start_pos) for m in P.mentions(t, i.limit(0), r.limit(0)).collect()] == [("phone", 0)]


def test_overlaps_and_long_texts(spark):
    text = "가 " * 200_000 + "010-1234-5678"
    t, i, r = tables(spark, [("a", text)], [("a", [], [], ["01012345678"])])
    assert [(m.kind, m.start_pos, m.protected) for m in P.mentions(t, i, r).collect()] == [("phone", 400_000, True)]


def test_of_a_chain_all_that_overlap_no_kept_mention_stay(spark):
    schema = "file string, kind string, start int, end int, disclosure double, sure boolean, protected boolean"
    spans = [(0, 10, 1.0), (8, 20, 1.0), (18, 24, 9.0), (23, 26, 5.0), (30, 33, 4.0), (40, 44, 4.0), (43, 47, 9.0), (46, 50, 5.0)]
    df = spark.createDataFrame([(f, "name", *s, False, True) for f in ("a", None) for s in spans], schema)
    want = [(8, 20), (23, 26), (30, 33), (43, 47)]
    got = sorted(((r.file or "", r.start_pos, r.end_pos) for r in P.disclosed(df).collect()))
    assert got == sorted((f, *s) for f in ("a", "") for s in want)
    ends = spark.createDataFrame([("a", "name", *s, False, True) for s in [(0, 5, 1.0), (4, 12, 1.0), (11, 15, 1.0), (14, 18, 1.0)]], schema)
    assert sorted(r.start_pos for r in P.disclosed(ends).collect()) == [4, 14]


def test_folding_keeps_offsets():
    text = "０１０－１２　\xa0​가–나"
    assert len(P.fold(text)) == len(text) and P.fold(text) == "010-12   가-나"


def test_query(spark, small):
    rows = queries.p6_found(spark, small)
    assert rows.columns == ["file", "kind", "start_pos"] and rows.count() == rows.distinct().count() > 0
    assert rows.where(~F.col("kind").isin(*P.PLACEHOLDERS)).count() == 0


def test_known_values_of_any_shape_are_masked(spark):
    text = "응우옌 씨와 Bob, 그리고 MARIA KIM, 남궁솔늘이랑 Bobby. 대표번호 1588 1234, 생일 90. 1. 2일, 주문 15881234567. 하이나라 이나라"
    info = [("a", ["응우옌", "Bob", None, " "], None, ["1588-1234"]), ("a", ["남궁 솔늘", "Maria Kim"], ["1990-01-02"], [None]), ("b", ["그리고"], None, None), (None, ["김 솔"], None, None)]
    t, i, r = tables(spark, [("a", text), ("a", text), ("b", text), (None, "김솔은 이나라에")], info, names=["이나라"])
    found = P.mentions(t, i, r)
    by = {}
    for m in found.collect():
        by.setdefault(m.file, set()).add((m.kind, (text if m.file else "김솔은 이나라에")[m.start_pos : m.end_pos]))
    assert by["a"] == {("name", x) for x in ("응우옌", "Bob", "MARIA KIM", "남궁솔늘", "이나라")} | {("phone", "1588 1234"), ("birthdate", "90. 1. 2일")}
    assert {x for k, x in by["b"] if k == "name"} >= {"그리고", "이나라"} and "응우옌" not in {x for _, x in by["b"]}
    assert by[None] == {("name", "김솔"), ("name", "이나라")}
    clean = {x.file: x.text for x in P.sanitised(t, found).collect()}
    assert clean["a"] == "[이름] 씨와 [이름], 그리고 [이름], [이름]이랑 Bobby. 대표번호 [전화번호], 생일 [생년월일], 주문 15881234567. 하이나라 [이름]"


def test_many_known_values_of_a_file(spark, monkeypatch):
    monkeypatch.setattr(P, "PART_VALUES", 7)
    syllables = "가나다라마바사아자차카타파하"
    names = [a + b + c for a in syllables for b in syllables for c in "렬률"]
    text = " ".join(names)
    t, i, r = tables(spark, [("a", text)], [("a", names, None, None)])
    rows = P.mentions(t, i, r).collect()
    assert sorted(m.start_pos for m in rows) == [4 * n for n in range(len(names))] and {m.route for m in rows} == {"known"}


def test_routes(spark):
    texts, info = corpus(spark)
    t, i, r = tables(spark, texts + [("p", "010-1234-5678")], info)
    assert {m.route for m in P.mentions(t, i, r).collect()} == {"shape", "known", "information"}
