import random

import pytest
from pyspark.sql import functions as F

from callweave.functions import text as T
from callweave.operators import masking as M
from callweave.operators import redaction as R

NAME, BIRTH, PHONE = T.TAGS["name"], T.TAGS["birthdate"], T.TAGS["phone"]


def masked(spark, text, names=(), phones=()):
    registry = M.Registry.of({"schema_version": 1, "names": list(names), "phone_numbers": list(phones)})
    return spark.createDataFrame([(text,)], "t string").select(M.mask_known(F.col("t"), registry).alias("m")).first().m


def test_names_longest_first_and_not_inside_tags(spark):
    assert masked(spark, "홍길동이가 홍길동씨한테, 김영희도", ["홍길동", "김영희"]) == f"{NAME}이가 {NAME}씨한테, {NAME}도"
    assert masked(spark, "WXYZ", ["XYZ", "WX"]) == f"W{NAME}"
    assert masked(spark, f"이름은 {NAME} 이름", ["이름"]) == f"{NAME}은 {NAME} {NAME}"
    marks = "".join(chr(0xE000 + i) for i in range(4))
    assert masked(spark, f"{marks}홍길동{chr(0xE003)}1", ["홍길동"]) == f"{marks}{NAME}{chr(0xE003)}1"
    assert masked(spark, None, ["홍길동"]) is None


def test_phones_in_any_writing_but_not_inside_longer_numbers(spark):
    phones = ["010-1234-5678", "+82 10-1234-5678"]
    for text in ("010-1234-5678", "01012345678", "010 (1234) 5678", "010.1234.5678"):
        assert masked(spark, f"a {text}b", phones=phones) == f"a {PHONE}b"
    assert masked(spark, "1010-1234-5678 010-1234-56789", phones=phones) == "1010-1234-5678 010-1234-56789"
    assert masked(spark, "+821012345678", phones=phones) == f"+{PHONE}"


def test_long_registries_mask_alike(spark, monkeypatch):
    rng = random.Random(9)
    names = ["홍길동", "홍길", "동김", "이름", "이", "]홍", "가나다", "나다", "다", "a.b", "WX", "XYZ"]
    phones = ["010-1234-5678", "1234-5678", "02 123 4567"]
    registry = M.Registry.of({"schema_version": 1, "names": names, "phone_numbers": phones})
    bits = [*names, *phones, *T.TAGS.values(), "01012345678", "(010) 1234.5678", "9", " ", "\n", "라", "٣"]
    texts = [("".join(rng.choices(bits, k=rng.randint(0, 12))),) for _ in range(400)] + [(None,)]
    df = spark.createDataFrame(texts, "t string")
    chain = [r.m for r in df.select(M.mask_known(F.col("t"), registry).alias("m")).collect()]
    monkeypatch.setattr(M, "CHAIN_ENTRIES", 0)
    assert [r.m for r in df.select(M.mask_known(F.col("t"), registry).alias("m")).collect()] == chain
    many = M.Registry.of({"schema_version": 1, "names": [f"이름{i}씨" for i in range(5000)], "phone_numbers": []})
    assert df.sparkSession.createDataFrame([("이름4999씨 안녕",)], "t string").select(M.mask_known(F.col("t"), many).alias("m")).first().m == f"{NAME} 안녕"


def test_masking_twice_changes_nothing(spark):
    once = masked(spark, "홍길동 010-1234-5678 홍길동", ["홍길동"], ["01012345678"])
    assert masked(spark, once, ["홍길동"], ["01012345678"]) == once


@pytest.mark.parametrize("document", [{}, {"schema_version": 2, "names": [], "phone_numbers": []}, {"schema_version": 1, "names": [" "], "phone_numbers": []}, {"schema_version": 1, "names": [f"a{NAME}"], "phone_numbers": []}, {"schema_version": 1, "names": [], "phone_numbers": ["(02) 000-0000"]}, {"schema_version": 1, "names": "x", "phone_numbers": []}])
def test_registries_that_break_a_rule(document):
    with pytest.raises(M.RegistryError):
        M.Registry.of(document)


def test_registry_keeps_the_first_writing():
    r = M.Registry.of({"schema_version": 1, "names": [" 홍길동 ", "홍길동"], "phone_numbers": ["010-1234-5678", "01012345678"]})
    assert r.names == ("홍길동",) and r.phones == (("01012345678", "010-1234-5678"),)


def test_shapes(spark):
    cases = [
        (PHONE, "010-1234-5678", True, True), (PHONE, "010 1234 5678", True, True), (PHONE, "(02) 000-0000", False, False), (PHONE, "+82 10-1234-5678", True, True),
        (PHONE, "123456", False, False), (PHONE, "1" * 16, False, False), (BIRTH, "1990년 1월 2일", True, True), (BIRTH, "900102", True, True), (NAME, "홍길동", True, True),
        (NAME, "홍 길자 동자", True, True), (NAME, "홍길동 님", True, False), (NAME, "가" * 21, False, False), (NAME, "홍1", False, False), (NAME, "", False, False), (NAME, None, False, False), (NAME, " 홍", True, False),
    ]
    df = spark.createDataFrame([(t, v) for t, v, *_ in cases], "t string, v string")
    got = [tuple(r) for r in df.select(T.looks_like(F.col("t"), F.col("v")), T.plausible(F.col("t"), F.col("v"))).collect()]
    assert got == [(a, b) for *_, a, b in cases]
    for tag, value, a, _ in cases:
        if value is not None:
            assert R.shaped(tag, value) == a, value


REGISTRY = M.Registry(("홍길동", "홍길", "동김"), (("01012345678", "010-1234-5678"),))


def recovered(spark, lines, registry=REGISTRY):
    pairs = spark.createDataFrame([(i, 1, 1, a, b) for i, (a, b) in enumerate(lines)], "id int, line int, place int, source_line string, masked_line string")
    out = [[] for _ in lines]
    for r in R.replacements(pairs, ["id"], registry).orderBy("id", "part", "item").collect():
        out[r.id].append((r.tag, r.value, r.reason))
    return out


CASES = [
    ("저는 홍길동 입니다", f"저는 {NAME} 입니다", [(NAME, "홍길동", None)]),
    ("홍길동 님", f"{NAME}님", [(NAME, "홍길동", None)]),
    ("홍길동010-1234-5678", f"{NAME}{PHONE}", [(NAME, "홍길동", None), (PHONE, "010-1234-5678", None)]),
    ("박철수010-9999-8888 입니다", f"{NAME}{PHONE} 입니다", [(NAME, "박철수", None), (PHONE, "010-9999-8888", None)]),
    ("박철수이영희", f"{NAME}{NAME}", [(NAME, None, R.ADJACENT)] * 2),
    ("저는 입니다", f"저는 {NAME}입니다", [(NAME, None, R.EMPTY)]),
    ("저는 입니다", f"저는 {NAME}{PHONE}입니다", [(NAME, None, R.ADJACENT), (PHONE, None, R.ADJACENT)]),
    ("제 이름은 홍길동이에요", f"이름이 {NAME}이에요", [(NAME, "홍길동", None)]),
    ("홍길동 갑니다", f"바{NAME}사 옵니다", [(NAME, None, R.ANCHOR_LOST)]),
    ("안녕 홍길동 이라 해요", f"안녕 {NAME} 이라고 해요", [(NAME, "홍길동", None)]),
    ("아무 표시도 없음", "아무 표시 없음", []),
    ("가 홍길동 나 900102 다", f"가 {NAME} 나 {BIRTH} 다", [(NAME, "홍길동", None), (BIRTH, "900102", None)]),
    ("앞말 가 홍길동 나", f"가 {NAME} 나", [(NAME, "홍길동", None)]),
    (f"가 {NAME} 나 홍길동", f"가 {NAME} 나 {NAME}", [(NAME, "홍길동", None)]),
    ("a.b*c 홍길동 (d)", f"a.b*c {NAME} (d)", [(NAME, "홍길동", None)]),
    ("", NAME, [(NAME, None, R.EMPTY)]),
]


def test_recovered_values(spark):
    assert recovered(spark, [c[:2] for c in CASES]) == [c[2] for c in CASES]


def test_many_adjacent_tags_dont_explode():
    region = "가" * 60
    assert R.cut_region([NAME] * 12, region, M.Registry()) is None
    assert R.cut_region([NAME, BIRTH, NAME], "홍길동900102김철수", M.Registry()) == ["홍길동", "900102", "김철수"]
    assert R.cut_region([NAME, NAME], "", M.Registry()) is None


def test_pairs_entries_and_info(spark):
    source = "저는 홍길동\n그대로\n홍길동 홍길동\n[이름] 있던 것\n박철수이영희"
    masked_text = f"저는 {NAME}\n그대로\n{NAME} {NAME}\n[이름] 있던 것!\n{NAME}{NAME}"
    df = spark.createDataFrame([("f", source, masked_text), ("g", "한 줄\n저는 홍길동", f"저는 {NAME}"), ("h", "", "")], "file string, source_text string, masked_text string")
    pairs = R.line_pairs(df, ["file"])
    assert sorted((r.file, r.line) for r in pairs.collect()) == [("f", 1), ("f", 3), ("f", 4), ("f", 5), ("g", 1), ("g", 2)]
    rows = R.entries(R.replacements(pairs, ["file"], REGISTRY), ["file"])
    got = sorted((r["file"], r["line"], r["value"] or "", r["count"]) for r in rows.collect())
    assert got[:3] == [("f", 1, "홍길동", 1), ("f", 3, "홍길동", 2), ("f", 5, "", 2)]
    summary = {r.file: (r.entries, r.total, r.unresolved) for r in R.summary(rows, ["file"]).collect()}
    assert summary["f"] == (3, 5, 2)
    info = {r.file: r.info for r in R.info(rows, ["file"]).collect()}
    assert info["f"].name == ["홍길동", None] and info["f"].phone == []
    text = {r.file: r.text for r in R.info_json(R.info(rows, ["file"])).collect()}["f"]
    assert text.startswith('{\n  "file": "f",\n  "info": {\n    "name": [\n      "홍길동",\n      null\n    ],') and text.endswith("}\n")


def test_lines_like_splitlines(spark):
    for text in ("", "a", "a\n", "a\n\n", "\n", "a\r\nb\rc\x0bd\x0ce\x1cf\x85g h", "a\nb\n"):
        got = spark.createDataFrame([(text,)], "t string").select(T.lines(F.col("t")).alias("l")).first().l
        assert got == text.splitlines(), repr(text)


def test_spaces_like_python(spark):
    for text in ("　a b \n", " \x1c ", " x ", "a"):
        r = spark.createDataFrame([(text,)], "t string").select(T.strip(F.col("t")), T.rstrip(F.col("t")), T.is_blank(F.col("t")), T.canonical_exact(F.col("t"))).first()
        assert tuple(r) == (text.strip(), text.rstrip(), not text.strip(), "".join(c for c in text if c.isalnum()).casefold())
