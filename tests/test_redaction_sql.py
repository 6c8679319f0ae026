"""The redaction record on invented edits, against its SQL."""

import random

import pytest

from callweave.functions.text import TAGS
from callweave.plans import queries

from .compare import rows_of, rows_of_sql

RNG = random.Random(11)
NAMES = ["홍길동", "홍길", "동김", "김영희", "박 철 수"]
VALUES = {TAGS["name"]: [*NAMES, "이몽룡", "Bob", "홍길동 님"], TAGS["phone"]: ["010-1234-5678", "02 123 4567", "01099998888"], TAGS["birthdate"]: ["900102", "1990년 1월 2일", "90.1.2"]}
WORDS = "저는 입니다 전화 주세요 생일은 네 아니요 가 나 다 .*( [이름] 이고요".split()


def line():
    return [RNG.choice(WORDS) if RNG.random() < 0.6 else RNG.choice(list(VALUES)) for _ in range(RNG.randint(0, 7))]


def texts():
    lines = [line() for _ in range(RNG.randint(1, 8))]
    glue = [RNG.choice([" ", " ", ""]) for _ in lines]
    source = [g.join(RNG.choice(VALUES[w]) if w in VALUES and RNG.random() < 0.9 else w for w in words) for g, words in zip(glue, lines)]
    masked = [g.join(words) for g, words in zip(glue, lines)]
    for _ in range(RNG.choice([0, 0, 1, 3])):
        kind, at = RNG.choice(["drop", "add", "edit", "edit"]), RNG.randrange(len(masked)) if masked else 0
        if kind == "add" or not masked:
            masked.insert(at, "새 줄 " + RNG.choice(list(TAGS.values())))
        elif kind == "drop":
            masked.pop(at)
        else:
            masked[at] = masked[at].replace(RNG.choice(WORDS), RNG.choice(["", "음", "저희는"]))
    return "\n".join(source), RNG.choice(["\n", "\n", "\r\n"]).join(masked)


@pytest.mark.parametrize("name", ["redacted_lines", "redaction_entries", "redaction_summary", "info_document"])
def test_invented_edits_like_sql(spark, tmp_path, name):
    pairs = [texts() for _ in range(150)] + [("", ""), (None, TAGS["name"]), ("가", None), ("홍길동" * 3, TAGS["name"] * 3)]
    spark.createDataFrame([(f"{i}.txt", s) for i, (s, _) in enumerate(pairs)], "file string, text string").coalesce(1).write.parquet(f"{tmp_path}/text_files.parquet")
    spark.createDataFrame([(i, f"{i}.txt", m) for i, (_, m) in enumerate(pairs)], "anon_id long, file string, text string").coalesce(1).write.parquet(f"{tmp_path}/anonymization.parquet")
    spark.createDataFrame([(1, NAMES, ["010-1234-5678"])], "schema_version int, names array<string>, phone_numbers array<string>").coalesce(1).write.parquet(f"{tmp_path}/registry.parquet")
    names, rows = rows_of(queries.QUERIES[name](spark, str(tmp_path)))
    assert (names, rows) == rows_of_sql(queries.ORACLES[name], tmp_path) and len(rows) > 50
