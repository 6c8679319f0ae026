import random
import re

import pytest

from callweave.llm import queries
from callweave.llm import splitting as S

from ..compare import rows_of, rows_of_sql


def pieces(spark, texts, **options):
    df = spark.createDataFrame(list(enumerate(texts)), "file int, text string")
    out = {}
    for r in S.split_texts(df, **options).orderBy("file", "piece").collect():
        out.setdefault(r.file, []).append(r)
    return out


def check(text, own, limit=1000):
    rebuilt = ""
    for i, r in enumerate(own):
        assert len(r.content) <= limit and text[r.start : r.end] == r.content and r.piece == i
        assert (50 <= r.overlap <= 150) if i else r.overlap == 0
        rebuilt += r.content[r.overlap :]
    assert rebuilt == text


def test_random_texts(spark):
    rng = random.Random(2)
    texts = []
    for _ in range(120):
        words = [rng.choice(["가나다", "a", "네.", "그래요!", "x" * rng.randint(1, 1300), "끝…", "\n", "\r\n", "　", "🙂"]) for _ in range(rng.randint(1, 260))]
        texts.append(rng.choice(["", " "]).join(words) if rng.random() < 0.2 else " ".join(words))
    found = pieces(spark, texts)
    for i, text in enumerate(texts):
        assert (i in found) == (len(text) > 1000)
        if i in found:
            check(text, found[i])
            forced = bool(re.search(r"[^\s.?!…]{1001}", text))
            assert all(r.unbroken == forced for r in found[i])
            for r in found[i]:
                if r.boundary == "character":  # nothing natural within what the piece could hold
                    assert not re.search(r"[\s]|[.?!…]", text[r.start + r.overlap + 50 : r.end])


def test_lines_before_sentences_before_words(spark):
    line = ("가나다 " * 150).strip() + ".\n" + "라마바 " * 200
    assert pieces(spark, [line])[0][0].boundary == "line"
    sentence = ("가나다 " * 150).strip() + ". " + "라마바 " * 200
    assert pieces(spark, [sentence])[0][0].boundary == "sentence"
    assert pieces(spark, ["라마바 " * 400])[0][0].boundary == "word"
    assert pieces(spark, ["가" * 3000])[0][0].boundary == "character"


@pytest.mark.parametrize("size", [999, 1000, 1001, 1950, 1951])
def test_sizes_around_the_limit(spark, size):
    text = "가" * size
    found = pieces(spark, [text])
    assert bool(found) == (size > 1000)
    if found:
        check(text, found[0])


def test_very_long_text(spark):
    text = "이것은 아주 긴 글의 한 문장입니다. " * 60_000
    check(text, pieces(spark, [text])[0])


def test_edges(spark):
    df = spark.createDataFrame([("a", None, 1), ("b", "", 2), ("c", "짧다", 3)], "file string, text string, piece int")
    assert S.split_texts(df).count() == 0
    assert [(r.file, r.content) for r in S.split_texts(df.where("text <> ''"), keep_short=True).collect()] == [("c", "짧다")]
    assert S.split_texts(df.limit(0)).count() == 0


def test_same_cuts_as_sql(spark, small):
    for name in ("p3_found", "p3_pieces"):
        assert rows_of(queries.QUERIES[name](spark, small)) == rows_of_sql(queries.ORACLES[name], small)


def test_forced_cuts_come_from_the_pieces(spark):
    for size in (990, 1000, 1001, 1005, 2100):
        for front in ("", "앞 ", "앞말 " * 313, "앞말 " * 100 + "\n"):
            for back in ("", " 뒤", " 뒷말" * 400):
                text = front + "가" * size + back
                if len(text) > 1000:
                    assert {r.unbroken for r in pieces(spark, [text])[0]} == {size > 1000}, (size, front[:3], back[:3])
