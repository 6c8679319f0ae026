import pytest
from pyspark.sql import functions as F

from callweave.llm import queries, tokenize as T

public = pytest.importorskip("public_tokenizers")
TEXTS = ["", "hello world", "안녕하세요  고객님\r\n\t반갑습니다!!", " 123  4567 don't we'll", "🙂🙂 é é ß", "<|endoftext|> x", "\n\n  \n x", "a" * 5000, "가" * 3000, "여보세요" * 2000 + " 끝", "　\xa0 x​", "ababab" * 700]


@pytest.fixture(scope="module")
def reference():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return lambda text: t.encode(text, add_special_tokens=False).ids


def test_same_ids(reference):
    own = T.ByteBpe(queries.vocabulary())
    for text in TEXTS:
        assert own.encode(text) == reference(text), text[:20]
    assert own.encode(None) == []


def test_small_caches_change_nothing(reference):
    own = T.ByteBpe(queries.vocabulary(), cache_entries=2)
    for text in TEXTS:
        assert own.encode(text) == reference(text)


def test_queue_gives_lowest_rank_then_leftmost():
    queue = T.RankQueue(50_000)
    entries = [(7, 3), (49_999, 1), (7, 1), (4096, 2), (0, 9), (7, 2), (63, 5), (64, 5)]
    for rank, place in entries:
        queue.push(rank, place)
    assert [queue.pop() for _ in entries] == sorted(entries) and queue.pop() is None
    queue.push(5, 1)
    assert queue.pop() == (5, 1) and queue.pop() is None


def test_whole_table(spark, small, reference):
    rows = {r.doc_id: r.ids for r in queries.p7_ids(spark, small).collect()}
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    assert rows == {k: reference(t) if t else [] for k, t in texts.items()}


def test_edges(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, "", "b"), (3, "x", "c"), (3, "x", "d")], "doc_id long, text string, ids string")
    got = sorted((r.doc_id, r.ids) for r in T.encode_corpus(df, queries.vocabulary()).collect())
    assert got[:2] == [(1, []), (2, [])] and len(got) == 4 and got[2] == got[3]
    assert T.encode_corpus(df.where(F.lit(False)), queries.vocabulary()).count() == 0
