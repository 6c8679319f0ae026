import random

import numpy as np

from callweave.llm import leakage as L
from callweave.llm import queries

from ..compare import rows_of, rows_of_sql

RNG = random.Random(7)
WORDS = ["".join(RNG.choice("가나다라마바사아자차카타파하거너더러머버") for _ in range(RNG.randint(2, 4))) for _ in range(3000)]


def item(n=24):
    return RNG.sample(WORDS, n)


def noise(n=120):
    return [RNG.choice(WORDS) for _ in range(n)]


def embed(words, changes=0):
    words = list(words)
    for i in RNG.sample(range(len(words)), changes):
        words[i] = RNG.choice(WORDS)
    return " ".join([*noise(), *words, *noise()])


def test_full_partial_and_changed_items(spark):
    intro = "다음 통화 내용을 읽고 물음에 답하시오"
    items = {i: [*intro.split(), *item()] for i in range(30)}
    docs, expected = [], set()
    for i, words in items.items():
        docs.append((100 + i, embed(words)))
        expected.add((100 + i, i))
        docs.append((200 + i, embed(words[len(words) // 2 - 4 :], 3)))
        expected.add((200 + i, i))
        docs.append((300 + i, embed(words[:6])))  # little more than the instruction
        half = len(words) // 2
        docs.append((400 + i, "\n".join(f"화자{n % 2 + 1}: {w.upper()}!" for n, w in enumerate(words))))
        expected.add((400 + i, i))
        docs.append((500 + i, " ".join(words[half:] + noise(400) + words[:half])))
    table = spark.createDataFrame([(d, t, 0, 1.0) for d, t in docs] + [(1, None, 0, 1.0), (2, "", 0, 1.0), (3, "?!", 0, 1.0)], "doc_id long, text string, item_id int, held double")
    got = {(r.doc_id, r.item_id) for r in L.leaks(table, [(i, " ".join(w) + ".") for i, w in items.items()]).collect()}
    assert got - {g for g in got if 500 <= g[0] < 600} == expected
    leaked = L.leaks(table, [(0, " ".join(items[0]))])
    kept = L.without_leaks(table, leaked)
    assert 100 not in {r.doc_id for r in kept.collect()} and kept.count() == table.count() - 4


def test_spacing_doesnt_count():
    words = item()
    known = L.ItemSet([(1, " ".join(words))])
    text = L.compact("".join(noise(20)) + "".join(words) + "".join(noise(20)))
    assert [(n, i, held, whole) for n, i, held, whole, *_ in known.leaks([text], L.CANDIDATE_SHARE, 0.5)] == [(0, 0, 1.0, True)]


def test_short_items_are_found(spark):
    docs = spark.createDataFrame([(1, "어제 서울 시청 앞에서"), (2, "ABC-defg."), (3, "가"), (4, "시 청서울"), (5, "서 울시 청!")], "doc_id long, text string")
    got = sorted((r.doc_id, r.item_id, r.start, r.end) for r in L.leaks(docs, [(1, "서울 시청"), (2, "abc defg"), (3, "가?"), (4, "없음")]).collect())
    assert got == [(1, 1, 3, 8), (2, 2, 0, 8), (3, 3, 0, 1), (5, 1, 0, 6)]


def test_recall_of_changed_words():
    """By the length of the words and the share of changed ones; printed for the README."""
    table = {}
    for size in (2, 3, 4):
        words = ["".join(RNG.choice("가나다라마바사아자차카타파하거너더러머버고노도로모보") for _ in range(size)) for _ in range(4000)]
        for every in (2, 3, 4, 5):
            cases = []
            for n in (8, 20, 60):
                for _ in range(15):
                    own = RNG.sample(words, n)
                    changed = [RNG.choice(words) if k % every == every - 1 else w for k, w in enumerate(own)]
                    cases.append((" ".join(own), L.compact("".join(RNG.choices(words, k=80)) + "".join(changed) + "".join(RNG.choices(words, k=80)))))
            known = L.ItemSet([(i, t) for i, (t, _) in enumerate(cases)])
            found = {(n, i) for n, i, *_ in known.leaks([d for _, d in cases], L.CANDIDATE_SHARE, 0.5)}
            table[size, every] = sum((i, i) in found for i in range(len(cases))) / len(cases)
    print(table)
    assert all(r >= 0.9 for (size, every), r in table.items() if every > 2 or size == 4), table


def test_a_passage_behind_chance_hits_is_found():
    own = [item() for _ in range(20)]
    known = L.ItemSet([(i, " ".join(w)) for i, w in enumerate(own)])
    texts = [L.compact(" ".join([w[20], *noise(9), w[3], *noise(8), *w, *noise(5), w[1], w[2], *noise(40), *w])) for w in own]
    found = known.leaks(texts, L.CANDIDATE_SHARE, 0.5)
    assert sorted((n, i) for n, i, held, *_ in found if held == 1) == sorted((n, n) for n in range(20) for _ in range(2))


def test_common_ngrams_dont_hide_items():
    intro = "다음통화내용을읽고물음에답하시오"
    items = [(i, f"{intro} " + " ".join(item(12))) for i in range(40)] + [(100 + i, f"{intro} {w}") for i, w in enumerate(WORDS[:20])]
    known = L.ItemSet(items)
    texts = [L.compact(" ".join([*noise(30), t, *noise(30)])) for _, t in items]
    found = {(n, i) for n, i, held, *_ in known.leaks(texts, L.CANDIDATE_SHARE, 0.5) if held == 1}
    assert {(n, n) for n in range(len(items))} <= found


def test_passages_are_taken_out(spark):
    words = item(10)
    said = " ".join(words)
    texts = [(1, f"앞말, 화자1: {said}.\n끝말"), (2, "그대로"), (3, None), (4, "앞 " + " ".join(words).upper() + " 중간말 " * 30 + said), (None, said)]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    found = L.leaks(df, spark.createDataFrame([(7, said), (7, said), (8, None)], "item_id long, text string"))
    clean = {r.doc_id: r.text for r in L.without_passages(df, found).collect()}
    assert clean == {1: "앞말, 화자1: .\n끝말", 2: "그대로", 3: None, 4: "앞 " + " 중간말 " * 30, None: said}


def test_blocks_of_items_give_the_same(spark, monkeypatch):
    items = [(i, " ".join(item())) for i in range(6)]
    docs = spark.createDataFrame([(i, embed(t.split())) for i, t in items], "doc_id long, text string")
    one = {(r.doc_id, r.item_id) for r in L.leaks(docs, items).collect()}
    monkeypatch.setattr(L, "MAX_SET_BYTES", 4000)
    many = {(r.doc_id, r.item_id) for r in L.leaks(docs, items).collect()}
    assert one == many == {(i, i) for i, _ in items}


def test_pieces_of_a_batch_dont_touch():
    words = item()
    known = L.ItemSet([(1, " ".join(words))])
    half = len(words) // 2 - 3
    piece = [L.compact(" ".join(words[:half])), L.compact(" ".join(words[half : 2 * half]))]
    assert known.leaks(piece, L.CANDIDATE_SHARE, 0.5) == []


def test_places_of_the_compact_text():
    for text in ("", "화자1: Aß, 나\n고객: 다_라 İx", " a  b", "상담원:상담원: 가"):
        places, compact = L.places_of(text), L.compact(text)
        assert len(places) == len(compact) and all(c in text[p].lower() for p, c in zip(places, compact))


def test_hashes_of_windows():
    codes = L.codes_of("abcdabcd")
    hashes = L.gram_hashes(codes, 4)
    assert len(hashes) == 5 and hashes[0] == hashes[4] and len(np.unique(hashes)) == 4
    assert len(L.gram_hashes(codes, 9)) == 0


def test_edges(spark):
    docs = spark.createDataFrame([(1, "가나다"), (1, "가나다")], "doc_id long, text string")
    assert L.leaks(docs, []).count() == 0
    assert L.leaks(docs, [(1, None), (2, ""), (3, "?"), (4, "라가")]).count() == 0
    assert L.leaks(docs.limit(0), [(1, "가나다라마바사")]).count() == 0
    long = spark.createDataFrame([(1, "라 " * 300_000 + " ".join(WORDS[:20]))], "doc_id long, text string")
    assert [r.item_id for r in L.leaks(long, [(9, " ".join(WORDS[:20]))]).collect()] == [9]


def test_query(spark, small):
    rows = queries.p8_found(spark, small)
    assert rows_of(queries.p8_in_full(spark, small)) == rows_of_sql(queries.ORACLES["p8_in_full"], small)
    cleaned = queries.p8_cleaned(spark, small)
    assert cleaned.where("removed > 0").count() == rows.select("doc_id").distinct().count() and cleaned.count() == 100
    assert rows.count() == rows.distinct().count() > 0
