import itertools
import random

import numpy as np
import pytest

from callweave.llm import queries
from callweave.llm import shared_spans as S

from ..compare import rows_of, rows_of_sql

RNG = random.Random(11)


def text(n):
    return "".join(RNG.choice("가나다라마바사아자차 abc.\n") for _ in range(n))


def pairs(docs, least):
    spans = {}
    for d, t in docs:
        for i in range(len(t or "") - least + 1):
            spans.setdefault(t[i : i + least], set()).add(d)
    return {p for s in spans.values() for p in itertools.combinations(sorted(s), 2)}


def frame(spark, docs):
    return spark.createDataFrame([(d, t, "x", 1) for d, t in docs], "doc_id long, text string, doc string, pos int").repartition(3)


@pytest.mark.parametrize("hot", [2, 32])
def test_pairs_like_brute_force(spark, hot):
    least, k = 60, 32
    shared = [text(n) for n in (45, 59, 60, 61, 90, 200)]
    announcement = text(50)
    docs = []
    for i in range(60):
        parts = [text(RNG.randint(0, 80))]
        for _ in range(RNG.randint(0, 2)):
            parts += [RNG.choice(shared), text(RNG.randint(0, 40))]
        if i % 2:
            parts.insert(RNG.randint(0, len(parts)), announcement)
        docs.append((i, "".join(parts)))
    docs += [(100 + i, docs[3][1]) for i in range(4)] + [(200, "라" * 300), (201, "라" * 70 + "마"), (202, "가나" * 100), (203, "x" + "가나" * 31), (300, None), (301, ""), (302, "짧다")]
    docs += [(203, docs[-4][1])]  # a repeated row
    got = [(r.doc_a, r.doc_b) for r in S.sharing_pairs(frame(spark, docs), least=least, k=k, hot=hot).collect()]
    assert set(got) == pairs(docs, least)


def test_windows_have_their_rightmost_minimum():
    rng = np.random.default_rng(1)
    for _ in range(200):
        n, w = int(rng.integers(1, 200)), int(rng.integers(1, 60))
        values = rng.integers(0, int(rng.choice([3, 1000])), n).astype(np.uint64) << np.uint64(20)
        w = min(w, n)
        assert set(S.minima(values, w)) == {i + w - 1 - int(np.argmin(values[i : i + w][::-1])) for i in range(n - w + 1)}


def test_hashes_depend_on_the_window_alone():
    codes = S.codes_of(text(500) + "끝")
    for n in (1, 2, 31, 128, 250):
        hashes = S.window_hashes(codes, n)
        assert len(hashes) == len(codes) - n + 1
        assert (S.window_hashes(codes[100:], n) == hashes[100:]).all()
        assert len(np.unique(hashes)) == len({codes[i : i + n].tobytes() for i in range(len(hashes))})


def test_loops_give_few_seeds():
    _, places, again = S.seeds_of("여보세요" * 50_000)
    assert len(places) < 400 and len(again) > 10_000


def worth(chain):
    """The sizes of a chain less the costs of its steps."""
    total = sum(size for _, _, size in chain)
    for (a, b, size), (a2, b2, _) in zip(chain, chain[1:]):
        total -= S.SKIP_COST * (max(a2 - a, b2 - b) - size) + S.GAP_COST * abs((a2 - a) - (b2 - b))
    return total


def best_worth(found):
    """The best worth of a chain by trying all predecessors."""
    order, score = S.runs_of(found), []
    for i, (a, b, size) in enumerate(order):
        before = [score[j] - S.SKIP_COST * (max(a - pa, b - pb) - ps) - S.GAP_COST * abs((a - pa) - (b - pb)) for j, (pa, pb, ps) in enumerate(order[:i]) if pa + ps <= a and pb + ps <= b]
        score.append(size + max([0.0, *before]))
    return max(score, default=0)


@pytest.mark.parametrize("size,reach", [(32, 400), (5, 120), (40, 2000)])
def test_chains_are_ordered_hold_each_run_once_and_are_best(size, reach):
    for _ in range(150):
        found = [(RNG.randint(0, reach), RNG.randint(0, reach), size) for _ in range(RNG.randint(1, 25))]
        if RNG.random() < 0.5:  # some on few diagonals
            found = [(a, max(0, a + RNG.choice([0, 3, -40])), n) for a, _, n in found]
        chains = S.chains(found)
        assert sorted(a for c in chains for a in c) == S.runs_of(found)
        for chain in chains:
            assert all(p[0] + p[2] <= q[0] and p[1] + p[2] <= q[1] for p, q in zip(chain, chain[1:]))
            assert all(max(q[0] - p[0], q[1] - p[1]) - p[2] <= S.MAX_GAP for p, q in zip(chain, chain[1:]))
        if reach <= S.MAX_GAP:
            assert max(map(worth, chains)) == pytest.approx(best_worth(found))


def test_anchors_on_one_diagonal_are_a_run():
    assert S.chains([(10 * i, 10 * i + 5, 32) for i in range(20)]) == [[(0, 5, 222)]]
    # the nearest anchor before isn't the best one
    found = [(0, 0, 128), (130, 130, 128), (260, 260, 128), (300, 20, 128), (440, 160, 128)]
    assert S.chains(found) == [[(0, 0, 128), (130, 130, 128), (260, 260, 128)], [(300, 20, 128), (440, 160, 128)]]


def test_fenwick_tree():
    for shape in ((50,), (9, 7)):
        tree, plain = S.Fenwick(*shape), {}
        for _ in range(300):
            i, v = tuple(map(RNG.randrange, shape)), RNG.random()
            tree.add(i, (v, 1))
            plain[i] = max(plain.get(i, S.NO_ANCHOR), (v, 1))
            at = tuple(map(RNG.randrange, shape))
            assert tree.upto(at) == max([S.NO_ANCHOR, *(e for j, e in plain.items() if all(x <= y for x, y in zip(j, at)))])
    assert S.Fenwick(3).upto((-1,)) == S.NO_ANCHOR


def test_fuzzy_passages_and_shares(spark):
    common = text(900)
    changed = common[:400] + "달라진 부분" + common[410:]
    docs = [(1, text(100) + common + text(50)), (2, text(30) + changed + text(100)), (3, text(500)), (4, text(20) + common[:300]), (5, docs_copy := text(400)), (6, docs_copy)]
    df = frame(spark, docs)
    rows = {(r.doc_a, r.doc_b): r for r in S.passages(df).collect()}
    one = rows[1, 2]
    assert one.longest >= 400 and 0.95 < one.identity < 1.0 and one.end_a - one.start_a >= 880
    for s in one.spans:
        assert docs[0][1][s.start_a : s.start_a + s.size] == docs[1][1][s.start_b : s.start_b + s.size] and s.size >= 250
    shares = {r.rep: r for r in S.shared_shares(df).collect()}
    assert set(shares) == {1, 2, 4, 5} and shares[5].copies == 2 and shares[5].share == 1.0
    assert shares[1].links == 2 and shares[1].shared_chars >= 880 and 0.9 < shares[4].share <= 1.0


def test_a_hot_group_of_copies_collapses(spark):
    same = text(400)
    df = frame(spark, [(i, same) for i in range(300)] + [(1000, text(50) + same[:300])])
    assert S.seeds(df).select("doc").distinct().count() == 2
    assert [(r.doc_a, r.doc_b) for r in S.passages(df).select("doc_a", "doc_b").collect()] == [(0, 1000)]
    assert [(r.rep, r.copies, r.links) for r in S.shared_shares(df).orderBy("rep").collect()] == [(0, 300, 1), (1000, 1, 1)]


def test_a_passage_that_a_text_holds_twice_counts_twice(spark):
    passage = text(300)
    docs = [(1, text(40) + passage + text(90) + passage + text(40)), (2, text(60) + passage), (3, "라마바" * 200), (4, "x" + "라마바" * 150)]
    shares = {r.rep: r.shared_chars for r in S.shared_shares(frame(spark, docs)).collect()}
    assert 600 <= shares[1] <= 604 and 300 <= shares[2] <= 302 and shares[3] == 600 and shares[4] == 450


def covered(docs, least):
    """Characters of each document in spans that stand in a text of another class, and the other classes."""
    spans = {}
    for d, t in docs:
        for i in range(len(t) - least + 1):
            spans.setdefault(t[i : i + least], set()).add(d)
    out = {}
    for d, t in docs:
        held, others = set(), set()
        for i in range(len(t) - least + 1):
            if len(spans[t[i : i + least]]) > 1:
                held.update(range(i, i + least))
                others |= spans[t[i : i + least]] - {d}
        if held:
            out[d] = (len(held), len(others))
    return out


def shares(spark, docs, hot, least=60, k=32):
    return {r.rep: (r.shared_chars, r.links) for r in S.shared_shares(frame(spark, docs), least=least, k=k, hot=hot).collect()}


@pytest.mark.parametrize("hot", [2, 32])
def test_a_long_common_passage_counts_in_full(spark, hot):
    long, other = text(1000), text(200)
    docs = [(i, text(RNG.randint(0, 60)) + long[RNG.choice([0, 0, 150]) : RNG.choice([700, 1000, 1000])] + text(30) + (other if i % 3 else "")) for i in range(8)]
    assert shares(spark, docs, hot) == covered(docs, 60)
    whole = [(1, text(20) + "1" + long), (2, text(30) + "2" + long), (3, text(10) + "3" + long)]
    assert {r.longest for r in S.passages(frame(spark, whole), least=60, k=32, hot=hot).collect()} == {1000}


@pytest.mark.parametrize("hot", [2, 32])
def test_a_template_with_values_of_equal_length_counts_on_both_sides(spark, hot):
    before, after = text(150), text(170)
    docs = [(i, text(20) + before + f"010-{i:04d}-{i:04d}" + after + text(i)) for i in range(6)]
    assert shares(spark, docs, hot) == covered(docs, 60)


@pytest.mark.parametrize("hot", [2, 32])
def test_a_common_passage_counts_at_every_place(spark, hot):
    said, other = text(90), text(150)
    docs = [(i, text(40) + said + text(45) + said + text(30) + (other if i % 2 else "") + text(10) + said[: 60 + 5 * i]) for i in range(6)]
    docs += [(6, other + said + other + said + other), (7, "가나" * 60 + said + "가나" * 60 + said), (8, said + "가나" * 80), (9, said * 3), (10, said * 2 + text(9) + said * 3)]
    assert shares(spark, docs, hot) == covered(docs, 60)


@pytest.mark.parametrize("hot", [1, 3, 1000])
def test_links_of_groups_are_those_of_pairs(spark, hot):
    said, other, third = text(200), text(150), text(120)
    docs = [(i, text(20) + said[: 60 + 20 * (i % 7)] + text(15) + (other if i % 3 else third) + text(10)) for i in range(14)]
    docs += [(20, said[100:] + text(9)), (21, other[:90] + "끝" + third), (22, third[30:] + text(70)), (23, text(300))]
    docs += [(30 + i, text(80) + docs[i][1][-70:]) for i in range(5)]
    assert shares(spark, docs, hot) == covered(docs, 60)


def test_common_spans_make_rows_in_proportion_to_texts(spark):
    said = text(400)
    sizes = []
    for n in (50, 100, 200):
        df = frame(spark, [(i, text(30) + chr(0x4E00 + i) + said + chr(0x4E00 + i) + text(30)) for i in range(n)])
        seeds = S.shared_seeds(df)
        assert S.anchors(df, shared=seeds, with_hot=False).count() == 0
        sizes.append(S.common_runs(df, seeds).count())
    assert sizes == [50, 100, 200]


def test_empty_table(spark):
    assert S.sharing_pairs(frame(spark, [(1, None)]).limit(0)).count() == 0
    assert S.sharing_pairs(frame(spark, [(1, None), (2, "")])).count() == 0


def test_same_pairs_as_sql(spark, small):
    assert rows_of(queries.p9_found(spark, small)) == rows_of_sql(queries.ORACLES["p9_found"], small)
    assert rows_of(queries.p9_shares(spark, small)) == rows_of_sql(queries.ORACLES["p9_shares"], small)
