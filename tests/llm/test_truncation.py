import random

import numpy as np
import pytest

from callweave.llm import queries
from callweave.llm import truncation as T

ENDS = ["알겠습니다.", "감사합니다!", "수고하세요", "들어가세요", "아니요 없어요", "기다릴게요..."]
VERBS = ["확인했습니다.", "신청하셨어요?", "발급할게요.", "정리하더라고요", "보류해주세요."]
WORDS = ["상담원이", "고객님의", "주문을", "배송지로", "요금때문에", "어제", "다시", "새", "영수증부터", "결제하면서", "문의하느라"]


def corpus(n=1500, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lines = [" ".join([*rng.choices(WORDS, k=rng.randint(2, 6)), rng.choice(VERBS)]) for _ in range(int(np.exp(rng.gauss(2.2, 0.7))) + 1)]
        text = "\n".join(lines) + "\n" + rng.choice(ENDS)
        source = rng.choice(["fixed", "bytes", "stream", "whole", None])
        cut = text
        if source == "fixed":
            cut = text[:250]
        elif source == "bytes":
            cut = text.encode()[:700].decode("utf-8", "replace")
        elif source == "stream" and rng.random() < 0.1:
            cut = text[: rng.randint(30, len(text) - 1)]
        rows.append((i, source, cut, cut != text))
    return rows


def test_cut_texts_are_found(spark):
    rows = corpus()
    df = spark.createDataFrame([(i, s, t, 0.5) for i, s, t, _ in rows], "anon_id long, source string, text string, probability double")
    got = {r.anon_id: r for r in T.truncation(df).collect()}
    assert len(got) == len(rows)
    wrong = [(i, t[-20:]) for i, s, t, cut in rows if got[i].truncated != cut]
    # a cut that happens to fall behind a finished sentence leaves a complete text
    assert all(any(t.rstrip().endswith(v.rstrip(".?")) or t.rstrip().endswith(v) for v in VERBS + ENDS) for i, t in wrong) and len(wrong) < 0.02 * len(rows)
    limits = {(r.source, r.unit, r.limit) for r in T.source_limits(T.measured(df).where("chars is not null")).collect()}
    assert ("fixed", "chars", 250) in limits and any(s == "bytes" and u == "bytes" and 698 <= c <= 702 for s, u, c in limits)
    assert not any(s == "whole" for s, _, _ in limits)
    rates = {r.source: r.rate for r in T.rates(T.truncation(df)).collect()}
    assert rates["whole"] == 0 and rates[None] == 0 and rates["fixed"] > 0.3


def test_the_length_decides_where_the_ending_says_nothing(spark):
    rare = ["쿼크", "뷁", "zyx", "튜플"]
    rows = corpus()
    body = "\n".join(["상담원이 주문을 확인했습니다."] * 40)
    rows += [(10_000 + i, "fixed", body[: 249 - len(w)] + " " + w, True) for i, w in enumerate(rare[:2])]
    rows += [(20_000 + i, "whole", body[: 17 * (7 + i)] + w, False) for i, w in enumerate(rare[2:])]
    got = {r.anon_id: r for r in T.truncation(spark.createDataFrame([(i, s, t) for i, s, t, _ in rows], "anon_id long, source string, text string")).collect()}
    assert {got[i].ending for i, *_ in rows[-4:]} == {"unfinished"}
    assert [got[i].truncated for i, *_ in rows[-4:]] == [True, True, False, False]
    assert all(got[i].length_posterior > 0.9 for i, *_ in rows[-4:-2])


def test_a_limit_changes_verdicts_both_ways(spark):
    rows = corpus()
    said = [f"{a}{b}" for a, b in zip("갑을병정무기경신임계자축", "촉뷁쿼튜햏샵뤼쮸븐퓨뮤휵")]
    body = "\n".join(["상담원이 주문을 확인했습니다."] * 40)
    for n, word in enumerate(said):  # stands inside sentences, ever more often
        rows.append((30_000 + n, "whole", "\n".join([f"저는 {word} 주문을 확인했습니다."] * 2**n), False))
    rows += [(50_000 + n, source, body[: 17 * (2 + n)] + word, None) for n, word in enumerate(said) for source in ("fixed", "whole")]
    at_limit = [(60_000 + n, "fixed", body[: 249 - len(w)] + " " + w, None) for n, w in enumerate(said)]
    found = T.truncation(spark.createDataFrame([(i, s, t) for i, s, t, _ in rows + at_limit], "anon_id long, source string, text string"))
    got = {(r.anon_id, r.source): r for r in found.where("anon_id >= 50000").collect()}
    verdicts = [(got[50_000 + n, "fixed"].truncated, got[50_000 + n, "whole"].truncated, got[60_000 + n, "fixed"].truncated) for n in range(len(said))]
    assert (False, True, True) in verdicts and (False, False, True) in verdicts, verdicts
    counts = {r.source: r for r in T.evidence(found).collect()}
    assert counts["fixed"].added_by_length > 0 and counts["fixed"].cleared_by_length > 0 and counts["whole"].length_only == 0


def test_fit_recovers_a_censored_distribution():
    rng = np.random.default_rng(2)
    true = np.exp(rng.normal(6.0, 0.7, 20_000)).astype(int) + 1
    values, counts = np.unique(np.minimum(true, 500), return_counts=True)
    assert list(T.candidate_limits(values, counts)) == [500]
    mu, sigma, share = T.fit_censored(values, counts, T.candidate_limits(values, counts))
    assert abs(mu - 6.0) < 0.05 and abs(sigma - 0.7) < 0.05 and share[500] > 0.95


def test_no_limits_in_smooth_lengths():
    rng = np.random.default_rng(3)
    values, counts = np.unique(np.exp(rng.normal(6.0, 0.7, 20_000)).astype(int) + 1, return_counts=True)
    assert T.candidate_limits(values, counts) == {}


@pytest.mark.parametrize("text,word,mark", [("네 감사합니다~", "감사합니다", ""), ("끝났어요 ...", "끝났어요", ""), ("요청되나요.\n>", "", "broken"), ("입니다.�", "입니다", "broken"), ("�", "", "broken"), ("확인했...", "확인했", "")])
def test_last_words(text, word, mark):
    assert T.last_word(text) == (word, mark)


def test_edges(spark):
    schema = "anon_id long, source string, text string"
    assert T.truncation(spark.createDataFrame([], schema)).count() == 0
    rows = [(1, None, None), (2, "a", ""), (3, "a", " \n"), (4, "a", "x" * 300_000), (4, "a", "x" * 300_000)]
    got = sorted((r.anon_id, r.truncated) for r in T.truncation(spark.createDataFrame(rows, schema)).collect())
    assert got[:3] == [(1, False), (2, False), (3, False)] and len(got) == 5


def test_query(spark, small):
    assert set(queries.p2_found(spark, small).columns) == {"anon_id", "source"}
