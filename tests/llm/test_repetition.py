import random
import re

from callweave.llm import queries
from callweave.llm import repetition as R

from ..compare import rows_of, rows_of_sql


def share(text, n=12):
    s = re.sub(r"[\W_]+", "", text.lower())
    seen, cover = set(), [0] * len(s)
    for i in range(len(s) - n + 1):
        if s[i : i + n] in seen:
            cover[i : i + n] = [1] * n
        seen.add(s[i : i + n])
    return sum(cover) / len(s) if s else 0.0


def test_span_share_like_a_plain_count():
    rng = random.Random(1)
    for _ in range(300):
        text = "".join(rng.choice("가나다 ab.\n") for _ in range(rng.randint(0, 400)))
        if rng.random() < 0.6:
            part = text[: rng.randint(0, 80)]
            text = text + part * rng.randint(1, 4)
        assert abs(R.span_share(text) - share(text)) < 1e-12
    for text in ("", "!!!", "가" * 12, "가" * 13, "가" * 24, "AbCdEfGhIjKl abcdefghijkl"):
        assert abs(R.span_share(text) - share(text)) < 1e-12


def test_colliding_hashes_are_seen_through(monkeypatch):
    import numpy as np

    monkeypatch.setattr(R, "window_hashes", lambda codes, n: np.zeros(len(codes) - n + 1, dtype=np.uint64))
    text = "가나다라마바사아자차카타파하" * 2 + "거너더러"
    assert abs(R.span_share(text) - share(text)) < 1e-12


def test_long_loop_is_fast():
    assert R.span_share("여보세요" * 200_000) > 0.99


def test_ledger_policies_and_ablation(spark):
    loop = "같은 말을 계속 반복합니다 정말로요.\n" * 8
    rows = [("loop", loop), ("loop", loop), ("fine", "서로 다른 말이 이어집니다. 다음 문장은 또 다릅니다."), ("null", None), ("empty", ""), ("marks", "?!")]
    df = spark.createDataFrame([(f, t, "x", 1) for f, t in rows], "file string, text string, measures string, failed int")
    ledger = R.ledger(df)
    got = {r.file: r for r in ledger.collect()}
    assert ledger.count() == 6 and got["null"].measures is None and got["null"].failed == 0
    assert got["empty"].measures == [0.0] * 7 and got["marks"].measures[0] == 0.0
    assert got["loop"].failed & 1 and not got["fine"].failed
    assert sorted(r.file for r in R.apply_policy(ledger, R.POLICIES[0]).distinct().collect()) == ["loop"]
    table = {(r.policy, r.version, r.rule): r for r in R.ablation(ledger).collect()}
    only = table["span_only", 1, "span"]
    assert (only.rows, only.failing, only.by_rule, only.only_by_rule) == (6, 2, 2, 2)
    assert table["broad", 1, "span"].only_by_rule == 0 and table["broad", 1, "line"].by_rule == 2
    strict = R.Policy("strict", 3, ("line",), {"line": 0.99})
    assert R.apply_policy(ledger, strict).count() == 0


def test_same_files_as_sql(spark, small):
    assert rows_of(queries.p1_found(spark, small)) == rows_of_sql(queries.ORACLES["p1_found"], small)


def test_empty_table(spark):
    ledger = R.ledger(spark.createDataFrame([], "file string, text string"))
    assert ledger.count() == 0 and R.ablation(ledger).count() == 0
