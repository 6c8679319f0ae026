"""Personal information inside free text: found, and replaced by typed placeholders.

How strongly a term reveals a protected entity is estimated from the corpus, in bits:

1. Values known to be personal (per file from anonymization_info, everywhere from the registry) are the protected
   entities.
2. Candidates are spans of the shape of a name, date or number. Numbers of an unmistakable shape (phone, resident,
   passport and licence numbers, e-mail and street addresses) stand for themselves; names and dates don't. What is
   known for the text's file, or everywhere, is searched besides, whatever its shape: it needs no estimate.
3. For names and dates every context (the word before, the end of the own word with the word behind) is counted
   over all candidates, and over those that are protected in their file: their ratio is the information that the
   context gives about the entity, the pointwise mutual information. For names the syllables add theirs: how much
   more often a syllable stands in protected given names than in the corpus.
4. A candidate whose bits exceed the threshold of its kind discloses an entity and is generalised to a
   placeholder of its kind; the rest of the text stays as it is.

Contexts are counted and joined as tables; what goes to the executors is the syllable table, at most one row for
each of the 11,172 syllables, and the registry, which is one document. The known values of a file meet its texts in
arrays of about PART_VALUES; a file with more of them has several, and its texts are scanned with each.

Defined results: null and empty texts hold no mentions; a file delivered several times gives each mention once if
the texts are equal; null lists and null entries in the known values are skipped; without any known value contexts
say nothing, and only unmistakable shapes are found. A known name is found at the beginning of a word, in its own
writing or in capitals, spaces in it aside; of fewer than three syllables, or in another script, only as a whole word (particles aside).
A known number or date is found in any writing of its digits that isn't part of a longer number. Names of one
character, and numbers and dates of fewer than six digits, aren't looked for. Offsets are code points of the stored text. Of overlapping mentions the one with more certainty stays, then the longer one, and what overlaps only mentions that don't stay.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from math import log2

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..storage import written

# Family names, of two syllables and of one.
FAMILIES_2 = "남궁 황보 제갈 사공 선우 서문 독고 동방 어금 망절".split()
FAMILIES_1 = (
    "김 이 박 최 정 강 조 윤 장 임 한 오 서 신 권 황 안 송 류 유 홍 전 고 문 손 양 배 백 허 남 심 노 하 곽 성 차 주 우 구 "
    "민 진 나 지 엄 채 원 천 방 공 현 함 변 염 여 추 도 소 석 선 설 마 길 연 위 표 명 기 반 라 왕 금 옥 육 인 맹 제 모 탁 국 어 은 편 용 예 경 봉 사 부 가 복 태 목 형 피 두 감 호 음 빈 동 온 시"
).split()
# What may follow a name within its word.
TAILS = (
    "(?:고객님|선생님|님|씨)(?:이나|이|가|은|는|을|를|께서|께|한테|에게|도|의|만|이랑|랑)?|이라고요?|라고요?|입니다|이에요|이예요|예요|인데요|이고요|으로|로|한테|에게|께서|께|이랑|랑|이나|이|가|은|는|을|를|와|과|도|의|만|요"
)
# Placeholders by kind.
PLACEHOLDERS = {"name": "[이름]", "birthdate": "[생년월일]", "phone": "[전화번호]", "email": "[이메일]", "id_number": "[신분번호]", "address": "[주소]"}
# Words that end like a unit of an address and aren't one.
NO_UNITS = set(
    "다시 혹시 역시 잠시 임시 즉시 동시 당시 일시 필시 몹시 반드시 몇시 표시 지시 실시 제시 무시 게시 "
    "별도 정도 한도 온도 속도 제도 용도 빈도 지도 보도 각도 태도 그래도 아직도 "
    "친구 누구 가구 요구 연구 입구 출구 도구 화면 하면 되면 라면 이면 그러면 "
    "바로 새로 따로 서로 별로 주로 실제로 이로 그대로 위로 으로 이동 자동 행동 활동 운동 공동 변동 아동 "
    "정리 처리 수리 관리 빨리 우리 미리 거리 소리 자리 멀리 분리 금리 물리".split()
)

NAME_BITS, DATE_BITS = 3.0, 0.2
#: Bits of a name in Latin script, whose syllables say nothing; a context of this many bits less than none rules a date out.
LATIN_BITS, VETO_BITS = 6.0, -3.0
#: A candidate name of fewer bits from its syllables isn't looked at further.
SYLLABLE_BITS = -4.0
SYLLABLES = 11_172
#: Counts as so many occurrences of each syllable in given names, seen or not.
SMOOTHING = 0.005
#: More names than this are looked up by what they begin with.
FEW_NAMES = 100
#: Known values of a file that are searched at once.
PART_VALUES = 500

# One to one, so offsets stay: full-width signs, dashes, odd spaces.
_fold = {code: code - 0xFEE0 for code in range(0xFF01, 0xFF5F)} | dict.fromkeys(map(ord, "‐‑‒–—―−﹣－ー"), ord("-")) | dict.fromkeys([0xA0, 0x1680, *range(0x2000, 0x2010), 0x202F, 0x205F, 0x3000, 0xFEFF, 0x2060], ord(" "))

_email = re.compile(r"(?<![A-Za-z0-9._+-])[A-Za-z0-9][A-Za-z0-9._+-]*(?:\s{0,3}@\s{0,3}|\s{0,3}\(\s?at\s?\)\s{0,3}|\s{0,3}골뱅이\s{0,3})[A-Za-z0-9-]+(?:(?:\.|\s{0,3}(?:점|닷)\s{0,3})[A-Za-z]{2,})+", re.IGNORECASE)
_spoken = "[공영일이삼사오육륙칠팔구]"
_phone = re.compile(
    r"(?<![\d\w-])(?:\+\s?82[ .-]{0,3}(?:\(0\)[ .-]?)?\d{1,2}|\(0\d{1,2}\)|(?<![\d.,])0\d{1,2})(?:\s?[-.]\s?|\s{1,3})?\d{3,4}(?:\s?[-.]\s?|\s{1,3})?\d{4}(?![\d-])"
    rf"|(?<![가-힣])공(?:일[공일육륙칠팔구]|이|[삼사오육륙]{_spoken})에?\s{{0,3}}{_spoken}{{3,4}}에?\s{{0,3}}{_spoken}{{4}}(?!{_spoken})"
)
_resident = re.compile(r"(?<![\dA-Za-z-])\d{2}(?:0[1-9]|1[0-2])(?:0[1-9]|[12]\d|3[01])(?:\s?-\s?|\s{1,2})?[0-9]\d{6}(?![\d-])")
_passport = re.compile(r"(?<![A-Za-z0-9-])[A-Z](?:\d{8}|\d{3}[A-Z]\d{4})(?![\dA-Za-z-])")
_licence = re.compile(r"(?<![\dA-Za-z-])\d{2}\s?-\s?\d{2}\s?-\s?\d{6}\s?-\s?\d{2}(?![\d-])")
_birth = re.compile(
    r"(?<![\d.,/\w-])(?:(?:19|20)\d{2}\s?[./-]\s?\d{1,2}\s?[./-]\s?\d{1,2}|(?:(?:19|20)?\d{2})년\s{0,2}\d{1,2}월\s{0,2}\d{1,2}일(?:생)?|(?:19|20)\d{2}(?:0[1-9]|1[0-2])(?:0[1-9]|[12]\d|3[01])|\d{2}(?:0[1-9]|1[0-2])(?:0[1-9]|[12]\d|3[01]))(?![\d-])(?![./]\d)"
)
_place = r"(?<![가-힣])[가-힣]{1,7}"
_address = re.compile(
    rf"(?P<units>(?:{_place}(?:특별자치시|특별자치도|특별시|광역시|시|도)\s{{1,3}})?(?:{_place}(?:시|군|구)\s{{1,3}}){{0,2}}(?:{_place}(?:읍|면)\s{{1,3}})?)"
    rf"(?:(?P<road>{_place}(?:대로|로|길))\s{{1,3}}\d{{1,5}}(?:(?P<branch>번길)\s{{0,3}}\d{{1,5}})?(?P<part>-\d{{1,5}})?(?P<flat>,?\s{{1,3}}\d{{1,4}}동\s{{1,3}}\d{{1,5}}호)?(?=[\s,.?!]|$|로|으로|에|입니다|이에요|예요)"
    rf"|(?P<lot>{_place}(?:동|리|가))\s{{1,3}}(?:산\s?)?\d{{1,5}}(?:-\d{{1,5}})?\s{{0,3}}번지(?:,?\s{{1,3}}\d{{1,4}}동\s{{1,3}}\d{{1,5}}호)?(?:,?\s{{1,3}}(?:지하\s?)?\d{{1,3}}층)?)"
)
_family = "|".join(FAMILIES_2) + "|[" + "".join(FAMILIES_1) + "]"
_name = re.compile(rf"(?<![가-힣A-Za-z0-9])(?=(?P<all>(?P<fam>{_family})(?:(?P<a>[가-힣])(?P<b>[가-힣])|\s{{1,2}}(?P<c>[가-힣])(?P<d>[가-힣])|\s{{1,2}}(?P<e>[가-힣])\s{{1,2}}(?P<f>[가-힣])))(?:{TAILS})?(?![가-힣A-Za-z0-9]))")
_given = re.compile(r"(?<![가-힣A-Za-z0-9])(?P<all>(?P<a>[가-힣])(?P<b>[가-힣]))(?=\s{0,2}(?:님|씨)(?:이나|이|가|은|는|을|를|께서|께|한테|에게|도|의|만|이랑|랑)?(?![가-힣A-Za-z0-9]))")
_latin = re.compile(r"(?<![A-Za-z0-9@._+-])(?P<all>[A-Z][a-z]{1,20}\s{1,2}[A-Z][a-z]{1,20})(?![A-Za-z0-9@_+-])")


_alnum = re.compile(r"[^\W_]")
_syllables = re.compile("[가-힣]{3,}")
_behind = re.compile(rf"(?:{TAILS})?(?![가-힣A-Za-z0-9])")
_digit_run = re.compile(r"\d(?:[ \t().-]{0,3}\d){5,}")
_any_date = re.compile(r"(?<!\d)\d{2}(?:\d{2})?\s?[./년-]\s{0,2}\d{1,2}\s?[./월-]\s{0,2}\d{1,2}(?:일(?:생)?)?(?!\d)")


_foldable = re.compile("[" + "".join(map(re.escape, map(chr, _fold))) + "]")
#: Every address holds one of these.
_address_core = re.compile(r"(?:로|길)\s{1,3}\d|번지")


def fold(text: str) -> str:
    """The text with plain digits, signs, dashes and spaces, character by character."""
    return text.translate(_fold) if _foldable.search(text) else text


def digits_of(value: str) -> str:
    return re.sub(r"\D", "", fold(value))


def name_of(value: str) -> str:
    return re.sub(r"\s", "", fold(value))


def date_of(value: str) -> str:
    """Digits of a date with months and days of two digits and years of two, as values are written either way."""
    parts = re.findall(r"\d+", fold(value))
    if len(parts) == 3:
        return parts[0][-2:] + parts[1].zfill(2) + parts[2].zfill(2)
    return "".join(parts)[-6:]


def context(text: str, start: int, end: int) -> tuple[str, str]:
    """(the word before, in the same sentence; the end of the own word and the word behind)."""
    before = text[max(0, start - 40) : start]
    words = before.split()
    left = words[-1] if words and not re.search(r"[.?!\n]\s*$", before) else "^"
    behind = text[end : end + 40]
    own = re.match(r"[^\s.?!]{0,12}", behind)[0]
    then = re.match(r"[ \t]*([^\s.?!]{0,12})", behind[len(own) :])[1]
    return re.sub(r"\d", "0", left)[-12:], re.sub(r"\d", "0", f"{own} {then}")


class Syllables:
    """Bits of syllables of given names and of family names."""

    def __init__(self, given: dict[str, int], family: dict[str, int], corpus: dict[str, int]):
        total, names, families = sum(corpus.values()) + SYLLABLES, sum(given.values()), sum(family.values())
        usual = lambda s: (corpus.get(s[0], 0) + 1) / total
        self.given = {s: log2((given.get(s, 0) + SMOOTHING) / (names + SMOOTHING * SYLLABLES) / usual(s)) for s in {*given, *corpus}} if names else {}
        self.family = {s: max(-3.0, min(6.0, log2((n + 0.5) / (families + 50) / usual(s)))) for s, n in family.items()} if families else {}

    def bits(self, family: str, a: str, b: str) -> float:
        return self.given.get(a, 0.0) + self.given.get(b, 0.0) + (self.family.get(family, -3.0 if self.family else 0.0) if family else 0.0)


class Known:
    """Known values, normalised, looked up by what they begin with."""

    def __init__(self, values: Iterable[tuple[str, str]]):
        self.every: set[tuple[str, str]] = set(values)
        # the longest first, as they are and in capitals
        ordered = sorted((v for k, v in self.every if k == "name" and len(v) > 1), key=lambda v: (-len(v), v))
        self.names = list(dict.fromkeys(w for v in ordered for w in (v, v.upper())))
        self.by_front: dict[str, list[str]] = {}
        for name in self.names if len(self.names) > FEW_NAMES else ():
            self.by_front.setdefault(name[:2], []).append(name)
        self.phones = {v for k, v in self.every if k == "phone" and len(v) >= 6}
        self.dates = {v for k, v in self.every if k == "birthdate" and len(v) >= 6}
        self.sizes = sorted({len(v) for v in self.phones}, reverse=True)

    def __contains__(self, kind_value: tuple[str, str]) -> bool:
        kind, value = kind_value
        return kind_value in self.every or kind == "name" and ("given", value) in self.every

    def hits(self, plain: str) -> Iterator[tuple[str, int, int, str]]:
        """(kind, start, end, value) of the values that stand in a folded text; the longest name at each place."""
        if self.names:
            dense = "".join(plain.split())
            names = {n for f in {dense[i : i + 2] for i in range(len(dense) - 1)} & self.by_front.keys() for n in self.by_front[f]} if self.by_front else self.names
            there = sorted((n for n in names if n in dense), key=lambda n: (-len(n), n))
            places = [i for i, c in enumerate(plain) if not c.isspace()] if there else []
            found: set[int] = set()
            for name in there:
                at = dense.find(name)
                while at >= 0:
                    start, end = places[at], places[at + len(name) - 1] + 1
                    # at the beginning of a word; long names in any form of it
                    if start not in found and not _alnum.match(plain, max(0, start - 1), start) and (_behind.match(plain, end) or _syllables.fullmatch(name) and "가" <= plain[end : end + 1] <= "힣"):
                        found.add(start)
                        yield "name", start, end, name
                    at = dense.find(name, at + 1)
        if self.phones:
            for run in _digit_run.finditer(plain):
                digits = [i for i in range(run.start(), run.end()) if plain[i].isdigit()]
                text = "".join(plain[i] for i in digits)
                edge = [i == 0 or digits[i - 1] + 1 < digits[i] for i in range(len(digits))] + [True]
                for i in range(len(digits)):
                    size = next((n for n in self.sizes if edge[i] and i + n <= len(digits) and edge[i + n] and text[i : i + n] in self.phones), 0)
                    if size:
                        yield "phone", digits[i], digits[i + size - 1] + 1, text[i : i + size]
        if self.dates:
            for m in _any_date.finditer(plain):
                if date_of(m[0]) in self.dates:
                    yield "birthdate", *m.span(), date_of(m[0])


NOTHING = Known(())


def candidates(text: str, syllables: Syllables, known: Known = NOTHING, registry: Known = NOTHING) -> list[tuple[str, int, int, str, str, str, float, bool, bool]]:
    """(kind, start, end, value, left, right, bits, sure, protected) of a text."""
    plain = fold(text)
    out: list[tuple] = []
    taken: list[tuple[int, int]] = []
    placed: set[tuple[str, int, int]] = set()

    def add(kind: str, start: int, end: int, value: str, bits: float, sure: bool) -> None:
        left, right = context(plain, start, end)
        out.append((kind, start, end, value, left, right, bits, sure, (kind, value) in known or (kind, value) in registry))
        placed.add((kind, start, end))
        if sure:
            taken.append((start, end))

    for m in _email.finditer(plain):
        add("email", *m.span(), m[0].lower(), 0.0, True)
    for pattern in (_licence, _resident, _passport):
        for m in pattern.finditer(plain):
            add("id_number", *m.span(), digits_of(m[0]), 0.0, True)
    for m in _phone.finditer(plain):
        add("phone", *m.span(), digits_of(m[0]), 0.0, True)
    for m in _address.finditer(plain) if _address_core.search(plain) else ():
        units = [(u.start(), u[0]) for u in re.finditer(r"\S+", m["units"])]
        while units and units[0][1] in NO_UNITS:
            units.pop(0)
        named = m["road"] or m["lot"]
        if named in NO_UNITS or (m["road"] and not (units or m["part"] or m["branch"] or m["flat"])):
            continue
        start = m.start("units") + units[0][0] if units else m.start("road") if m["road"] else m.start("lot")
        add("address", start, m.end(), plain[start : m.end()], 0.0, True)
    free = lambda s, e: all(e <= a or s >= b for a, b in taken)
    for m in _birth.finditer(plain):
        if free(*m.span()):
            add("birthdate", *m.span(), date_of(m[0]), 0.0, m[0].endswith("생"))
    for pattern in (_name, _given):
        for m in pattern.finditer(plain):
            g = m.groupdict()
            a, b = next((g[x], g[y]) for x, y in (("a", "b"), ("c", "d"), ("e", "f")) if g.get(x))
            bits = syllables.bits(g.get("fam", ""), a, b)
            if bits >= SYLLABLE_BITS and free(m.start("all"), m.end("all")):
                add("name", m.start("all"), m.end("all"), name_of(m["all"]), bits, False)
    for m in _latin.finditer(plain):
        if free(*m.span("all")):
            add("name", *m.span("all"), name_of(m["all"]), LATIN_BITS, False)
    for values in (known, registry):
        for kind, start, end, value in values.hits(plain):
            if (kind, start, end) not in placed and free(start, end):
                left, right = context(plain, start, end)
                out.append((kind, start, end, value, left, right, 0.0, False, True))
                placed.add((kind, start, end))
    return out


def known_values(info: DataFrame, registry: DataFrame) -> DataFrame:
    """(general, file, kind, value) of the protected entities, normalised; general: known everywhere, the file is null.

    A full Korean name also protects its given name, as the kind `given`.
    """
    listed = info.select("file", F.explode(F.array(*(F.struct(F.lit(kind).alias("kind"), F.col(f"info.{kind}").alias("entries")) for kind in ("name", "birthdate", "phone")))).alias("i"))
    own = listed.select(F.lit(False).alias("general"), "file", "i.kind", F.explode("i.entries").alias("value"))
    everywhere = (F.lit(True).alias("general"), F.lit(None).cast("string").alias("file"))
    general = registry.select(*everywhere, F.lit("name").alias("kind"), F.explode("names").alias("value")).unionByName(registry.select(*everywhere, F.lit("phone").alias("kind"), F.explode("phone_numbers").alias("value")))

    def normalised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for general, file, kind, value in zip(*(c.to_pylist() for c in batch.columns)):
                if not value or not value.strip():
                    continue
                plain = {"name": name_of, "birthdate": date_of, "phone": digits_of}[kind](value)
                if plain:
                    rows.append((general, file, kind, plain))
                    if kind == "name" and re.fullmatch(r"[가-힣]{3,4}", plain):
                        rows.append((general, file, "given", plain[-2:]))
            columns = list(zip(*rows)) if rows else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, (pa.bool_(), *[pa.string()] * 3))], names=["general", "file", "kind", "value"])

    return own.unionByName(general).where(F.col("value").isNotNull()).mapInArrow(normalised, "general boolean, file string, kind string, value string").distinct()


def with_known(texts: DataFrame, known: DataFrame, text: str = "text") -> DataFrame:
    """(file, text, values): each text with the known values of its file, in as many rows as those have parts."""
    own = known.where(~F.col("general"))
    sizes = own.groupBy(F.col("file").alias("_f")).agg(F.ceil(F.count(F.lit(1)) / F.lit(PART_VALUES)).alias("_parts"))
    parts = own.join(sizes, F.col("file").eqNullSafe(F.col("_f"))).groupBy("_f", F.pmod(F.xxhash64("kind", "value"), "_parts").alias("_part")).agg(F.collect_list(F.struct("kind", "value")).alias("values"))
    whole = texts.where(F.length(text) > 0).select("file", F.col(text).alias("text"))
    return whole.join(parts, F.col("file").eqNullSafe(F.col("_f")), "left").select("file", "text", "values")


def syllable_table(texts: DataFrame, known: DataFrame, text: str = "text") -> Syllables:
    """The syllable model: counts over all texts and all protected names; at most 11,172 rows of each reach the driver."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: Counter = Counter()
            for t in batch.column(0).to_pylist():
                counts.update(t or "")
            rows = [(c, n) for c, n in counts.items() if "가" <= c <= "힣"]
            columns = list(zip(*rows)) if rows else [[], []]
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], type=pa.string()), pa.array(columns[1], type=pa.int64())], names=["s", "n"])

    corpus = {r.s: r.n for r in texts.select(text).mapInArrow(counted, "s string, n long").groupBy("s").agg(F.sum("n").alias("n")).collect()}
    full = known.where((F.col("kind") == "name") & F.col("value").rlike("^[가-힣]{3,4}$")).select("value").distinct()
    parts = full.select(F.explode(F.array(F.struct(F.lit("g").alias("k"), F.substring("value", -1, 1).alias("s")), F.struct(F.lit("g").alias("k"), F.substring("value", -2, 1).alias("s")), F.struct(F.lit("f").alias("k"), F.expr("substring(value, 1, length(value) - 2)").alias("s")))).alias("p"))
    rows = parts.select("p.*").where((F.col("k") == "g") | F.col("s").isin(*FAMILIES_1, *FAMILIES_2)).groupBy("k", "s").count().collect()
    return Syllables({r.s: r["count"] for r in rows if r.k == "g"}, {r.s: r["count"] for r in rows if r.k == "f"}, corpus)


def found_candidates(texts: DataFrame, known: DataFrame, text: str = "text") -> DataFrame:
    """All candidates of all texts with `protected`: the value is known for the file or everywhere."""
    context = texts.sparkSession.sparkContext
    shared = context.broadcast(syllable_table(texts, known, text))
    # the registry is one document, so what it holds fits wherever it was read
    everywhere = context.broadcast(Known((r.kind, r.value) for r in known.where("general").select("kind", "value").collect()))
    names = ["file", "kind", "start", "end", "value", "left", "right", "bits", "sure", "protected"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for f, t, values in zip(*(c.to_pylist() for c in batch.columns)):
                rows += [(f, *c) for c in candidates(t, shared.value, Known((v["kind"], v["value"]) for v in values or ()), everywhere.value)]
            columns = list(zip(*rows)) if rows else [[]] * 10
            kinds = (pa.string(), pa.string(), pa.int32(), pa.int32(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.bool_(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(columns, kinds)], names=names)

    found = with_known(texts, known, text).mapInArrow(scan, "file string, kind string, start int, end int, value string, left string, right string, bits double, sure boolean, protected boolean")
    # texts of a file, and the parts of its known values, may give a place several times
    rest = F.max(F.struct("protected", "sure", "value", "left", "right", "bits")).alias("m")
    return found.groupBy("file", "kind", "start", "end").agg(rest).select("file", "kind", "start", "end", *(f"m.{c}" for c in names[4:]))


def _ambiguous(kind: Column) -> Column:
    return kind.isin("name", "birthdate")


def context_bits(found: DataFrame, side: str) -> DataFrame:
    """(kind, side, n, n_protected, bits): the information of each context about the entities of a kind."""
    counts = found.where(_ambiguous(F.col("kind"))).groupBy("kind", side).agg(F.count(F.lit(1)).alias("n"), F.count_if("protected").alias("n_protected"))
    sums = counts.groupBy("kind").agg(F.sum("n").alias("_n"), F.sum("n_protected").alias("_p"))
    rate = F.col("_p") / F.col("_n")
    ratio = (F.col("n_protected") + 0.5 * rate) / (F.col("n") + 0.5) / rate
    return counts.join(sums, "kind").select("kind", side, "n", "n_protected", F.when(F.col("_p") > 0, F.log2(ratio)).otherwise(F.lit(0.0)).alias("bits"))


def scored(found: DataFrame) -> DataFrame:
    """The candidates with `disclosure`, the sum of their bits."""
    out = found
    for side in ("left", "right"):
        bits = context_bits(found, side).select(F.col("kind").alias("_k"), F.col(side).alias("_s"), F.least(F.greatest("bits", F.lit(-6.0)), F.lit(8.0)).alias(f"{side}_bits"))
        out = out.join(bits, (F.col("kind") == F.col("_k")) & (F.col(side) == F.col("_s")), "left").drop("_k", "_s")
    total = F.col("bits") + F.coalesce("left_bits", F.lit(0.0)) + F.coalesce("right_bits", F.lit(0.0))
    # of a date either context may tell what it is, unless the other one says that it's something else
    least, most = F.least("left_bits", "right_bits"), F.greatest("left_bits", "right_bits")
    return out.withColumn("disclosure", F.when(F.col("kind") == "birthdate", F.when(least <= VETO_BITS, least).otherwise(most)).otherwise(total))


def disclosed(rows: DataFrame) -> DataFrame:
    """Those that exceed the threshold of their kind, without overlaps."""
    least = F.when(F.col("kind") == "name", NAME_BITS).otherwise(DATE_BITS)
    over = rows.where(F.col("sure") | F.col("protected") | (F.col("disclosure") >= least))
    # by rank: the more certain, the longer, the one that discloses more
    row = F.struct((~F.col("sure")).alias("unsure"), (F.col("start") - F.col("end")).alias("less"), (-F.coalesce("disclosure", F.lit(0.0))).alias("hides"), "kind", "start", "end", "disclosure", "protected")
    # mentions of a text that overlap in a chain form a group, of which each by rank stays that overlaps none before it
    order = Window.partitionBy("file").orderBy("start", "end", "kind")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    group = F.sum(F.when(F.col("start") < reach, 0).otherwise(1)).over(order.rowsBetween(Window.unboundedPreceding, 0))
    groups = over.withColumn("_group", group).groupBy("file", "_group").agg(F.sort_array(F.collect_list(row)).alias("_rows"))
    apart = lambda kept, r: ~F.exists(kept, lambda k: (k["start"] < r["end"]) & (r["start"] < k["end"]))
    kept = F.aggregate("_rows", F.slice("_rows", 1, 1), lambda kept, r: F.when(apart(kept, r), F.concat(kept, F.array(r))).otherwise(kept))
    return groups.select("file", F.explode(kept).alias("m")).select("file", "m.kind", F.col("m.start").cast("long").alias("start_pos"), F.col("m.end").cast("long").alias("end_pos"), "m.disclosure", "m.protected", F.when(F.col("m.unsure"), F.when(F.col("m.protected"), "known").otherwise("information")).otherwise("shape").alias("route"))


def mentions(texts: DataFrame, info: DataFrame, registry: DataFrame, text: str = "text") -> DataFrame:
    """(file, kind, start_pos, end_pos, disclosure, protected, route): every mention in the texts.

    route: what it was found by: an unmistakable `shape`, a `known` value, or the `information` of its context and syllables.
    """
    # counted on both sides and scored: written once instead of scanning the texts for each
    return disclosed(scored(written(found_candidates(texts, known_values(info, registry), text))))


def sanitised(texts: DataFrame, found: DataFrame, text: str = "text") -> DataFrame:
    """(file, text): the texts with each mention replaced by the placeholder of its kind, everything else unchanged."""
    placeholder = F.create_map(*(F.lit(x) for pair in PLACEHOLDERS.items() for x in pair))
    spans = found.groupBy("file").agg(F.sort_array(F.collect_list(F.struct("start_pos", "end_pos", placeholder[F.col("kind")].alias("put")))).alias("_spans"))
    whole = texts.select("file", F.col(text).alias("_text")).distinct().join(spans.withColumnRenamed("file", "_file"), F.col("file").eqNullSafe(F.col("_file")), "left")
    # piece i is what stands between mention i-1 and mention i, then the placeholder
    pieces = F.transform(
        "_spans",
        lambda s, i: F.concat(F.substring(F.col("_text"), F.when(i > 0, F.col("_spans")[i - 1]["end_pos"]).otherwise(F.lit(0)).cast("int") + 1, (s["start_pos"] - F.when(i > 0, F.col("_spans")[i - 1]["end_pos"]).otherwise(F.lit(0))).cast("int")), s["put"]),
    )
    rest = F.substring(F.col("_text"), F.element_at("_spans", -1)["end_pos"].cast("int") + 1, F.length("_text"))
    return whole.select("file", F.when(F.col("_spans").isNull(), F.col("_text")).otherwise(F.concat(F.array_join(pieces, ""), rest)).alias("text"))
