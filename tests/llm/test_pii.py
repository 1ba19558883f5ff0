import random
import re

import pytest

from verdigris.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def digits_of(text):
    return re.sub("[^0-9]", "", text)


def brute(text):
    """The contract's patterns as they stand."""
    checks = [
        (EMAIL, lambda s: True), (IP, lambda s: all(int(p) <= 255 for p in s.split("."))),
        (CARD, lambda s: 16 <= len(digits_of(s)) <= 19 and pii.luhn(digits_of(s))), (PHONE, lambda s: 8 <= len(digits_of(s)) <= 15),
    ]
    return [(kind, *m.span()) for kind, (pattern, fits) in enumerate(checks) for m in pattern.finditer(text) if fits(m.group())]


def test_base_spans_are_those_of_the_patterns():
    pick = random.Random(3)
    parts = ["a", "b.", "@", "@x", ".co", "1", "12", "255", "256", ".", "-", " ", "+", "(", ")", "4111 1111 1111 1111", "é", "%", "10.2.3.4", "+1 555", "\n"]
    for _ in range(20_000):
        text = "".join(pick.choice(parts) for _ in range(pick.randint(0, 14)))
        assert pii.base_spans(text) == brute(text), text


def test_luhn():
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112") and pii.luhn("79927398713")


def test_long_runs_are_quick():
    assert pii.base_spans("a" * 300_000 + "1" * 300_000 + "@") == [] and pii.base_spans("1." * 100_000 + "+" * 100_000) != []


@pytest.fixture
def private_rows():
    plain = [(1000 + i, f"Nothing to see in text number version 2.{i % 9} here.") for i in range(40)]
    found = [(1100 + i, f"write to user{i}@mail.example.com or call +1 (0{i + 10}) 555-77{i + 10} from 10.0.{i}.7") for i in range(40)]
    cards = [(1200 + i, f"card 4111 1111 1111 1111 and card 4111-1111-1111-11{i + 10}") for i in range(20)]
    loose = [(1300 + i, f"please call phone (415) 555-01{i + 10} today") for i in range(20)]
    return plain + found + cards + loose


def test_base_stays_and_added_spans_do_not_overlap(make_docs, private_rows, odd_rows):
    rows = private_rows + odd_rows
    texts = {row[0]: row[1] or "" for row in rows if row[0] is not None}
    for row in pii.find_personal_data(make_docs(rows, clashing=True)).collect():
        if row.doc_id is None:
            continue
        assert [(s.kind, s.start, s.end) for s in row.spans if s.base] == brute(texts[row.doc_id])
        base = [(s.start, s.end) for s in row.spans if s.base]
        for s in row.spans:
            assert s.base or all(s.end <= a or s.start >= b for a, b in base)
        if 1000 <= row.doc_id < 1040:
            assert not row.spans


def test_em_trusts_labelers_that_agree():
    counts = {"card:111:v": 400, "card:110:v": 20, "card:11-:v": 300, "card:000:x": 500, "card:00-:x": 300, "card:010:x": 20, "card:011:x": 5}
    likely = pii.estimate(counts)
    assert likely["card:111:v"] > 0.95 > 0.5 > 0.1 > likely["card:00-:x"]
    decided = pii.train_span_classifier(counts, likely)
    assert decided["card:111:v"] > 0.9 and decided["card:000:x"] < 0.2


def test_listing_and_redaction(make_docs):
    text = "é a@b.co x 10.0.0.1"
    row = pii.find_personal_data(make_docs([(1, text)])).select("spans", pii.listed(pii.F.col("spans")).alias("listed")).first()
    assert row.listed == "email:2:8,ip:11:19"
    assert pii.redact(text, [(s.kind, s.start, s.end) for s in row.spans]) == "é [email] x [ip]"


def test_empty_table(make_docs):
    assert pii.find_personal_data(make_docs([])).count() == 0
    assert pii.estimate({}) == {} and pii.train_span_classifier({}, {}) == {}


# Spans in << >>: phones and cards that the base loses because its match runs on into the next number.
PLANTED = (
    "un. <<+1 (843) 555-7672>> 170.106.47.218 x", "Des <<+1 (826) 555-4081>> 190.137.223.20 x", "call <<+1 (826) 555-4081>> 4711 22 33",
    "x <<4111 1111 1111 1111>> 4845168114407321 y", "x <<5500000000000004>> 190.137.223.20 y", "card 1999 <<4111 1111 1111 1111>> y",
    "x 77 <<4845168114407329>> 12345678 y",
)
# Numbers that look alike and are nobody's.
DECOYS = (
    "id 4183418637171908 x", "card 4111-1111-1111-1112 x", "row 555 123 4567 x", "see 12-34-56-78 x", "from 9777946427004852 14 x",
    "look [at] this.thing x", "part 10.20.30.999 x",
)


def added(docs):
    return {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans if not s.base] for r in pii.find_personal_data(docs).collect()}


@pytest.mark.parametrize("decoys", [1, 40])
def test_numbers_next_to_another_are_added_and_decoys_are_not(make_docs, decoys):
    usual = [f"u{i}@mail.example.com, +1 (2{i + 10}) 555-77{i + 10}, 4111 1111 1111 1111, 10.0.{i}.7" for i in range(40)]
    texts = [*usual, *PLANTED, *DECOYS * decoys]
    found = added(make_docs([(i, text.replace("<<", "").replace(">>", "")) for i, text in enumerate(texts)]))
    for i, text in enumerate(texts):
        plain = text.replace("<<", "").replace(">>", "")
        assert [plain[start:end] for _, start, end in found[i]] == re.findall("<<(.*?)>>", text), text
