"""Operator 4: the field's precision and recall on sentences that its generator did not
make, and every column of the query against the four patterns."""

import hashlib
import re
from collections import Counter

import pyarrow as pa
import pytest

import brute
from hirelake.llm import pii

# sentences written by hand, and what the field and the rules should find in them
SENTENCES = [
    ("You can reach Anna under (212) 555-0187 after six.", [("phone", "(212) 555-0187")]),
    ("our office, 030-445-9921, is closed", [("phone", "030-445-9921")]),
    ("write me: jo.smith(at)mail.example.org please", [("email", "jo.smith(at)mail.example.org")]),
    ("billed to 4539.1488.0343.6467 last week", [("card", "4539.1488.0343.6467")]),
    ("Visa 4556.7375.8689.9855 on file", [("card", "4556.7375.8689.9855")]),
    ("tracking 1234.5678.9012.3456 was lost", []),
    ("the parcel number is 9999.8888.7777.6666 today", []),
    ("Invoice 20230418 lists 14 items at 12.50 each", []),
    ("kernel 5.15.0.91 boots fine", [("ip", "5.15.0.91")]),
    ("released on 2021-03-04, version 2.4.1", []),
    ("Call 555-867-5309 and ask for Jenny", [("phone", "555-867-5309")]),
    ("meet me at 10:30 in room 4021 of block 77", []),
    ("ISBN 978-3-16-148410-0 is out of print", []),
    ("kontakt: heike[at]firma.de oder fax", [("email", "heike[at]firma.de")]),
    ("The 1999 and 2004 editions differ on pages 12 to 48.", []),
    ("sha 9f86d081884c7d659a2feaa0c55ad015 matches", []),
    ("phone (415)555-2671, ext 12", [("phone", "(415)555-2671")]),
    ("population 1 234 567 in 2010 census", []),
]
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


@pytest.fixture(scope="module")
def field(spark):
    return pii.train(pii.labelled_table(spark))


def _luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (2 if i % 2 else 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def _base(text):
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    found = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    found += [(m.start(), 1, m.end()) for m in IP.finditer(text)
              if all(int(p) <= 255 for p in m.group().split("."))]
    found += [(m.start(), 2, m.end()) for m in CARD.finditer(text)
              if 12 <= len(digits(m)) <= 19 and _luhn(digits(m))]
    found += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 9 <= len(digits(m)) <= 15]
    return sorted(found)


def test_precision_and_recall(field):
    hit, wrong, missed = Counter(), Counter(), Counter()
    out = pii.find_spans(field, pa.array([s for s, _ in SENTENCES]))
    for (text, want), (_, spans) in zip(SENTENCES, out):
        got = {(pii.KINDS[k], text[a:b]) for a, k, b in spans}
        for kind, _ in got & set(want):
            hit[kind] += 1
        for kind, _ in got - set(want):
            wrong[kind] += 1
        for kind, _ in set(want) - got:
            missed[kind] += 1
    assert not wrong
    assert not missed["email"] and not missed["card"] and not missed["ip"]
    assert hit["phone"] >= 2 and sum(hit.values()) >= 7


def test_labelled_cards_pass_luhn():
    for text, spans in pii.labelled_examples():
        for span in filter(None, spans.split(",")):
            kind, a, b = span.split(":")
            if kind == "card":
                assert _luhn(re.sub("[^0-9]", "", text[int(a):int(b)]))


def test_every_column_of_the_query(spark, field):
    texts = {r.doc_id: r.text or "" for r in
             spark.read.parquet(f"{brute.SMALL}/documents.parquet").collect()}
    for r in pii.run(spark, brute.SMALL).collect():
        base = _base(texts[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [
            sum(k == kind for _, k, _ in base) for kind in range(4)]
        joined = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in base)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        spans = [s.split(":") for s in r.spans.split(",") if s]
        assert set(filter(None, joined.split(","))) <= set(r.spans.split(","))
        for kind, a, b in spans:             # no added card that fails
            if kind == "card":
                assert _luhn(re.sub("[^0-9]", "", texts[r.doc_id][int(a):int(b)]))


def test_parts_of_a_batch_give_the_same_spans(field, monkeypatch):
    texts = pa.array([t for _, t in brute.TEXTS])
    whole = list(pii.find_spans(field, texts))
    monkeypatch.setattr(pii, "PART", 50)
    assert list(pii.find_spans(field, texts)) == whole
