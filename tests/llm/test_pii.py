from __future__ import annotations

import random
import re

import pytest

from tollgate.llm import pii
from tollgate.llm.catalog import QUERIES

SF = "/root/testdata/sf0.001"
KEY = b"test key"


def replaced(documents, texts: list, key: bytes = KEY) -> list:
    rows = pii.replace(documents(list(enumerate(texts))), key, count="n").collect()
    return [r["text"] for r in sorted(rows, key=lambda r: r["doc_id"])]


@pytest.mark.parametrize(("kind", "text"), [
    ("email", "to Ann.Lee+x@mail.some-host.org, please"), ("email", "é.12@mail2.example.com"), ("phone", "call +1 (499) 555-6503 now"),
    ("phone", "(212) 555-0100"), ("phone", "212-555-0100"), ("phone", "+49 30 1234 5678"), ("card", "card 4111 1111 1111 1111 x"),
    ("card", "4845168114407329"), ("ssn", "078-05-1120"), ("ipv4", "host 192.168.10.255."), ("ipv6", "2001:db8:0:0:1:2:3:ff"),
    ("iban", "DE89 3704 0044 0532 0130 00"), ("name", "Dear Mrs. Jane Doe,"), ("name", "господин Иванов"), ("name", "Herr Müller kam"),
    ("name", "王小明先生"),
])
def test_found_and_replaced(kind, text, documents):
    spans = pii.find(text)
    assert [s.kind for s in spans] == [kind]
    new = replaced(documents, [text])[0]
    assert new[: spans[0].start] == text[: spans[0].start] and new != text
    again = pii.find(new)
    assert [s.kind for s in again] == [kind]
    if kind not in ("name", "email"):
        assert re.sub(r"\w", "0", new) == re.sub(r"\w", "0", text) or kind in ("ipv4", "ipv6")


@pytest.mark.parametrize("text", ["no personal data", "", "1.2.3", "v1.2.3.4.5", "999.1.1.1", "12345", "a@b", "Mr", "Drum Solo", "2024-01-02 10:11:12", "1,234,567.89"])
def test_clean_texts_stay(text, documents):
    assert pii.find(text) == [] and replaced(documents, [text]) == [text]


@pytest.mark.parametrize("n", [1, 2, 3, 4])
def test_permutation(n):
    words = [f"{i:0{n}d}" for i in range(10**n)]
    images = [pii.permute(w, pii.DIGITS, KEY, "t") for w in words]
    assert sorted(images) == words and all(a != b for a, b in zip(words, images, strict=True))


def test_check_digits(documents):
    new = replaced(documents, ["4111 1111 1111 1111", "4111111111111112", "DE89370400440532013000"])
    assert pii.luhn(new[0].replace(" ", "")[:-1]) == int(new[0][-1])
    assert (int(new[1][-1]) - pii.luhn(new[1][:-1])) % 10 == 1
    assert pii.mod97(new[2]) == 1 and new[2].startswith("DE")


def test_coreference_and_distinctness(documents):
    texts = ["Mrs. Jane Doe met Mr. Doe.", "Mr. DOE and Mrs. Jane Doe", "ann@x.org ANN@X.ORG bob@x.org", "+1 212 555 0100 or (212) 555-0100"]
    first, second, mails, phones = replaced(documents, texts)
    doe = first.split()[-1].rstrip(".")
    assert first.split()[2] == doe and second.split()[1] == doe.upper() and second.split()[-1] == doe
    assert first.split()[1].endswith("a")  # a woman's name
    a, b, c = mails.split()
    assert a.upper() == b and a != c and a.split("@")[1] == c.split("@")[1]
    assert re.sub(r"\D", "", phones.split(" or ")[0])[1:] == re.sub(r"\D", "", phones.split(" or ")[1])
    assert replaced(documents, texts) == [first, second, mails, phones]
    assert replaced(documents, texts, b"other")[0] != first


def test_many_names_stay_distinct(documents):
    names = [f"Family{chr(97 + i // 26 % 26)}{chr(97 + i % 26)}{'x' * (i // 676)}" for i in range(2000)]
    new = [t.split()[1] for t in replaced(documents, [f"Mr. {n}" for n in names])]
    assert len(set(new)) == 2000 and not {n.lower() for n in new} & {n.lower() for n in names}


def test_numbers_stay_distinct(documents):
    rng = random.Random(1)
    texts = sorted({f"10.0.{rng.randint(0, 255)}.{rng.randint(0, 255)}" for _ in range(3000)})
    assert len(set(replaced(documents, texts))) == len(texts)


def test_query(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = QUERIES["op7_pii_surrogates"](spark, SF).collect()
    assert len(got) == len(docs)
    for r in got:
        spans = pii.find(docs[r["doc_id"]])
        assert r["n_entities"] == len(spans)
        if not spans:
            assert r["text"] == docs[r["doc_id"]]
        assert not any(s.text in r["text"] for s in spans if len(s.text) > 8)


def test_odd_rows(clashing, documents):
    got = pii.replace(clashing, KEY)
    assert got.columns == clashing.columns
    key = lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["text"] or "")
    assert [r["text"] for r in sorted(got.collect(), key=key)] == [r["text"] for r in sorted(clashing.collect(), key=key)]
    twice = documents([(1, "a@b.org"), (1, "a@b.org"), (None, "a@b.org"), (None, None)])
    texts = [r["text"] for r in pii.replace(twice, KEY).collect()]
    assert texts.count(None) == 1 and len(set(texts)) == 2 and len(texts) == 4
    assert pii.replace(documents([]), KEY).count() == 0


@pytest.mark.parametrize(("kind", "text"), [
    ("phone", "اتصل +٩٧١ ٥٠ ١٢٣ ٤٥٦٧ الآن"), ("phone", "+٩٧١ ٥٠ ١٢٣ ٤٥٦٧ in 2023"), ("phone", "２１２-５５５-０１００"), ("ssn", "०७८-०५-११२०"),
    ("card", "４１１１ １１１１ １１１１ １１１１"), ("card", "4111 1111 ١١١١ ١١١١"), ("ipv4", "١٩٢.١٦٨.١٠.٢٥٥"), ("iban", "DE٨٩ 3704 0044 0532 0130 00"),
    ("email", "ann٤٢b@x٧.org"), ("ipv6", "٢٠٠١:db8:0:0:1:2:3:ff"), ("ssn", "𝟎𝟕𝟖-𝟎𝟓-𝟏𝟏𝟐𝟎"),
])
def test_digits_of_all_scripts(kind, text, documents):
    span = pii.find(text)[0]
    assert [s.kind for s in pii.find(text)] == [kind]
    plain = text.translate(pii.TO_ASCII)
    new, ascii_new, _ = replaced(documents, [text, plain, "no digits"])
    assert new.translate(pii.TO_ASCII) == ascii_new != plain and span.text not in new
    if kind not in ("ipv4", "ipv6"):
        zero = lambda t: [chr(ord(c) - int(c)) for c in t if c.isdecimal()]
        assert zero(new) == zero(text)
    assert kind == "ipv6" or not set("0123456789") & set(new) or set("0123456789") & set(text)


def test_net_has_all_digits():
    digits = {chr(c) for c in range(0x110000) if re.fullmatch(r"\d", chr(c))}
    assert digits == {chr(c) for c in pii.ASCII} and {c for c in digits if re.search(re.sub(r"\\x\{(\w+)\}", lambda m: chr(int(m[1], 16)), pii.MAYBE), c)} == digits
