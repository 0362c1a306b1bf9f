"""Personal data: base spans against the contract's patterns run plainly, added spans, odd texts."""

import hashlib
import random
import re
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from contentspark.llm import pii as op

EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
IP = r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
CARD = r"[0-9]([\x20-]?[0-9])+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"


def plain(text):
    digits = lambda s: re.sub("[^0-9]", "", s)

    def luhn(s):
        d = [int(c) for c in s[::-1]]
        return (sum(d[::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])) % 10 == 0

    checks = [("email", EMAIL, lambda s: True), ("ip", IP, lambda s: all(int(p) <= 255 for p in s.split("."))),
              ("card", CARD, lambda s: 13 <= len(digits(s)) <= 19 and luhn(digits(s))),
              ("phone", PHONE, lambda s: 9 <= len(digits(s)) <= 15)]
    return {k: [m.span() for m in re.finditer(p, text) if ok(m.group())] for k, p, ok in checks}


@given(st.text(alphabet="0123456789@.+-() ab%_é", max_size=80))
@settings(max_examples=1500, deadline=None)
def test_base_spans_equal_the_plain_patterns(text):
    assert op.base_spans(text) == plain(text)


def test_base_spans_in_sentences():
    rng = random.Random(2)
    parts = ["a.b@c.de", "x@y", "@q.r", "1.2.3.4", "256.1.1.1", "1.2.3.4.5.6.7.8", "4111 1111 1111 1111", "4111111111111112",
             "+1 (988) 555-2485", "+49 30 1234567.", "0001.002.3.4", "a@b.c@d.e", " ", "\n", "é", "5", "-", "4242-4242-4242-4242"]
    for _ in range(800):
        text = rng.choice(["", " "]).join(rng.choice(parts) for _ in range(rng.randrange(1, 9)))
        assert op.base_spans(text) == plain(text)


@pytest.mark.parametrize("text, want", [
    ("iban DE89 3704 0044 0532 0130 00 ok", [("iban", 5, 32)]),
    ("DE89370400440532013000", [("iban", 0, 22)]),
    ("DE88370400440532013000", []),
    ("SSN: 078-05-1120", [("ssn", 5, 16)]),
    ("order 078-05-1120", []),
    ("call (030) 555 1234 now", [("phone", 5, 19)]),
    ("+1 (269) 555-3296 4111111111111111", [("card", 18, 34), ("phone", 0, 17)]),
])
def test_added_spans(text, want):
    assert [(k, a, b) for k, a, b, _ in op.find(text)[1]] == want


def test_context_raises_the_score():
    plain_, near = op.find("number 10.0.0.1")[1][0][3], op.find("server 10.0.0.1")[1][0][3]
    assert near > plain_


@pytest.mark.parametrize("text", ["a" * 200_000, "1" * 200_000, "1." * 100_000, "+1" + " " * 200_000, "a@" * 100_000, "1 " * 100_000,
                                  "+1-" * 60_000, "AA11" * 50_000, "%" * 100_000 + "@x.y"])
def test_linear_time(text):
    began = time.time()
    op.find(text)
    assert time.time() - began < 5


def test_frames(spark):
    rows = [(1, "mail a.b@c.de and 1.2.3.4", 1), (None, "x@y.zz", 1), (2, None, 1), (3, "", 1), (1, "mail a.b@c.de and 1.2.3.4", 1),
            (4, "no data here", 1), (5, "é漢 +1 (988) 555-2485", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans int")
    got = {(r.doc_id, r.spans): r for r in op.personal_data(docs).collect()}
    assert op.personal_data(docs).count() == len(rows)
    assert {s for _, s in got} == {"email:5:13,ip:18:25", "email:0:6", "", "phone:3:20"}
    first = got[1, "email:5:13,ip:18:25"]
    assert (first.n_email, first.n_ip, first.n_card, first.n_phone, first.n_added) == (1, 1, 0, 0, 0)
    assert first.base_sha256 == hashlib.sha256(b"email:5:13,ip:18:25").hexdigest()
    assert got[2, ""].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert op.personal_data(docs.limit(0)).count() == 0
    hidden = {r.text for r in op.masked(docs).collect()}
    assert hidden == {"mail <email> and <ip>", "<email>", None, "", "no data here", "é漢 <phone>"}
