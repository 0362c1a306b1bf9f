"""Personal data: patterns propose spans, checksums confirm them, context words adjust the score.

Base kinds (email, ip, card, phone) follow their contract: leftmost matches of one pattern
per kind that don't overlap, and a failing check drops the match. They always stay, with a
score. The method adds spans that don't overlap a span of any kind taken before:

* ``card`` and ``phone`` in stricter shapes, for numbers that run into a neighbour (a phone
  number with a card number behind it is one failing base match),
* ``iban`` with the mod-97 check, ``ssn`` (three, two and four digits),
* ``phone`` without a country code.

A proposal's score is its kind's weight, plus ``CONFIRMED`` where a checksum holds, plus
``CONTEXT`` where a word that goes with the kind stands among the ``REACH`` characters
before it; added spans need ``ACCEPT``. So an SSN or a national phone number needs context,
and a checksum alone is enough for cards and IBANs.

Every whole text is searched in its own row, nothing is shuffled. Texts without any digit
or ``@`` can't hold a span and don't leave the JVM. Patterns run in linear time: runs of
digits are taken whole (possessive), and an email is found from its ``@``.

Defined results: null text counts as empty; no spans give empty strings and the digest of
the empty string. Rows are independent: repeated rows repeat, null ids stay null, extra
columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contentspark.llm.common import small_batches

KINDS = ["email", "ip", "card", "phone", "iban", "ssn"]
BASE_KINDS = KINDS[:4]

# Weights of the scores.
WEIGHT = {"email": 0.9, "ip": 0.7, "card": 0.4, "phone": 0.5, "iban": 0.3, "ssn": 0.2, "national phone": 0.2}
CONFIRMED, CONTEXT, ACCEPT = 0.4, 0.4, 0.6
REACH = 40

# Words that stand before each kind, in English, German, French and Spanish.
CONTEXT_WORDS = {
    "email": ["email", "e-mail", "mail", "contact", "kontakt", "courriel", "correo"],
    "ip": ["ip", "address", "host", "server", "adresse", "serveur", "servidor"],
    "card": ["card", "visa", "mastercard", "amex", "credit", "debit", "karte", "kreditkarte", "carte", "tarjeta"],
    "phone": ["phone", "tel", "telephone", "call", "fax", "mobile", "telefon", "handy", "téléphone", "portable", "teléfono", "móvil"],
    "iban": ["iban", "account", "bank", "konto", "compte", "banque", "cuenta", "banco"],
    "ssn": ["ssn", "social", "security", "sozialversicherung"],
}

EMAIL_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
EMAIL_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
ADDED = [
    ("card", "card", re.compile(r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![0-9])")),
    ("phone", "phone", re.compile(r"\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})(?:[ .-]?[0-9]{2,4}){2,3}(?![0-9])")),
    ("iban", "iban", re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)(?![A-Za-z0-9])")),
    ("ssn", "ssn", re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")),
    ("phone", "national phone", re.compile(r"(?<![0-9+])(?:\([0-9]{2,4}\) ?|[0-9]{2,5}[ /-])[0-9]{2,4}(?:[ -][0-9]{2,4}){1,3}(?![0-9])")),
]
DIGIT = re.compile("[0-9]")


def luhn(digits: str) -> bool:
    """Whether the last digit is the Luhn check digit of the others."""
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def mod97(iban: str) -> bool:
    """Whether an IBAN's check digits hold."""
    moved = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    """The contract's spans by kind: leftmost, not overlapping, checked."""
    out: dict[str, list[tuple[int, int]]] = {k: [] for k in BASE_KINDS}
    end = 0
    for m in EMAIL_DOMAIN.finditer(text):
        start = m.start()
        while start > end and text[start - 1] in EMAIL_LOCAL:
            start -= 1
        if start < m.start():
            out["email"].append((start, m.end()))
            end = m.end()
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in m.group().split(".")):
            out["ip"].append(m.span())
    for m in CARD.finditer(text):
        if m.end() - m.start() <= 38:  # 19 digits and the separators between them
            digits = "".join(DIGIT.findall(m.group()))
            if 13 <= len(digits) <= 19 and luhn(digits):
                out["card"].append(m.span())
    for m in PHONE.finditer(text):
        if 9 <= len(DIGIT.findall(m.group())) <= 15:
            out["phone"].append(m.span())
    return out


_CONTEXT = {k: re.compile(r"(?<!\w)(?:" + "|".join(map(re.escape, words)) + r")(?!\w)", re.I)
            for k, words in CONTEXT_WORDS.items()}


def score(text: str, kind: str, start: int, weight: str, confirmed: bool) -> float:
    context = _CONTEXT[kind].search(text, max(0, start - REACH), start)
    return min(1.0, WEIGHT[weight] + CONFIRMED * confirmed + CONTEXT * (context is not None))


def find(text: str) -> tuple[dict[str, list[tuple[int, int]]], list[tuple[str, int, int, float]]]:
    """(base spans by kind, all spans with scores by kind, then start)."""
    base = base_spans(text)
    spans = [(k, a, b, score(text, k, a, k, k == "card")) for k in BASE_KINDS for a, b in base[k]]
    covered = bytearray(len(text))
    for _, a, b, _ in spans:
        covered[a:b] = b"\1" * (b - a)
    for kind, weight, pattern in ADDED:
        for m in pattern.finditer(text):
            a, b = m.span()
            if covered.find(1, a, b) >= 0:
                continue
            raw = m.group()
            if kind == "iban":
                compact = raw.replace(" ", "")
                confirmed = 15 <= len(compact) <= 34 and mod97(compact)
            else:
                digits = "".join(DIGIT.findall(raw))
                confirmed = kind == "card" and luhn(digits)
                if weight == "phone":
                    confirmed = 9 <= len(digits) <= 15
            if kind in ("iban", "card") and not confirmed:
                continue
            s = score(text, kind, a, weight, confirmed)
            if s >= ACCEPT:
                spans.append((kind, a, b, s))
                covered[a:b] = b"\1" * (b - a)
    return base, sorted(spans, key=lambda x: (KINDS.index(x[0]), x[1]))


RESULT = ("doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, "
          "spans string, scores string, n_added bigint")
_NOTHING = hashlib.sha256(b"").hexdigest()


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in RESULT.split(", ")]
    for batch in batches:
        rows = []
        for text in batch["text"]:
            text = text.as_py()
            if not text:
                rows.append((0, 0, 0, 0, _NOTHING, "", "", 0))
                continue
            base, spans = find(text)
            joined = ",".join(f"{k}:{a}:{b}" for k in BASE_KINDS for a, b in base[k])
            rows.append((*(len(base[k]) for k in BASE_KINDS), hashlib.sha256(joined.encode()).hexdigest(),
                         ",".join(f"{k}:{a}:{b}" for k, a, b, _ in spans), ",".join(f"{s:.2f}" for *_, s in spans),
                         len(spans) - sum(map(len, base.values()))))
        kinds = [pa.int64()] * 4 + [pa.string()] * 3 + [pa.int64()]
        yield pa.record_batch([batch["doc_id"], *(pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds))],
                              names=names)


def personal_data(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, scores, n_added.

    The counts and the digest are of base spans; ``spans`` holds all as kind:start:end
    (code points, end exclusive), ``scores`` the score of each, ``n_added`` how many the method added.
    """
    small_batches(docs.sparkSession)
    searched = F.when(F.col("text").rlike("[0-9@]"), F.col("text"))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), searched.alias("text")).mapInArrow(_scan, RESULT)


def masked(docs: DataFrame) -> DataFrame:
    """``docs`` with every span of the text replaced by its kind in angle brackets."""
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text in batch["text"].to_pylist():
                if text:
                    found = sorted(find(text)[1], key=lambda x: x[1], reverse=True)
                    last = len(text)
                    for kind, a, b, _ in found:
                        if b <= last:
                            text, last = f"{text[:a]}<{kind}>{text[b:]}", a
                out.append(text)
            at = names.index("text")
            yield pa.record_batch([pa.array(out, pa.string()) if i == at else c for i, c in enumerate(batch.columns)],
                                  names=names)

    return docs.mapInArrow(run, docs.schema)
