"""Personal data: patterns propose spans, checksums confirm them, context words move the score.

Base kinds (email, ip, card, phone) follow fixed patterns and always stay when their check holds.
Two kinds are added: iban, confirmed by mod 97, and ssn, which has no checksum and therefore needs
a context word nearby. Offsets are code points, the end exclusive.

Edge cases: null and empty texts have no span; texts of any length are read whole, each pattern in
time linear in the text; repeated rows give repeated results; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("iban", "ssn")
ORDER = {kind: i for i, kind in enumerate((*BASE_KINDS, *ADDED_KINDS))}

LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?"
                  r"(?![A-Za-z0-9])")
SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")

# Words that make a kind likelier, looked for in the characters before and after a span.
CONTEXT = {
    "email": ("mail", "email", "contact", "write"),
    "ip": ("ip", "address", "server", "host", "login"),
    "card": ("card", "visa", "credit", "payment", "mastercard"),
    "phone": ("phone", "call", "tel", "mobile", "fax"),
    "iban": ("iban", "bank", "account", "transfer"),
    "ssn": ("ssn", "social security", "social-security"),
}
CONTEXT_CHARS = 60
# Score of a pattern alone, what a held checksum adds, what a context word adds.
BASE_SCORE = {"email": 0.8, "ip": 0.5, "card": 0.3, "phone": 0.5, "iban": 0.3, "ssn": 0.3}
CHECKSUM_BONUS, CONTEXT_BONUS = 0.5, 0.3
ADDED_AT = 0.6

SPAN = "struct<kind:string,start:long,end:long,score:double>"


def luhn(digits: str) -> bool:
    """The check of card numbers: every second digit from the right is doubled."""
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def mod_97(account: str) -> bool:
    """The check of account numbers: country and check digits last, letters as 10 to 35."""
    turned = account[4:] + account[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches found from their @ sign: a long run without one costs nothing."""
    past = 0
    at = text.find("@")
    while at >= 0:
        if at >= past:
            start = at
            while start > past and LOCAL.match(text[start - 1]):
                start -= 1
            domain = DOMAIN.match(text, at + 1) if start < at else None
            if domain:
                yield start, domain.end()
                past = domain.end()
        at = text.find("@", at + 1)


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def propose(text: str) -> Iterator[tuple[str, int, int, bool]]:
    """Kind, start, end of each confirmed span, and whether a checksum confirmed it."""
    for start, end in emails(text):
        yield "email", start, end, False
    for m in IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or "0") <= 255 for part in m[0].split(".")):
            yield "ip", m.start(), m.end(), False
    for m in CARD.finditer(text):
        digits = _digits(m[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            yield "card", m.start(), m.end(), True
    for m in PHONE.finditer(text):
        if 9 <= len(_digits(m[0])) <= 15:
            yield "phone", m.start(), m.end(), False
    for m in IBAN.finditer(text):
        account = m[0].replace(" ", "")
        if 15 <= len(account) <= 34 and mod_97(account):
            yield "iban", m.start(), m.end(), True
    for m in SSN.finditer(text):
        if m[0][:3] not in ("000", "666") and m[0][0] != "9" and m[0][4:6] != "00" \
                and m[0][7:] != "0000":
            yield "ssn", m.start(), m.end(), False


def spans_of(text: str | None) -> list[dict]:
    """All spans of a text by start, then kind as listed, each with its score."""
    found = []
    for kind, start, end, checked in propose(text or ""):
        near = (text[max(0, start - CONTEXT_CHARS):start] + " "
                + text[end:end + CONTEXT_CHARS]).lower()
        context = any(re.search(rf"(?<!\w){re.escape(word)}", near) for word in CONTEXT[kind])
        score = min(1.0, BASE_SCORE[kind] + CHECKSUM_BONUS * checked + CONTEXT_BONUS * context)
        if kind in BASE_KINDS or score >= ADDED_AT:
            found.append({"kind": kind, "start": start, "end": end, "score": score})
    return sorted(found, key=lambda s: (s["start"], ORDER[s["kind"]]))


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id and its spans (kind, start, end, score)."""

    spans = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                                ("score", pa.float64())]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [spans_of(text) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(found, spans)], ["doc_id", "spans"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = dict(rows.dtypes)["doc_id"]
    return rows.mapInArrow(scan, f"doc_id {kind}, spans array<{SPAN}>")


def redact(text: str | None, spans: list) -> str | None:
    """The text with every span replaced by its kind in brackets; overlapping spans merge."""
    if text is None:
        return None
    out, past = [], 0
    for span in spans:
        if span["end"] > past:
            if span["start"] >= past:
                out += [text[past:span["start"]], f"[{span['kind'].upper()}]"]
            past = span["end"]
    return "".join(out) + text[past:]


def digest(found: DataFrame) -> DataFrame:
    """Counts of the base kinds, the digest of the base spans and the list of all spans."""
    text = lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", *[count(kind).alias(f"n_{kind}") for kind in BASE_KINDS],
        F.sha2(F.array_join(F.transform(base, text), ","), 256).alias("base_sha256"),
        F.array_join(F.transform("spans", text), ",").alias("spans"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["score"])), F.lit(0.0))
        .alias("top_score"))


