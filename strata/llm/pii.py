"""Personal data by anchor expansion.

An Aho-Corasick automaton finds anchors in the whole text: at-signs, digits,
URL schemes and identifier cues.  From each anchor a local parser expands to
the run of characters its kind may use, reads the value there and validates
it.  A value never leaves its run, so reading the runs from left to right
gives the same leftmost, non-overlapping values as reading the text.

Base kinds: email, ip, card (Luhn), phone.  The method adds url (scheme
anchors) and account (identifier cues followed by a value; IBAN check digits
where the value has that form).  Nulls and empty texts have no spans; repeated
rows are separate rows; an empty table gives none.  A text of any length is read
whole, in time that grows with its length.  Extra columns are dropped, whatever
their names.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "url", "account")
SCHEMES = ("http://", "https://", "ftp://", "mailto:")
CUES = ("iban", "account", "acct", "passport", "ssn", "social security", "tax id", "customer id", "user id", "member id")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IP_RUN = re.compile(r"[0-9.]+")
_CARD_RUN = re.compile(r"[0-9\x20-]+")
_NOT_DIGIT = re.compile(r"[^0-9]")
_URL = re.compile(r"(?:https?|ftp)://[^\s<>\"']+|mailto:[^\s<>\"']+", re.I)
_LABEL = re.compile(r"(?:\s{0,3}(?:no\.?|number|nr\.?|id|is|#|:|=)){0,3}\s{0,3}", re.I)
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
# a value and its hyphens have 67 characters at most, so a digit is looked for within as many
_VALUE = re.compile(r"(?=[A-Z0-9-]{0,66}[0-9])[A-Z0-9](?:-?[A-Z0-9]){4,33}(?![A-Za-z0-9])", re.I)

_automaton: list[ahocorasick.Automaton] = []


def _anchors() -> ahocorasick.Automaton:
    if not _automaton:
        a = ahocorasick.Automaton()
        a.add_word("@", ("@", 1))
        for d in "0123456789":
            a.add_word(d, ("0", 1))
        for s in SCHEMES:
            a.add_word(s, ("url", len(s)))
        for c in CUES:
            a.add_word(c, ("account", len(c)))
        a.make_automaton()
        _automaton.append(a)
    return _automaton[0]


def luhn(digits: str) -> bool:
    """The Luhn check of a digit string."""
    total = 0
    for k, d in enumerate(reversed(digits)):
        v = ord(d) - 48
        if k % 2:
            v = v * 2 - 9 if v > 4 else v * 2
        total += v
    return total % 10 == 0


def _iban_ok(value: str) -> bool:
    moved = value[4:] + value[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _email(text: str, at: int, since: int) -> tuple[int, int] | None:
    """The address around the at-sign, whose local part starts at ``since`` at the earliest."""
    start = at
    while start > since and text[start - 1] in _LOCAL:
        start -= 1
    if start == at:
        return None
    domain = _DOMAIN.match(text, at + 1)
    return (start, domain.end()) if domain else None


def _run(text: str, at: int, chars: str, back_to: int) -> int:
    """The first place from which only ``chars`` lead to ``at``."""
    while at > back_to and text[at - 1] in chars:
        at -= 1
    return at


def find_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of all spans, by start and then kind as listed."""
    found: list[tuple[int, int, str]] = []
    email_end = ip_end = card_end = phone_end = url_end = account_end = 0
    low = text.encode().lower().decode()  # A-Z only: str.lower may change a text's length
    for last, (what, size) in _anchors().iter(low):
        if what == "0":
            if last >= ip_end:
                start = _run(text, last, "0123456789.", ip_end)
                run = _IP_RUN.match(text, start)
                for m in _IP.finditer(text, start, run.end()):
                    if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.group().split(".")):
                        found.append((m.start(), m.end(), "ip"))
                ip_end = run.end()
            if last >= card_end:
                run = _CARD_RUN.match(text, last)
                for m in _CARD.finditer(text, last, run.end()):
                    digits = m.group().replace(" ", "").replace("-", "")
                    if 12 <= len(digits) <= 19 and luhn(digits):
                        found.append((m.start(), m.end(), "card"))
                card_end = run.end()
            if last >= phone_end and last and text[last - 1] == "+":
                m = _PHONE.match(text, last - 1)
                if m and m.start() >= phone_end:
                    phone_end = m.end()
                    if 9 <= len(_NOT_DIGIT.sub("", m.group())) <= 15:
                        found.append((m.start(), m.end(), "phone"))
        elif what == "@":
            span = _email(text, last, email_end)
            if span:
                email_end = span[1]
                found.append((*span, "email"))
        elif what == "url":
            start = last + 1 - size
            m = _URL.match(text, start) if start >= url_end else None
            if m:
                url_end = m.end()
                end = start + len(m.group().rstrip(".,;:!?)]}"))
                if end > last + 1:
                    found.append((start, end, "url"))
        else:
            start = last + 1 - size
            if start < account_end or (start and text[start - 1].isalnum()):
                continue
            at = _LABEL.match(text, last + 1).end()
            m = _IBAN.match(text, at)
            if m and not _iban_ok(m.group().replace(" ", "")):
                continue
            m = m or _VALUE.match(text, at)
            if m:
                account_end = m.end()
                found.append((m.start(), m.end(), "account"))
    found.sort(key=lambda s: (s[0], KINDS.index(s[2])))
    return found


def _joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in spans)


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: counts of the base kinds, digest of their spans, all spans."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: list[list[int]] = [[] for _ in BASE_KINDS]
            digests, joined = [], []
            for text in batch.column(1):
                spans = find_spans(text.as_py() or "")
                base = [s for s in spans if s[2] in BASE_KINDS]
                for k, kind in enumerate(BASE_KINDS):
                    counts[k].append(sum(s[2] == kind for s in base))
                digests.append(hashlib.sha256(_joined(base).encode()).hexdigest())
                joined.append(_joined(spans))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in counts), pa.array(digests, pa.string()), pa.array(joined, pa.string())],
                ["doc_id", *(f"n_{k}" for k in BASE_KINDS), "base_sha256", "spans"])

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
            .mapInArrow(scan, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every whole text of documents."""
    return find_pii(spark.read.parquet(f"{sf_dir}/documents.parquet"))
