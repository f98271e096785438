"""Personal data by anchor expansion.

An Aho-Corasick automaton finds anchors in one pass: at-signs, schemes, digits and plus signs, and
cues such as IBAN or password. At each anchor a deterministic parser expands to both sides and
validates what it found. Four base kinds (email, ip, card, phone) follow fixed patterns, leftmost
and without overlap within a kind; matches that fail their check are dropped without a retry.
Added kinds: account (IBAN, numbers after an account cue), key (credentials), url (with user info).
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ragstone.llm.common import slices

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "account", "key", "url")
#: Words after which an account number is looked for, and a credential.
ACCOUNT_CUES = ("iban", "account number", "account no", "acct", "ssn", "social security")
KEY_CUES = ("password", "passwd", "secret", "token", "api_key", "apikey")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_DIGITS = re.compile(r"[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_GAP = re.compile(r"[ \t:#.=]*")
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}")
_SSN = re.compile(r"(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9])")
_ACCOUNT = re.compile(r"[0-9](?:[ -]?[0-9]){5,16}(?![0-9])")
_AKIA = re.compile(r"AKIA[0-9A-Z]{16}(?![0-9A-Za-z])")
_ASSIGNED = re.compile(r"[ \t]*[=:][ \t]*[\"']?")
_VALUE = re.compile(r"[A-Za-z0-9_+/.~-]{8,}")
_AUTHORITY = re.compile(r"[^\s<>\"'/?#]+")
_REST = re.compile(r"[^\s<>\"']+")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def iban_valid(text: str) -> bool:
    text = text.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97 == 1


@lru_cache(maxsize=1)
def automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    for word, kind in [("@", "email"), ("://", "url"), ("+", "phone"), ("AKIA", "akia"), *[(str(d), "digit") for d in range(10)]]:
        found.add_word(word, (kind, len(word)))
    for cues, kind in ((ACCOUNT_CUES, "account"), (KEY_CUES, "key")):
        for cue in cues:
            for form in {cue, cue.upper(), cue.title(), cue.capitalize()}:
                found.add_word(form, (kind, len(form)))
    found.make_automaton()
    return found


def spans_of(text: str) -> dict[str, list[tuple[int, int]]]:
    """Spans (start, end in code points) by kind, each list ascending."""
    spans: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    end = dict.fromkeys(KINDS, 0)  # up to where each kind has looked
    for last, (kind, length) in automaton().iter(text):
        at = last + 1 - length
        if kind == "digit":
            if at >= end["ip"]:
                if m := _IP.match(text, at):
                    end["ip"] = m.end()
                    if all(len(p) <= 3 and int(p or 0) <= 255 for p in (x.lstrip("0") for x in m.group().split("."))):
                        spans["ip"].append(m.span())
                else:
                    end["ip"] = _DIGITS.match(text, at).end()
            if at >= end["card"]:
                if m := _CARD.match(text, at):
                    end["card"] = m.end()
                    digits = m.group().replace(" ", "").replace("-", "")
                    if 13 <= len(digits) <= 19 and luhn(digits):
                        spans["card"].append(m.span())
        elif kind == "email":
            start = at
            while start > end["email"] and text[start - 1] in _LOCAL:
                start -= 1
            if start < at and (m := _DOMAIN.match(text, at + 1)):
                spans["email"].append((start, m.end()))
                end["email"] = m.end()
        elif kind == "phone":
            if at >= end["phone"] and (m := _PHONE.match(text, at)):
                end["phone"] = m.end()
                if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
                    spans["phone"].append(m.span())
        elif kind == "account":
            if at >= end["account"]:
                start = _GAP.match(text, last + 1).end()
                m = _IBAN.match(text, start)
                if m and not iban_valid(m.group()):
                    m = None
                if m := m or _SSN.match(text, start) or _ACCOUNT.match(text, start):
                    spans["account"].append(m.span())
                    end["account"] = m.end()
        elif kind == "akia":
            if at >= end["key"] and (m := _AKIA.match(text, at)):
                spans["key"].append(m.span())
                end["key"] = m.end()
        elif kind == "key":
            if at >= end["key"] and (gap := _ASSIGNED.match(text, last + 1)) and (m := _VALUE.match(text, gap.end())) and any(c.isdigit() for c in m.group()):
                spans["key"].append(m.span())
                end["key"] = m.end()
        elif at >= end["url"]:
            start = at
            while start > end["url"] and text[start - 1].isascii() and (text[start - 1].isalnum() or text[start - 1] in "+.-"):
                start -= 1
            # The user info stands before the next slash, so no text is looked at for two schemes.
            m = _AUTHORITY.match(text, last + 1)
            if start < at and text[start].isalpha() and m and "@" in m.group():
                end["url"] = _REST.match(text, last + 1).end()
                spans["url"].append((start, end["url"]))
    return spans


def listed(spans: dict[str, list[tuple[int, int]]], kinds: tuple[str, ...] = KINDS) -> str:
    """kind:start:end by kind as listed, then start, joined by commas."""
    return ",".join(f"{k}:{a}:{b}" for k in kinds for a, b in spans[k])


def redacted(text: str) -> str:
    """``text`` with each run of overlapping spans replaced by the first one's kind, as in ``<EMAIL>``."""
    out, done = [], 0
    for start, end, kind in sorted((a, b, k) for k, found in spans_of(text).items() for a, b in found):
        if start >= done:
            out += [text[done:start], f"<{kind.upper()}>"]
        done = max(done, end)
    return "".join(out) + text[done:]


def find_pii(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, n_account, n_key, n_url, base_sha256, spans of every row.

    Null text counts as empty (no spans; the digest of the empty string). Repeated rows are judged
    each for itself, an empty table gives an empty result, and only doc_id and text are read. Each
    text is scanned once, in linear time; no rows are shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                found = [spans_of(t or "") for t in part["text"].to_pylist()]
                columns = {"doc_id": part["doc_id"]} | {f"n_{k}": pa.array([len(x[k]) for x in found], pa.int64()) for k in KINDS}
                columns["base_sha256"] = [hashlib.sha256(listed(x, BASE).encode()).hexdigest() for x in found]
                yield pa.RecordBatch.from_pydict(columns | {"spans": [listed(x) for x in found]})

    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, f"doc_id long, {counts}, base_sha256 string, spans string")


def redact(docs: DataFrame, column: str = "text") -> DataFrame:
    """``docs`` with personal data in ``column`` replaced by the names of its kinds; all rows and columns stay, null stays null.

    A column ``n_chars``, where there is one, is left as it was: it tells of the original text.
    """

    @F.udf("string", useArrow=True)
    def clean(text):
        return None if text is None else redacted(text)

    return docs.withColumn(column, clean(F.col(column)))
