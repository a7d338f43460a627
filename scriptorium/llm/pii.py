"""Personal data by anchor expansion.

One Aho-Corasick automaton walks each text once and reports anchors: at-signs, plus signs,
digits, URL schemes and account cues. A deterministic parser for each kind expands left and
right from its anchor and validates what it found. Offsets are code points, end exclusive.

Kinds: email, ip, card, phone (the base definitions, leftmost and non-overlapping within a
kind, no retry after a failed check), and two that the method adds: `address` (scheme://user@host)
and `account` (IBAN with valid check digits, or a cue word followed by 6 to 20 digits).

Defined cases: a null text counts as empty and has no spans; each input row gives one row
(repeated rows too); an empty table gives an empty result; parsers are linear in the text, so
long texts and long runs need no cap; other columns are ignored by `scan` and kept by `redact`.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "address", "account")
SCHEMES = ("http://", "https://", "ftp://", "ssh://", "sftp://")
CUES = ("iban", "account", "acct", "konto", "compte", "cuenta")

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
CHAIN = re.compile(r"[0-9]+(?:\.[0-9]+)*")
PARTS = re.compile(r"[0-9]+")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
USERINFO = re.compile(r"[^\s/@:]+(?::[^\s/@]*)?@[A-Za-z0-9.-]+(?::[0-9]+)?")
IBAN = re.compile(r"[\s:#.]{0,4}([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?)(?![A-Za-z0-9])")
NUMBER = re.compile(r"(?:\s?(?:no|nr|number|num)\.?)?[\s:#.]{1,4}([0-9](?:[ -]?[0-9]){5,19})(?![0-9])", re.I)


def automaton():
    import ahocorasick

    a = ahocorasick.Automaton()
    for key, kind in [("@", "@"), ("+", "+"), *((str(d), "0") for d in range(10)), *((s, "s") for s in SCHEMES)]:
        a.add_word(key, kind)
    for cue in CUES:
        for form in (cue, cue.capitalize(), cue.upper()):
            a.add_word(form, "c")
    a.make_automaton()
    return a


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(x), 10)) for x in digits[-2::-2])
    return total % 10 == 0


def iban_valid(raw: str) -> bool:
    s = raw.replace(" ", "")
    return 15 <= len(s) <= 34 and int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def octet(part: str) -> bool:
    bare = part.lstrip("0")
    return len(bare) <= 3 and int(bare or "0") <= 255


def spans(text: str | None, anchors) -> dict[str, list[tuple[int, int]]]:
    """Spans by kind, each list in order of start."""
    out: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    if not text:
        return out
    past = dict.fromkeys(KINDS, 0)  # where the next match of a kind may start
    for end, kind in anchors.iter(text):
        at = end
        if kind == "0":
            if at >= past["ip"]:
                m = CHAIN.match(text, at)
                past["ip"] = m.end()
                if text.find(".", at, m.end()) >= 0:
                    parts = [x.span() for x in PARTS.finditer(text, at, m.end())]
                    for k in range(0, len(parts) - 3, 4):
                        if all(octet(text[s:e]) for s, e in parts[k : k + 4]):
                            out["ip"].append((parts[k][0], parts[k + 3][1]))
            if at >= past["card"]:
                m = CARD.match(text, at)
                past["card"] = m.end() if m else at + 1
                if m and m.end() - at >= 13:
                    digits = m[0].replace(" ", "").replace("-", "")
                    if 13 <= len(digits) <= 19 and luhn(digits):
                        out["card"].append(m.span())
        elif kind == "@":
            floor, s = past["email"], at
            while s > floor and text[s - 1] in LOCAL:
                s -= 1
            if s < at and (m := DOMAIN.match(text, at + 1)):
                out["email"].append((s, m.end()))
                past["email"] = m.end()
        elif kind == "+":
            if at >= past["phone"] and (m := PHONE.match(text, at)):
                past["phone"] = m.end()
                if 9 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
                    out["phone"].append(m.span())
        elif kind == "s":
            if at >= past["address"] and (m := USERINFO.match(text, end + 1)):
                s = text.rfind(":", 0, end)
                while s > past["address"] and "a" <= text[s - 1] <= "z":
                    s -= 1
                out["address"].append((s, m.end()))
                past["address"] = m.end()
        elif end + 1 >= past["account"]:
            m = IBAN.match(text, end + 1)
            if not (m and iban_valid(m[1])):
                m = NUMBER.match(text, end + 1)
            if m:
                out["account"].append(m.span(1))
                past["account"] = m.end()
    return out


def joined(found: dict[str, list[tuple[int, int]]], kinds) -> str:
    return ",".join(f"{k}:{s}:{e}" for k in kinds for s, e in found[k])


SCHEMA = pa.schema(
    [("doc_id", pa.int64()), *((f"n_{k}", pa.int64()) for k in BASE), ("base_sha256", pa.string()), ("spans", pa.string()), ("n_added", pa.int64())]
)
DDL = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"


def scan(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row for each document: counts of the base kinds, digest of the base spans, all spans, number of added ones."""

    def make():
        anchors = automaton()

        def each(i, t) -> Iterator[tuple]:
            found = spans(t, anchors)
            base = joined(found, BASE)
            added = sum(len(found[k]) for k in KINDS[len(BASE) :])
            yield (i, *(len(found[k]) for k in BASE), hashlib.sha256(base.encode()).hexdigest(), joined(found, KINDS), added)

        return each

    df = df.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return map_rows(df, ["doc_id", "text"], SCHEMA, DDL, make)


def masked(text: str | None, anchors) -> str | None:
    """The text with each run of overlapping spans replaced by the kind of its first span, in brackets."""
    if not text:
        return text
    runs: list[list] = []
    for s, e, k in sorted((s, e, k) for k, found in spans(text, anchors).items() for s, e in found):
        if runs and s < runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], e)
        else:
            runs.append([s, e, k])
    if not runs:
        return text
    out, at = [], 0
    for s, e, k in runs:
        out += [text[at:s], f"[{k.upper()}]"]
        at = e
    return "".join([*out, text[at:]])


def redact(df: DataFrame, text: str = "text") -> DataFrame:
    """df with personal data in the text column masked; all rows and columns stay, null stays null."""

    @F.pandas_udf("string")
    def mask(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        anchors = automaton()
        for part in parts:
            yield part.map(lambda t: masked(t, anchors))

    return df.withColumn(text, mask(F.col(f"`{text}`")))
