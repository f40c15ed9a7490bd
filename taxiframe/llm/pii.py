"""Personal data by anchor expansion.

One pass of an Aho-Corasick automaton over the whole text finds anchors: at
signs, plus signs, digits, URL schemes and identifier cues. At each anchor a
local parser finds the borders of the item and validates it. Nothing else of
the text is looked at.

* ``email`` - from an at sign to the left over the local part and to the right
  over a domain of two or more labels.
* ``ip``, ``card`` - from the first digit of a run to the right: four numbers
  of at most 255; 16 to 19 digits with single blanks or hyphens that pass the
  Luhn check.
* ``phone`` - from a plus sign to the right, 8 to 15 digits.
* ``login`` - from a URL scheme (``://``) to the right, the user and password
  in front of an at sign.
* ``account`` - from a cue (``iban``, ``ssn``, ``account``, ``passport``, in
  any case) over a separator to a value of 6 to 34 letters, digits, blanks
  between groups or hyphens with at least 5 digits; after ``iban`` the value
  has to pass the mod-97 check.

Spans of one kind do not overlap: the leftmost wins, and a candidate that
fails validation is dropped as a whole. Spans are in code points, the end
exclusive. Null and empty texts have no spans; other columns, nulls in them
and repeated rows are carried along; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from functools import lru_cache

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taxiframe.llm.common import fresh

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "login", "account")
CUES = ("iban", "ssn", "account", "passport")
#: A-Z in lower case; every character keeps its place.
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DIGITS = frozenset("0123456789")
IP = re.compile(r"[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
LOGIN = re.compile(r"://([^\s/@:]+:[^\s/@]+)@")
LEAD = r"(?: ?(?:no|nr|number|num)\.?)? ?[:=#]? ?"
VALUE = re.compile(LEAD + r"([A-Za-z0-9]+(?:[ -][0-9][A-Za-z0-9]*)*)")
IBAN = re.compile(LEAD + r"([A-Z]{2}[0-9]{2}(?:[ -]?[A-Z0-9]{1,4})*)")


@lru_cache(maxsize=1)
def automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    anchors = [("@", "email"), ("+", "phone"), ("://", "login"), *[(d, "digit") for d in sorted(DIGITS)]]
    for text, kind in [*anchors, *[(cue, "account") for cue in CUES]]:
        found.add_word(text, (kind, len(text), text))
    found.make_automaton()
    return found


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def only_digits(text: str) -> str:
    return "".join(c for c in text if c in DIGITS)


def valid_ip(text: str) -> bool:
    # Leading zeros don't count, and a number of more digits is above 255.
    return all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in text.split("."))


def valid_card(text: str) -> bool:
    digits = only_digits(text)
    return 16 <= len(digits) <= 19 and luhn(digits)


def valid_phone(text: str) -> bool:
    return 8 <= len(only_digits(text)) <= 15


def valid_iban(value: str) -> bool:
    value = re.sub(r"[ -]", "", value).upper()
    if not re.fullmatch(r"[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}", value):
        return False
    return int("".join(str(int(c, 36)) for c in value[4:] + value[:4])) % 97 == 1


def valid_value(value: str) -> bool:
    return 6 <= len(value) <= 34 and len(only_digits(value)) >= 5


def expand(text: str) -> list[tuple[str, int, int]]:
    """All spans ``(kind, start, end)`` of a text, by kind and start."""
    spans: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    after = dict.fromkeys(KINDS, 0)  # where the last candidate of a kind ended

    def candidate(kind: str, start: int, end: int, ok: bool) -> None:
        after[kind] = end
        if ok:
            spans[kind].append((start, end))

    for last, (kind, length, cue) in automaton().iter(text.translate(LOWER)):  # cues in any case
        at = last - length + 1
        if kind == "digit":
            if at >= after["ip"] and not (at > after["ip"] and text[at - 1] in DIGITS) and (m := IP.match(text, at)):
                candidate("ip", at, m.end(), valid_ip(m[0]))
            if at >= after["card"] and (m := CARD.match(text, at)):
                candidate("card", at, m.end(), valid_card(m[0]))
        elif kind == "email":
            start = at
            while start > after["email"] and text[start - 1] in LOCAL:
                start -= 1
            if start < at and (m := DOMAIN.match(text, at)):
                candidate("email", start, m.end(), True)
        elif kind == "phone":
            if at >= after["phone"] and (m := PHONE.match(text, at)):
                candidate("phone", at, m.end(), valid_phone(m[0]))
        elif kind == "login":
            if m := LOGIN.match(text, at):
                candidate("login", m.start(1), m.end(1), True)
        elif at >= after["account"] and not (at and text[at - 1].isalnum()):
            m = (IBAN if cue == "iban" else VALUE).match(text, last + 1)
            if m and (valid_iban if cue == "iban" else valid_value)(m[1]):
                candidate("account", m.start(1), m.end(1), True)
    return [(k, a, b) for k in KINDS for a, b in spans[k]]


SPANS = "array<struct<kind:string,start:int,end:int>>"


def find_spans(texts: pd.Series) -> pd.Series:
    return pd.Series([[{"kind": k, "start": a, "end": b} for k, a, b in expand(t)] if t else [] for t in texts],
                     dtype=object)


def find_pii(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``pii``, the array of its spans by kind and start."""
    return docs.withColumn(fresh("pii", docs.columns), F.pandas_udf(find_spans, SPANS)(docs[text]))


def digest(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts by base kind, the hash of the base spans and the list of all."""
    found = find_pii(docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text")))
    listed = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    only = lambda *kinds: F.filter("pii", lambda s: s["kind"].isin(*kinds))
    return found.select(
        "doc_id", *[F.size(only(k)).cast("long").alias(f"n_{k}") for k in BASE_KINDS],
        F.sha2(listed(only(*BASE_KINDS)), 256).alias("base_sha256"), listed(F.col("pii")).alias("spans"),
        F.size("pii").cast("long").alias("n_spans"))


def redact(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each span replaced by its kind in angle brackets; of
    overlapping spans the first by start, then the longest, is replaced."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], f"<{kind}>"]
            at = b
    return "".join([*out, text[at:]])
