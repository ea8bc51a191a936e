"""Personal data by anchor expansion.

One Aho-Corasick automaton finds the anchors of a whole text in one pass: at-signs,
schemes, plus signs, digits, and words that announce an identifier. At each anchor a
local parser expands to the left and right, decides where the span ends and validates
it. The parsers return what the leftmost non-overlapping matches of these patterns are,
failing matches being dropped:

* email ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``
* ip ``[0-9]+(\\.[0-9]+)(\\.[0-9]+)(\\.[0-9]+)`` with parts of at most 255
* card ``[0-9]([\\x20-]?[0-9])+`` of 16 to 19 digits with a valid check digit (Luhn)
* phone ``\\+[0-9][\\x20().0-9-]+[0-9]`` of 8 to 15 digits

and besides:

* login: ``scheme://user:password@`` - the part between the slashes and the at-sign
* iban: after a cue word, two letters, two digits and 11 to 30 letters or digits, perhaps
  in groups of four, with a valid check (remainder 1 of 97)
* account: after a cue word, 8 to 12 digits

Spans are in code points with an exclusive end; spans of different kinds may overlap.
A null or empty text has none. Rows with null or repeated ids are kept as they are;
other columns are ignored, and kept by ``mask_documents``.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tenantflow.llm.inputs import record_batch, texts_of

BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("login", "iban", "account")

#: Words that announce an identifier, lower case.
IBAN_CUES = ("iban", "bank account", "bankverbindung", "cuenta bancaria", "compte bancaire")
ACCOUNT_CUES = (
    "account number", "account no", "kontonummer", "numero de cuenta", "número de cuenta",
    "numero de compte", "numéro de compte",
)

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOGIN = re.compile(r"[^\s/@:?#]+:[^\s/@?#]+(?=@)")
_IBAN = re.compile(r"[\s:#]{0,4}([A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30})(?![A-Za-z0-9])")
_ACCOUNT = re.compile(r"[\s:#.]{0,4}([0-9]{8,12})(?![0-9])")
_DIGITS = re.compile(r"[0-9]+")
_NOT_DIGIT = re.compile(r"[^0-9]")

Span = tuple[int, int]


def _passes_luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    for digit in digits[-2::-2]:
        twice = 2 * int(digit)
        total += twice - 9 if twice > 9 else twice
    return total % 10 == 0


def _valid_ip(span: str) -> bool:
    return all(len(part.lstrip("0")) <= 3 and int(part[-9:]) <= 255 for part in span.split("."))


def _valid_card(span: str) -> bool:
    digits = _NOT_DIGIT.sub("", span)
    return 16 <= len(digits) <= 19 and _passes_luhn(digits)


def _valid_phone(span: str) -> bool:
    return 8 <= len(_NOT_DIGIT.sub("", span)) <= 15


def _iban_length(span: str) -> int:
    """The length of the longest valid start of ``span``; 0 if there is none."""
    for end in range(len(span), 14, -1):
        plain = span[:end].replace(" ", "")
        if span[end - 1] != " " and 15 <= len(plain) <= 34:
            if int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1:
                return end
    return 0


class AnchorScanner:
    """Finds spans in texts. One scanner serves many texts."""

    def __init__(self) -> None:
        self._anchors = ahocorasick.Automaton()
        for digit in "0123456789":
            self._anchors.add_word(digit, (self._at_digit, 1))
        self._anchors.add_word("@", (self._at_sign, 1))
        self._anchors.add_word("+", (self._at_plus, 1))
        self._anchors.add_word("://", (self._at_scheme, 3))
        for cues, parser in ((IBAN_CUES, self._at_iban), (ACCOUNT_CUES, self._at_account)):
            for cue in cues:
                for form in {cue, cue.upper(), cue.capitalize(), cue.title()}:
                    self._anchors.add_word(form, (parser, len(form)))
        self._anchors.make_automaton()

    def scan(self, text: str) -> dict[str, list[Span]]:
        self._text = text
        self._found: dict[str, list[Span]] = {kind: [] for kind in (*BASE_KINDS, *ADDED_KINDS)}
        self._free = dict.fromkeys(self._found, 0)  # by kind: where the last match ended
        self._digits_end = 0
        for last, (parser, length) in self._anchors.iter(text):
            parser(last + 1 - length, last + 1)
        return self._found

    def _keep(self, kind: str, start: int, end: int, valid: bool) -> None:
        self._free[kind] = end
        if valid:
            self._found[kind].append((start, end))

    def _at_sign(self, start: int, end: int) -> None:
        text, free, begin = self._text, self._free["email"], start
        while begin > free and text[begin - 1] in _LOCAL:
            begin -= 1
        domain = _DOMAIN.match(text, end) if begin < start else None
        if domain:
            self._keep("email", begin, domain.end(), True)

    def _at_digit(self, start: int, end: int) -> None:
        if start < self._digits_end:  # inside a run of digits that was looked at
            return
        text = self._text
        self._digits_end = _DIGITS.match(text, start).end()
        for kind, pattern, valid in (("ip", _IP, _valid_ip), ("card", _CARD, _valid_card)):
            if start >= self._free[kind] and (found := pattern.match(text, start)):
                self._keep(kind, start, found.end(), valid(found[0]))

    def _at_plus(self, start: int, end: int) -> None:
        if start >= self._free["phone"] and (found := _PHONE.match(self._text, start)):
            self._keep("phone", start, found.end(), _valid_phone(found[0]))

    def _at_scheme(self, start: int, end: int) -> None:
        if end >= self._free["login"] and (found := _LOGIN.match(self._text, end)):
            self._keep("login", end, found.end(), True)

    def _at_iban(self, start: int, end: int) -> None:
        found = _IBAN.match(self._text, end)
        if found and found.start(1) >= self._free["iban"]:
            length = _iban_length(found[1])
            self._keep("iban", found.start(1), found.start(1) + (length or len(found[1])), length > 0)

    def _at_account(self, start: int, end: int) -> None:
        found = _ACCOUNT.match(self._text, end)
        if found and found.start(1) >= self._free["account"]:
            self._keep("account", found.start(1), found.end(1), True)


def _joined(found: dict[str, list[Span]], kinds: tuple[str, ...]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind in kinds for start, end in found[kind])


def _merged(found: dict[str, list[Span]]) -> list[tuple[int, int, str]]:
    """The spans of all kinds without overlaps, in order; a joint span has its first kind."""
    merged: list[tuple[int, int, str]] = []
    for start, end, kind in sorted((a, b, k) for k, spans in found.items() for a, b in spans):
        if merged and start < merged[-1][1]:
            merged[-1] = (merged[-1][0], max(end, merged[-1][1]), merged[-1][2])
        else:
            merged.append((start, end, kind))
    return merged


def find_personal_data(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, a count for each base kind, base_sha256 and spans.

    ``spans`` lists all spans as kind:start:end, by kind and start; ``base_sha256`` is the
    digest of that list for the base kinds.
    """
    schema = T.StructType(
        [T.StructField("doc_id", docs.select(F.col("doc_id")).schema.fields[0].dataType)]
        + [T.StructField(f"n_{kind}", T.LongType()) for kind in BASE_KINDS]
        + [T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType())]
    )
    arrow = to_arrow_schema(schema)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = AnchorScanner()
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), texts_of(batch.column(1))):
                found = scanner.scan(text)
                base = hashlib.sha256(_joined(found, BASE_KINDS).encode()).hexdigest()
                counts = [len(found[kind]) for kind in BASE_KINDS]
                rows.append((doc_id, *counts, base, _joined(found, BASE_KINDS + ADDED_KINDS)))
            if rows:
                yield record_batch(arrow, zip(*rows))

    return docs.select("doc_id", "text").mapInArrow(scan, schema)


def mask_documents(docs: DataFrame) -> DataFrame:
    """``docs`` with every span replaced by its kind in angle brackets.

    ``n_chars``, where it is a column, is the length of the new text. A null text stays.
    """
    schema = docs.schema
    arrow = to_arrow_schema(schema)
    text_at = docs.columns.index("text")
    count_at = docs.columns.index("n_chars") if "n_chars" in docs.columns else None

    def masked(scanner: AnchorScanner, text: str | None) -> str | None:
        if not text:
            return text
        parts, at = [], 0
        for start, end, kind in _merged(scanner.scan(text)):
            parts += [text[at:start], f"<{kind}>"]
            at = end
        return "".join([*parts, text[at:]])

    def mask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = AnchorScanner()
        for batch in batches:
            columns = list(batch.columns)
            old = columns[text_at].to_pylist()
            new = [masked(scanner, text) for text in old]
            columns[text_at] = pa.array(new, arrow.field(text_at).type)
            if count_at is not None:
                counts = columns[count_at].to_pylist()
                counts = [n if a == b else len(b) for n, a, b in zip(counts, old, new)]
                columns[count_at] = pa.array(counts, arrow.field(count_at).type)
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return docs.mapInArrow(mask, schema)
