"""Personal data by anchor expansion.

One Aho-Corasick pass finds anchors: at-signs, plus signs, digits, scheme
marks and identifier cues. From each anchor a deterministic local parser
expands to the boundaries of the item and validates it.

Base kinds (leftmost, non-overlapping per kind; a match that fails its check
is dropped and not tried again): ``email``, ``ip``, ``card`` (14 to 19
digits, Luhn), ``phone`` (10 to 15 digits). Added kinds: ``iban`` (mod 97),
``ssn`` and ``account`` (an identifier or secret after a cue), ``login`` (a
web address that carries a user name and password).

Defined results: a null or empty text has no spans, an empty table gives an
empty result. Whole texts are searched in time proportional to their length:
the end of a run of digits or identifier characters is found once, however
many cues stand in it. Positions are code points, ends exclusive. Spans come sorted by start, then by kind as listed.
Kinds may overlap each other; ``redact`` masks the union of the spans. Null
ids and repeated rows are treated row by row; other columns are kept by
``redact`` and ignored by ``find_pii``.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# fixed values: kinds in sorting order, the base kinds first
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "ssn", "account", "login")
_RANK = {k: i for i, k in enumerate(KINDS)}

# fixed values: identifier cues by the parser they start
CUES = {
    "iban": ("iban",),
    "ssn": ("ssn", "social security"),
    "account": ("account", "acct", "customer id", "passport", "token", "api key", "api_key",
                "apikey", "secret", "password", "konto", "compte", "cuenta"),
}

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DIGITS = re.compile(r"[0-9]+")
_IP = re.compile(r"[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_AFTER_CUE = r"""(?:[ _-]?(?:number|no\.?|nr\.?|id))?["']?[ ]{0,3}(?:[:=#]|is)?[ ]{0,3}["']?"""
_IBAN = re.compile(_AFTER_CUE + r"([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?)(?![A-Za-z0-9])")
_SSN = re.compile(_AFTER_CUE + r"((?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4})(?![0-9-])")
_ACCOUNT = re.compile(_AFTER_CUE + r"(?=([A-Za-z0-9]))")
_RUN = re.compile(r"[A-Za-z0-9_/+.-]+")
_SCHEME_BEFORE = re.compile(r"[A-Za-z][A-Za-z0-9+.-]{0,15}")
_LOGIN = re.compile(r"://[^\s:/@<>\"']++:[^\s:/@<>\"']++@[A-Za-z0-9.-]+(?::[0-9]{1,5})?(?:/[^\s<>\"']*)?")


@functools.cache
def _automaton() -> ahocorasick.Automaton:
    auto = ahocorasick.Automaton()
    for mark, kind in (("@", "email"), ("+", "phone"), ("://", "login"), *((d, "digit") for d in "0123456789")):
        auto.add_word(mark, (kind, len(mark)))
    for kind, cues in CUES.items():
        for cue in cues:
            for form in {cue, cue.upper(), cue.capitalize(), cue.title()}:
                auto.add_word(form, (kind, len(form)))
    auto.make_automaton()
    return auto


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _mod97(iban: str) -> bool:
    moved = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def find_spans(text: str | None) -> list[tuple[str, int, int]]:
    """All spans (kind, start, end) of one whole text."""
    if not text:
        return []
    out: list[tuple[str, int, int]] = []
    done = dict.fromkeys(KINDS, 0)  # where the last match of a kind ended
    run_end = 0                     # end of the last run of digits
    run = _Run()
    for last, (anchor, length) in _automaton().iter(text):
        at = last - length + 1
        if anchor == "digit":
            if at < run_end:
                continue
            run_end = _DIGITS.match(text, at).end()
            if at >= done["ip"] and text[run_end:run_end + 1] == "." and (m := _IP.match(text, at)):
                done["ip"] = m.end()
                if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in m[0].split(".")):
                    out.append(("ip", at, m.end()))
            if at >= done["card"] and (m := _CARD.match(text, at)):
                done["card"] = m.end()
                if m.end() - at >= 14 and 14 <= len(d := _digits_of(m[0])) <= 19 and luhn(d):
                    out.append(("card", at, m.end()))
        elif anchor == "email":
            start = at
            while start > done["email"] and text[start - 1] in _LOCAL:
                start -= 1
            if start < at and (m := _DOMAIN.match(text, at + 1)):
                done["email"] = m.end()
                out.append(("email", start, m.end()))
        elif anchor == "phone":
            if at >= done["phone"] and (m := _PHONE.match(text, at)):
                done["phone"] = m.end()
                if 10 <= len(_digits_of(m[0])) <= 15:
                    out.append(("phone", at, m.end()))
        elif anchor == "login":
            start = at
            while start > max(done["login"], at - 16) and text[start - 1].isascii() and (
                    text[start - 1].isalnum() or text[start - 1] in "+.-"):
                start -= 1
            if _SCHEME_BEFORE.fullmatch(text, start, at) and (m := _LOGIN.match(text, at)):
                done["login"] = m.end()
                out.append(("login", start, m.end()))
        elif at >= done[anchor] and not text[at - 1:at].isalnum():
            out.extend(_after_cue(text, anchor, last + 1, done, run))
    out.sort(key=lambda s: (s[1], _RANK[s[0]]))
    return out


class _Run:
    """The last run of identifier characters after an account cue, measured once."""

    def __init__(self):
        self.start = self.end = 0   # of the whole run
        self.last = 0               # its end without marks
        self.digits = -1            # where its last four digits start, -1 if it has fewer
        self.sound = True           # no underscore follows ``last``

    def reach(self, text: str, at: int) -> None:
        """Make this the run that holds ``at``."""
        if self.start <= at < self.end:
            return
        self.start, self.end = at, _RUN.match(text, at).end()
        value = text[at:self.end]
        self.last = at + len(value.rstrip("_/+.-"))
        self.sound = text[self.last:self.last + 1] != "_"
        left, i = 4, len(value)
        while left and i:
            i -= 1
            left -= "0" <= value[i] <= "9"
        self.digits = -1 if left else at + i


def _after_cue(text: str, anchor: str, at: int, done: dict[str, int], run: _Run) -> Iterator[tuple[str, int, int]]:
    """The identifier that follows a cue ending at ``at``, if it is a valid one."""
    m = {"iban": _IBAN, "ssn": _SSN, "account": _ACCOUNT}[anchor].match(text, at)
    if not m or m.start(1) == at:  # the cue must stand apart from the identifier
        return
    start, end = m.start(1), m.end(1)
    if anchor == "account":         # the whole run, without marks at its end
        run.reach(text, start)
        end = run.last
        if end - start < 8 or run.digits < start or not run.sound:
            return
    if anchor == "iban" and not _mod97(m[1].replace(" ", "")):
        return
    if start >= done[anchor]:
        done[anchor] = end
        yield anchor, start, end


SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
                                  T.StructField("end", T.LongType())]))
_SPANS_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def _span_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [[{"kind": k, "start": s, "end": e} for k, s, e in find_spans(x.as_py())]
                 for x in batch.column("text")]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, _SPANS_ARROW)],
                                         names=["doc_id", "spans"])


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, spans) for every document; spans is an array of (kind, start, end)."""
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("spans", SPANS)])
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).cast("string").alias("text")).mapInArrow(_span_batches, schema)


def mask(text: str | None, spans: list[tuple[str, int, int]]) -> str | None:
    """The text with each union of overlapping spans replaced by ``[KIND]`` of its first span."""
    if not spans:
        return text
    out, end, until = [], 0, -1
    for kind, s, e in spans:
        if s >= until:
            out += [text[end:s], f"[{kind.upper()}]"]
            end = until = e
        elif e > until:
            end = until = e
    return "".join([*out, text[end:]])


def redact(docs: DataFrame, text_col: str = "text", length_col: str | None = None) -> DataFrame:
    """The same rows and columns with personal data masked; ``length_col`` gets the new length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [mask(t, find_spans(t)) for t in batch.column(text_col).to_pylist()]
            columns = list(batch.columns)
            index = batch.schema.get_field_index
            columns[index(text_col)] = pa.array(texts, batch.schema.field(text_col).type)
            if length_col:
                columns[index(length_col)] = pa.array(
                    [None if t is None else len(t) for t in texts], batch.schema.field(length_col).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(run, docs.schema)
