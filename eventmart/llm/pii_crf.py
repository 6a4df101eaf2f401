"""Personal data: fixed patterns, and a sequence model over the shapes of words.

Base spans come from four patterns. A linear-chain conditional random field adds spans that
they miss, such as numbers written in groups of words, addresses with the signs spelled out,
or numbers without a country code.

The model is trained on the small labelled table below, whose rows are sentences with marked
spans, and decoded by Viterbi in numpy batches over the whole texts; words that belong to no
span whatever stands around them part a text into short runs.

Defined cases: a null text counts as empty; rows are independent of each other, so repeated
rows give equal results; extra columns pass through, but for those named like added columns,
which are replaced. Texts are read whole.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.llm import crf
from eventmart.llm.textops import Texts, hash_ranges, per_chunk

# The base patterns.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
KINDS = ("email", "ip", "card", "phone")

LABELS = ("O", "phone", "email", "ip", "card", "ident")

# The labelled table: spans in brackets, with their label.
EXAMPLES = """
Please call [phone 555-203-8841] after noon .
my number is [phone (415) 555-0132] today
Call me at [phone 0171 5550 123] , thanks .
reach the office on [phone 555.867.5309] or write
tel : [phone 01 70 36 39 21]
Telefon [phone 030-5550-1122] abends
phone [phone 202-555-0147] ext 4
cell [phone 917 555 0192] only in the evening
mobile : [phone 0049 151 5550 4432]
Llame al [phone 91 555 01 23] por la tarde
write to [email jane.roe at example dot org] soon
mail : [email bob (at) mail dot net]
e-mail [email ann[at]corp[dot]com] for more
reach me under [email tom(at)firm(dot)com] please
[email office[at]uni[dot]edu] is read daily
they gave [email lea.sol[at]web[dot]fr] as well
for example [email max(at)haus(dot)de] said no
and then [email k_lee[AT]lab[DOT]org] , of course
contact [email sales at shop dot co dot uk] today
mail [email info@localhost] now
send it to [email kim AT post DOT de] please
reach me at [phone 917 555 0192] tonight
you can ring us on [phone 020 7946 0018] before six
Rufen Sie [phone 030 5550 1122] an
bitte [phone 0171 555 0123] anrufen oder schreiben
unter [phone 0221-5550-987] sind wir da
appelez le [phone 06 12 34 56 78] ce soir
au [phone 01 42 68 53 00] , merci
mi número es [phone 600 555 012]
su teléfono , [phone 93 555 01 77] , no responde
she left [phone 646-555-0170] on the desk
text [phone 312.555.0111] if late
it is [phone (212) 555-0199] , ask for Ann
fax [phone 0044 20 7946 0999] or mail
his cell was [phone 5035550144] then
ask for room service at [phone 808 555 0110] now
schreib an [email eva at web punkt de] bitte
send the file to [email lee AT work DOT com] today
write [email ana at correo punto es] or call
adresse [email luc at poste point fr] merci
to [email pat (at) site (dot) org] only
mine is [email joe_b at mail dot com] , thanks
forward it to [email hr at firm dot co dot uk] please
[email sam AT home DOT net] is mine
or ask [email kai[at]dorf[dot]de] about it
her address [email mia(at)post(dot)at] works
from [email root@intranet] at night
server [ip 10.0.0.17] answered
host [ip 192.168.4.20] is down
from [ip 172.16.254.1] to [ip 10.1.2.3] again
card [card 4111 1111 1111 1111] was charged
paid with [card 5500-0000-0000-0004] yesterday
Visa [card 4012888888881881] expired
the number 4111 was on [card 4929 1234 5678 9015] too
charge [card 3714 496353 98431] please
his card [card 6011-1111-1111-1117] was lost
Mastercard [card 5105105105105100] , valid to 2030
my SSN is [ident 078-05-1120] , keep it safe
social security [ident 219-09-9999] on file
ssn : [ident 123-45-6789]
number [ident 321-54-9876] on his card
her social is [ident 457-55-5462]
we met at dot com times , at point zero
look at the dot on the map
at 9 am the 3 trains leave from 2 stations
in 2019 2020 and 2021 sales fell
call me at 9 or write at 10
order 4500 123 of 12 May 1999
the card game has 52 cards
number 7 beat number 12
He said 20 30 or 40 is fine
pages 101 - 140 of volume 3
sum of 1200 300 45 and 6
tel quel , il reste 3 jours
In 1998 the price rose by 14 percent .
It took 3 days and 12 hours in 2004 .
page 12 of 240
The score was 3 - 2 after 90 minutes .
version 2.0.1 was released on 2021-05-17
He paid 12.50 for 3 books in 1987 .
chapter 4 , section 2.1 , figure 7
between 1914 and 1918 some 9,000,000 people
at 10:30 on 5 May 2003
born 1956 - died 2011
room 404 on floor 4
1 2 3 4 5 6 7 8 9 10
it weighs 1,250 kg and costs 3,499 EUR
12 % of 300 voters
Route 66 and Highway 101
see [1] and [2] for more
Order 20391 was sent on 03/04/2020 .
ISBN 978-3-16-148410-0 is in print
between 10 and 20 at most 30 or 40
follow @someone and @other for news
a1 b2 c3 d4 e5
he met 4 at 5 and 6 at 7
the year 2020 at dot matrix 12
item 100 200 300 400
license 2.0 , see section 4
commit 9f2c1ab fixed bug 1023
x = 12 ; y = 34 ;
40.7128 , -74.0060
3.14159 and 2.71828
"""

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_EXAMPLE = re.compile(r"\[(" + "|".join(LABELS[1:]) + r") ((?:\[[A-Za-z]+\]|[^\]])*)\]")

# Feature groups: shape of the word, of both neighbours, digits of the word and of the number it
# is in, whether it is a hint word, and a hint word shortly before.
_SHAPES = (
    "none", "word", "at", "dot", "digits1", "digits2", "digits3", "digits4", "digits5",
    "digits9", "groups-", "groups.", "ip", "paren", "mixed", "atsign", "mark", "plus", "other", "glued",
)
_HINTS = (
    ("phone", {"call", "number", "phone", "tel", "telefon", "cell", "mobile", "fax", "office",
               "llame", "reach", "appelez"}),
    ("mail", {"mail", "e-mail", "email", "write", "contact", "send"}),
    ("ssn", {"ssn", "social", "security"}),
    ("card", {"card", "visa", "mastercard", "paid"}),
    ("host", {"server", "host", "ip"}),
    ("ref", {"page", "chapter", "section", "version", "isbn", "figure", "year", "order", "item"}),
)
_COUNTS = (0, 1, 2, 3, 4, 5, 7, 9, 10, 11, 12, 13, 17)
#: Shapes that go on a number which is written in several words.
_NUMERIC = [k for k, s in enumerate(_SHAPES) if s.startswith(("digits", "groups", "paren", "plus"))]
_GROUPS = (len(_SHAPES),) * 3 + (len(_COUNTS) + 1,) * 2 + (len(_HINTS) + 1,) * 2
_BASES = np.concatenate([[0], np.cumsum(_GROUPS)[:-1]])
N_FEATURES = sum(_GROUPS)

_STRIP = ".,;:!?\"'"
_SPELLED_SIGNS = {w: _SHAPES.index("at") for w in ("at", "AT")} | {
    w: _SHAPES.index("dot") for w in ("dot", "DOT", "punkt", "punto", "point")
}
_RULES = [
    (re.compile(p), s)
    for p, s in (
        (r"\d{1,3}(?:\.\d{1,3}){3}", "ip"),
        (r"\d", "digits1"),
        (r"\d\d", "digits2"),
        (r"\d{3}", "digits3"),
        (r"\d{4}", "digits4"),
        (r"\d{5,8}", "digits5"),
        (r"\d{9,}", "digits9"),
        (r"\(\d+\)", "paren"),
        (r"\d+(?:-\d+)+", "groups-"),
        (r"\d+(?:\.\d+)+", "groups."),
        (r"\+\d[\d-]*", "plus"),
        (r"[^@]+@[^@]+", "atsign"),
        (r"[(\[]?(?:at|AT)[)\]]?", "at"),
        (r"[(\[]?(?:dot|DOT|punkt|punto|point)[)\]]?", "dot"),
        (r"[^\w\s]+", "mark"),
        (r"[^\W\d_]+(?:['-][^\W\d_]+)*", "word"),
        (r"(?i).+[(\[]at[)\]].+", "glued"),
        (r"(?=.*\d)(?=.*[^\W\d_]).+", "mixed"),
    )
]


def _shape(word: str) -> int:
    core = word.strip(_STRIP) or word
    if core.isalpha():
        return _SPELLED_SIGNS.get(core, _SHAPES.index("word"))
    for rule, name in _RULES:
        if rule.fullmatch(core):
            return _SHAPES.index(name)
    return _SHAPES.index("other")


_HINTED = {word: k for k, (_, words) in enumerate(_HINTS, 1) for word in words}


def _hint(word: str) -> int:
    return _HINTED.get(word.strip(_STRIP + "()").lower(), 0)


class Shapes:
    """Shape, hint and number of digits of words; words seen before are looked up."""

    def __init__(self):
        self.known: dict[str, tuple[int, int, int]] = {}

    def of(self, word: str) -> tuple[int, int, int]:
        if (found := self.known.get(word)) is None:
            if len(self.known) > 200_000:
                self.known.clear()
            digits = 0 if word.isalpha() else sum(c.isdigit() for c in word)
            found = _shape(word), _hint(word), digits
            self.known[word] = found
        return found

    def of_texts(self, texts: Texts, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """One row for each word; equal words are looked at once."""
        data = texts.data.tobytes()
        hashes = hash_ranges(texts.data, starts, ends)
        _, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        places = zip(starts[first].tolist(), ends[first].tolist(), strict=True)
        found = [self.of(data[a:b].decode()) for a, b in places]
        return np.array(found, np.int64).reshape(-1, 3)[which]


def features_of(found: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Features of words from their shapes and those of their neighbours in a sequence."""
    some = np.diff(offsets) > 0
    first, last = np.zeros((2, len(found)), bool)
    first[offsets[:-1][some]] = True
    last[offsets[1:][some] - 1] = True
    shape, hint, digits = found.T
    before, after = np.roll(shape, 1), np.roll(shape, -1)
    before[first], after[last] = 0, 0
    near = [np.roll(hint, 1), np.roll(hint, 2)]
    near[0][first] = 0
    near[1][first | np.roll(first, 1)] = 0
    hinted = np.where(near[0] > 0, near[0], near[1])
    # digits of a number that is written in several words
    numeric = np.isin(shape, _NUMERIC)
    fresh = first | ~numeric | ~np.roll(numeric, 1)
    run = np.cumsum(fresh) - 1
    whole = np.bincount(run, digits * numeric).astype(np.int64)[run] if len(run) else digits
    count, total = (np.searchsorted(_COUNTS, c, "right") for c in (digits, whole))
    return np.stack([shape, before, after, count, total, hint, hinted], 1) + _BASES


def labelled(table: str = EXAMPLES) -> tuple[list[list[str]], list[list[int]]]:
    """Words and labels of each row."""
    words, labels = [], []
    for line in table.strip().splitlines():
        row, at = ([], []), 0
        for m in [*_EXAMPLE.finditer(line), None]:
            for w in _WORD.findall(line[at : m.start() if m else len(line)]):
                row[0].append(w)
                row[1].append(0)
            if m:
                inner = _WORD.findall(m[2])
                row[0].extend(inner)
                row[1].extend([LABELS.index(m[1])] * len(inner))
                at = m.end()
        words.append(row[0])
        labels.append(row[1])
    return words, labels


def train(table: str = EXAMPLES) -> crf.Crf:
    words, labels = labelled(table)
    offsets = np.concatenate([[0], np.cumsum([len(w) for w in words])])
    shapes = Shapes()
    found = np.array([shapes.of(w) for row in words for w in row], np.int64).reshape(-1, 3)
    features = features_of(found, offsets)
    flat = np.array([x for row in labels for x in row], np.int64)
    return crf.fit(features, offsets, flat, N_FEATURES, len(LABELS), steps=300, ridge=5e-4)


def _luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


_DIGIT = re.compile(r"[0-9]")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the base patterns, by kind and then start."""
    out = []
    if "@" in text:
        out += [("email", *m.span()) for m in EMAIL.finditer(text)]
    if not _DIGIT.search(text):
        return out
    for m in IP.finditer(text):
        if all(int(p) <= 255 if len(p) < 9 else not p.strip("0") or int(p[-18:]) <= 255 and not p[:-18].strip("0") for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and _luhn(digits):
                out.append(("card", *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= len(_DIGIT.findall(m[0])) <= 15:
                out.append(("phone", *m.span()))
    return out


_SPELLED = re.compile(r"(?i)\bat\b.*\b(?:dot|punkt|punto|point)\b")


def _likely(kind: str, value: str) -> bool:
    """Bounds that a span of the model has to meet."""
    digits = len(_DIGIT.findall(value))
    if kind == "phone":
        return 9 <= digits <= 15
    if kind == "card":
        return 13 <= digits <= 19 and _luhn("".join(_DIGIT.findall(value)))
    if kind == "ident":
        return digits == 9
    if kind == "ip":
        return re.search(r"\d+\.\d+\.\d+\.\d+", value) is not None
    return "@" in value or _SPELLED.search(value) is not None


def model_spans(texts: Texts, model: crf.Crf, shapes: Shapes) -> list[list[tuple[str, int, int]]]:
    """Spans of the model for each text, in code points."""
    out: list[list[tuple[str, int, int]]] = [[] for _ in range(texts.n)]
    starts, ends, text = texts.words()
    if not len(starts):
        return out
    data = texts.data.tobytes()
    offsets = np.searchsorted(text, np.arange(texts.n + 1), "left")
    features = features_of(shapes.of_texts(texts, starts, ends), offsets)
    labels = model.decode_sparse(features, offsets)
    new = np.ones(len(labels), bool)
    new[1:] = (labels[1:] != labels[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(labels)) - 1
    points = np.zeros(len(texts.data) + 1, np.int64)
    np.cumsum((texts.data & 0xC0) != 0x80, out=points[1:])
    for a, b in zip(first[labels[first] > 0].tolist(), last[labels[first] > 0].tolist(), strict=True):
        kind, lo, hi = LABELS[labels[a]], int(starts[a]), int(ends[b])
        value = data[lo:hi].decode()
        stripped = value.strip(_STRIP)
        lo += len(value[: len(value) - len(value.lstrip(_STRIP))].encode())
        hi = lo + len(stripped.encode())
        if stripped and _likely(kind, stripped):
            base = points[texts.offsets[text[a]]]
            out[text[a]].append((f"{kind}_like", int(points[lo] - base), int(points[hi] - base)))
    return out


_SPANS = pa.list_(
    pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
)
_TYPE = "array<struct<kind:string,start:bigint,end:bigint>>"


def scan(docs: DataFrame, text: str = "text", table: str = EXAMPLES) -> DataFrame:
    """``docs`` with ``base_spans`` and ``spans``: arrays of (kind, start, end), in code
    points, end exclusive, by kind and then start. Spans of the model have the kinds
    phone_like, email_like, ip_like, card_like and ident_like; one that overlaps a base span
    is left out."""
    model = train(table)
    carried = [f for f in docs.schema.fields if f.name.lower() not in ("base_spans", "spans")]
    keep = [f.name for f in carried]
    schema = ", ".join(
        [f"`{f.name}` {f.dataType.simpleString()}" for f in carried]
        + [f"base_spans {_TYPE}", f"spans {_TYPE}"]
    )
    kinds = (*KINDS, *[f"{k}_like" for k in LABELS[1:]])

    def named(found):
        return [dict(zip(("kind", "start", "end"), s, strict=True)) for s in found]

    def run(batches):
        shapes = Shapes()

        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            column = batch.column(text)
            base = [base_spans(t or "") for t in column.to_pylist()]
            more = model_spans(Texts(column), model, shapes)
            whole = [
                b + [s for s in m if not any(x[1] < s[2] and s[1] < x[2] for x in b)]
                for b, m in zip(base, more, strict=True)
            ]
            whole = [sorted(w, key=lambda s: (kinds.index(s[0]), s[1])) for w in whole]
            columns = {c: batch.column(c) for c in keep}
            columns["base_spans"] = pa.array([named(b) for b in base], _SPANS)
            columns["spans"] = pa.array([named(w) for w in whole], _SPANS)
            return pa.RecordBatch.from_pydict(columns)

        yield from per_chunk(each, text)(batches)

    wanted = docs.select(*[F.col(f"`{c}`") for c in keep])
    return wanted.mapInArrow(run, schema)
