"""Personal data by patterns, validators and context (operator 10). DataFrame functions only.

Patterns propose spans, leftmost and without overlap within a kind; validators confirm them: an ip has parts of at
most 255, a card 12 to 19 digits that pass Luhn, a phone 9 to 15 digits, an iban passes mod 97. A proposal that fails
is dropped and not tried again shorter. An iban has its country's length, so what follows a blank is never part of it; only a
country code that is not in `IBAN_LENGTHS` takes in all that may belong to it. Each confirmed span has a score: a prior of its kind, plus `NEAR` if one of the kind's
context words stands within `REACH` characters before or after it, but not beyond the next proposal of its kind, at most 1. An iban is reported from a score of 0.5 on;
the four base kinds whatever their score.

Patterns are written with possessive repeats and may start inside a run of their characters only where the match before
ended, so that no text, however long, makes them go over a run twice. Positions are code points; they are running sums of the
lengths of the matches and of the pieces that `split` leaves between them, taken by blocks of `BLOCK` matches: the time
of a text grows with its length, whatever it holds.

Scale: one row in, one row out, no shuffle. Texts without the character a kind needs are not searched for it.

Edge cases: a null text is empty and has no spans (counts 0, the digest of the empty string, an empty list). Rows
that share an id are searched each by itself. An empty table gives an empty result. Other columns are never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orestrata.llm.line_rules import let

NEAR = 0.3
REACH = 40
THRESHOLD = 0.5
KINDS = ["email", "ip", "card", "phone", "iban"]
BASE = KINDS[:4]

# How long the ibans of each country are.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE",
    31: "MT SC", 32: "LC", 33: "RU",
}
_COUNTRIES = f"(?:{'|'.join('|'.join(codes.split()) for codes in IBAN_LENGTHS.values())})"
_IBANS = "|".join(rf"(?:{codes.replace(' ', '|')})[0-9]{{2}}(?:\x20?[A-Z0-9]){{{n - 4}}}" for n, codes in IBAN_LENGTHS.items())
_OTHER_IBANS = rf"(?!{_COUNTRIES})[A-Z]{{2}}[0-9]{{2}}(?:(?:\x20(?!{_COUNTRIES}[0-9]{{2}}))?[A-Z0-9]){{11,30}}+"

# What each kind looks like. \G lets a match begin where the one before ended.
_LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": rf"(?<![A-Za-z0-9])(?=[A-Z]{{2}}[0-9]{{2}})(?:{_IBANS}|{_OTHER_IBANS})(?![A-Za-z0-9])",
}
# A text is searched for a kind only if it matches this.
_NEEDED = {"email": "@", "phone": "+"}
_PRIOR = {"email": 0.7, "ip": 0.5, "card": 0.6, "phone": 0.5, "iban": 0.7}
# Context words, in lower case.
CONTEXT = {
    "email": ["mail", "contact", "write", "correo", "courriel"],
    "ip": ["ip", "server", "host", "address", "serveur"],
    "card": ["card", "visa", "credit", "karte", "carte", "tarjeta"],
    "phone": ["phone", "tel", "call", "mobile", "fax", "anruf", "llame"],
    "iban": ["iban", "account", "bank", "konto", "compte", "cuenta"],
}


def _digits(span: Column) -> Column:
    return F.regexp_replace(span, "[^0-9]", "")


def _luhn(span: Column) -> Column:
    """Every second digit from the right doubled, nine taken off above nine; the sum ends in 0."""

    def summed(digits: Column) -> Column:
        values = F.transform(F.split(F.reverse(digits), ""), lambda d, i: _doubled(d.cast("int"), i))
        return F.aggregate(values, F.lit(0), lambda s, x: s + F.coalesce(x, F.lit(0))) % 10 == 0

    return let(_digits(span), summed)


def _doubled(digit: Column, place: Column) -> Column:
    return F.when(place % 2 == 0, digit).when(digit > 4, digit * 2 - 9).otherwise(digit * 2)


def _mod97(span: Column) -> Column:
    """The first four characters moved to the end, letters as 10 to 35; the number leaves 1."""

    def remainder(code: Column) -> Column:
        turned = F.concat(F.substring(code, 5, 40), F.substring(code, 1, 4))

        def step(rest: Column, c: Column) -> Column:
            value = F.when(c.between("0", "9"), F.ascii(c) - 48).otherwise(F.ascii(c) - 55)
            return F.when(c == "", rest).otherwise((rest * F.when(value < 10, 10).otherwise(100) + value) % 97)

        return F.aggregate(F.split(turned, ""), F.lit(0), step) == 1

    return let(F.regexp_replace(span, " ", ""), remainder)


def _valid(kind: str, span: Column) -> Column:
    size = F.length(_digits(span))
    if kind == "ip":
        # Parts may be longer than any number type.
        return F.forall(F.split(span, r"\."), lambda p: F.coalesce(F.regexp_replace(p, "^0+(?=.)", "").try_cast("int") <= 255, F.lit(False)))
    if kind == "card":
        return size.between(12, 19) & _luhn(span)
    if kind == "phone":
        return size.between(9, 15)
    if kind == "iban":
        return F.length(F.regexp_replace(span, " ", "")).between(15, 34) & _mod97(span)
    return F.lit(True)


BLOCK = 128
_FOUND = "array<struct<start:int,end:int,m:string,g:string,h:string>>"
_SPAN = "array<struct<start:int,end:int,kind:string,order:int,score:double>>"


def _spans(kind: str, text: Column) -> Column:
    """All confirmed spans of a kind in a text."""
    pattern = PATTERNS[kind]

    def placed(found: Column) -> Column:
        return let(F.split(text, pattern, -1), lambda gaps: within(gaps, found))

    def within(gaps: Column, found: Column) -> Column:
        """Matches between the gaps around them; the last element is the gap behind the last match."""
        pairs = F.zip_with(gaps, found, lambda g, m: F.struct(g.alias("g"), m.alias("m")))
        behind = F.slice(gaps, F.lit(2), F.size(gaps))
        return let(F.zip_with(pairs, behind, lambda x, h: F.struct(x["g"].alias("g"), x["m"].alias("m"), h.alias("h"))), counted)

    def counted(parts: Column) -> Column:
        """Positions are running sums. They are taken by blocks of matches, so that no long array is copied for each match."""
        size = lambda x: F.coalesce(F.length(x["g"]), F.lit(0)) + F.coalesce(F.length(x["m"]), F.lit(0))
        block = lambda c: F.slice(parts, c * BLOCK + 1, F.lit(BLOCK))
        numbers = F.sequence(F.lit(0), F.floor((F.size(parts) - 1) / BLOCK).cast("int"))
        totals = F.transform(numbers, lambda c: F.aggregate(block(c), F.lit(0), lambda n, x: n + size(x)))
        none = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("all"))
        begins = F.aggregate(
            totals, none, lambda n, x: F.struct((n["at"] + x).alias("at"), F.array_append(n["all"], n["at"]).alias("all")), lambda n: n["all"]
        )

        def spans_of(begin: Column, number: Column) -> Column:
            start = F.struct(begin.alias("at"), F.array().cast(_FOUND).alias("all"))

            def add(state: Column, x: Column) -> Column:
                first = state["at"] + F.coalesce(F.length(x["g"]), F.lit(0))
                end = first + F.coalesce(F.length(x["m"]), F.lit(0))
                span = F.struct(first.alias("start"), end.alias("end"), x["m"].alias("m"), x["g"].alias("g"), x["h"].alias("h"))
                every = F.when(x["m"].isNull() | ~_valid(kind, x["m"]), state["all"]).otherwise(F.array_append(state["all"], span))
                return F.struct(end.alias("at"), every.alias("all"))

            return F.aggregate(block(number), start, add, lambda state: state["all"])

        return F.transform(F.flatten(F.transform(begins, spans_of)), scored)

    def scored(s: Column) -> Column:
        near = F.lower(F.concat(F.right(s["g"], F.lit(REACH)), F.lit(" "), F.substring(F.coalesce(s["h"], F.lit("")), 1, REACH)))
        hit = F.exists(F.array(*[F.lit(w) for w in CONTEXT[kind]]), lambda w: F.contains(near, w))
        score = F.least(F.lit(1.0), F.lit(_PRIOR[kind]) + F.when(hit, NEAR).otherwise(0.0))
        return F.struct(
            s["start"].alias("start"), s["end"].alias("end"), F.lit(kind).alias("kind"), F.lit(KINDS.index(kind)).alias("order"), score.alias("score")
        )

    needed = _NEEDED.get(kind)
    seen = F.contains(text, F.lit(needed)) if needed else text.rlike("[0-9]")
    found = let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), placed)
    if kind not in BASE:
        found = F.filter(found, lambda s: s["score"] >= THRESHOLD)
    return F.when(seen, found.cast(_SPAN)).otherwise(F.array().cast(_SPAN))


def found(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each row of `docs`: id_col, found: an array of (start, end, kind, order, score), by start, then kind."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    # Bound once: each kind's search is evaluated over the same string.
    every = let(text, lambda t: F.flatten(F.array(*[_spans(kind, t) for kind in KINDS])))
    key = lambda s: F.struct(s["start"].alias("a"), s["order"].alias("b"))
    spans = F.array_sort(
        every, lambda x, y: F.when(key(x) < key(y), F.lit(-1)).when(key(x) > key(y), F.lit(1)).otherwise(F.lit(0))
    )
    return docs.select(F.col(id_col), F.when(F.size(every) > 1, spans).otherwise(every).alias("found"))


def joined(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redacted(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind in brackets; of overlapping spans the first one counts."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def add(state: Column, s: Column) -> Column:
        piece = F.concat(state["out"], F.substring(text, state["at"] + 1, s["start"] - state["at"]), F.lit("["), s["kind"], F.lit("]"))
        return F.when(s["start"] < state["at"], state).otherwise(F.struct(s["end"].alias("at"), piece.alias("out")))

    tail = lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.length(text)))
    return F.aggregate(spans, start, add, tail)
