"""Personal data in whole texts: patterns propose, checksums confirm, context words adjust the score.

Kinds, in order: email, ip, card, phone (the base kinds) and iban, ssn (added by the method). Matches
are leftmost and do not overlap within a kind; positions are code points, the end exclusive.
ip parts are at most 255, card numbers have 13 to 19 digits and pass Luhn, phones have 9 to 15
digits, ibans pass mod-97, an ssn counts only with a context word nearby. A failing match is dropped
without another try. Every span has a score (0 to 100): a value for its kind, raised when one of the
kind's context words stands within ``WINDOW`` code points before or after it.

DataFrame functions only. A pattern's spans come from its matches and from the pieces between them
(``split`` by the same pattern): running lengths over both, summed in runs, give the positions, and windows are
looked up in short leaves of the text; both only for texts that match. Runs are possessive and start at a run's
first character, so the work is linear in very long texts, with many matches too.

Defined results: a null or empty text has no spans (counts 0, empty strings, the hash of the empty
string); null ids and repeated rows are kept row by row; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.binding import let
from .common import ascii_lower

# --- fixed values: patterns. A run may begin where the match before it ended or where no run character precedes.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?:\x20[A-Z0-9]{4}){2,7}(?:\x20[A-Z0-9]{1,3})?)",
    "ssn": r"(?:\G|(?<![0-9]))[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9])",
}
BASE = ("email", "ip", "card", "phone")
KINDS = tuple(PATTERNS)

# --- fixed values: score of a confirmed span, rise by context, and the context words (lower case)
SCORES = {"email": (60, 20), "ip": (50, 20), "card": (80, 15), "phone": (50, 20), "iban": (90, 5), "ssn": (40, 40)}
CONTEXT = {
    "email": ("mail", "contact", "correo", "courriel", "kontakt"),
    "ip": ("ip", "server", "host", "address", "adresse"),
    "card": ("card", "visa", "mastercard", "credit", "karte", "tarjeta", "carte"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "handy"),
    "iban": ("iban", "account", "bank", "konto", "cuenta", "compte"),
    "ssn": ("ssn", "social security", "sozialversicherung", "seguridad social"),
}
NEEDS_CONTEXT = ("ssn",)
WINDOW = 40
LEAF = 256  # code points of the pieces in which a window is looked up, at least ``WINDOW``
RUN = 64  # matches whose positions are summed at once

_IP_PART = r"0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])"
_SPANS = "array<struct<s:int,e:int,score:int>>"


def digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the Luhn checksum."""
    def step(total: Column, c: Column, i: Column) -> Column:
        d = c.cast("int") * F.when(i % 2 == 1, 2).otherwise(1)
        return total + d - F.when(d > 9, 9).otherwise(0)

    back = F.transform(F.split(F.reverse(number), ""), lambda c, i: F.struct(c.alias("c"), i.alias("i")))
    return F.aggregate(back, F.lit(0), lambda a, x: step(a, x["c"], x["i"])) % 10 == 0


def mod97(iban: Column) -> Column:
    """Whether an account number without spaces passes the mod-97 checksum."""
    turned = F.concat(F.substring(iban, 5, 64), F.substring(iban, 1, 4))
    value = lambda c: F.when(c.rlike("[0-9]"), F.ascii(c) - 48).otherwise(F.ascii(c) - 55)
    return F.aggregate(F.split(turned, ""), F.lit(0), lambda a, c: F.when(
        value(c) > 9, (a * 100 + value(c)) % 97).otherwise((a * 10 + value(c)) % 97)) == 1


def confirmed(kind: str, match: Column) -> Column:
    if kind == "ip":
        return match.rlike(rf"^{_IP_PART}(?:\.{_IP_PART}){{3}}$")
    if kind == "card":
        return let(digits(match), lambda d: F.length(d).between(13, 19) & luhn(d))
    if kind == "phone":
        return F.length(digits(match)).between(9, 15)
    if kind == "iban":
        return let(F.replace(match, F.lit(" "), F.lit("")), lambda m: F.length(m).between(15, 34) & mod97(m))
    return F.lit(True)


def _sums(sizes: Column, levels: int = 2) -> Column:
    """For every element the sum of those before it. Sums are built by runs of ``RUN``, and those of the runs
    likewise, so that no step copies a list that grows with the text."""
    def fold(xs: Column, first: Column) -> Column:
        start = F.struct(first.cast("int").alias("at"), F.array().cast("array<int>").alias("all"))
        return F.aggregate(xs, start, lambda acc, x: F.struct(
            (acc["at"] + x).alias("at"), F.concat(acc["all"], F.array(acc["at"])).alias("all")), lambda acc: acc["all"])

    def runs_of(xs: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.greatest(F.size(xs), F.lit(1)), F.lit(RUN)),
                           lambda i: F.slice(xs, i, F.lit(RUN)))

    if not levels:
        return fold(sizes, F.lit(0))
    return let(let(sizes, runs_of), lambda runs: let(
        _sums(F.transform(runs, lambda r: F.aggregate(r, F.lit(0), lambda t, x: t + x)), levels - 1),
        lambda before: F.flatten(F.zip_with(runs, before, fold))))


def _part(leaves: Column, start: Column, n: Column) -> Column:
    """Up to n (at most ``LEAF``) code points from a position, out of the text's leaves: not found by walking the whole text."""
    leaf = F.floor(start / LEAF).cast("int")
    return F.substring(F.concat_ws("", F.get(leaves, leaf), F.get(leaves, leaf + 1)), (start - leaf * LEAF + 1).cast("int"), n.cast("int"))


def _near(kind: str, leaves: Column, start: Column, end: Column) -> Column:
    """Whether a context word stands in the window before or after the span."""
    before = _part(leaves, F.greatest(start - WINDOW, F.lit(0)), F.least(start, F.lit(WINDOW)))
    return ascii_lower(F.concat(before, F.lit("\n"), _part(leaves, end, F.lit(WINDOW)))).rlike("|".join(CONTEXT[kind]))


def spans_of(kind: str, text: Column) -> Column:
    """Array of (s, e, score) of one kind; null where the text has no match."""
    pattern, (least, rise) = PATTERNS[kind], SCORES[kind]

    def located(matches: Column) -> Column:
        # a match and what stands between it and the one before; the last piece has no match after it
        pairs = F.slice(F.arrays_zip(F.split(text, pattern, -1).alias("between"), matches.alias("match")),
                        F.lit(1), F.size(matches))
        sized = F.transform(pairs, lambda x: F.struct(
            x["match"].alias("match"), F.length(x["between"]).alias("gap"), F.length(x["match"]).alias("n")))
        return let(sized, lambda xs: F.zip_with(
            xs, _sums(F.transform(xs, lambda x: x["gap"] + x["n"])), lambda x, before: F.struct(
                x["match"].alias("match"), (before + x["gap"]).alias("s"), (before + x["gap"] + x["n"]).alias("e"))))

    def scored(spans: Column, leaves: Column) -> Column:
        told = F.transform(spans, lambda x: F.struct(
            x["s"].alias("s"), x["e"].alias("e"), _near(kind, leaves, x["s"], x["e"]).alias("near")))
        if kind in NEEDS_CONTEXT:
            told = F.filter(told, lambda x: x["near"])
        return F.transform(told, lambda x: F.struct(
            x["s"].alias("s"), x["e"].alias("e"), (F.lit(least) + F.when(x["near"], rise).otherwise(0)).cast("int").alias("score")))

    def walk(matches: Column) -> Column:
        spans = F.filter(located(matches), lambda x: confirmed(kind, x["match"]))
        leaves = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{LEAF}}}"), F.lit(0))
        return F.when(F.size(matches) > 0, let(spans, lambda xs: F.when(
            F.size(xs) > 0, let(leaves, lambda ls: scored(xs, ls)))))

    proposed = let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), walk)
    sign = {"email": "@", "phone": "+"}.get(kind)
    return F.when(text.contains(sign), proposed) if sign else proposed


def find_pii(docs: DataFrame, text: str = "text") -> DataFrame:
    """Per row: doc_id and one array of (s, e, score) per kind (empty when there is none)."""
    t = F.coalesce(F.col(text), F.lit(""))
    none = F.array().cast(_SPANS)
    return docs.select("doc_id", *[F.coalesce(spans_of(k, t), none).alias(k) for k in KINDS])


def span_text(kinds, scored: bool = False) -> Column:
    """kind:start:end of all spans by kind, then start, comma-joined."""
    def show(kind: str) -> Column:
        return F.transform(F.col(kind), lambda x: F.concat_ws(
            ":", F.lit(kind), x["s"].cast("string"), x["e"].cast("string"),
            *([x["score"].cast("string")] if scored else [])))

    return F.array_join(F.concat(*[show(k) for k in kinds]), ",")


def pii_digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_<kind> per kind, base_sha256 (over the base kinds), spans, scored (spans with score)."""
    found = find_pii(docs)
    return found.select(
        "doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(span_text(BASE), 256).alias("base_sha256"), span_text(KINDS).alias("spans"),
        span_text(KINDS, scored=True).alias("scored"))
