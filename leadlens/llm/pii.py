"""Personal data spans by patterns, checksums and context, in DataFrame
functions alone.

A pattern puts a marker before and after each of its matches, the text is split
at the markers, and running lengths give the positions (code points, end
exclusive). Checks drop matches that can't be right: parts of an address above
255, a wrong number of digits, a failed Luhn sum, an IBAN that isn't 1 modulo
97. An IBAN is as long as its country says, whatever follows it, and is tried
wherever one can start; other first letters are no country of the registry.
Words near a match raise its score.

Kinds in order: email, ip, card, phone (the base kinds), iban.

Defined cases: a null text counts as empty and has no spans; repeated rows each
get their result; kinds are searched one by one, so spans of different kinds may
overlap; further columns are not read. A text that holds the marker itself is
searched with another character in its place, and positions stay.

Scale: one pass over the texts without a shuffle. Patterns start only where a
run of their characters starts and never give back characters, and an IBAN looks
a bounded way ahead, so very long runs of digits or letters cost linear time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadlens.llm.tables import narrowed

MARK, STAND_IN = "\ue000", "\ue001"
NEAR = 40           # code points of context on each side
_LOCAL, _HOST = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban")
# fixed values: lengths of account numbers by country (ISO 13616, and the countries that use it unregistered)
ACCOUNT_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK",
    21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "AO CV GW LY MZ PT ST", 26: "DZ IR IS TR",
    27: "BI BL CF CG CM DJ FR GA GF GP GQ GR IT KM MC MF MG MQ MR NC PF PM RE SM TD TF WF YT",
    28: "AL AZ BF BJ BY CI CY DO GT HN HU LB MA ML NE NI PL SN SV TG", 29: "BR EG PS QA UA",
    30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
ACCOUNT = "(?:" + "|".join(f"(?:{c.replace(' ', '|')})[0-9]{{2}}(?: ?[A-Z0-9]){{{n - 4}}}"
                           for n, c in ACCOUNT_LENGTHS.items()) + ")(?![A-Za-z0-9])"
REACH = 2 * max(ACCOUNT_LENGTHS) + NEAR      # code points from an account number's start to the end of its context
SHORTEST = 5                                 # from one place where an account number can start to the next
PATTERNS = {
    # a match can start inside a run of local characters only right after another match
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@{_HOST}++(?:\.{_HOST}++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # all runs of digits with single separators, from twelve digits on
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){11,}+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
    # only where it starts: what follows may be part of another one
    "iban": rf"(?=[A-Z]{{2}}[0-9]{{2}})(?<![A-Za-z0-9])(?={ACCOUNT})",
}
HINT = {"email": "@", "phone": "+"}                 # texts without it have no match
SCORE = {"email": 0.9, "ip": 0.5, "card": 0.8, "phone": 0.5, "iban": 0.9}
RAISE = 0.1
# fixed values: words that make a kind likelier nearby
CONTEXT = {
    "email": "mail|contact|kontakt|correo|courriel|write|schreib",
    "ip": "ip|server|host|address|adresse|login|client",
    "card": "card|karte|carte|tarjeta|visa|master|credit|kredit|payment|zahlung",
    "phone": "phone|call|tel|fon|fax|mobile|handy|llam|appel|whatsapp",
    "iban": "iban|bank|account|konto|compte|cuenta|transfer",
}


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substr(digits, i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when((n - i) % 2 == 1, twice).otherwise(d)
    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0


def mod97(iban: Column) -> Column:
    """The account number's remainder, letters counting from A = 10."""
    plain = F.replace(iban, F.lit(" "), F.lit(""))
    turned = F.concat(F.substr(plain, F.lit(5)), F.substr(plain, F.lit(1), F.lit(4)))

    def add(rest: Column, i: Column) -> Column:
        c = F.ascii(F.substr(turned, i, F.lit(1)))
        return F.when(c >= 65, rest * 100 + c - 55).otherwise(rest * 10 + c - 48) % 97
    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), add)


def _holds(kind: str, match: Column) -> Column:
    n = F.length(_digits(match))
    if kind == "ip":
        return F.forall(F.split(match, r"\."),
                        lambda p: p.rlike("^0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    if kind == "card":
        return F.when(n.between(12, 19), luhn(_digits(match))).otherwise(F.lit(False))
    if kind == "phone":
        return n.between(9, 15)
    return F.lit(True)


def _pieces(kind: str, text: Column) -> Column:
    """Text outside and inside of matches in turn (iban: before the first start,
    then from each start to the next); empty if there is none."""
    may = text.contains(HINT[kind]) if kind in HINT else text.rlike(PATTERNS[kind])
    marked = F.regexp_replace(text, PATTERNS[kind], MARK if kind == "iban" else f"{MARK}$0{MARK}")
    return F.when(may, F.split(marked, MARK, -1)).otherwise(F.array().cast("array<string>"))


_SPAN = "struct<start:int,rank:int,kind:string,end:int,score:double>"


def _span(kind: str, start: Column, end: Column, before: Column, after: Column) -> Column:
    around = F.lower(F.concat_ws(" ", F.right(before, F.lit(NEAR)), F.left(after, F.lit(NEAR))))
    score = SCORE[kind] + F.when(around.rlike(CONTEXT[kind]), RAISE).otherwise(0.0)
    return F.struct(start.alias("start"), F.lit(KINDS.index(kind)).alias("rank"), F.lit(kind).alias("kind"),
                    end.alias("end"), score.alias("score")).cast(_SPAN)


def _accounts(pieces: Column) -> Column:
    """Confirmed account numbers, each tried from the start of its piece; the
    first of two that overlap."""
    def joined(start: Column, n: Column, cut) -> Column:
        return F.array_join(F.transform(F.slice(pieces, start, n), lambda p: cut(p, F.lit(REACH))), "")

    def step(acc: Column, piece: Column) -> Column:
        i, start = acc["i"], acc["at"]
        ahead = joined(i + 1, F.lit(REACH // SHORTEST + 1), F.left)
        before = joined(F.greatest(F.lit(1), i + 1 - NEAR // SHORTEST - 1), F.least(i, F.lit(NEAR // SHORTEST + 1)), F.right)
        match = F.regexp_extract(ahead, f"^{ACCOUNT}", 0)
        n = F.length(match)
        holds = (i > 0) & (start >= acc["free"]) & (n > 0) & (mod97(match) == 1)
        span = _span("iban", start, start + n, before, F.substr(ahead, n + 1))
        return F.struct((i + 1).alias("i"), (start + F.length(piece)).alias("at"),
                        F.when(holds, start + n).otherwise(acc["free"]).alias("free"),
                        F.when(holds, F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"]).alias("spans"))
    none = F.struct(F.lit(0).alias("i"), F.lit(0).alias("at"), F.lit(0).alias("free"),
                    F.array().cast(f"array<{_SPAN}>").alias("spans"))
    return F.aggregate(pieces, none, step, lambda acc: acc["spans"])


def _spans(kind: str, pieces: Column) -> Column:
    """Confirmed matches, from the pieces that lie at odd places."""
    if kind == "iban":
        return _accounts(pieces)

    def step(acc: Column, piece: Column) -> Column:
        i, start = acc["i"], acc["at"]
        end = start + F.length(piece)
        span = _span(kind, start, end, F.get(pieces, i - 1), F.get(pieces, i + 1))
        found = F.when((i % 2 == 1) & _holds(kind, piece), F.concat(acc["spans"], F.array(span))
                       ).otherwise(acc["spans"])
        return F.struct((i + 1).alias("i"), end.alias("at"), found.alias("spans"))
    none = F.struct(F.lit(0).alias("i"), F.lit(0).alias("at"),
                    F.array().cast(f"array<{_SPAN}>").alias("spans"))
    return F.aggregate(pieces, none, step, lambda acc: acc["spans"])


def _text_of(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, spans (array of start, rank, kind, end, score), and per kind n_<kind>;
    base and all are the spans of the base kinds and of all kinds as text, scores
    the scores of all in the same order."""
    text = F.translate("__text", MARK, STAND_IN)
    cut = narrowed(docs, id_col, text_col).select(
        F.col("__id").alias("id"), *[_pieces(k, text).alias(k) for k in KINDS])
    found = cut.select("id", *[_spans(k, F.col(k)).alias(k) for k in KINDS])
    return found.select(
        "id", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
        F.array_sort(F.concat(*BASE)).alias("base_spans"),
        F.array_sort(F.concat(*KINDS)).alias("spans"),
    ).select("id", *[f"n_{k}" for k in KINDS], "spans", _text_of(F.col("base_spans")).alias("base"),
             _text_of(F.col("spans")).alias("all"),
             F.array_join(F.transform("spans", lambda s: F.format_number(s["score"], 1)), ",").alias("scores"))
