"""Personal data by pattern, checksum and context, as DataFrame functions only.

Patterns propose spans, one pass over the text for each. A pass puts a control character around
each match and splits there, so that matches and the text between them alternate in an array and
the places follow from running lengths: no shuffle, no Python, and a text without the pattern's
rarest character is not searched at all. Validators decide what counts: parts of an address up to
255, Luhn's check for cards, the remainder 97 for account numbers, the number of digits for phones.
Words near a span raise its score or lower it.

Base spans (`base` true) are matches of the four given patterns that their validator confirms,
leftmost and not overlapping within a kind; they stay whatever their score. Added spans need a
score of `LEAST`: account numbers (`iban`) with the right remainder; cards that stand next to
other digits, so that the base pattern takes both for one number; and phone numbers without a
country code where a word nearby speaks of one.

Patterns are written so that a long run of letters or digits is looked at once: a run that can't
match is entered at its start only, and repeated groups give nothing back.

Defined cases: a null text is empty; an empty text has no spans; repeated rows are texts of their
own; places are code points; U+0001 in a text counts as any other character outside of patterns;
other columns are kept, or ignored by the digest query.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketspark.llm.common import fresh

KINDS = ("email", "ip", "card", "phone", "iban")
BASE = KINDS[:4]
#: The score that an added span needs, and code points on each side in which words count as near.
LEAST = 0.5
NEAR = 40

EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
#: A phone with its country code, or one without, which never holds a plus and so takes no place from the others.
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]|(?<![0-9+(.-])(?:\([0-9]{3}\)|[0-9]{3})[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9-])"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
#: A card as one run or in groups of four, within a longer row of digits.
CARD_ALONE = r"(?<![0-9])(?:[0-9]{14,19}|[0-9]{4}([\x20-])[0-9]{4}\1[0-9]{4}\1[0-9]{4})(?![0-9])"

_PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
_IP_PARTS = rf"^{_PART}(?:\.{_PART}){{3}}$"

#: Fixed words: what speaks for a kind, and what speaks against any.
FOR = {
    "email": r"(?i)\b(e-?mail|mail|contact|write|courriel|correo)\b",
    "ip": r"(?i)\b(ip|address|host|server|login|adresse)\b",
    "card": r"(?i)\b(card|visa|mastercard|amex|credit|payment|pay|karte|carte|tarjeta)\b",
    "phone": r"(?i)\b(phone|tel|call|mobile|fax|cell|telefon|téléphone|teléfono)\b",
    "iban": r"(?i)\b(iban|account|bank|transfer|konto|compte|cuenta)\b",
}
AGAINST = r"(?i)\b(version|release|isbn|issn|section|invoice|order|example|sample|serial)\b"
#: Score of a span whose validator agrees, before its surroundings are looked at.
PRIOR = {"email": 0.9, "ip": 0.7, "card": 0.8, "phone": 0.7, "iban": 0.9, "card alone": 0.7, "phone alone": 0.3}
CLOSER, FARTHER = 0.25, -0.25

_MARK = "\x01"


def _split(text: Column, pattern: str, where: Column) -> Column:
    """The text cut at both ends of each match: what is between matches at even places of the array, matches at odd ones (from 0)."""
    marked = F.regexp_replace(text, F.lit(pattern), F.lit(f"{_MARK}$0{_MARK}"))
    return F.when(where, F.split(marked, _MARK, -1)).otherwise(F.array(text))


def _once(value: Column, body) -> Column:
    """body(value), where value is computed once a row however often body or a function in it names it."""
    return F.element_at(F.transform(F.array(value), lambda v: body(v)), 1)


def _starts(pieces: Column) -> Column:
    """The place at which each piece starts. Sums run over 256 pieces at a time, so that many matches don't cost their square."""
    total = lambda some: F.aggregate(some, F.lit(0), lambda a, b: a + b)

    def blocks(sizes: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.shiftright(F.size(sizes), 8)), lambda j: total(F.slice(sizes, F.lit(1), j * 256)))

    def places(sizes: Column, before: Column) -> Column:
        return F.transform(sizes, lambda _, i: F.get(before, F.shiftright(i, 8)) + total(F.slice(sizes, F.shiftleft(F.shiftright(i, 8), 8) + 1, i.bitwiseAND(F.lit(255)))))

    return _once(F.transform(pieces, lambda p: F.length(p)), lambda sizes: _once(blocks(sizes), lambda before: places(sizes, before)))


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, F.lit("[^0-9]"), F.lit(""))


def _luhn(match: Column) -> Column:
    return F.length(_digits(match)).between(14, 19) & F.call_function("luhn_check", _digits(match))


def remainder_97(account: Column) -> Column:
    """What is left of an account number modulo 97: the first four characters last, letters as 10 to 35."""
    plain = F.replace(account, F.lit(" "), F.lit(""))
    characters = F.split(F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, 1, 4)), "")
    step = lambda left, c: F.when(F.ascii(c) < 58, left * 10 + F.ascii(c) - 48).otherwise(left * 100 + F.ascii(c) - 55) % 97
    return F.aggregate(F.filter(characters, lambda c: c != ""), F.lit(0), step)


def _phone(match: Column) -> Column:
    return F.length(_digits(match)).between(10, 15)


#: kind, column of pieces, what the match must be, whether it is a base span, its prior.
_RULES = (
    ("email", "email", lambda m: F.lit(True), True, "email"),
    ("ip", "ip", lambda m: m.rlike(_IP_PARTS), True, "ip"),
    ("card", "card", _luhn, True, "card"),
    ("phone", "phone", lambda m: m.startswith("+") & _phone(m), True, "phone"),
    ("phone", "phone", lambda m: ~m.startswith("+"), False, "phone alone"),
    ("iban", "iban", lambda m: remainder_97(m) == 1, False, "iban"),
    ("card", "alone", _luhn, False, "card alone"),
)


def _spans(pieces: Column, kind: str, valid, base: bool, prior: str) -> Column:
    """array of (start, rank of the kind, end, kind, score, base): the matches among the pieces that hold."""
    empty = F.array().cast("array<struct<start:int,rank:int,end:int,kind:string,score:double,base:boolean>>")

    def span(i: Column, starts: Column) -> Column:
        match, start = F.get(pieces, i), F.get(starts, i)
        near = F.concat_ws(" ", F.right(F.get(pieces, i - 1), F.lit(NEAR)), F.left(F.get(pieces, i + 1), F.lit(NEAR)))
        score = F.lit(PRIOR[prior]) + F.when(near.rlike(FOR[kind]), CLOSER).otherwise(0.0) + F.when(near.rlike(AGAINST), FARTHER).otherwise(0.0)
        return F.struct(
            start.alias("start"), F.lit(KINDS.index(kind)).alias("rank"), (start + F.length(match)).alias("end"), F.lit(kind).alias("kind"),
            F.greatest(F.lit(0.0), F.least(F.lit(1.0), score)).alias("score"), F.lit(base).alias("base"),
        )

    places = F.filter(F.sequence(F.lit(1), F.size(pieces) - 2, F.lit(2)), lambda i: valid(F.get(pieces, i)))
    found = _once(_starts(pieces), lambda starts: F.transform(places, lambda i: span(i, starts)))
    return F.when(F.size(pieces) > 1, found if base else F.filter(found, lambda s: s["score"] >= LEAST)).otherwise(empty)


def find(docs: DataFrame, text: str = "text", name: str = "pii") -> DataFrame:
    """docs with `name`: array of (start, rank, end, kind, score, base) of all spans, by start, then kind."""
    columns = {c: fresh(docs, f"_{c}") for c in ("plain", "email", "ip", "card", "phone", "iban", "alone")}
    given = F.coalesce(F.col(text), F.lit(""))
    plain = F.col(columns["plain"])
    held = docs.withColumn(columns["plain"], F.when(F.contains(given, F.lit(_MARK)), F.translate(given, _MARK, "\x02")).otherwise(given))
    held = held.withColumn(columns["card"], _split(plain, CARD, plain.rlike(r"[0-9][\x20-]?[0-9]")))
    some = F.size(columns["card"]) > 1
    long = F.exists(columns["card"], lambda p: p.rlike("^[0-9]") & (F.length(p) > 19) & (F.length(_digits(p)) > 19))
    held = held.withColumns({
        columns["email"]: _split(plain, EMAIL, F.contains(plain, F.lit("@"))),
        columns["ip"]: _split(plain, IP, plain.rlike(r"[0-9]\.[0-9]")),
        columns["phone"]: _split(plain, PHONE, some | F.contains(plain, F.lit("+"))),
        columns["iban"]: _split(plain, IBAN, plain.rlike("[A-Z]{2}[0-9]{2}")),
        columns["alone"]: _split(plain, CARD_ALONE, some & long),
    })
    lists = [_spans(F.col(columns[c]), kind, valid, base, prior) for kind, c, valid, base, prior in _RULES[:-1]]
    held = held.withColumn(name, F.concat(*lists))
    kind, c, valid, base, prior = _RULES[-1]
    own = _spans(F.col(columns[c]), kind, valid, base, prior)
    new = F.filter(own, lambda s: ~F.exists(name, lambda b: (b["kind"] == "card") & (b["start"] < s["end"]) & (s["start"] < b["end"])))
    both = F.when(F.size(own) > 0, F.concat(F.col(name), new)).otherwise(F.col(name))
    return held.withColumn(name, F.array_sort(both)).drop(*columns.values())


def listed(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat(s["kind"], F.lit(":"), s["start"].cast("string"), F.lit(":"), s["end"].cast("string"))), ",")


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, counts of the base spans by kind, base_sha256 of their list, spans: the list of all."""
    found = find(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")))
    base = found.select("doc_id", "pii", F.filter("pii", lambda s: s["base"]).alias("base"))
    of = lambda kind: F.filter("base", lambda s: s["kind"] == kind)
    counts = [F.size(of(kind)).cast("long").alias(f"n_{kind}") for kind in BASE]
    return base.select("doc_id", *counts, F.sha2(listed(F.col("base")), 256).alias("base_sha256"), listed(F.col("pii")).alias("spans"))


def redacted(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with every found span of the text replaced by its kind in brackets; overlapping spans become one, named by the first."""
    name = fresh(docs, "_pii")
    found = find(docs, text, name)
    empty = F.array().cast("array<struct<start:int,end:int,kind:string>>")
    last = lambda some: F.element_at(some, -1)

    def joined(some: Column, s: Column) -> Column:
        new = F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))
        longer = F.struct(last(some)["start"].alias("start"), F.greatest(last(some)["end"], s["end"]).alias("end"), last(some)["kind"].alias("kind"))
        return F.when((F.size(some) > 0) & (F.try_element_at(some, F.lit(-1))["end"] > s["start"]), F.concat(F.slice(some, F.lit(1), F.size(some) - 1), F.array(longer))).otherwise(F.concat(some, F.array(new)))

    spans = F.aggregate(name, empty, joined)
    merged = fresh(found, "_merged")
    held = found.withColumn(merged, spans)
    ends = lambda i: F.coalesce(F.get(F.col(merged), i - 1)["end"], F.lit(0))
    before = F.transform(merged, lambda s, i: F.concat(F.substring(text, ends(i) + 1, s["start"] - ends(i)), F.lit("["), F.upper(s["kind"]), F.lit("]")))
    rest = F.substring(text, F.element_at(merged, -1)["end"] + 1, F.length(text))
    return held.withColumn(text, F.when(F.size(merged) > 0, F.concat(F.array_join(before, ""), rest)).otherwise(F.col(text))).select(*docs.columns)
