"""Format-preserving pseudonyms of personal numbers, dates and mail addresses.

Validated values are found in the text and permuted, by a keyed Feistel network, within
the set of values of the same format: a Luhn-valid card number becomes a Luhn-valid card
number of the same length and spacing, a date another date of the same notation.  The
permutation depends on the key and the format alone, so equal values stay linked across
documents, and different values stay different.

Only DataFrame functions are used.  Each text is handled in its own row: no shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import need, others, positional

ROUNDS = 10
KINDS = ("card", "phone", "ssn", "ip", "date", "email")

_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
#: What each kind looks like, tried in this order at each place.  Checks beyond the look follow in `_fields`.
SHAPES = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}(?=@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,})",
    "ip": rf"(?<![0-9A-Za-z.]){_OCTET}(?:\.{_OCTET}){{3}}(?![0-9A-Za-z]|\.[0-9])",
    "date": r"(?<![0-9A-Za-z-])(?:19|20)[0-9]{2}-(?:0[1-9]|1[0-2])-(?:0[1-9]|[12][0-9]|3[01])(?![0-9A-Za-z]|-[0-9])",
    # any digits with the area in brackets or after +1, else only those that the North American plan gives out
    "phone": r"(?:(?:\([0-9]{3}\) ?|(?<=\+1[-. ])[0-9]{3}[-. ])[0-9]{3}|(?<![0-9A-Za-z-])[2-9][0-9]{2}[-. ][2-9][0-9]{2})[-. ][0-9]{4}(?![0-9A-Za-z]|-[0-9])",
    "ssn": r"(?<![0-9A-Za-z-])(?!000|666)[0-8][0-9]{2}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9A-Za-z]|-[0-9])",
    "card": r"(?<![0-9A-Za-z])(?:[0-9]{13,19}|[0-9]{4} [0-9]{4} [0-9]{4} [0-9]{1,7}|[0-9]{4}-[0-9]{4}-[0-9]{4}-[0-9]{1,7}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![0-9A-Za-z])",
}
_ANY = "|".join(SHAPES.values())
#: The same places; a mail name is taken with its @, which tells it from other kinds that its name may look like.
_ANY_AT = _ANY.replace("(?=@", "@(?=", 1)
_ANCHORED = {
    "ip": rf"^{_OCTET}(\.{_OCTET}){{3}}$",
    "date": r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$",
    "phone": r"^(\([0-9]{3}\) ?|[0-9]{3}[-. ])[0-9]{3}[-. ][0-9]{4}$",
    "ssn": r"^[0-9]{3}-[0-9]{2}-[0-9]{4}$",
    "card": r"^[0-9][0-9 -]{12,22}$",
}
#: Dates of 1900-01-01 to 2099-12-31 are 73,049 days = 17 * 4,297.
_DATE_SPLIT = (17, 4297)
_HALF = 12  # characters of a mail name in each half: 26^12 fits a long


def _big(n: int) -> Column:
    return F.lit(n).cast("bigint")


def _div(x: Column, y: Column) -> Column:
    """Whole-number division of longs."""
    return F.call_function("div", x, y)


def _power(base: int, n: Column) -> Column:
    """base^n for small whole n, exactly."""
    return F.element_at(F.array(*(_big(base**k) for k in range(19))), (n + 1).cast("int"))


def _digit_at(s: Column, i: Column | int) -> Column:
    return F.substring(s, i, 1).cast("int") if isinstance(i, int) else F.substr(s, i, F.lit(1)).cast("int")


def luhn_sum(digits: Column, doubled_from_end: int) -> Column:
    """Luhn sum; every second digit counts double, from `doubled_from_end` (1: the last) on leftwards."""
    back = F.reverse(digits)
    parts = F.transform(
        F.sequence(F.lit(1), F.length(digits)),
        lambda i: (lambda v: F.when(F.pmod(i - F.lit(doubled_from_end), F.lit(2)) != 0, v).otherwise(F.when(v > 4, v * 2 - 9).otherwise(v * 2)))(_digit_at(back, i)),
    )
    return F.aggregate(parts, F.lit(0), lambda a, x: a + x)


def _radix(ch: Column) -> Column:
    return F.when(ch.rlike("^[A-Za-z]$"), 26).when(ch.rlike("^[0-9]$"), 10).otherwise(1)


def _place(ch: Column) -> Column:
    return F.when(ch.rlike("^[a-z]$"), F.ascii(ch) - 97).when(ch.rlike("^[A-Z]$"), F.ascii(ch) - 65).when(ch.rlike("^[0-9]$"), F.ascii(ch) - 48).otherwise(0)


def _chars(s: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), F.length(s)), lambda i: F.substr(s, i, F.lit(1)))


def _mixed(s: Column) -> Column:
    """Value of a short string in the mixed radix of its characters, first digit highest."""
    return F.when(s == "", _big(0)).otherwise(F.aggregate(_chars(s), _big(0), lambda a, ch: a * _radix(ch) + _place(ch)))


def _span(s: Column) -> Column:
    return F.when(s == "", _big(1)).otherwise(F.aggregate(_chars(s), _big(1), lambda a, ch: a * _radix(ch)))


def _kind(m: Column) -> Column:
    """The kind whose alternative matched; mail names come with their @."""
    out = F.when(F.endswith(m, F.lit("@")), "email").when(m.rlike(_ANCHORED["ip"]), "ip")
    for k in ("date", "phone", "ssn"):
        out = out.when(m.rlike(_ANCHORED[k]), k)
    return out.otherwise("card")


def _fields(m: Column, kind: Column) -> Column:
    """Struct (kind or null, text, shape, l, r, a, b): the value as a pair of residues modulo a and b."""
    d = F.regexp_replace(m, "[^0-9]", "")
    n = F.length(d)
    body = F.substr(d, F.lit(2), n - 2)  # between a card's first digit and its check digit
    nl = F.floor((n - 2) / 2).cast("int")
    num = lambda s: s.cast("bigint")
    area, exch, line = (num(F.substring(d, *x)) for x in ((1, 3), (4, 3), (7, 4)))
    # area and exchange of the plan are permuted among themselves, and so are the other 360,000 pairs
    planned = (area >= 200) & (exch >= 200)
    unplanned = F.when(area < 200, area * 1000 + exch).otherwise(200000 + (area - 200) * 200 + exch)
    s_area, s_rest = num(F.substring(d, 1, 3)), (num(F.substring(d, 4, 2)) - 1) * 9999 + num(F.substring(d, 6, 4)) - 1
    oct_ = F.transform(F.split(F.when(kind == "ip", m).otherwise("0.0.0.0"), r"\."), lambda x: x.cast("bigint"))
    day = F.datediff(F.try_to_timestamp(F.when(kind == "date", m), F.lit("yyyy-MM-dd")).cast("date"), F.lit("1900-01-01").cast("date")).cast("bigint")
    nc = F.least(F.length(m), F.lit(2 * _HALF))
    half = F.ceil(nc / 2).cast("int")
    left, right = F.substr(m, F.lit(1), half), F.substr(m, half + 1, nc - half)

    def pick(**by: Column) -> Column:
        return reduce(lambda acc, kv: acc.when(kind == kv[0], kv[1]), list(by.items())[1:], F.when(kind == next(iter(by)), next(iter(by.values()))))

    valid = pick(card=F.pmod(luhn_sum(d, 2), F.lit(10)) == 0, phone=F.lit(True), ssn=F.lit(True), ip=F.lit(True), date=day.isNotNull(), email=F.lit(True))
    return F.struct(
        F.when(valid, kind).alias("kind"),
        m.alias("text"),
        pick(card=n.cast("string"), phone=F.when(planned, "").otherwise("unplanned"), ssn=F.lit(""), ip=F.lit(""), date=F.lit(""), email=F.regexp_replace(F.regexp_replace(m, "[a-zA-Z]", "a"), "[0-9]", "9")).alias("shape"),
        pick(card=num(F.substr(body, F.lit(1), nl)), phone=F.when(planned, (area - 200) * 800 + exch - 200).otherwise(unplanned), ssn=F.when(s_area > 666, s_area - 2).otherwise(s_area - 1), ip=F.get(oct_, 0) * 256 + F.get(oct_, 1), date=_div(day, _big(_DATE_SPLIT[1])), email=_mixed(left)).alias("l"),
        pick(card=num(F.substr(body, nl + 1, n)), phone=line, ssn=s_rest, ip=F.get(oct_, 2) * 256 + F.get(oct_, 3), date=F.pmod(day, _big(_DATE_SPLIT[1])), email=_mixed(right)).alias("r"),
        pick(card=_power(10, nl), phone=F.when(planned, _big(640000)).otherwise(_big(360000)), ssn=_big(898), ip=_big(65536), date=_big(_DATE_SPLIT[0]), email=_span(left)).alias("a"),
        pick(card=_power(10, n - 2 - nl), phone=_big(10000), ssn=_big(99 * 9999), ip=_big(65536), date=_big(_DATE_SPLIT[1]), email=_span(right)).alias("b"),
    )


def _keyed(key: str, *parts: Column) -> Column:
    """60 bits of SHA-256 over the key and the parts, as a long."""
    return F.conv(F.substring(F.sha2(F.concat_ws("|", F.lit(key), *parts), 256), 1, 15), 16, 10).cast("bigint")


def _round(x: Column, i: int, key: str, back: bool) -> Column:
    """One Feistel round: one residue moves by a keyed function of the other."""
    sign = -1 if back else 1
    of = lambda half: _keyed(key, F.lit(str(i)), x["kind"], x["shape"], half.cast("string"))
    l, r = x["l"], x["r"]
    if i % 2 == 0:
        l = F.pmod(l + sign * F.pmod(of(r), x["a"]), x["a"])
    else:
        r = F.pmod(r + sign * F.pmod(of(l), x["b"]), x["b"])
    return F.struct(x["kind"].alias("kind"), x["text"].alias("text"), x["shape"].alias("shape"), l.alias("l"), r.alias("r"), x["a"].alias("a"), x["b"].alias("b"))


def _rounds(i: int, key: str, back: bool):
    return lambda x: _round(x, i, key, back)


def _refill(template: Column, digits: Column) -> Column:
    """Put digits in the places of the template's digits, one by one."""
    place = lambda i: F.length(F.regexp_replace(F.substr(template, F.lit(1), i), "[^0-9]", ""))
    return F.array_join(
        F.transform(F.sequence(F.lit(1), F.length(template)), lambda i: F.when(F.substr(template, i, F.lit(1)).rlike("[0-9]"), F.substr(digits, place(i), F.lit(1))).otherwise(F.substr(template, i, F.lit(1)))),
        "",
    )


def _pad(v: Column, n: Column | int) -> Column:
    n = F.lit(n) if isinstance(n, int) else n
    return F.when(n > 0, F.lpad(v.cast("string"), n, "0")).otherwise("")


def _char(ch: Column, v: Column) -> Column:
    """The character of ch's class whose place is v."""
    base = F.when(ch.rlike("^[a-z]$"), 97).when(ch.rlike("^[A-Z]$"), 65).when(ch.rlike("^[0-9]$"), 48)
    return F.when(base.isNull(), ch).otherwise(F.char(base + v))


def _from_mixed(template: Column, v: Column) -> Column:
    """The string of the template's character classes whose mixed-radix value is v."""

    def step(acc: Column, ch: Column) -> Column:
        radix = _radix(ch).cast("bigint")
        return F.struct(_div(acc["v"], radix).alias("v"), F.concat(_char(ch, F.pmod(acc["v"], radix)), acc["s"]).alias("s"))

    return F.when(template == "", "").otherwise(
        F.aggregate(F.reverse(_chars(template)), F.struct(v.alias("v"), F.lit("").alias("s")), step, lambda acc: acc["s"])
    )


def _shifted(rest: Column, key: str, x: Column, sign: int) -> Column:
    """Characters beyond both halves of a long mail name, shifted by a key stream that the halves fix."""
    return F.when(rest == "", "").otherwise(
        F.array_join(
            F.transform(_chars(rest), lambda ch, i: _char(ch, F.pmod(_place(ch) + sign * F.pmod(_keyed(key, F.lit("rest"), i.cast("string"), x["l"].cast("string"), x["r"].cast("string")), _radix(ch).cast("bigint")), _radix(ch).cast("bigint")))),
            "",
        )
    )


def _written(x: Column, halves: Column, key: str, sign: int) -> Column:
    """The permuted value in the notation of the original.  `halves`: those that the rest's key stream hangs on."""
    m, l, r = x["text"], x["l"], x["r"]
    d = F.regexp_replace(m, "[^0-9]", "")
    n = F.length(d)
    nl = F.floor((n - 2) / 2).cast("int")
    body = F.concat(F.substring(d, 1, 1), _pad(l, nl), _pad(r, n - 2 - nl))
    card = F.concat(body, F.pmod(10 - F.pmod(luhn_sum(body, 1), F.lit(10)), F.lit(10)).cast("string"))
    rest = l - 200000
    area = F.when(x["shape"] == "", _div(l, _big(800)) + 200).when(rest < 0, _div(l, _big(1000))).otherwise(_div(rest, _big(200)) + 200)
    exch = F.when(x["shape"] == "", F.pmod(l, _big(800)) + 200).when(rest < 0, F.pmod(l, _big(1000))).otherwise(F.pmod(rest, _big(200)))
    phone = F.concat(_pad(area, 3), _pad(exch, 3), _pad(r, 4))
    ssn = F.concat(_pad(F.when(l >= 665, l + 2).otherwise(l + 1), 3), _pad(_div(r, _big(9999)) + 1, 2), _pad(F.pmod(r, _big(9999)) + 1, 4))
    ip = F.concat_ws(".", *(v.cast("string") for h in (l, r) for v in (_div(h, _big(256)), F.pmod(h, _big(256)))))
    date = F.date_format(F.date_add(F.lit("1900-01-01").cast("date"), (l * _DATE_SPLIT[1] + r).cast("int")), "yyyy-MM-dd")
    nc = F.least(F.length(m), F.lit(2 * _HALF))
    half = F.ceil(nc / 2).cast("int")
    mail = F.concat(_from_mixed(F.substr(m, F.lit(1), half), l), _from_mixed(F.substr(m, half + 1, nc - half), r), _shifted(F.substr(m, nc + 1, F.length(m)), key, halves, sign))
    kind = x["kind"]
    return (
        F.when(kind == "card", _refill(m, card)).when(kind == "phone", _refill(m, phone)).when(kind == "ssn", _refill(m, ssn))
        .when(kind == "ip", ip).when(kind == "date", date).when(kind == "email", mail).otherwise(m)
    )


def _found(text: Column, key: str, back: bool) -> Column:
    """The matches of a text in order: array of (kind or null, text, pseudonym)."""
    hits = F.when(text.rlike("[0-9@]"), F.regexp_extract_all(text, F.lit(_ANY_AT), F.lit(0))).otherwise(F.array().cast("array<string>"))
    before = F.transform(hits, lambda m: _fields(F.rtrim(m, F.lit("@")), _kind(m)))
    after = before
    for i in reversed(range(ROUNDS)) if back else range(ROUNDS):
        after = F.transform(after, _rounds(i, key, back))
    return F.zip_with(after, before if back else after, lambda x, y: F.struct(x["kind"].alias("kind"), x["text"].alias("value"), _written(x, F.struct(y["l"].alias("l"), y["r"].alias("r")), key, -1 if back else 1).alias("pseudonym")))


def find(text: Column, key: str) -> Column:
    """Array of struct(kind, value, pseudonym) of the validated values in a text; empty for null."""
    return F.filter(_found(F.coalesce(text, F.lit("")), key, False), lambda x: x["kind"].isNotNull())


def pseudonymize(docs: DataFrame, key: str, text_col: str = "text", restore: bool = False) -> DataFrame:
    """Return every row with the validated values in `text_col` replaced by their pseudonyms.

    Adds `found`, array<struct(kind, value, pseudonym)> in order of place; an input column
    of that name is replaced, in whatever case.  `restore=True` inverts the permutation under the same
    key.  A very long text is one row's work, in time linear in its length.

    Kinds: card (13-19 digits, Luhn), phone (ten digits with the area code in
    brackets or after +1, or a number of the North American plan), ssn, ip (dotted quad), date
    (ISO, 1900-2099) and email (the name before the @).  What only looks like one, as a
    number that fails its check, stays.  A null text stays null with nothing found; an
    empty table stays empty; repeated rows get equal results.
    """
    need(docs, text_col)
    frame, at = positional(docs)
    text = F.coalesce(F.col(at[text_col]).cast("string"), F.lit(""))
    got = frame.withColumn("__el_found", _found(text, key, restore))
    gaps = F.split(text, _ANY, -1)
    joined = F.array_join(
        F.concat(F.array(F.get(gaps, 0)), F.flatten(F.zip_with(F.col("__el_found"), F.slice(gaps, 2, F.size("__el_found")), lambda x, gap: F.array(x["pseudonym"], gap)))), ""
    )
    new = F.when(F.col(at[text_col]).isNull() | (F.size("__el_found") == 0), F.col(at[text_col])).otherwise(joined)
    rest = [new.alias(name) if name == text_col else F.col(place).alias(name) for name, place in others(at, "found").items()]
    return got.select(*rest, F.filter("__el_found", lambda x: x["kind"].isNotNull()).alias("found"))
