"""Personal data: validated values are permuted within their format by a keyed Feistel network. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as c

#: Rounds of the network (even, so that halves return to their sides) and the key; a production run passes its own.
ROUNDS = 8
KEY = "change-me"
#: What stands before a secret, and secrets: token characters (with a digit and a letter), perhaps in three parts, or hexadecimal digits.
_SAYS_SECRET = r"(?i:(?<![A-Za-z])(?:token|secret|password|api[_-]?key)[\"']?\s{0,3}[=:]\s{0,3}[\"']?)"
_SECRET = r"(?:(?=[0-9A-Za-z_+/~\-]*[0-9])(?=[0-9A-Za-z_+/~\-]*[A-Za-z])[0-9A-Za-z_+/~\-]{8,}+(?:\.[0-9A-Za-z_\-]{8,}+){0,2}={0,2}|[0-9A-Fa-f]{32,64}(?![0-9A-Za-z]))"
#: Lengths of IBANs by country: in groups of four, only the length tells where one ends.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE",
    31: "MT SC", 32: "LC", 33: "RU",
}
_GROUPED = "|".join(f"(?:{names.replace(' ', '|')})[0-9]{{2}}(?:[ \\-][A-Z0-9]{{4}}){{{n // 4 - 1}}}" + (f"[ \\-][A-Z0-9]{{{n % 4}}}" if n % 4 else "") for n, names in IBAN_LENGTHS.items())
#: Country codes of telephone numbers but 1, after a plus and perhaps with a trunk 0 in brackets; then a digit, perhaps after a mark if it begins
#: a group of two or more, or is one digit before such a group.
_COUNTRY = r"\+(?:7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|2[1-689][0-9]|3[578][0-9]|42[0-9]|5[09][0-9]|6[7-9][0-9]|8[0578][0-9]|9[679][0-9])(?: ?\(0\))?"
_NEXT = r"(?:[ .\-/](?=[0-9]{2}|[0-9][ .\-/][0-9]{2}))?[0-9]"
_ABROAD = rf"{_COUNTRY}(?:[ .\-/]?\([0-9]{{2,5}}\)(?:{_NEXT}){{4,9}}|(?:{_NEXT}){{6,13}})(?![0-9])(?![.\-/][0-9])"
_PHONES = [
    _ABROAD,
    r"\+?[0-9]{1,3}[ .\-]?\([0-9]{2,4}\)[ .\-]?[0-9]{3,4}[ .\-]?[0-9]{3,4}(?![0-9])",
    r"\+1[ .\-/]?[0-9]{3}[ .\-]?[0-9]{3}[ .\-]?[0-9]{4}(?![0-9])(?![.\-/][0-9])",
    r"\([0-9]{3}\)[ .\-]?[0-9]{3}[ .\-]?[0-9]{4}(?![0-9A-Za-z])(?![.\-/][0-9])",
    r"(?<![0-9][.\-/])(?:1-)?[0-9]{3}-[0-9]{3}-[0-9]{4}(?![0-9A-Za-z])(?![.\-/][0-9])",
    r"(?<![0-9][.\-/])(?:1\.)?[0-9]{3}\.[0-9]{3}\.[0-9]{4}(?![0-9A-Za-z])(?![.\-/][0-9])",
]
#: Kinds in the order in which they are tried at a place of the text; each pattern takes a whole value.
PATTERNS = {
    # labels of a domain name have at most 63 letters and names at most 127 labels, so the loop over labels ends
    "email": r"(?<![A-Za-z0-9._%+\-])[A-Za-z0-9._%+\-]++@[A-Za-z0-9\-]{1,63}+(?:\.[A-Za-z0-9\-]{1,63}+){0,125}\.[A-Za-z]{2,63}",
    "secret": _SAYS_SECRET + _SECRET,
    "iban": rf"(?<![A-Za-z0-9])(?:[A-Z]{{2}}[0-9]{{2}}[A-Z0-9]{{11,30}}|{_GROUPED})(?![A-Za-z0-9])",
    "phone": rf"(?<![0-9A-Za-z])(?:{'|'.join(_PHONES)})",
    "date": r"(?<![0-9A-Za-z.\-/])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}/[0-9]{2}/[0-9]{4}|[0-9]{2}\.[0-9]{2}\.[0-9]{4})(?![0-9A-Za-z])",
    "ssn": r"(?<![0-9A-Za-z\-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z\-])",
    "ip": r"(?<![0-9A-Za-z.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9A-Za-z]|\.[0-9])",
    "card": r"(?<![0-9A-Za-z])(?:[0-9]{13,19}|[0-9]{4}(?:[ \-][0-9]{4}){3}|[0-9]{4}[ \-][0-9]{6}[ \-][0-9]{4,5})(?![0-9A-Za-z])",
}
_ANY = "|".join(PATTERNS.values())
#: Dates that are permuted: from the first of these days on, so many days; SIDE * SIDE is the least square that holds them.
FIRST_DAY, DAYS, SIDE = "1900-01-01", 73049, 271
#: Steps by which a pseudonym outside of its range walks on at most: one in nine at a step for a social security number, so less than 1e-22 are left.
WALK = 24


def _number(key: Column, *parts: Column) -> Column:
    """28 keyed bits as a long."""
    return F.conv(F.substring(F.sha2(F.concat_ws("|", key, *parts), 256), 1, 7), 16, 10).cast("long")


def _let(value: Column, use) -> Column:
    """use(value), with value computed once, however often and in whatever lambda it is read."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _shifted(half: Column, other: Column, turn: Column, key: Column, kind: str, sign: int) -> Column:
    """Each letter of half moved within its class (digits, a-z, A-Z; of secrets a-f and g-z apart, so that hexadecimal ones stay so) by a keyed
    hash of the other half, which is made once, and of its place; others stay."""
    classes = [("[0-9]", 48, 10)] + ([("[a-f]", 97, 6), ("[g-z]", 103, 20), ("[A-F]", 65, 6), ("[G-Z]", 71, 20)] if kind == "secret" else [("[a-z]", 97, 26), ("[A-Z]", 65, 26)])

    def move(digest: Column, ch: Column, i: Column) -> Column:
        code = F.ascii(ch)
        by = _number(digest, i.cast("string"))
        to = lambda first, size: F.char(F.lit(first) + F.pmod(code - first + sign * F.pmod(by, F.lit(size)), F.lit(size)))
        return F.coalesce(*[F.when(ch.rlike(letters), to(first, size)) for letters, first, size in classes], ch)

    digest = F.sha2(F.concat_ws("|", key, F.lit(kind), turn.cast("string"), F.lower(other)), 256)
    return _let(digest, lambda d: F.array_join(F.transform(F.split(half, ""), lambda ch, i: move(d, ch, i)), ""))


def permuted(value: Column, key: Column, kind: str, sign: int = 1) -> Column:
    """The Feistel network on a string: halves in turn are shifted by the other. sign -1 undoes sign 1."""
    cut = F.floor(F.length(value) / 2).cast("int")
    start = F.struct(F.substr(value, F.lit(1), cut).alias("a"), F.substr(value, cut + 1).alias("b"))
    turns = F.sequence(F.lit(1), F.lit(ROUNDS)) if sign > 0 else F.sequence(F.lit(ROUNDS), F.lit(1), F.lit(-1))

    def turn(at: Column, r: Column) -> Column:
        if sign > 0:
            return F.struct(at["b"].alias("a"), _shifted(at["a"], at["b"], r, key, kind, 1).alias("b"))
        return F.struct(_shifted(at["b"], at["a"], r, key, kind, -1).alias("a"), at["a"].alias("b"))

    end = F.aggregate(turns, start, turn)
    return F.concat(end["a"], end["b"])


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column, shift: int = 0) -> Column:
    """The Luhn sum modulo 10; shift 1 counts from the place before a check digit that is not there yet."""
    def weight(ch: Column, i: Column) -> Column:
        d = ch.cast("int")
        twice = (i + shift) % 2 == 1
        return F.when(twice & (d * 2 > 9), d * 2 - 9).when(twice, d * 2).otherwise(d)

    return F.aggregate(F.transform(F.split(F.reverse(digits), ""), weight), F.lit(0), lambda s, x: s + x) % 10


def _refilled(shape: Column, digits: Column, places: str = "[0-9]") -> Column:
    """shape with its digits (or what places says) replaced in turn."""
    state = F.aggregate(
        F.split(shape, ""),
        F.struct(F.lit("").alias("said"), F.lit(1).alias("at")),
        lambda s, ch: F.when(ch.rlike(places), F.struct(F.concat(s["said"], F.substr(digits, s["at"], F.lit(1))).alias("said"), (s["at"] + 1).alias("at"))).otherwise(F.struct(F.concat(s["said"], ch).alias("said"), s["at"].alias("at"))),
    )
    return state["said"]


def _mod97(text: Column) -> Column:
    """An IBAN's letters and digits, in the order given, as a number modulo 97."""
    value = lambda ch: F.when(ch.rlike("[0-9]"), F.ascii(ch) - 48).otherwise(F.ascii(ch) - 55)
    return F.aggregate(F.split(text, ""), F.lit(0), lambda s, ch: F.when(ch.rlike("[0-9]"), (s * 10 + value(ch)) % 97).otherwise((s * 100 + value(ch)) % 97))


def _pair(number: Column, side: int, key: Column, kind: str, sign: int) -> Column:
    """The network on a number below side * side: two numbers below side are shifted in turn."""
    start = F.struct(F.floor(number / side).cast("long").alias("a"), F.pmod(number, F.lit(side)).cast("long").alias("b"))
    turns = F.sequence(F.lit(1), F.lit(ROUNDS)) if sign > 0 else F.sequence(F.lit(ROUNDS), F.lit(1), F.lit(-1))

    def turn(at: Column, r: Column) -> Column:
        if sign > 0:
            by = _number(key, F.lit(kind), r.cast("string"), at["b"].cast("string"))
            return F.struct(at["b"].alias("a"), F.pmod(at["a"] + by, F.lit(side)).cast("long").alias("b"))
        by = _number(key, F.lit(kind), r.cast("string"), at["a"].cast("string"))
        return F.struct(F.pmod(at["b"] - by, F.lit(side)).cast("long").alias("a"), at["a"].alias("b"))

    end = F.aggregate(turns, start, turn)
    return end["a"] * side + end["b"]


def _date(value: Column, key: Column, sign: int) -> Column:
    form = F.when(value.contains("-"), "yyyy-MM-dd").when(value.contains("/"), "dd/MM/yyyy").otherwise("dd.MM.yyyy")
    day = F.coalesce(*[F.when(form == f, F.try_to_timestamp(value, F.lit(f)).cast("date")) for f in ("yyyy-MM-dd", "dd/MM/yyyy", "dd.MM.yyyy")])
    number = F.datediff(day, F.lit(FIRST_DAY).cast("date")).cast("long")
    once = _pair(number, SIDE, key, "date", sign)
    # few results lie beyond the last day: walk on from them until one lies within
    walked = F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), once, lambda x, _: F.when(x >= DAYS, _pair(x, SIDE, key, "date", sign)).otherwise(x))
    new = F.date_add(F.lit(FIRST_DAY).cast("date"), walked.cast("int"))
    said = F.coalesce(*[F.when(form == f, F.date_format(new, f)) for f in ("yyyy-MM-dd", "dd/MM/yyyy", "dd.MM.yyyy")])
    return F.when((number >= 0) & (number < DAYS) & (walked < DAYS), said)


def _ip(value: Column, key: Column, sign: int) -> Column:
    parts = F.transform(F.split(value, r"\."), lambda x: x.cast("long"))
    number = F.aggregate(parts, F.lit(0).cast("long"), lambda s, x: s * 256 + x)
    new = _pair(number, 65536, key, "ip", sign)
    said = F.concat_ws(".", *[(F.floor(new / 256**i) % 256).cast("long").cast("string") for i in (3, 2, 1, 0)])
    return F.when(F.forall(parts, lambda x: x <= 255) & (F.concat_ws(".", F.transform(parts, lambda x: x.cast("string"))) == value), said)


def _card(value: Column, key: Column, sign: int) -> Column:
    digits = _digits(value)
    body = permuted(F.substr(digits, F.lit(1), F.length(digits) - 1), key, "card", sign)
    return F.when(_luhn(digits) == 0, _refilled(value, F.concat(body, F.pmod(10 - _luhn(body, 1), F.lit(10)).cast("string"))))


def _iban(value: Column, key: Column, sign: int) -> Column:
    plain = F.regexp_replace(value, "[^A-Z0-9]", "")
    country, rest = F.substr(plain, F.lit(1), F.lit(2)), F.substr(plain, F.lit(5))
    valid = _mod97(F.concat(rest, country, F.substr(plain, F.lit(3), F.lit(2)))) == 1
    body = permuted(rest, key, "iban", sign)
    new = F.concat(country, F.lpad((98 - _mod97(F.concat(body, country, F.lit("00")))).cast("string"), 2, "0"), body)
    return F.when(valid, F.when(value == plain, new).otherwise(_refilled(value, new, "[A-Z0-9]")))


def _phone(value: Column, key: Column, sign: int) -> Column:
    """The country code, or what stands for one, stays."""
    lead = F.when(value.rlike(f"^(?:{_ABROAD})$"), F.regexp_extract(value, f"^{_COUNTRY}", 0)).when(value.contains("("), F.regexp_extract(value, r"^[^(]*", 0)).otherwise(F.regexp_extract(value, r"^(?:\+1|1[.\-])?", 0))
    rest = F.substr(value, F.length(lead) + 1)
    return F.concat(lead, _refilled(rest, permuted(_digits(rest), key, "phone", sign)))


def _ssn(value: Column, key: Column, sign: int) -> Column:
    given_out = lambda digits: ~digits.rlike("^(?:000|666|9|...00|.....0000)")
    digits = _digits(value)
    # one number in nine is none that is given out: walk on from such until one is
    walked = F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), permuted(digits, key, "ssn", sign), lambda x, _: F.when(given_out(x), x).otherwise(permuted(x, key, "ssn", sign)))
    return F.when(given_out(digits) & given_out(walked), _refilled(value, walked))


def _email(value: Column, key: Column, sign: int) -> Column:
    name = F.regexp_extract(value, "^[^@]*", 0)
    return F.concat(permuted(name, key, "email", sign), F.substr(value, F.length(name) + 1))


def _secret(value: Column, key: Column, sign: int) -> Column:
    said = F.regexp_extract(value, f"^{_SAYS_SECRET}", 0)
    return F.concat(said, permuted(F.substr(value, F.length(said) + 1), key, "secret", sign))


_MAKE = {"email": _email, "secret": _secret, "iban": _iban, "phone": _phone, "date": _date, "ssn": _ssn, "ip": _ip, "card": _card}


def pseudonym(value: Column, key: Column, sign: int = 1) -> Column:
    """The pseudonym of one found value; the value itself if it is not valid of its kind."""
    out = None
    for kind, pattern in PATTERNS.items():
        whole = value.rlike(f"^(?:{pattern})$")
        new = F.coalesce(_MAKE[kind](value, key, sign), value)
        out = F.when(whole, new) if out is None else out.when(whole, new)
    return out.otherwise(value)


def pseudonymise(docs: DataFrame, text_col: str = "text", key: str = KEY, sign: int = 1) -> DataFrame:
    """docs with every valid email address, secret, IBAN, phone number, date, social security number, IPv4 address and payment card number in
    the text that is written in a form below replaced by its pseudonym, and n_values (how many) appended.

    Forms that are known: phone numbers with a plus, a country code and 6 to 13 digits after it (for +1 ten; for others 4 to 9 after an area code
    in brackets), together or in groups between which one blank, dot, hyphen or slash stands; with up to three digits before an area code in
    brackets; (ddd) ddd-dddd; ddd-ddd-dddd and ddd.ddd.dddd, perhaps after 1. IBANs written together, or in groups of four by their countries'
    lengths; card numbers of 13 to 19 digits together, or of groups 4-4-4-4, 4-6-5 and 4-6-4. Secrets after the words token, secret, password
    or api key with = or :, of 32 to 64 hexadecimal digits, or of 8 and more of letters, digits and _ + / ~ - with a digit and a letter (up to
    three such parts with dots between). Other forms are not found: national numbers of other countries, three groups of digits with blanks
    between, passwords with other marks or without a digit, secrets without such a word.

    Values are valid if their check digits, ranges or calendar say so; others stay. A pseudonym is valid of the same kind and form, equal values have equal ones in all
    documents (letter case apart: it is kept), and sign -1 with the same key brings the values back. Of an address the name before @ is
    replaced. Null stays null with n_values 0; texts without values stay byte for byte, of any length (no pattern repeats a group without a
    bound, and a name's letters are moved by one digest of its other half); repeated rows are treated alike; an empty table gives no rows; an input column n_values is replaced."""
    text = F.col(f"`{text_col}`")
    names = [n for n in docs.columns if n.lower() != "n_values"]
    found = F.when(text.rlike("[0-9@]"), F.regexp_extract_all(text, F.lit(_ANY), F.lit(0)))
    base = docs.select(*[F.col(f"`{n}`") for n in names], found.alias("__found"))
    base = base.withColumn("__new", F.transform("__found", lambda v: pseudonym(v, F.lit(key), sign)))
    between = F.split(text, _ANY, -1)
    joined = F.array_join(F.zip_with(between, F.col("__new"), lambda s, v: F.concat(s, F.coalesce(v, F.lit("")))), "")
    new = F.when(F.size("__found") > 0, joined).otherwise(text)
    n = F.when(F.size("__found") > 0, F.size(F.filter(F.arrays_zip("__found", "__new"), lambda x: x["__found"] != x["__new"]))).otherwise(0)
    return base.select(*[new.alias(x) if x == text_col else F.col(f"`{x}`") for x in names], n.cast("long").alias("n_values"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its values replaced; a run of one's own sets the key in spark.lectern.pseudonym.key."""
    return pseudonymise(c.table(spark, sf_dir, "documents").select("doc_id", "text"), key=spark.conf.get("spark.lectern.pseudonym.key", KEY))
