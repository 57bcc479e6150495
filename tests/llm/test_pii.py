"""Pseudonyms against a plain reading of the same rules, value by value, and on long texts made to make patterns slow."""

import datetime
import hashlib
import random
import re
import time

from lectern.llm import pii

KEY = "k"


def number(*parts):
    return int(hashlib.sha256("|".join(parts).encode()).hexdigest()[:7], 16)


def permuted(value, kind, sign=1):
    cut = len(value) // 2
    a, b = value[:cut], value[cut:]
    classes = ["0123456789"] + (["abcdef", "ghijklmnopqrstuvwxyz", "ABCDEF", "GHIJKLMNOPQRSTUVWXYZ"] if kind == "secret" else ["abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"])

    def shifted(half, other, turn):
        digest, out = hashlib.sha256("|".join([KEY, kind, str(turn), other.lower()]).encode()).hexdigest(), ""
        for i, ch in enumerate(half):
            own = next((x for x in classes if ch in x), None)
            out += ch if own is None else own[(own.index(ch) + sign * number(digest, str(i))) % len(own)]
        return out

    for turn in range(1, 9) if sign > 0 else range(8, 0, -1):
        a, b = (b, shifted(a, b, turn)) if sign > 0 else (shifted(b, a, turn), a)
    return a + b


def pair(n, side, kind):
    a, b = divmod(n, side)
    for turn in range(1, 9):
        a, b = b, (a + number(KEY, kind, str(turn), str(b))) % side
    return a * side + b


def refilled(shape, new, places="0123456789"):
    new = iter(new)
    return "".join(next(new) if ch in places else ch for ch in shape)


def luhn(digits, shift=0):
    return sum(sum(divmod(int(d) * (1 + (k + shift) % 2), 10)) for k, d in enumerate(reversed(digits))) % 10


def given_out(ssn):
    return ssn[:3] not in ("000", "666") and ssn[0] != "9" and ssn[3:5] != "00" and ssn[5:] != "0000"


def brute(kind, v):
    """The pseudonym of a value of a kind, None if it is not valid."""
    digits = re.sub("[^0-9]", "", v)
    if kind == "email":
        name = v.split("@")[0]
        return permuted(name, kind) + v[len(name) :]
    if kind == "secret":
        said = re.match(pii._SAYS_SECRET, v)[0]
        return said + permuted(v[len(said) :], kind)
    if kind == "iban":
        plain = re.sub("[^A-Z0-9]", "", v)
        mod = lambda s: int("".join(str(int(ch, 36)) for ch in s)) % 97
        if mod(plain[4:] + plain[:4]) != 1:
            return None
        body = permuted(plain[4:], kind)
        return refilled(v, plain[:2] + f"{98 - mod(body + plain[:2] + '00'):02}" + body, "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ")
    if kind == "phone":
        abroad = re.fullmatch(pii._ABROAD, v)
        lead = re.match(pii._COUNTRY, v)[0] if abroad else v.split("(")[0] if "(" in v else re.match(r"(?:\+1|1[.\-])?", v)[0]
        return lead + refilled(v[len(lead) :], permuted(re.sub("[^0-9]", "", v[len(lead) :]), kind))
    if kind == "date":
        form = "%Y-%m-%d" if "-" in v else "%d/%m/%Y" if "/" in v else "%d.%m.%Y"
        try:
            day = (datetime.datetime.strptime(v, form) - datetime.datetime(1900, 1, 1)).days
        except ValueError:
            return None
        if not 0 <= day < pii.DAYS:
            return None
        new = pair(day, pii.SIDE, kind)
        while new >= pii.DAYS:
            new = pair(new, pii.SIDE, kind)
        return (datetime.datetime(1900, 1, 1) + datetime.timedelta(new)).strftime(form)
    if kind == "ssn":
        if not given_out(digits):
            return None
        new = permuted(digits, kind)
        while not given_out(new):
            new = permuted(new, kind)
        return refilled(v, new)
    if kind == "ip":
        parts = v.split(".")
        if any(int(p) > 255 or str(int(p)) != p for p in parts):
            return None
        new = pair(sum(int(p) << 8 * (3 - k) for k, p in enumerate(parts)), 65536, kind)
        return ".".join(str(new >> 8 * (3 - k) & 255) for k in range(4))
    if luhn(digits):
        return None
    body = permuted(digits[:-1], "card")
    return refilled(v, body + str(-luhn(body, 1) % 10))


def brute_text(text):
    said, values = "", 0
    at = 0
    for m in re.finditer(pii._ANY, text):
        kind = next(k for k, p in pii.PATTERNS.items() if re.fullmatch(p, m[0]))
        new = brute(kind, m[0]) or m[0]
        said += text[at : m.start()] + new
        at, values = m.end(), values + (new != m[0])
    return said + text[at:], values


def made_texts(seed=4):
    rng = random.Random(seed)
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    out = []
    for _ in range(150):
        card = digits(15)
        said = [
            f"{rng.choice('abXY')}{digits(2)}.b_{digits(1)}@mail{digits(1)}.example.org", f"token={digits(9)}abcDEF{digits(3)}", f"DE{digits(20)}", "GB82 WEST 1234 5698 7654 32", f"({digits(3)}) 555-{digits(4)}",
            f"+49 30 {digits(7)}", f"{1880 + int(digits(3)) % 250}-{rng.randint(1, 13):02}-{rng.randint(1, 31):02}", f"{rng.randint(1, 31):02}/{rng.randint(1, 12):02}/20{digits(2)}", f"{digits(3)}-{digits(2)}-{digits(4)}",
            ".".join(str(rng.randint(0, 300)) for _ in range(4)), card + str(-luhn(card, 1) % 10), f"{digits(4)} {digits(4)} {digits(4)} {digits(4)}", "x@y..z", "plain words",
        ]
        out.append(", ".join(rng.sample(said, 6)))
    return out


def test_pseudonyms_equal_brute_force(spark):
    texts = made_texts()
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in pii.pseudonymise(rows, key=KEY).collect():
        assert (r.text, r.n_values) == brute_text(texts[r.doc_id]), texts[r.doc_id]


def test_social_security_numbers_map_to_given_out_ones_and_back(spark):
    rng = random.Random(1)
    old = sorted({f"{a:03}-{b:02}-{d:04}" for a, b, d in ((rng.randint(0, 999), rng.randint(0, 99), rng.randint(0, 9999)) for _ in range(10_000))})
    rows = spark.createDataFrame(list(enumerate(old)), "doc_id long, text string")
    new = pii.pseudonymise(rows, key=KEY)
    got = {r.doc_id: r.text for r in new.collect()}
    plain = lambda s: s.replace("-", "")
    for k, v in enumerate(old):
        assert given_out(plain(got[k])) if given_out(plain(v)) else got[k] == v
    assert len(set(got.values())) == len(old)
    back = {r.doc_id: r.text for r in pii.pseudonymise(new.drop("n_values"), key=KEY, sign=-1).collect()}
    assert back == dict(enumerate(old))


MEGA = 1 << 20
LONG = {
    "labels": "a@" + "a." * (MEGA // 2) + "9",
    "name": "a" * MEGA + "@example.org",
    "names": "a@" * (MEGA // 2),
    "dots": "x@y." + "." * MEGA,
    "secret": "token=" + "a1" * (MEGA // 2),
    "secrets": "token=" * (MEGA // 6),
    "dashes": "password: " + "-" * MEGA,
    "iban": "DE89 " * (MEGA // 5),
    "iban_run": "DE89" + "A" * MEGA,
    "phone": "+49 " + "1 " * (MEGA // 2),
    "brackets": "+49 (030) " * (MEGA // 10),
    "dates": "2020-" * (MEGA // 5),
    "ssn": "123-45-" * (MEGA // 7),
    "ip": "1." * (MEGA // 2),
    "card": "4111 " * (MEGA // 5),
    "digits": "4" * MEGA,
}


def test_long_texts_of_every_kind(spark, tmp_path):
    spark.createDataFrame(sorted(LONG.items()), "name string, text string").repartition(16, "name").write.parquet(str(tmp_path / "long"))
    began = time.time()
    got = {r.name: r for r in pii.pseudonymise(spark.read.parquet(str(tmp_path / "long")), key=KEY).collect()}
    assert time.time() - began < 120
    for name, text in LONG.items():
        assert len(got[name].text) == len(text)
    assert got["name"].text == permuted("a" * MEGA, "email") + "@example.org"
    assert got["secret"].text == "token=" + permuted("a1" * (MEGA // 2), "secret")
    for name in ("labels", "dots", "secrets", "digits", "ip", "dates"):
        assert (got[name].text, got[name].n_values) == (LONG[name], 0)
