"""Personal data replaced by format-preserving pseudonyms, in DataFrame functions alone.

One pattern finds candidates; each is validated (card numbers by their Luhn digit, bank accounts by their
remainder, addresses by their octets, dates by the calendar) and permuted within its format by a
keyed Feistel network: the digits or the day number are two halves of a mixed-radix number, and each
of ten rounds adds a keyed hash of one half to the other.  A network is a permutation, so equal values get equal
pseudonyms in all documents, different values different ones, and check digits are made anew.

kind         format that stays                      domain of the permutation
card         digits, separators, Luhn digit         all digits but the last
iban         country, letters, spaces, remainder    the digits after the check digits
phone        country code, brackets, separators     the last ten digits; abroad (+49 30 1234567) all after the code
ssn          three, two and four digits             nine digits
date         yyyy-mm-dd, yyyy/mm/dd, dd.mm.yyyy,    the 73,049 days of 1900 to 2099, 229 x 319
             dd/mm/yyyy
ip           four octets                            32 bits
email        name@host                              keyed hash; the host becomes example.invalid
secret       length, what a token begins with       keyed hash of keys, passwords and tokens (AKIA, gh._, xox.-, sk-)

A run of digits with single blanks or hyphens may hold a card beside other numbers.  If the whole run isn't a
card, its parts between separators are tried: the usual groupings first (one group, 4-4-4-4-3, 4-4-4-4, 4-6-5,
4-6-4), then all others, longer ones first.  Every part that validates and doesn't overlap an earlier one is a card;
the rest of the run stays.  A run ends before what looks like a phone, ssn, date, ip or email.  An iban of a country in
LENGTHS has that country's length and may hold letters; others have digits only.

What looks like a kind but doesn't validate stays as it is, and so do formats that aren't listed: mm/dd/yyyy where it
isn't a day of dd/mm/yyyy too, IPv6 addresses, names, postal addresses.  A null text stays null and an empty one empty.
Repeated rows get equal results.  All other columns stay as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 10
DAYS = (229, 319)  # 229 * 319 days from 1900-01-01 to 2099-12-31

# fixed values: the formats; none matches an empty string, and each starts where no digit or letter stands before
_EMAIL = r"[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){1,6}"
_AWS = r"A[KS]IA[0-9A-Z]{16}(?![0-9A-Za-z])"
_TOKEN = r"(?:gh[opsu]_[0-9A-Za-z]{36}|xox[abprs]-[0-9A-Za-z-]{10,72}|sk-[0-9A-Za-z]{20,64})(?![0-9A-Za-z])"
_SECRET = r"(?i:password|passwd|pwd|secret|token|api_key|apikey)\s{0,2}[=:]\s{0,2}[\"']?[^\s\"',;]{8,128}[\"']?"
LENGTHS = {  # characters of an iban by country
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA",
    23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
_IBAN_KNOWN = "(?:" + "|".join(f"(?:{'|'.join(c.split())})[0-9]{{2}}(?: ?[0-9A-Z]){{{n - 4}}}" for n, c in LENGTHS.items()) + ")(?![0-9A-Za-z])"
_IBAN = r"(?=[A-Z]{2}[0-9]{2})(?:" + _IBAN_KNOWN + r"|[A-Z]{2}[0-9]{2}(?: ?[0-9]{4}){2,6}(?: ?[0-9]{1,4})?(?![0-9A-Za-z]))"
_PHONE = r"(?:\+[0-9]{1,3}[ .-]?)?\([0-9]{3}\)[ .-]?[0-9]{3}[ .-][0-9]{4}(?![0-9])"
_PHONE_PLAIN = r"(?:\+[0-9]{1,3}[ .-])?[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}(?![0-9])"
_PHONE_FAR = r"\+[1-9](?:[ ./-]?[0-9]){7,14}(?![0-9])"
_SSN = r"[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
_DATE = r"(?:(?:19|20)[0-9]{2}([-/])[0-9]{2}\1[0-9]{2}|[0-9]{2}([./])[0-9]{2}\2(?:19|20)[0-9]{2})(?![0-9])"
_DATE_LIKE = _DATE.replace(r"([-/])", "[-/]").replace(r"\1", "[-/]").replace(r"([./])", "[./]").replace(r"\2", "[./]")  # without groups
_IP = r"(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9])(?!\.[0-9])"
_OTHER = "|".join(f"(?:{p})" for p in (_EMAIL, _PHONE_PLAIN, _SSN, _DATE_LIKE, _IP))
_CARD = rf"(?=[0-9](?:[ -]?[0-9]){{12}})[0-9]++(?:[ -](?!{_OTHER})[0-9]++)*+(?![0-9])"  # possessive: runs may be long
_ALL = "(?:" + "|".join(f"(?:{p})" for p in (_EMAIL, _AWS, _TOKEN, _SECRET, _IBAN, _PHONE, _PHONE_PLAIN, _PHONE_FAR, _SSN, _DATE_LIKE, _IP, _CARD)) + ")"
PATTERN = r"(?<![0-9A-Za-z])" + _ALL
_GROUPED = ["[0-9]{13,19}", *("([ -])".join(["[0-9]{%d}"] * 2) % g[:2] + "".join(rf"\2[0-9]{{{n}}}" for n in g[2:]) for g in ((4, 4, 4, 4, 3), (4, 4, 4, 4), (4, 6, 5), (4, 6, 4)))]
_PARTS = [rf"(?<![0-9A-Za-z])(?=({p})(?![0-9A-Za-z]))" for p in (*_GROUPED, *(rf"[0-9](?:[ -]?[0-9]){{{n - 1}}}" for n in range(19, 12, -1)))]
_MARKED = "^[0-9A-Z -]+$"  # values that cards may be found in; no such value holds a |
_TAKEN = "abcdefghij"  # digits of cards that are done, while others of their run are looked for
_WHOLE = {k: f"^(?:{p})$" for k, p in {"email": _EMAIL, "aws": _AWS, "token": _TOKEN, "secret": _SECRET, "iban": _IBAN, "phone": f"{_PHONE}|{_PHONE_PLAIN}", "far": _PHONE_FAR, "ssn": _SSN, "date": _DATE, "ip": _IP, "card": _CARD}.items()}
_START = "1900-01-01"


def _keyed(key: str, kind: str, *parts: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), *[p.cast("string") for p in parts]).cast("binary"), 256)


def feistel(left: Column, right: Column, left_size: Column, right_size: Column, key: str, kind: str) -> Column:
    """struct(l, r) of two halves, l below left_size and r below right_size, after all rounds."""

    def turn(s: Column, i: Column) -> Column:
        number = lambda half: F.conv(F.substring(_keyed(key, kind, i, half), 1, 14), 16, 10).cast("long")
        return F.when(i % 2 == 0, F.struct(F.pmod(s["l"] + number(s["r"]), left_size).alias("l"), s["r"].alias("r"))).otherwise(F.struct(s["l"].alias("l"), F.pmod(s["r"] + number(s["l"]), right_size).alias("r")))

    return F.aggregate(F.array(*[F.lit(i) for i in range(ROUNDS)]), F.struct(left.cast("long").alias("l"), right.cast("long").alias("r")), turn)


def permuted_digits(digits: Column, key: str, kind: str) -> Column:
    """A digit string of 2 to 36 digits as another of the same length."""
    n = F.length(digits)
    a = F.floor(n / 2).cast("int")
    size = lambda d: F.pow(F.lit(10.0), d).cast("long")
    out = feistel(F.substr(digits, F.lit(1), a), F.substr(digits, a + 1, n - a), size(a), size(n - a), key, kind)
    return F.concat(F.lpad(out["l"].cast("string"), a, "0"), F.lpad(out["r"].cast("string"), n - a, "0"))


def only_digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def refitted(value: Column, digits: Column) -> Column:
    """The value with its digits, in order, replaced by `digits`."""
    place = lambda i: F.length(only_digits(F.substr(value, F.lit(1), i)))
    one = lambda i: F.when(F.substr(value, i, F.lit(1)).rlike("[0-9]"), F.substr(digits, place(i), F.lit(1))).otherwise(F.substr(value, i, F.lit(1)))
    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(value)), one), "")


def luhn_sum(digits: Column) -> Column:
    """Luhn sum of a digit string whose last digit is the check digit."""
    back = F.reverse(digits)

    def add(s: Column, i: Column) -> Column:
        d = F.substr(back, i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return s + d - F.when(d > 9, 9).otherwise(0)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add)


def _iban_remainder(bban: Column, country: Column, check: Column) -> Column:
    whole = F.concat(bban, country, check)

    def add(r: Column, i: Column) -> Column:
        c = F.ascii(F.substr(whole, i, F.lit(1)))
        return F.when(c < 58, r * 10 + c - 48).otherwise(r * 100 + c - 55) % 97  # letters count 10 to 35

    return F.aggregate(F.sequence(F.lit(1), F.length(whole)), F.lit(0), add)


def _card(value: Column, key: str) -> Column:
    digits = only_digits(value)
    body = permuted_digits(F.substr(digits, F.lit(1), F.length(digits) - 1), key, "card")
    return refitted(value, F.concat(body, F.pmod(10 - luhn_sum(F.concat(body, F.lit("0"))) % 10, F.lit(10)).cast("string")))


def _cards_within(value: Column, key: str) -> Column:
    """The value with the cards among its parts replaced, a | after each."""
    parts = F.array_distinct(F.concat(*[F.regexp_extract_all(value, F.lit(p), F.lit(1)) for p in _PARTS]))
    sound = F.filter(parts, lambda p: luhn_sum(only_digits(p)) % 10 == 0)

    def put(text: Column, p: Column) -> Column:
        return F.regexp_replace(text, F.concat(F.lit("(?<![0-9A-Za-z])"), p, F.lit("(?![0-9A-Za-z])")), F.concat(F.translate(_card(p, key), "0123456789", _TAKEN), F.lit("|")))

    return F.translate(F.aggregate(sound, value, put), _TAKEN, "0123456789")


def _hashed(value: Column, key: str, kind: str, n: Column) -> Column:
    return F.substr(F.repeat(_keyed(key, kind, value), F.lit(2)), F.lit(1), n)


def _marked(value: Column, key: str) -> Column:
    """As pseudonym, but with a | after each card."""
    digits = only_digits(value)
    n = F.length(digits)
    country, check, bban = F.substring(value, 1, 2), F.substring(value, 3, 2), F.regexp_replace(F.substr(value, F.lit(5), F.length(value) - 4), " ", "")
    moved = permuted_digits(F.substr(digits, F.lit(3), n - 2), key, "iban")
    body = F.substr(value, F.lit(5), F.length(value) - 4)
    new_body = refitted(body, moved)
    iban = F.concat(country, F.lpad((98 - _iban_remainder(F.regexp_replace(new_body, " ", ""), country, F.lit("00"))).cast("string"), 2, "0"), new_body)
    phone = refitted(value, F.concat(F.substr(digits, F.lit(1), n - 10), permuted_digits(F.substr(digits, n - 9, F.lit(10)), key, "phone")))
    ssn = refitted(value, permuted_digits(digits, key, "ssn"))
    far_lead = F.regexp_extract(value, r"^\+(?:[0-9]{1,3}(?=[ ./-])|[0-9]{2})", 0)
    far_rest = F.substr(value, F.length(far_lead) + 1)
    far = F.concat(far_lead, refitted(far_rest, permuted_digits(only_digits(far_rest), key, "phone")))
    token_lead = F.regexp_extract(value, "^[^_-]+[_-]", 0)
    token = F.concat(token_lead, _hashed(value, key, "secret", F.length(value) - F.length(token_lead)))
    shapes = ("yyyy-MM-dd", "yyyy/MM/dd", "dd.MM.yyyy", "dd/MM/yyyy")
    shape = F.when(F.substring(value, 5, 1) == "-", "yyyy-MM-dd").when(F.substring(value, 5, 1) == "/", "yyyy/MM/dd").when(F.substring(value, 3, 1) == ".", "dd.MM.yyyy").otherwise("dd/MM/yyyy")
    day = F.coalesce(*[F.when(shape == s, F.try_to_timestamp(value, F.lit(s)).cast("date")) for s in shapes])
    number = F.datediff(day, F.lit(_START).cast("date"))
    turned = feistel(F.floor(number / DAYS[1]), F.pmod(number, F.lit(DAYS[1])), F.lit(DAYS[0]).cast("long"), F.lit(DAYS[1]).cast("long"), key, "date")
    other = F.date_add(F.lit(_START).cast("date"), (turned["l"] * DAYS[1] + turned["r"]).cast("int"))
    date = F.coalesce(*[F.when(shape == s, F.date_format(other, s)) for s in shapes])
    octet = F.transform(F.split(value, "[.]"), lambda x: x.cast("int"))
    half = lambda i: F.get(octet, F.lit(i)) * 256 + F.get(octet, F.lit(i + 1))
    mixed = feistel(half(0), half(2), F.lit(65536).cast("long"), F.lit(65536).cast("long"), key, "ip")
    ip = F.concat_ws(".", *[x.cast("string") for h in ("l", "r") for x in (F.floor(mixed[h] / 256), mixed[h] % 256)])
    lead = F.regexp_extract(value, "^[A-Za-z_]+\\s*[=:]\\s*[\"']?", 0)
    secret = F.regexp_extract(F.substr(value, F.length(lead) + 1), "^[^\"']*", 0)
    tail = F.substr(value, F.length(lead) + F.length(secret) + 1)
    like = lambda k: value.rlike(_WHOLE[k])
    return (
        F.when(like("email"), F.concat(F.lit("user-"), _hashed(F.lower(value), key, "email", F.lit(12)), F.lit("@example.invalid")))
        .when(like("aws"), F.concat(F.substring(value, 1, 4), F.upper(_hashed(value, key, "secret", F.lit(16)))))
        .when(like("token"), token)
        .when(like("secret"), F.concat(lead, _hashed(secret, key, "secret", F.length(secret)), tail))
        .when(like("iban") & (F.when(like("iban") & (n >= 4) & F.length(bban).between(10, 30), _iban_remainder(bban, country, check)).otherwise(0) == 1), iban)
        .when(like("phone"), phone)
        .when(like("far"), far)
        .when(like("ssn") & ~value.rlike("^(?:000|666|9)|-00-|-0000$"), ssn)
        .when(like("date") & day.isNotNull(), date)
        .when(like("ip") & F.forall(octet, lambda x: x <= 255), ip)
        .when(like("card") & n.between(13, 19) & (luhn_sum(digits) % 10 == 0), F.concat(_card(value, key), F.lit("|")))
        .when(like("card") | like("iban"), _cards_within(value, key))
        .otherwise(value)
    )


def _has_marks(value: Column) -> Column:
    return value.rlike(_MARKED)


def pseudonym(value: Column, key: str) -> Column:
    """The pseudonym of a value that PATTERN found; the value itself where it doesn't validate."""
    return _unmarked(value, _marked(value, key))


def _unmarked(value: Column, new: Column) -> Column:
    return F.when(_has_marks(value), F.translate(new, "|", "")).otherwise(new)


def pseudonymise(docs: DataFrame, key: str, text: str = "text", found: str | None = None) -> DataFrame:
    """docs with the text's personal data replaced; `found` names a column for the number of replacements.

    Who knows the key can turn pseudonyms back: it belongs to the caller, and has no default."""
    if not key:
        raise ValueError("pseudonyms need a key")
    marked = F.transform(F.regexp_extract_all(F.col(text), F.lit(PATTERN), F.lit(0)), lambda v: F.struct(v.alias("old"), _marked(v, key).alias("new")))
    count = lambda x: F.when(_has_marks(x["old"]) & x["new"].contains("|"), F.length(F.regexp_replace(x["new"], "[^|]", ""))).otherwise((x["old"] != x["new"]).cast("int"))
    old = F.transform(marked, lambda x: F.struct(_unmarked(x["old"], x["new"]).alias("new"), count(x).alias("n")))
    pair = "__pairs"
    while pair in docs.columns:
        pair += "_"
    has = F.col(text).rlike(PATTERN)
    paired = docs.withColumn(pair, F.when(has, F.struct(old.alias("v"), F.split(F.col(text), PATTERN, -1).alias("g"))))
    v, g = F.col(pair)["v"], F.col(pair)["g"]
    joined = F.array_join(F.zip_with(g, F.transform(v, lambda x: x["new"]), lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
    out = paired.withColumn(text, F.when(F.col(pair).isNotNull(), joined).otherwise(F.col(text)))
    if found:
        out = out.withColumn(found, F.coalesce(F.aggregate(v, F.lit(0), lambda n, x: n + x["n"]), F.lit(0)))
    return out.drop(pair)
