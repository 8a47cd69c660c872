"""Personal data to format-preserving pseudonyms, in column expressions only.

Validated numbers and dates are permuted within their own format by a keyed Feistel network: a card number stays a
card number that passes its check digit, an address stays an address, a date stays a date of the same style. The
permutation depends on the key and the kind alone, so equal values get equal pseudonyms in all documents, and
different ones of a kind stay different. E-mail addresses have no fixed alphabet; they get a keyed digest as name.

Kinds: email; card (13 to 19 digits with a valid check digit, plain or in groups); iban (valid check digits); phone; ip
(version 4, but for versions such as v1.2.3.4); ip6 (eight groups, or fewer around a ``::`` behind a first group of four
digits); ssn; date (years 1800 to 2199); key (AKIA or ASIA and 16 letters and digits); token (prefixes of TOKEN, which stay);
password (see PASSWORD; its letters and digits are permuted, other signs stay in their places); secret (32 to 64 hexadecimal
digits). What fails validation is left as it stands.

The key is a literal of the plan: where plans are kept (user interface, event log), ``spark.sql.redaction.string.regex`` must
cover it.

Defined cases: a null text stays null with nothing found; an empty text stays empty; repeated rows get equal results;
an empty table gives no rows; other columns are kept, but for one named ``pii_found``, which gives way to the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annomerge.llm.common import numbered, renamed

ROUNDS = 10
#: Days from the first day of 1800 to the last of 2199: a whole Gregorian cycle, 189 x 773.
FIRST_DAY, DAYS = "1800-01-01", (189, 773)
OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
NAME = r"[\p{L}\p{N}._%+-]"
EMAIL = rf"(?<!{NAME}){NAME}++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{{2,}}"
IP = rf"(?<![\d.])(?<!(?<![A-Za-z])[vV]){OCTET}(?:\.{OCTET}){{3}}(?!\d|\.\d)"
DATE = r"(?<!\d)(?:\d{4}-\d\d-\d\d|\d\d/\d\d/\d{4}|\d\d\.\d\d\.\d{4})(?!\d)"
SSN = r"(?<![\d-])\d{3}-\d\d-\d{4}(?![\d-])"
NO_DATE = r"(?![ .-](?:\d{4}-\d\d-\d\d|\d\d[./]\d\d[./]\d{4}))"
#: After a plus sign: 3-3-4, nine digits in France and Spain, ten in Britain, else 8 to 15 in any groups. Without one: 3-3-4, also
#: after a 1; French pairs and British 3-4-4 after a 0.
PHONE = (
    r"(?:\+\d{1,3}[ .-]?\(?\d{3}\)?[ .-]?\d{3}[ .-]?\d{4}|\+(?:3[34](?:[ .-]?\(0\))?(?:[ .-]?\d){9}|44(?:[ .-]?\(0\))?(?:[ .-]?\d){10})"
    rf"|(?<![\p{{L}}\d])\+[1-9](?:{NO_DATE}[ .-]?\(?\d\)?){{7,14}}"
    r"|(?<![\d(+.-])(?:(?:1[ .-])?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}|0\d(?:[ .-]\d\d){4}(?![ .-]\d\d(?!\d))|0\d\d[ .-]\d{4}[ .-]\d{4}))(?!\d)"
)
SECRET = r"(?<![0-9A-Za-z])(?=[0-9a-f]*[a-f]|[0-9A-F]*[A-F])(?:[0-9a-f]{32,64}|[0-9A-F]{32,64})(?![0-9A-Za-z])"
GROUP = "[0-9a-fA-F]{1,4}"
IP6 = rf"(?<![0-9A-Za-z:])(?:(?:{GROUP}:){{7}}{GROUP}|(?=[a-fA-F:]*[0-9])[0-9a-fA-F]{{4}}(?::{GROUP}){{0,6}}::(?:{GROUP}(?::{GROUP}){{0,5}})?)(?![0-9A-Za-z:])"
IBAN = r"(?<![0-9A-Za-z])[A-Z]{2}\d\d(?: ?[0-9A-Z]{4}){2,7}(?: ?[0-9A-Z]{1,3})?(?![0-9A-Za-z])"
ACCESS_KEY = r"(?<![0-9A-Za-z])A[KS]IA[0-9A-Z]{16}(?![0-9A-Za-z])"
TOKEN = r"(?<![0-9A-Za-z_-])(?:(?:gh[opsur]_|npm_|[ps]k_(?:live|test)_)[0-9A-Za-z]{16,}|(?:github_pat_|glpat-|xox[abprs]-|AIza|sk-)[0-9A-Za-z_-]{16,})(?![0-9A-Za-z])"
#: A visible ASCII sign of a password without quotes. A comma, semicolon or ampersand ends it before a blank or another name=.
SIGN = r"(?:[!#-%(-+\--:=?-~]|[,;&](?=[!-~])(?![A-Za-z_][0-9A-Za-z_]*=))"
AHEAD = r"(?i:password|passwd|pwd)[\"']?[ \t]*[=:]"
#: Six signs or more: in quotes any of the line up to 128; without, up to a blank and without closing punctuation, and behind a
#: blank only if one is a digit or a sign that prose does not use.
PASSWORD = (
    rf"{AHEAD}(?:[ \t]*(?:\"[^\"\x00-\x1F]{{6,128}}\"|'[^'\x00-\x1F]{{6,128}}')"
    rf"|(?:[ \t]+(?={SIGN}*?[0-9#$%&*+=@^~]))?[\"']?{SIGN}{{5,}}[!#-%(*+\-/-9=?-\\^-|~])"
)
CARD = r"(?<!\d)(?:\d{13,19}|\d{4}(?: \d{4}){3}|\d{4}(?:-\d{4}){3}|\d{4}[ -]\d{6}[ -]\d{5})(?!\d)"
KINDS = (("email", EMAIL), ("ip", IP), ("ip6", IP6), ("date", DATE), ("ssn", SSN), ("iban", IBAN), ("phone", PHONE), ("key", ACCESS_KEY), ("token", TOKEN), ("password", PASSWORD), ("secret", SECRET), ("card", CARD))
ANY = "|".join(f"(?:{pattern})" for _, pattern in KINDS)
#: Holds in every text that ANY finds something in, and costs less.
GATE = rf"\d\d|@|\d\.\d|[0-9a-fA-F]{{32}}|A[KS]IA[0-9A-Z]{{16}}|{AHEAD}|[0-9a-fA-F]:[0-9a-fA-F]{{1,4}}:|[0-9a-fA-F]{{4}}::|gh[opsur]_|npm_|[ps]k_(?:live|test)_|github_pat_|glpat-|xox[abprs]-|AIza|sk-"
#: Country codes of one and two digits; all others have three.
CODE_1, CODE_2 = "^[17]", "^(?:2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"
HEX = "0123456789abcdef"
UPPER = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BOTH = UPPER + UPPER[10:].lower()


def keyed(key: str, kind: str, turn: Column, half: Column) -> Column:
    """Hexadecimal digest that a round adds."""
    return F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), turn.cast("string"), half.cast("string")), 256)


def keyed_number(key: str, kind: str, turn: Column, half: Column) -> Column:
    return F.conv(F.substring(keyed(key, kind, turn, half), 1, 15), 16, 10).cast("long")


def rounds(start: Column, step) -> Column:
    """ROUNDS times ``step(state, turn)``."""
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step)


def permute_pair(key: str, kind: str, left: Column, right: Column, a: int, b: int) -> Column:
    """A permutation of pairs (left below a, right below b): each in turn gets a keyed number of the other added."""
    def step(s: Column, turn: Column) -> Column:
        even = turn % 2 == 0
        return F.struct(F.when(even, (s["l"] + keyed_number(key, kind, turn, s["r"])) % a).otherwise(s["l"]).alias("l"), F.when(even, s["r"]).otherwise((s["r"] + keyed_number(key, kind, turn, s["l"])) % b).alias("r"))

    return rounds(F.struct(left.cast("long").alias("l"), right.cast("long").alias("r")), step)


def permute_digits(key: str, kind: str, digits: Column) -> Column:
    """A permutation of the digit strings of each length from 2 to 36: halves swap roles each round."""
    n = F.length(digits)
    short = F.floor(n / 2).cast("int")

    def step(s: Column, turn: Column) -> Column:
        m = F.length(s["l"])
        whole = F.pow(F.lit(10.0), m).cast("long")
        added = (s["l"].cast("long") + F.pmod(keyed_number(key, kind, turn, s["r"]), whole)) % whole
        return F.struct(s["r"].alias("l"), F.lpad(added.cast("string"), m, "0").alias("r"))

    done = rounds(F.struct(F.substring(digits, F.lit(1), short).alias("l"), F.substring(digits, short + 1, n).alias("r")), step)
    return F.concat(done["l"], done["r"])


def permute_hex(key: str, text: Column) -> Column:
    """As permute_digits, digit by digit modulo 16; case is kept."""
    low, n = F.lower(text), F.length(text)
    short = F.floor(n / 2).cast("int")
    value = lambda s, i: F.instr(F.lit(HEX), F.substring(s, i, F.lit(1))) - 1

    def step(s: Column, turn: Column) -> Column:
        added = keyed(key, "secret", turn, s["r"])
        digits = F.transform(F.sequence(F.lit(1), F.length(s["l"])), lambda i: F.substring(F.lit(HEX), (value(s["l"], i) + value(added, i)) % 16 + 1, F.lit(1)))
        return F.struct(s["r"].alias("l"), F.array_join(digits, "").alias("r"))

    done = rounds(F.struct(F.substring(low, F.lit(1), short).alias("l"), F.substring(low, short + 1, n).alias("r")), step)
    out = F.concat(done["l"], done["r"])
    return F.when(text == low, out).otherwise(F.upper(out))


def permute_signs(key: str, kind: str, text: Column, signs: str) -> Column:
    """As permute_digits, sign by sign modulo their number, for texts of 2 to 32 of them."""
    n = F.length(text)
    short = F.floor(n / 2).cast("int")
    value = lambda s, i: F.instr(F.lit(signs), F.substring(s, i, F.lit(1))) - 1

    def step(s: Column, turn: Column) -> Column:
        added = keyed(key, kind, turn, s["r"])
        drawn = lambda i: F.conv(F.substring(added, i * 4 - 3, F.lit(4)), 16, 10).cast("int")
        made = F.transform(F.sequence(F.lit(1), F.length(s["l"])), lambda i: F.substring(F.lit(signs), (value(s["l"], i) + drawn(i)) % len(signs) + 1, F.lit(1)))
        return F.struct(s["r"].alias("l"), F.array_join(made, "").alias("r"))

    done = rounds(F.struct(F.substring(text, F.lit(1), short).alias("l"), F.substring(text, short + 1, n).alias("r")), step)
    return F.concat(done["l"], done["r"])


def digits_of(text: Column) -> Column:
    return F.regexp_replace(text, r"\D", "")


def refill(text: Column, signs: Column, kind: str = "0-9") -> Column:
    """The text with its signs of a kind, which are digits, replaced one after another."""
    def one(i: Column) -> Column:
        c = F.substring(text, i, F.lit(1))
        return F.when(c.rlike(f"[{kind}]"), F.substring(signs, F.length(F.regexp_replace(F.substring(text, F.lit(1), i), f"[^{kind}]", "")), F.lit(1))).otherwise(c)

    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(text)), one), "")


def luhn_sum(digits: Column, odd: int) -> Column:
    """Sum of digits, doubling those whose place from the right, from 0, has parity ``odd``; nines cast out."""
    n = F.length(digits)

    def add(acc: Column, i: Column) -> Column:
        d = F.substring(digits, n - i, F.lit(1)).cast("int")
        return acc + F.when(i % 2 == odd, F.when(d > 4, 2 * d - 9).otherwise(2 * d)).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add)


def new_card(key: str, hit: Column) -> Column:
    digits = digits_of(hit)
    body = permute_digits(key, "card", F.substring(digits, F.lit(1), F.length(digits) - 1))
    full = F.transform(F.array(body), lambda b: F.concat(b, ((10 - luhn_sum(b, 0) % 10) % 10).cast("string")))[0]
    return F.when(luhn_sum(digits, 1) % 10 == 0, refill(hit, full))


def new_phone(key: str, hit: Column) -> Column:
    """The last ten digits are permuted, or all behind a country code or a trunk 0 if those are fewer."""
    digits = digits_of(hit)
    code = F.when(digits.rlike(CODE_1), 1).when(digits.rlike(CODE_2), 2).otherwise(3) + F.when(F.contains(hit, F.lit("(0)")), 1).otherwise(0)
    ahead = F.when(F.startswith(hit, F.lit("+")), code).when(hit.rlike(r"^0\d(?:\D\d\d){4}$"), 1).otherwise(0)
    own = F.least(F.lit(10), F.length(digits) - ahead)
    return refill(hit, F.concat(F.substring(digits, F.lit(1), F.length(digits) - own), permute_digits(key, "phone", F.right(digits, own))))


def new_ip(key: str, hit: Column) -> Column:
    o = F.transform(F.split(hit, r"\."), lambda x: x.cast("int"))
    made = F.array(permute_pair(key, "ip", o[0] * 256 + o[1], o[2] * 256 + o[3], 65536, 65536))
    text = lambda s: F.concat_ws(".", *[x.cast("string") for h in ("l", "r") for x in (F.floor(s[h] / 256).cast("int"), s[h] % 256)])
    return F.transform(made, text)[0]


def new_ip6(key: str, hit: Column) -> Column:
    """All 32 hexadecimal digits, written in full, so equal addresses meet however their zeros are written."""
    groups = lambda part: F.filter(F.split(part, ":"), lambda g: g != "")
    ahead, behind = groups(F.substring_index(hit, "::", 1)), F.when(F.contains(hit, F.lit("::")), groups(F.substring_index(hit, "::", -1))).otherwise(F.array().cast("array<string>"))
    missing = F.lit(8) - F.size(ahead) - F.size(behind)
    every = F.concat(ahead, F.array_repeat(F.lit("0"), missing), behind)
    full = F.array_join(F.transform(every, lambda g: F.lpad(F.lower(g), 4, "0")), "")
    made = F.transform(F.array(full), lambda x: permute_hex(key, x))[0]
    return F.when((missing >= 0) & ((missing > 0) == F.contains(hit, F.lit("::"))), F.array_join(F.transform(F.sequence(F.lit(0), F.lit(7)), lambda k: F.substring(made, k * 4 + 1, F.lit(4))), ":"))


def mod_97(text: Column) -> Column:
    """The remainder of the number that digits, and letters as 10 to 35, write."""
    def add(acc: Column, i: Column) -> Column:
        code = F.ascii(F.substring(text, i, F.lit(1)))
        return F.when(code < 58, acc * 10 + code - 48).otherwise(acc * 100 + code - 55) % 97

    return F.aggregate(F.sequence(F.lit(1), F.length(text)), F.lit(0), add)


def new_iban(key: str, hit: Column) -> Column:
    """The digits behind the check digits are permuted, letters stay, and check digits follow."""
    plain = F.replace(hit, F.lit(" "), F.lit(""))
    country, check, body = F.substring(plain, 1, 2), F.substring(plain, 3, 2), F.substring(plain, F.lit(5), F.length(plain))
    digits = F.transform(F.array(digits_of(body)), lambda d: permute_digits(key, "iban", d))
    whole = F.transform(digits, lambda d: F.concat(F.lpad((98 - mod_97(F.concat(refill(body, d), country, F.lit("00")))).cast("string"), 2, "0"), d))[0]
    return F.when((mod_97(F.concat(body, country, check)) == 1) & (F.length(digits_of(body)) > 1), refill(hit, whole))


def new_access_key(key: str, hit: Column) -> Column:
    return F.concat(F.substring(hit, 1, 4), permute_signs(key, "key", F.substring(hit, 5, 16), UPPER))


def behind(key: str, kind: str, hit: Column, ahead: str) -> Column:
    """The letters and digits behind the match of ``ahead`` are permuted, in equal parts of at most 32; other signs stay.
    Null for fewer than two."""
    first = F.regexp_extract(hit, ahead, 0)
    rest = F.substring(hit, F.length(first) + 1, F.length(hit))
    own = F.regexp_replace(rest, "[^0-9A-Za-z]", "")

    def parts(x: Column) -> Column:
        n = F.length(x)
        k = F.greatest(F.lit(1), F.ceil(n / 32).cast("int"))
        edge = lambda i: F.floor(i * n / k).cast("int")
        return F.array_join(F.transform(F.sequence(F.lit(0), k - 1), lambda i: permute_signs(key, kind, F.substring(x, edge(i) + 1, edge(i + 1) - edge(i)), BOTH)), "")

    made = F.transform(F.array(own), parts)
    return F.when(F.length(own) > 1, F.transform(made, lambda m: F.concat(first, refill(rest, m, "0-9A-Za-z")))[0])


def new_token(key: str, hit: Column) -> Column:
    return behind(key, "token", hit, "^(?:github_pat_|glpat-|xox[a-z]-|AIza|sk-|[a-z]+_(?:(?:live|test)_)?)")


def new_password(key: str, hit: Column) -> Column:
    return behind(key, "password", hit, "^" + AHEAD + r"[ \t]*[\"']?")


def new_ssn(key: str, hit: Column) -> Column:
    """Areas 001 to 899 but 666, groups 01 to 99, serials 0001 to 9999, and nothing else, is valid."""
    area, group, serial = (F.substring(hit, at, n).cast("int") for at, n in ((1, 3), (5, 2), (8, 4)))
    valid = (area > 0) & (area < 900) & (area != 666) & (group > 0) & (serial > 0)
    made = F.array(permute_pair(key, "ssn", area - 1 - F.when(area > 666, 1).otherwise(0), (group - 1) * 9999 + serial - 1, 898, 99 * 9999))
    text = lambda s: F.format_string("%03d-%02d-%04d", s["l"] + 1 + F.when(s["l"] >= 665, 1).otherwise(0), F.floor(s["r"] / 9999) + 1, s["r"] % 9999 + 1)
    return F.when(valid, F.transform(made, text)[0])


def new_date(key: str, hit: Column) -> Column:
    """Within the style; day before month where that is a date, else month before day."""
    def styled(style: str) -> Column:
        day = F.datediff(F.try_to_date(hit, style), F.lit(FIRST_DAY).cast("date"))
        made = F.array(permute_pair(key, "date", F.floor(day / DAYS[1]), day % DAYS[1], *DAYS))
        moved = F.transform(made, lambda s: F.date_format(F.date_add(F.lit(FIRST_DAY).cast("date"), (s["l"] * DAYS[1] + s["r"]).cast("int")), style))[0]
        return F.when((day >= 0) & (day < DAYS[0] * DAYS[1]), moved)

    return F.when(F.substring(hit, 5, 1) == "-", styled("yyyy-MM-dd")).when(F.substring(hit, 3, 1) == ".", styled("dd.MM.yyyy")).otherwise(F.coalesce(styled("dd/MM/yyyy"), styled("MM/dd/yyyy")))


def new_email(key: str, hit: Column) -> Column:
    low = F.lower(hit)
    return F.concat(F.lit("u"), F.substring(keyed(key, "email", F.lit(0), low), 1, 16), F.lit("@d"), F.substring(keyed(key, "domain", F.lit(0), F.substring_index(low, "@", -1)), 1, 8), F.lit(".example.com"))


MAKERS = {"email": new_email, "ip": new_ip, "ip6": new_ip6, "iban": new_iban, "key": new_access_key, "token": new_token, "password": new_password, "date": new_date, "ssn": new_ssn, "phone": new_phone, "secret": lambda key, hit: permute_hex(key, hit), "card": new_card}


def kind_of(hit: Column) -> Column:
    out = F.when(F.contains(hit, F.lit("@")) & ~hit.rlike("[=:]"), F.lit("email"))
    for kind, pattern in KINDS[1:]:
        out = out.when(hit.rlike(f"^(?:{pattern})$"), F.lit(kind))
    return out


def pseudonym(key: str, kind: Column, hit: Column) -> Column:
    """Null where validation fails."""
    out = F.when(kind == "email", new_email(key, hit))
    for name, make in MAKERS.items():
        if name != "email":
            out = out.when(kind == name, make(key, hit))
    return out


def pseudonymise(docs: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """Rows with the text replaced in place, and ``pii_found``, in place of a column of that name: array of (kind, pseudonym)
    in order of place.

    Only a text in which GATE holds is searched.
    """
    out, text_name = numbered(docs, text_col)
    text = F.col(text_name).cast("string")
    some = text.rlike(GATE)
    hits = F.when(some, F.regexp_extract_all(text, F.lit(ANY), F.lit(0)))
    made = F.transform(F.transform(hits, lambda h: F.struct(kind_of(h).alias("kind"), h.alias("hit"))), lambda x: F.struct(x["kind"].alias("kind"), x["hit"].alias("hit"), pseudonym(key, x["kind"], x["hit"]).alias("pseudonym")))
    rows = out.withColumn("pii_made", made)
    pieces = F.split(text, ANY, -1)
    fill = F.concat(F.transform("pii_made", lambda x: F.coalesce(x["pseudonym"], x["hit"])), F.array(F.lit("")))
    new = F.when(F.size("pii_made") > 0, F.array_join(F.zip_with(pieces, fill, lambda p, f: F.concat(p, f)), "")).otherwise(text)
    found = F.transform(F.filter("pii_made", lambda x: x["pseudonym"].isNotNull()), lambda x: F.struct(x["kind"].alias("kind"), x["pseudonym"].alias("pseudonym")))
    own = [new.alias(c) if c == text_name else F.col(c) for c in out.columns]
    return renamed(rows.select(*own, F.coalesce(found, F.array().cast("array<struct<kind:string,pseudonym:string>>")).alias("pii_found")), docs.columns, "pii_found")
