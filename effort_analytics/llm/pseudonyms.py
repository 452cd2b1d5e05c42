"""PII (3): format-preserving Feistel pseudonyms, in Spark SQL expressions throughout.

Personal numbers, dates and names of accounts are found by one pattern, told apart and validated
(Luhn digit, octets, calendar, number plan), and replaced by a keyed permutation of all valid values
of the same format. So equal values get equal pseudonyms in every document, different values
different ones, and what was valid stays valid.

A value is numbered within its format's domain, the number split as l * b + r with domain a * b, and
l and r are changed in turns: l + F(r) modulo a, r + F(l) modulo b, with F from SHA-256 of key, kind,
round and the other half. Each step can be undone, so the whole is a permutation for any F. Strings
(account names, keys) are split in two halves of characters, each moved within its own alphabet.

Only documents with a digit or an @ are looked into; nothing is shuffled.

A card number may stand in a run of digit groups with others (a CVV, an expiry date), so the
run's parts are tried, too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import fresh, table

ROUNDS = 10
#: The query's key. A deployment passes its own, from its secret store.
KEY = "not-a-secret"
# Loops over groups are possessive: Java's matcher runs these in place, others by recursion.
_EMAIL = r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
_KEY_ID = r"AKIA[0-9A-Z]{16}"
_SECRET = r"(?:password|passwd|secret|token|api_key)\s?=\s?\"?[0-9a-f]{12,64}"
_DATE = r"\d{4}-\d{2}-\d{2}|\d{1,2}\.\d{1,2}\.\d{4}|\d{1,2}/\d{1,2}/\d{4}"
_SEPARATED = r"(?:\+?1[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}"
_SSN = r"\d{3}-\d{2}-\d{4}"
_IP = r"\d{1,3}(?:\.\d{1,3}){3}"
#: What a run of digit groups stops before: a value of another kind.
_STOP = rf"(?![ -](?:{_DATE}|{_SEPARATED}|{_SSN}|{_IP})(?![A-Za-z0-9]|[.-]\d))"
#: North American numbers with separators or without any, and those with a + (8 to 15 digits).
_PHONE = rf"{_SEPARATED}|[2-9]\d{{9}}|\+[1-9](?:(?:{_STOP}[ .-])?(?:\(\d{{1,4}}\)|\d)){{6,14}}"
#: A run of digit groups with 13 digits at least, of which none is followed by a letter or a decimal part.
_GROUP = r"\d++(?![A-Za-z]|\.\d)"
_CARD = rf"(?=\d(?:[ -]?\d){{12}}){_GROUP}(?:{_STOP}[ -]{_GROUP})*+"
#: kind and pattern, in the order in which they are tried
KINDS = [("email", _EMAIL), ("key", _KEY_ID), ("secret", _SECRET), ("date", _DATE), ("phone", _PHONE), ("ssn", _SSN), ("ip", _IP), ("card", _CARD)]
PATTERN = r"(?<![A-Za-z0-9._%+-])(?:" + "|".join(p for _, p in KINDS) + r")(?![A-Za-z0-9]|[.-]\d)"
#: Digit groups that are worked on at a time.
BLOCK = 256
#: Days from here make a domain of 400 years = 189 * 773 days.
FIRST_DAY = "1800-01-01"


def let(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once, however often it is used (also in inner loops)."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _f(key: str, kind: str, i: Column, x: Column) -> Column:
    """Keyed round function: 48 bits."""
    return F.conv(F.substring(F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), i.cast("string"), x.cast("string")), 256), 1, 12), 16, 10).cast("long")


def feistel(value: Column, a, b, key: str, kind: str) -> Column:
    """Keyed permutation of 0 .. a*b-1 (``value``, ``a``, ``b`` long)."""
    a, b = (x if isinstance(x, Column) else F.lit(x).cast("long") for x in (a, b))
    half = F.struct(((value - F.pmod(value, b)) / b).cast("long").alias("l"), F.pmod(value, b).alias("r"))

    def turn(x, i):
        left = i % 2 == 0
        return F.struct(F.when(left, F.pmod(x.l + _f(key, kind, i, x.r), a)).otherwise(x.l).alias("l"),
                        F.when(left, x.r).otherwise(F.pmod(x.r + _f(key, kind, i, x.l), b)).alias("r"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), half, turn, lambda x: x.l * b + x.r)


def _moved(s: Column, other: Column, i: Column, alphabets: list[str], key: str, kind: str) -> Column:
    digest = F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), i.cast("string"), F.length(s).cast("string"), other), 256)

    def one(j):
        c = F.substring(s, j, F.lit(1))
        by = F.conv(F.substring(digest, (j - 1) % 30 * 2 + 1, F.lit(4)), 16, 10).cast("int")
        out = c
        for letters in alphabets:
            at = F.instr(F.lit(letters), c)
            out = F.when(at > 0, F.substring(F.lit(letters), F.pmod(at - 1 + by, F.lit(len(letters))) + 1, F.lit(1))).otherwise(out)
        return out
    return F.when(F.length(s) > 0, F.array_join(F.transform(F.sequence(F.lit(1), F.length(s)), one), "")).otherwise(s)


def feistel_text(s: Column, alphabets: list[str], key: str, kind: str) -> Column:
    """Keyed permutation of the strings with each character in the same alphabet as before."""
    n = F.floor(F.length(s) / 2).cast("int")
    half = F.struct(F.substring(s, F.lit(1), n).alias("l"), F.substring(s, n + 1, F.length(s)).alias("r"))

    def turn(x, i):
        left = i % 2 == 0
        return F.struct(F.when(left, _moved(x.l, x.r, i, alphabets, key, kind)).otherwise(x.l).alias("l"),
                        F.when(left, x.r).otherwise(_moved(x.r, x.l, i, alphabets, key, kind)).alias("r"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), half, turn, lambda x: F.concat(x.l, x.r))


LOWER, UPPER, DIGITS, HEX = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "0123456789abcdef"


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _filled(m: Column, digits: Column) -> Column:
    """``m`` with its digits, from the left, replaced by ``digits``."""
    def one(i):
        c = F.substring(m, i, F.lit(1))
        return F.when(c.rlike("^[0-9]$"), F.substring(digits, F.length(_digits(F.substring(m, F.lit(1), i))), F.lit(1))).otherwise(c)
    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(m)), one), "")


def _luhn(digits: Column) -> Column:
    """Luhn sum of digits, the last one being the check digit."""
    def add(total, i):
        x = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int") * F.when(i % 2 == 1, 2).otherwise(1)
        return total + F.when(x > 9, x - 9).otherwise(x)
    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), add)


def _long(s: Column, at: int, n: int) -> Column:
    return F.substring(s, F.lit(at), F.lit(n)).cast("long")


def _card(m: Column, key: str) -> Column:
    """The first digit stays, the check digit follows from the others."""
    def moved(d):
        n = F.length(d) - 2
        high = F.pow(F.lit(10.0), F.ceil(n / 2)).cast("long")
        low = F.pow(F.lit(10.0), F.floor(n / 2)).cast("long")
        return F.concat(F.substring(d, 1, 1), F.lpad(feistel(F.substring(d, F.lit(2), n).cast("long"), high, low, key, "card").cast("string"), n, F.lit("0")))

    def whole(m, d):
        new = let(moved(d), lambda head: F.concat(head, F.pmod(10 - _luhn(F.concat(head, F.lit("0"))) % 10, F.lit(10)).cast("string")))
        return F.when(F.call_function("luhn_check", d), let(new, lambda x: _filled(m, x)))
    return let(m, lambda m: let(_digits(m), lambda d: whole(m, d)))


def _cards(m: Column, key: str) -> Column:
    """struct(out, n) of a run of digit groups: the run with each card replaced (NULL without one),
    and their number. Sub-runs of one group, or of several of which all but the last have 4 to 12
    digits (so five at most make a card's 19), are tried from the left and the longest first;
    without a card among them, the whole run, grouped in any way.

    The groups are worked on in blocks of ``BLOCK``, so that a run of any length takes time in
    proportion to its length, or nearly; a card may reach into the next block."""
    def longest(own, j):  # groups of the longest card from the j-th of these groups on, or 0
        def add(t, group):
            bare = F.regexp_replace(group, "[ -]$", "")
            digits = F.when(F.length(t["digits"]) > 19, t["digits"]).otherwise(F.concat(t["digits"], bare))
            good = t["open"] & F.length(digits).between(13, 19) & F.call_function("luhn_check", digits)
            return F.struct(digits.alias("digits"), (t["open"] & F.length(bare).between(4, 12)).alias("open"), (t["k"] + 1).alias("k"),
                            F.when(good, t["k"] + 1).otherwise(t["used"]).alias("used"))
        start = F.struct(F.lit("").alias("digits"), F.lit(True).alias("open"), F.lit(0).alias("k"), F.lit(0).alias("used"))
        return F.aggregate(F.slice(own, j + 1, F.lit(5)), start, add, lambda t: t["used"])

    def block(groups, x, b):
        lo = b * BLOCK
        count = F.least(F.size(groups) - lo, F.lit(BLOCK))

        def walk(own):
            def one(y, j):
                def put(k):
                    run = F.array_join(F.slice(own, j + 1, k), "")
                    new = let(run, lambda r: F.concat(_card(F.regexp_replace(r, "[ -]$", ""), key), F.regexp_extract(r, "[ -]?$", 0)))
                    return F.when(k > 0, F.struct(F.concat(y["out"], new).alias("out"), (y["n"] + 1).alias("n"), (lo + j + k).alias("next"))).otherwise(
                        F.struct(F.concat(y["out"], F.get(own, j)).alias("out"), y["n"].alias("n"), y["next"].alias("next")))
                return F.when(lo + j < y["next"], y).otherwise(let(longest(own, j), put))
            start = F.struct(F.lit("").alias("out"), x["n"].alias("n"), x["next"].alias("next"))
            return F.aggregate(F.sequence(F.lit(0), count - 1), start, one)
        return let(F.slice(groups, lo + 1, F.lit(BLOCK + 5)), walk)

    def solve(groups):
        def add(x, b):
            return let(block(groups, x, b), lambda z: F.struct(F.concat(x["out"], z["out"]).alias("out"), z["n"].alias("n"), z["next"].alias("next")))
        start = F.struct(F.lit("").alias("out"), F.lit(0).alias("n"), F.lit(0).alias("next"))
        last = F.floor((F.size(groups) - 1) / F.lit(BLOCK)).cast("int")
        return F.aggregate(F.sequence(F.lit(0), last), start, add)

    d = _digits(m)
    whole = F.struct(F.when(F.length(d) <= 19, _card(m, key)).alias("out"), F.lit(1).alias("n"))
    found = let(F.regexp_extract_all(m, F.lit("[0-9]+[ -]?"), F.lit(0)), solve)
    return let(found, lambda x: F.when(x["n"] > 0, F.struct(x["out"].alias("out"), x["n"].alias("n"))).otherwise(whole))


def _phone(m: Column, key: str) -> Column:
    """North American numbers: country code and the first digits of area and exchange stay, so that
    numbers valid in the plan stay so; the other eight digits move. Numbers with another country
    code: the + and the first four digits stay, so the code does; the others move."""
    d = _digits(m)
    code = F.substring(d, F.lit(1), F.length(d) - 10)
    own = F.substring(d, F.length(d) - 9, F.lit(10))
    x = feistel((_long(own, 2, 2) * 100 + _long(own, 5, 2)) * 10_000 + _long(own, 7, 4), 10_000, 10_000, key, "phone")
    new = F.lpad(x.cast("string"), 8, "0")
    near = _filled(m, F.concat(code, F.substring(own, 1, 1), F.substring(new, 1, 2), F.substring(own, 4, 1), F.substring(new, 3, 6)))
    n = F.length(d) - 4
    high, low = (F.pow(F.lit(10.0), f(n / 2)).cast("long") for f in (F.ceil, F.floor))
    y = feistel(F.substring(d, F.lit(5), n).cast("long"), high, low, key, "phone abroad")
    far = _filled(m, F.concat(F.substring(d, 1, 4), F.lpad(y.cast("string"), n, F.lit("0"))))
    american = (F.length(d) == 10) & ~m.startswith("+") | (F.length(d) == 11) & d.startswith("1")
    return F.when(american, near).when(F.length(d).between(8, 15), far)


def _ssn(m: Column, key: str) -> Column:
    area, group, serial = _long(m, 1, 3), _long(m, 5, 2), _long(m, 8, 4)
    ok = (area > 0) & (area != 666) & (area < 900) & (group > 0) & (serial > 0)
    place = area - F.when(area > 666, 2).otherwise(1)
    x = feistel((place * 99 + group - 1) * 9999 + serial - 1, 898 * 99, 9999, key, "ssn")
    top = ((x - x % 9999) / 9999).cast("long")
    place = ((top - top % 99) / 99).cast("long")
    area = place + F.when(place >= 665, 2).otherwise(1)
    return F.when(ok, F.concat(F.lpad(area.cast("string"), 3, "0"), F.lit("-"), F.lpad((top % 99 + 1).cast("string"), 2, "0"), F.lit("-"), F.lpad((x % 9999 + 1).cast("string"), 4, "0")))


def _ip(m: Column, key: str) -> Column:
    """Dotted quads without leading zeros."""
    value = F.aggregate(F.split(m, r"\."), F.lit(0).cast("long"), lambda t, o: t * 256 + o.cast("long"))
    x = feistel(value, 65_536, 65_536, key, "ip")
    octets = F.array(*(F.shiftright(x, s).bitwiseAND(255).cast("string") for s in (24, 16, 8, 0)))
    ok = F.forall(F.split(m, r"\."), lambda o: (o.cast("int") <= 255) & (o.cast("int").cast("string") == o))
    return F.when(ok, F.array_join(octets, "."))


def _month_first(m: Column) -> Column:
    """The first day of a month, counted from that of ``FIRST_DAY``."""
    return F.add_months(F.lit(FIRST_DAY).cast("date"), m.cast("int"))


def _late_day(day: Column, key: str) -> Column:
    """Permutation of the days after the twelfth of their months, which only dd/MM/yyyy can mean:
    there are 9 * 9833 in 400 years."""
    start = F.lit(FIRST_DAY).cast("date")

    def before(m):  # late days before the month
        return F.datediff(_month_first(m), start).cast("long") - 12 * m
    month = (F.year(day) - int(FIRST_DAY[:4])) * 12 + F.month(day) - 1
    x = feistel(before(month) + F.day(day) - 13, 9, 9833, key, "late date")
    # A month has 18.4 late days on average, and no sum is off by as much as one month's.
    guess = F.floor(x * 4800 / F.lit(9 * 9833.0)).cast("long")

    def found(m):
        return F.date_add(_month_first(m), (x - before(m) + 12).cast("int"))
    return F.when(x < before(guess), found(guess - 1)).when(x >= before(guess + 1), found(guess + 1)).otherwise(found(guess))


def _date(m: Column, key: str) -> Column:
    """A slashed date is MM/dd/yyyy where it can be, else dd/MM/yyyy. With a part of one digit, the
    new one has no leading zeros either."""
    out, start = None, F.lit(FIRST_DAY).cast("date")
    for like, form in ((r"^\d{4}-", "yyyy-MM-dd"), (r"^\d+\.", "d.M.yyyy"), (r"^\d+/", "M/d/yyyy"), (r"^\d+/", "d/M/yyyy")):
        day = F.try_to_date(m, form)
        n = F.datediff(day, start).cast("long")
        new = _late_day(day, key) if form == "d/M/yyyy" else F.date_add(start, feistel(n, 189, 773, key, "date").cast("int"))
        wide = form if "MM" in form else form.replace("d", "dd").replace("M", "MM")
        new = F.when(m.rlike(r"^(?:\d{4}-|\d\d([./])\d\d\1)"), F.date_format(new, wide)).otherwise(F.date_format(new, form))
        this = F.when(m.rlike(like), F.when((n >= 0) & (n < 189 * 773), new))
        out = this if out is None else F.coalesce(out, this)
    return out


def _email(m: Column, key: str) -> Column:
    """The account name; the domain stays."""
    return F.concat(feistel_text(F.substring_index(m, "@", 1), [LOWER, UPPER, DIGITS], key, "email"), F.lit("@"), F.substring_index(m, "@", -1))


def _key_id(m: Column, key: str) -> Column:
    return F.concat(F.substring(m, 1, 4), feistel_text(F.substring(m, F.lit(5), F.length(m)), [UPPER, DIGITS], key, "key"))


def _secret(m: Column, key: str) -> Column:
    value = F.regexp_extract(m, "[0-9a-f]+$", 0)
    return F.concat(F.substring(m, F.lit(1), F.length(m) - F.length(value)), feistel_text(value, [HEX], key, "secret"))


_MAKERS = {"email": _email, "key": _key_id, "secret": _secret, "date": _date, "phone": _phone, "ssn": _ssn, "ip": _ip}


def replaced(text: Column, key: str) -> tuple[Column, Column]:
    """(array of struct(kind, m, new) for each match of ``PATTERN``, array of the text between them);
    ``new``: ``out``, NULL where nothing in the match is valid, and ``n``, the values replaced in it."""
    def one(m):
        kind = None
        for name, pattern in reversed(KINDS):
            kind = F.when(m.rlike(f"^(?:{pattern})$"), F.lit(name)).otherwise(kind)
        out = None
        for name, pattern in KINDS:
            new = _cards(m, key) if name == "card" else F.struct(_MAKERS[name](m, key).alias("out"), F.lit(1).alias("n"))
            this = F.when(kind == name, new)
            out = this if out is None else F.coalesce(out, this)
        return F.struct(kind.alias("kind"), m.alias("m"), out.alias("new"))
    return F.transform(F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0)), one), F.split(text, PATTERN, -1)


def pseudonymise(docs: DataFrame, key: str = KEY, *, text_col: str = "text") -> DataFrame:
    """``docs`` with the pseudonymised text, and two columns more: ``pii_found``, the number of
    values replaced, and ``pii_kinds``, their distinct kinds, sorted and joined by commas.

    A NULL text stays NULL, with 0 found; an empty one stays empty. Repeated rows get the same
    result. Other columns stay, whatever their names; columns of the two new names are replaced.
    Matches that aren't valid stay as they are.
    """
    pii, gaps = fresh("_pii", docs), fresh("_gaps", docs)
    text = F.col(f"`{text_col}`")
    some = text.rlike("[0-9@]")
    found, between = replaced(text, key)
    rest = [c for c in docs.columns if c not in ("pii_found", "pii_kinds")]
    rows = docs.select(*(F.col(f"`{c}`") for c in rest), F.when(some, found).alias(pii), F.when(some, between).alias(gaps))
    whole = F.array_join(F.transform(gaps, lambda gap, i: F.concat(gap, F.coalesce(F.get(pii, i)["new"]["out"], F.get(pii, i)["m"], F.lit("")))), "")
    new = F.when(F.size(pii) > 0, whole).otherwise(text)
    hits = F.filter(pii, lambda x: x["new"]["out"].isNotNull())
    return rows.select(*(new.alias(c) if c == text_col else F.col(f"`{c}`") for c in rest), F.coalesce(F.aggregate(hits, F.lit(0), lambda t, x: t + x["new"]["n"]), F.lit(0)).alias("pii_found"),
                       F.coalesce(F.array_join(F.array_sort(F.array_distinct(F.transform(hits, lambda x: x["kind"]))), ","), F.lit("")).alias("pii_kinds"))


def op3_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pseudonymise(docs).select("doc_id", "text", "pii_found", "pii_kinds")
