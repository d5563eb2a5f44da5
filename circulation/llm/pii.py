"""Format-preserving Feistel pseudonyms for personal data in texts.

Main path: DataFrame functions only. Candidates are found by one pattern, validated (Luhn digit,
calendar, number plan, octets), and mapped by a keyed Feistel permutation of their own format: cards to
cards with a right check digit, dates to dates (those of 1800 to 2199 among themselves), phone numbers to numbers of the
plan, IPv4 addresses to addresses. Addresses of mail and credentials keep the class of every
character. A permutation has no collisions, and one key maps equal values alike in every
document, so records stay linked; whoever holds the key can invert it.

Defined results: a null text stays null, an empty one empty; texts without validated values stay as
they are to the byte; repeated rows change alike; an empty table gives no rows; only the text
column is read, and an input column named like the count of replacements is replaced.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from circulation.llm.common import without
from circulation.llm.quality import let

ROUNDS = 8
KEY = "change-me"

# The candidates' patterns. Each begins and ends where no word or number goes on.
MAIL = r"(?<![\w.+%-])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}+@[A-Za-z0-9][A-Za-z0-9.-]{0,250}\.[A-Za-z]{2,24}(?![\w-])"
CREDENTIAL = r"(?<!\w)(?:AKIA[0-9A-Z]{16}|(?:password|passwd|token|secret|api_key)[ \t]{0,3}[=:][ \t]{0,3}[\"']?[A-Za-z0-9_/+-]{8,})(?![\w/+-])"
PHONE = r"(?<![\w+.-])(?:\+?1[ .-]?)?(?:\([0-9]{3}\)[ .-]?|[0-9]{3}[.-])[0-9]{3}[ .-][0-9]{4}(?![\w-]|[.][0-9])"
# Digits, or groups of them with single separators; dots alone only between three groups or more, as one is a decimal point.
_GAP = "[ \u00a0\u202f/-]?"
E164 = (r"(?<![\w+.-])\+(?:[0-9]{1,3}" + _GAP + r"\([0-9]{1,4}\)(?:[ \u00a0\u202f./-]?[0-9]){5,8}|(?=[0-9]+\.[0-9]+\.)[0-9](?:\.?[0-9]){7,14}|"
        r"[0-9](?:" + _GAP + r"[0-9]){7,14})(?!\w)")
SOCIAL = r"(?<![\w.+-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-]|[.][0-9])"
CARD = r"(?<![\w.+-])(?:[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}|[0-9]{4}([ -])[0-9]{6}\2[0-9]{5})(?![\w-]|[.][0-9])"
ADDRESS = r"(?<![\w.+-])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?!\w|[.-][0-9])"
DATE = r"(?<![\w.+/-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}\.[0-9]{2}\.[0-9]{4}|[0-9]{2}/[0-9]{2}/[0-9]{4})(?!\w|[./-][0-9])"
_KINDS = [MAIL, CREDENTIAL, PHONE, E164, SOCIAL, CARD, ADDRESS, DATE]
# In one pattern the card's groups keep their numbers, as no other kind has any.
CANDIDATE = "|".join(_KINDS)

# Days, and days after the 12th of their month (the only ones that show a date to be day-first), of the years 1 to 9999
# are counted from 0001-01-01. Those of the 400 years 1800 to 2199 (where they begin, and their number as a product) are
# permuted among themselves, and so are all others.
FIRST_DAY = "0001-01-01"
DAYS = (657071, (189, 773), (6, 584327))
LATE_DAYS = (398015, (9, 9833), (6, 353951))
LATE_A_MONTH = 88497 / 4800


# --- permutations ----------------------------------------------------------------------------

def _prf(key: str, tweak: str, i: int, value: Column) -> Column:
    """60 pseudorandom bits as a long."""
    seed = F.concat(F.lit(f"{key}\x1f{tweak}\x1f{i}\x1f"), value.cast("string"))
    return F.conv(F.substring(F.sha2(seed, 256), 1, 15), 16, 10).cast("long")


def feistel_pair(left: Column, a: int, right: Column, b: int, key: str, tweak: str) -> Column:
    """A keyed permutation of Z_a x Z_b: struct(l, r). Each round adds a function of one side to the other."""
    def added(i: int, side: Column, other: Column, n: int) -> Column:
        return F.pmod(side + F.pmod(_prf(key, tweak, i, other), F.lit(n)), F.lit(n))

    def turn(i: int) -> Callable[[Column], Column]:
        if i % 2:
            return lambda s: F.struct(s["l"].alias("l"), added(i, s["r"], s["l"], b).alias("r"))
        return lambda s: F.struct(added(i, s["l"], s["r"], a).alias("l"), s["r"].alias("r"))

    state = F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))
    for i in range(ROUNDS):
        state = let(state, turn(i))
    return state


def feistel_classes(s: Column, key: str, tweak: str) -> Column:
    """A keyed permutation of strings that keeps digits digits, and small and capital letters such.

    Each round shifts the characters of one half, within their class, by a function of the other half
    and the place. A half without such characters lets the other pass through the odd rounds alone."""
    def shifted(half: Column, other: Column, i: int) -> Column:
        def one(c: Column, k: Column) -> Column:
            by = _prf(key, tweak, i, F.concat(k.cast("string"), F.lit("\x1f"), other))
            code = F.ascii(c)
            move = lambda base, n: F.char(F.lit(base) + F.pmod(code - base + by, F.lit(n)))
            return (F.when(c.between("0", "9"), move(48, 10)).when(c.between("a", "z"), move(97, 26))
                    .when(c.between("A", "Z"), move(65, 26)).otherwise(c))
        return F.when(half == "", half).otherwise(F.array_join(F.transform(F.split(half, ""), one), ""))

    cut = F.floor(F.length(s) / 2).cast("int")
    state = F.struct(F.substring(s, F.lit(1), cut).alias("l"), F.substring(s, cut + 1, F.length(s)).alias("r"))

    def turn(i: int) -> Callable[[Column], Column]:
        if i % 2:
            return lambda t: F.struct(t["l"].alias("l"), shifted(t["r"], t["l"], i).alias("r"))
        return lambda t: F.struct(shifted(t["l"], t["r"], i).alias("l"), t["r"].alias("r"))

    for i in range(4):
        state = let(state, turn(i))
    return let(state, lambda t: F.concat(t["l"], t["r"]))


# --- kinds -----------------------------------------------------------------------------------

def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _number(digits: Column, start: int, n: int) -> Column:
    return F.substring(digits, start, n).cast("long")


def _filled(m: Column, digits: Column) -> Column:
    """``m`` with its digits, in order, replaced by ``digits``."""
    start = F.struct(F.lit("").alias("s"), F.lit(1).alias("k"))
    return F.aggregate(F.split(m, ""), start, lambda a, c: F.when(c.between("0", "9"), F.struct(
        F.concat(a["s"], F.substring(digits, a["k"], F.lit(1))).alias("s"), (a["k"] + 1).alias("k"))).otherwise(
        F.struct(F.concat(a["s"], c).alias("s"), a["k"].alias("k"))), lambda a: a["s"])


def _luhn_sum(digits: Column) -> Column:
    """Of a number with its check digit; a multiple of 10 if that is right."""
    each = F.transform(F.split(F.reverse(digits), ""), lambda c, i: let(
        c.cast("int") * (1 + i % 2), lambda d: F.when(d > 9, d - 9).otherwise(d)))
    return F.aggregate(each, F.lit(0), lambda s, d: s + d)


def _padded(value: Column, n: int) -> Column:
    return F.lpad(value.cast("string"), n, "0")


def _card(m: Column, key: str) -> Column:
    def permuted(d: Column) -> Column:
        out = F.lit(None).cast("string")
        for n in range(13, 20):
            out = F.when(F.length(d) == n, of_length(d, n)).otherwise(out)
        return out

    def of_length(d: Column, n: int) -> Column:
        left, right = (n - 1) // 2, n - 1 - (n - 1) // 2
        pair = feistel_pair(_number(d, 1, left), 10**left, _number(d, left + 1, right), 10**right, key, f"card{n}")
        body = let(pair, lambda s: F.concat(_padded(s["l"], left), _padded(s["r"], right)))
        return let(body, lambda b: F.concat(b, F.pmod(-_luhn_sum(F.concat(b, F.lit("0"))), F.lit(10)).cast("string")))

    return let(_digits(m), lambda d: F.when(F.pmod(_luhn_sum(d), F.lit(10)) == 0, _filled(m, permuted(d))).otherwise(m))


def _phone(m: Column, key: str) -> Column:
    """Numbers of the North American plan: area and exchange begin with 2 to 9. Others keep their digits' places."""
    def permuted(d: Column) -> Column:
        area, exchange, line = _number(d, 1, 3) - 200, _number(d, 4, 3) - 200, _number(d, 7, 4)
        pair = feistel_pair(area, 800, exchange * 10_000 + line, 8_000_000, key, "phone")
        return let(pair, lambda s: F.concat((s["l"] + 200).cast("string"), (F.floor(s["r"] / 10_000) + 200).cast("string"),
                                            _padded(F.pmod(s["r"], F.lit(10_000)), 4)))

    def whole(d: Column) -> Column:
        ten, code = F.right(d, F.lit(10)), F.substring(d, F.lit(1), F.length(d) - 10)
        new = F.when(ten.rlike("^[2-9][0-9]{2}[2-9]"), permuted(ten)).otherwise(feistel_classes(ten, key, "phone"))
        return _filled(m, F.concat(code, new))
    return let(_digits(m), whole)


def _e164(m: Column, key: str) -> Column:
    """All digits but the first; one number maps alike with and without separators."""
    return let(_digits(m), lambda d: _filled(m, F.concat(
        F.substring(d, 1, 1), feistel_classes(F.substring(d, 2, 20), key, "e164"))))


def _social(m: Column, key: str) -> Column:
    """Area 001 to 899 but 666, group 01 to 99, serial 0001 to 9999."""
    def permuted(d: Column) -> Column:
        area, group, serial = _number(d, 1, 3), _number(d, 4, 2), _number(d, 6, 4)
        place = F.when(area < 666, area - 1).otherwise(area - 2)
        pair = feistel_pair(place, 898, (group - 1) * 9999 + serial - 1, 99 * 9999, key, "social")
        return let(pair, lambda s: F.concat(
            _padded(F.when(s["l"] < 665, s["l"] + 1).otherwise(s["l"] + 2), 3),
            _padded(F.floor(s["r"] / 9999) + 1, 2), _padded(F.pmod(s["r"], F.lit(9999)) + 1, 4)))
    good = ~m.rlike("^(000|666|9)") & ~m.rlike("-00-") & ~m.rlike("-0000$")
    return F.when(good, let(_digits(m), lambda d: _filled(m, permuted(d)))).otherwise(m)


def _address(m: Column, key: str) -> Column:
    def permuted(o: Column) -> Column:
        pair = feistel_pair(o[0] * 256 + o[1], 65_536, o[2] * 256 + o[3], 65_536, key, "ipv4")
        side = lambda x: F.concat(F.floor(x / 256).cast("string"), F.lit("."), F.pmod(x, F.lit(256)).cast("string"))
        return let(pair, lambda s: F.concat(side(s["l"]), F.lit("."), side(s["r"])))
    octets = F.transform(F.split(m, r"\."), lambda x: x.cast("long"))
    return let(octets, lambda o: F.when(F.array_max(o) <= 255, permuted(o)).otherwise(m))


def _late_before(month: Column) -> Column:
    """How many days after the 12th the months before this one (0 is January of year 1) have."""
    first = F.lit(FIRST_DAY).cast("date")
    return F.datediff(F.add_months(first, month.cast("int")), first) - 12 * month


def _late_day(n: Column) -> Column:
    def placed(guess: Column) -> Column:
        month = F.when(_late_before(guess + 1) <= n, guess + 1).when(_late_before(guess) <= n, guess).otherwise(guess - 1)
        return let(month, lambda k: F.date_add(F.add_months(F.lit(FIRST_DAY).cast("date"), k.cast("int")), (n - _late_before(k) + 12).cast("int")))
    return let(F.floor(n / LATE_A_MONTH), placed)


def _date(m: Column, key: str) -> Column:
    """Days in the format they have: 2001-12-31, 31.12.2001, 12/31/2001, or 31/12/2001 where that can be no month."""
    first = F.lit(FIRST_DAY).cast("date")

    def permuted(n: Column, span: tuple[int, tuple[int, int], tuple[int, int]], tweak: str) -> Column:
        begin, (a, b), (c, d) = span
        size = a * b

        def mapped(k: Column, one: int, two: int, t: str) -> Column:
            return let(feistel_pair(F.floor(k / two), one, F.pmod(k, F.lit(two)), two, key, t), lambda s: s["l"] * two + s["r"])
        near = mapped(n - begin, a, b, tweak) + begin
        far = let(mapped(F.when(n < begin, n).otherwise(n - size), c, d, f"far {tweak}"), lambda k: F.when(k < begin, k).otherwise(k + size))
        return F.when(n.between(begin, begin + size - 1), near).otherwise(far)

    def moved(day: Column) -> Column:
        days = let(F.datediff(day, first).cast("long"), lambda n: let(permuted(n, DAYS, "date"), lambda x: F.date_add(first, x.cast("int"))))
        month = (F.year(day) - 1) * 12 + F.month(day) - 1
        late_days = let((_late_before(month) + F.dayofmonth(day) - 13).cast("long"),
                        lambda n: let(permuted(n, LATE_DAYS, "late date"), _late_day))
        return F.when(late, late_days).otherwise(days)

    late = m.contains("/") & F.try_to_date(m, "MM/dd/yyyy").isNull()
    form = lambda f: F.when(m.contains("-"), f("yyyy-MM-dd")).when(m.contains("."), f("dd.MM.yyyy")).when(
        late, f("dd/MM/yyyy")).otherwise(f("MM/dd/yyyy"))
    return let(form(lambda x: F.try_to_date(m, x)), lambda day: F.when(day.isNull() | (day < first), m).otherwise(
        let(moved(day), lambda new: form(lambda x: F.date_format(new, x)))))


def _mail(m: Column, key: str) -> Column:
    at = F.instr(m, "@")
    return F.concat(feistel_classes(F.substring(m, F.lit(1), at - 1), key, "mail"), F.substring(m, at, F.length(m)))


def _credential(m: Column, key: str) -> Column:
    named = F.regexp_extract(m, r"^(AKIA|[a-z_]+[ \t]*[=:][ \t]*[\"']?)", 1)
    return let(named, lambda n: F.concat(n, feistel_classes(F.substring(m, F.length(n) + 1, F.length(m)), key, "credential")))


def pseudonym(m: Column, key: str) -> Column:
    """The pseudonym of one candidate; itself if it is not valid."""
    return (F.when(m.contains("@"), _mail(m, key))
            .when(m.rlike("^(AKIA|[a-z])"), _credential(m, key))
            .when(m.rlike(f"^{PHONE}$"), _phone(m, key))
            .when(m.rlike(r"^\+"), _e164(m, key))
            .when(m.rlike(f"^{SOCIAL}$"), _social(m, key))
            .when(m.rlike(f"^{DATE}$"), _date(m, key))
            .when(m.contains("."), _address(m, key))
            .otherwise(_card(m, key)))


def pseudonymised(docs: DataFrame, key: str = KEY, text: str = "text", count: str | None = "n_replaced") -> DataFrame:
    """``docs`` with the text's personal data replaced and, if asked for, how many values were."""
    df = without(docs, [count] if count else [])
    names = df.columns
    t = F.col(f"`{text}`").cast("string")

    def replaced(found: Column) -> Column:
        new = F.transform(found, lambda m: pseudonym(m, key))
        between = F.split(t, CANDIDATE, -1)
        joined = let(new, lambda ms: F.struct(
            F.array_join(F.zip_with(between, F.concat(ms, F.array(F.lit(""))), lambda p, m: F.concat(p, m)), "").alias("text"),
            F.size(F.filter(ms, lambda m, i: m != found[i])).cast("long").alias("n")))
        return joined

    same = F.struct(t.alias("text"), F.lit(0).cast("long").alias("n"))
    # A text without a digit, an at sign, AKIA or a credential's name is not searched any further.
    maybe = t.rlike("[0-9@]|AKIA|password|passwd|token|secret|api_key")
    found = F.regexp_extract_all(t, F.lit(CANDIDATE), F.lit(0))
    out = F.when(maybe, let(found, lambda ms: F.when(F.size(ms) > 0, replaced(ms)).otherwise(same))).otherwise(same)
    work = df.withColumn("__pii", out)
    done = [F.col("__pii.text").alias(c) if c.lower() == text.lower() else F.col(f"`{c}`") for c in names]
    return work.select(*done, *([F.col("__pii.n").alias(count)] if count else []))
