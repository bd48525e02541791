"""Personal data: format-preserving Feistel pseudonyms, as column expressions only.

Values are found by pattern and validated: card numbers (13 to 19 digits, Luhn check), telephone numbers (by shape where
a country code, brackets or a leading 0 mark them, else ten digits with area and exchange code 2xx to 9xx), social security
numbers, IPv4 addresses (octets up to 255) and dates (of the calendar, 1800 to 2199, in figures, the year first or last;
03/04/2024 has the month first, 03.04.2024 and 03-04-2024 the day, unless only the other order is a date). A valid value is permuted within its own format by a keyed Feistel network: its numeric parts are two
numbers, and each round adds a keyed hash of one to the other, modulo that one's range. So a pseudonym is again a valid
value of the same kind with the same separators, equal values have equal pseudonyms in all documents, and
the key turns them back (``inverse=True``). Mail addresses get a keyed name at a reserved domain: equal ones
stay linked too, but there is no way back.

All happens inside one projection: no shuffle, texts of any length.

Defined cases: null text stays null with no findings, empty text stays empty. Values that fail their check stay as they
are. Extra columns pass through; an input column with the name of an output column is replaced.
Repeated rows are treated alike. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The patterns, tried in this order at every place.
#: A mail name is taken whole, from the first of its characters on; a domain has at most the 127 labels that fit into a name.
MAIL = (r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]{1,63}(?:\.[\p{L}\p{N}-]{1,63}){0,125}\.[A-Za-z]{2,24}")
ADDRESS = r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?!\.?[0-9])"
YEAR = "(?:1[89]|2[01])[0-9]{2}"
DATE = (rf"(?<![0-9]){YEAR}[-/.][01][0-9][-/.][0-3][0-9](?![0-9])|(?<![0-9])(?<![0-9][-/.])(?:"
        + "|".join(f"[0-3]?[0-9]{c}[0-3]?[0-9]{c}" for c in ("-", "/", "[.]")) + f"){YEAR}(?![0-9]|[-/.][0-9])")
SOCIAL = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
#: Ten digits, marked by a country code or brackets, or bare; and numbers grouped in any way, marked by a country code,
#: brackets or a leading 0. What follows a blank and is a value of its own ends a number.
TEN = (r"(?:\+1[ .-]?(?:\([0-9]{3}\)|[0-9]{3})|(?:1[ .-]?)?\([0-9]{3}\))[ .-]?[0-9]{3}[ .-]?[0-9]{4}"
       r"|(?:\+?1[ .-]?)?\(?[2-9][0-9]{2}\)?[ .-]?[2-9][0-9]{2}[ .-][0-9]{4}"
       r"|(?<![A-Za-z])(?:1[ .-]?)?[2-9][0-9]{2}[ .-]?[2-9][0-9]{6}(?![A-Za-z])")
COUNTRY = "(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[2-9][0-9]{2})"
_OTHER = (r"(?! (?:[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![.0-9])|[0-9]{1,4}[-/.][0-9]{1,2}[-/.][0-9]{1,4}(?![-/.0-9])"
          r"|[0-9]{4}[ -][0-9]{4}[ -][0-9]{4}))")
ABROAD = (rf"(?:\+|00)(?>{COUNTRY})(?: ?\((?:0|[0-9]{{2,5}})\))?(?:[ ./-]?[0-9]){{5}}(?:{_OTHER}[ ./-]?[0-9]){{1,8}}")
AREA = (rf"\([0-9][1-9][0-9]{{0,3}}\)(?:[ ./-]?[0-9]){{5}}(?:{_OTHER}[ ./-]?[0-9]){{0,5}}"
        rf"|(?<![A-Za-z.-])0[1-9](?:(?:[ .-][0-9]{{2}}){{4}}|[0-9]{{1,4}}[ /-][0-9]{{3}}(?:{_OTHER}[ -]?[0-9]){{3,6}})(?![A-Za-z])")
PHONE = f"(?<![0-9+])(?:{TEN}|{ABROAD}|{AREA})(?![0-9])"
CARD = (r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}(?:-[0-9]{4}){2}-[0-9]{1,7}|[0-9]{4}(?: [0-9]{4}){3}"
        r"|[0-9]{4} [0-9]{6} [0-9]{5}|[0-9]{4}-[0-9]{6}-[0-9]{5})(?![0-9])")
ANY = "|".join((MAIL, ADDRESS, DATE, SOCIAL, PHONE, CARD))
KINDS = ("mail", "address", "date", "social", "phone", "card")
OUTPUTS = ("safe_text", "n_findings", *[f"n_{k}" for k in KINDS])
ROUNDS = 8
DAYS, FIRST_DAY = (189, 773), "1800-01-01"  # 189 * 773 days are the 400 years from there


def keyed(key: str, kind: str, turn: Column, value: Column) -> Column:
    """A number below 2**60 from the key, the kind, the round and a value."""
    h = F.sha2(F.concat_ws(":", F.lit(key), F.lit(kind), turn.cast("string"), value.cast("string")), 256)
    return F.conv(F.substring(h, 1, 15), 16, 10).cast("bigint")


def feistel(left: Column, right: Column, m: Column, n: Column, key: str, kind: str, inverse: bool) -> Column:
    """A keyed permutation of the pairs (left below m, right below n), as a struct (l, r)."""
    turns = list(range(ROUNDS))[::-1] if inverse else list(range(ROUNDS))

    def step(s: Column, t: Column) -> Column:
        even = t % 2 == 0
        moved = keyed(key, kind, t, F.when(even, s["r"]).otherwise(s["l"]))
        add = lambda x, size: F.pmod(x - F.pmod(moved, size) if inverse else x + F.pmod(moved, size), size)
        return F.struct(F.when(even, add(s["l"], m)).otherwise(s["l"]).alias("l"),
                        F.when(even, s["r"]).otherwise(add(s["r"], n)).alias("r"))
    start = F.struct(left.cast("bigint").alias("l"), right.cast("bigint").alias("r"))
    return F.aggregate(F.array(*[F.lit(t) for t in turns]), start, step)


def digits_of(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def refill(shape: Column, digits: Column) -> Column:
    """The digits in the places of the shape's digits, other characters kept."""
    before = lambda i: F.length(digits_of(F.substring(shape, F.lit(1), i + 1)))
    return F.array_join(F.transform(F.split(shape, ""), lambda c, i: F.when(
        c.rlike("[0-9]"), F.substring(digits, before(i), F.lit(1))).otherwise(c)), "")


def pad(x: Column, n: Column | int) -> Column:
    return F.lpad(x.cast("string"), n, "0")


def check_digit(payload: Column) -> Column:
    """The Luhn digit of a string of digits."""
    total = F.aggregate(
        F.transform(F.split(F.reverse(payload), ""), lambda c, i: F.coalesce(
            F.try_to_number(c, F.lit("9")).cast("int"), F.lit(0)) * F.when(i % 2 == 0, 2).otherwise(1)),
        F.lit(0), lambda a, x: a + F.when(x > 9, x - 9).otherwise(x))
    return (F.lit(10) - total % 10) % 10


def part(s: Column, at: int, n: int) -> Column:
    return F.substring(s, at, n).cast("bigint")


def whole(s: str):
    return lambda x: x.rlike(f"^(?:{s})$")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """The body with the value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def card(x: Column, key: str, inverse: bool) -> Column:
    def permuted(d: Column) -> Column:
        n = F.length(d) - 1
        a = F.floor(n / 2).cast("int")
        moved = feistel(F.substring(d, F.lit(1), a), F.substring(d, a + 1, n - a), ten(a), ten(n - a), key, "card", inverse)
        new = let(moved, lambda s: F.concat(pad(s["l"], a), pad(s["r"], n - a)))
        good = check_digit(F.substring(d, F.lit(1), n)) == F.substring(d, n + 1, F.lit(1)).cast("int")
        return F.when(good, let(new, lambda p: refill(x, F.concat(p, check_digit(p).cast("string")))))
    return let(digits_of(x), permuted)


def ten(k: Column) -> Column:
    return F.pow(F.lit(10.0), k).cast("bigint")


def ten_digits(x: Column, key: str, inverse: bool) -> Column:
    """Two permutations: of area and exchange codes from 200 on, which bare numbers need, and of all the others."""
    def permuted(d: Column) -> Column:
        area, exchange = part(d, 1, 3), part(d, 4, 3)
        usual = (area >= 200) & (exchange >= 200)
        left = F.when(usual, (area - 200) * 800 + exchange - 200).when(area < 200, area * 1000 + exchange) \
            .otherwise(200_000 + (area - 200) * 200 + exchange)
        moved = feistel(left, part(d, 7, 4), F.when(usual, 640_000).otherwise(360_000), F.lit(10_000), key, "phone", inverse)

        def spelled(s: Column) -> Column:
            n, m = s["l"], s["l"] - 200_000
            codes = F.when(usual, (F.floor(n / 800) + 200) * 1000 + n % 800 + 200).when(m < 0, n) \
                .otherwise((F.floor(m / 200) + 200) * 1000 + m % 200)
            return F.concat(F.when(F.length(digits_of(x)) == 11, "1").otherwise(""), pad(codes, 6), pad(s["r"], 4))
        return let(moved, spelled)
    return refill(x, let(F.right(digits_of(x), F.lit(10)), permuted))


def phone(x: Column, key: str, inverse: bool) -> Column:
    """Country code, a leading 0 and (0) stay; a number without country code keeps its next digit from being 0."""
    abroad, nought = x.rlike(r"^(?:\+|00)"), F.when(x.rlike(r"\(0\)"), "0").otherwise("")

    def permuted(d: Column) -> Column:
        lead = F.when(x.startswith("+"), F.regexp_extract(d, f"^{COUNTRY}", 0)).when(
            x.startswith("00"), F.regexp_extract(d, f"^00{COUNTRY}", 0)).otherwise(F.regexp_extract(d, "^0?", 0))

        def moved(lead: Column) -> Column:
            rest = F.substring(d, F.length(lead) + 1, F.length(d))
            n = F.length(rest)
            a = F.floor(n / 2).cast("int")
            least = F.when(abroad, 0).otherwise(ten(a - 1))
            s = feistel(F.substring(rest, F.lit(1), a).cast("bigint") - least, F.substring(rest, a + 1, n - a), ten(a) - least,
                        ten(n - a), key, "phone", inverse)
            return let(s, lambda s: F.concat(lead, nought, pad(s["l"] + least, a), pad(s["r"], n - a)))
        return let(lead, moved)
    other = refill(x, let(digits_of(F.regexp_replace(x, r"\(0\)", "")), permuted))
    return F.when(whole(TEN)(x), ten_digits(x, key, inverse)).otherwise(other)


def social(x: Column, key: str, inverse: bool) -> Column:
    area, group, serial = part(x, 1, 3), part(x, 5, 2), part(x, 8, 4)
    good = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    index = area - 1 - (area > 666).cast("int")
    s = feistel(index * 99 + group - 1, serial - 1, F.lit(898 * 99), F.lit(9999), key, "social", inverse)

    def spelled(s: Column) -> Column:
        a = F.floor(s["l"] / 99) + 1
        return F.concat_ws("-", pad(a + (a >= 666).cast("int"), 3), pad(s["l"] % 99 + 1, 2), pad(s["r"] + 1, 4))
    return F.when(good, let(s, spelled))


def address(x: Column, key: str, inverse: bool) -> Column:
    o = lambda i: F.get(F.split(x, r"\."), F.lit(i)).cast("bigint")
    good = (o(0) < 256) & (o(1) < 256) & (o(2) < 256) & (o(3) < 256)
    s = feistel(o(0) * 256 + o(1), o(2) * 256 + o(3), F.lit(65536), F.lit(65536), key, "address", inverse)
    return F.when(good, let(s, lambda s: F.concat_ws(".", *[v.cast("string") for v in (
        F.floor(s["l"] / 256), s["l"] % 256, F.floor(s["r"] / 256), s["r"] % 256)])))


def calendar(days: Column, key: str, inverse: bool) -> Column:
    """A keyed permutation of the days from FIRST_DAY on."""
    s = feistel(F.floor(days / DAYS[1]), days % DAYS[1], F.lit(DAYS[0]), F.lit(DAYS[1]), key, "date", inverse)
    return let(s, lambda s: s["l"] * DAYS[1] + s["r"])


def date(x: Column, key: str, inverse: bool) -> Column:
    first = F.lit(FIRST_DAY).cast("date")
    d = F.try_to_date(F.regexp_replace(x, "[/.]", "-"), "yyyy-MM-dd")
    new = let(F.datediff(d, first), lambda n: F.date_format(F.date_add(first, calendar(n, key, inverse).cast("int")), "yyyyMMdd"))
    return F.when(x.rlike("^[0-9]{4}"), F.when(d.isNotNull(), refill(x, new))).otherwise(year_last(x, key, inverse))


def year_last(x: Column, key: str, inverse: bool) -> Column:
    """Permuted until the day can be spelled in the same places and is read in the same order, which turns back."""
    first = F.lit(FIRST_DAY).cast("date")
    parts, slash = F.split(x, "[-/.]"), x.contains("/")
    a, b, y = (F.get(parts, F.lit(i)) for i in range(3))
    read = lambda month, day: F.try_to_date(F.concat_ws("-", y, pad(month, 2), pad(day, 2)), "yyyy-MM-dd")
    usual = F.when(slash, read(a, b)).otherwise(read(b, a))
    other = F.when(slash, read(b, a)).otherwise(read(a, b))

    def permuted(f: Column) -> Column:
        month_first = slash == f["usual"]
        fields = lambda n: let(F.date_add(first, n.cast("int")), lambda d: F.struct(
            F.when(month_first, F.month(d)).otherwise(F.day(d)).alias("a"),
            F.when(month_first, F.day(d)).otherwise(F.month(d)).alias("b"), F.day(d).alias("day"), F.year(d).alias("y")))
        fits = lambda n: let(fields(n), lambda v: ((F.length(a) == 2) | (v["a"] < 10))
                             & ((F.length(b) == 2) | (v["b"] < 10)) & (f["usual"] | (v["day"] > 12)))
        step = lambda n: let(calendar(n, key, inverse), lambda m: F.struct(m.alias("n"), fits(m).alias("done")))
        start = F.struct(f["n"].cast("bigint").alias("n"), F.lit(False).alias("done"))
        # over a fifth of all days fit in any case: 300 steps fail with odds below 10**-30
        found = F.aggregate(F.sequence(F.lit(1), F.lit(300)), start, lambda s, _: F.when(s["done"], s).otherwise(step(s["n"])))
        return let(found, lambda s: F.when(s["done"], let(fields(s["n"]), lambda v: refill(x, F.concat(
            pad(v["a"], F.length(a)), pad(v["b"], F.length(b)), pad(v["y"], 4))))))
    days = F.datediff(F.coalesce(usual, other), first)
    return F.when(days.isNotNull(), let(F.struct(days.alias("n"), usual.isNotNull().alias("usual")), permuted))


def mail(x: Column, key: str, inverse: bool) -> Column:
    name = F.concat(F.lit("user"), F.substring(F.sha2(F.concat_ws(":", F.lit(key), F.lit("mail"), F.lower(x)), 256), 1, 12))
    return F.lit(None).cast("string") if inverse else F.concat(name, F.lit("@example.invalid"))


_RULES = {"mail": (MAIL, mail), "address": (ADDRESS, address), "date": (DATE, date), "social": (SOCIAL, social),
          "phone": (PHONE, phone), "card": (CARD, card)}


def pseudonym(x: Column, key: str, inverse: bool = False) -> Column:
    """(kind, value) of a found string; null kind if it fails its check."""
    out = F.lit(None).cast("struct<kind:string,value:string>")
    for kind in reversed(KINDS):
        pattern, f = _RULES[kind]
        inner = F.struct(F.lit(kind).alias("kind"), f(x, key, inverse).alias("value"))
        out = F.when(whole(pattern)(x), inner).otherwise(out)
    return out


def pseudonymise(docs: DataFrame, key: str, text: str = "text", inverse: bool = False) -> DataFrame:
    """Add safe_text, n_findings and a count per kind to every row."""
    d = docs.select(*[c for c in docs.columns if c not in OUTPUTS])
    t = F.coalesce(F.col(text), F.lit(""))
    busy = t.rlike("[0-9@]")
    d = d.withColumns({
        "_gaps": F.when(busy, F.split(t, ANY, -1)).otherwise(F.array(t)),
        "_found": F.when(busy, F.regexp_extract_all(t, F.lit(ANY), F.lit(0))).otherwise(F.array().cast("array<string>"))})
    d = d.withColumn("_new", F.transform("_found", lambda x: pseudonym(x, key, inverse)))
    good = F.filter("_new", lambda x: x["value"].isNotNull())
    d = d.withColumn("_kinds", F.transform(good, lambda x: x["kind"]))
    spelled = F.array_join(F.transform("_gaps", lambda g, i: F.concat(g, F.coalesce(
        F.get(F.col("_new"), i)["value"], F.get(F.col("_found"), i), F.lit("")))), "")
    count = lambda kind: F.size(F.filter("_kinds", lambda x: x == kind)).cast("bigint")
    counts = {f"n_{k}": count(k) for k in KINDS}
    d = d.withColumns({"safe_text": F.when(F.size("_kinds") == 0, F.col(text)).otherwise(spelled),
                       "n_findings": F.size("_kinds").cast("bigint"), **counts})
    return d.drop("_gaps", "_found", "_new", "_kinds")
