"""Format-preserving pseudonyms for personal data by keyed Feistel permutations.

Numbers and dates are validated and then permuted within the set of valid values of their
format, so the result is valid too, equal values get equal pseudonyms in all documents
and who holds the key can undo it. A set of a * b values is a pair (left, right); each of
eight rounds adds to one half, modulo its size, an HMAC of the other. Nothing is
mapped outside the set, so no cycle walking is needed. The local part of an e-mail
address is permuted the same way character by character: letters stay letters of their
case, digits stay digits.

kind    validated                                       permuted
email   up to 64 characters, @, labels, a name of letters  local part; the domain stays
iban    country and its length, mod 97                  all behind the check digits; new check digits
ip      four numbers up to 255                          all 2^32 addresses
phone   three, three and four digits, or + and 7 to 15  see below
card    13 to 19 digits, Luhn                           all but the first digit; new check digit
ssn     area, group and serial in use                   898 areas x 99 * 9999
date    Y-M-D, D-M-Y or M-D-Y with - / or .             the 73,049 days from 1900 to 2099

A date is read day first, and month first only if there is no such day. Years have four
digits, or two where day and month are set off by / or have two digits each: these are 1950
to 2049 and are permuted among the 36,525 days of those years. A date is laid out again in its own
order, and without leading zeros if it had a day or month of one digit.

A phone number of ten digits (+1 or no country code) whose area and exchange start with 2
to 9 stays such a number: 800 areas x 8 million numbers. The other 3.6 billion are permuted
among themselves. Any area and exchange count where separators or +1 show the shape; ten
digits in a row without + count only with both from 2, as clocks and counters look the same.
Of other numbers with + the country code stays and the digits behind it are permuted, but
for a trunk zero in parentheses.

Only built-in column functions are used and nothing is shuffled. A text without digits
and @ is passed on as it is.

Edge cases: a null text stays null with counts of zero; an empty text stays empty. What
fails validation stays as it is, all of a match (a wrong IBAN with a card number in it too). Other columns are kept, but for those named like a result (n_pii,
n_<kind>). No pattern repeats a group without a bound, so no text, however long, makes
matching recurse.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ._shared import column, unused_prefix

#: The key of tests and checks. Use your own, from a secret store.
TEST_KEY = "not a secret"
ROUNDS = 8

#: Countries by the length of their IBANs: fixed values of the public registry.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FO FI GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU", 31: "MT SC", 32: "LC",
}


def _iban_shape() -> str:
    """An IBAN of its country's length, without spaces or in groups of four."""
    kinds = []
    for length, countries in IBAN_LENGTHS.items():
        groups, rest = divmod(length - 4, 4)
        grouped = f"(?: [A-Z0-9]{{4}}){{{groups}}}" + f" [A-Z0-9]{{{rest}}}" * (rest > 0)
        kinds.append(f"(?:{countries.replace(' ', '|')})[0-9]{{2}}(?:[A-Z0-9]{{{length - 4}}}|{grouped})")
    return f"(?<![A-Za-z0-9])(?=[A-Z]{{2}}[0-9]{{2}})(?:{'|'.join(kinds)})(?![A-Za-z0-9])"


#: Shapes, by kind, in the order in which they are tried at a place.
SHAPES = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@(?=[A-Za-z0-9-]++\.[A-Za-z0-9-])[A-Za-z0-9.-]++",
    "iban": _iban_shape(),
    "phone": r"\+1[ .-]?\(?[0-9]{3}\)?[ .-]?[0-9]{3}[ .-]?[0-9]{4}(?![0-9])"
    r"|(?<![0-9A-Za-z])\+[1-9](?:[ .()/-]{0,2}[0-9]){6,14}(?![0-9])"
    r"|(?<![0-9+])\(?[0-9]{3}(?:\)[ .-]?|[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])"
    r"|(?<![A-Za-z0-9_./=#&$+-])[2-9][0-9]{2}[2-9][0-9]{6}(?![A-Za-z0-9_]|[.,-][0-9])",
    "ip": r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9]|\.[0-9])",
    "card": r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){2}[ -][0-9]{1,7}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![0-9])",
    "ssn": r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])",
    "date": r"(?<![0-9])(?:(?:19|20)[0-9]{2}(?:-[0-9]{1,2}-|/[0-9]{1,2}/|\.[0-9]{1,2}\.)[0-9]{1,2}"
    r"|[0-9]{1,2}(?:-[0-9]{1,2}-|/[0-9]{1,2}/|\.[0-9]{1,2}\.)(?:19|20)[0-9]{2})(?![0-9])"
    r"|(?<![0-9])(?<![0-9][-/.])(?:[0-9]{1,2}/[0-9]{1,2}/[0-9]{2}|[0-9]{2}(?:-[0-9]{2}-|\.[0-9]{2}\.)[0-9]{2})(?![0-9]|[-/.][0-9])",
}
#: Country codes; no code begins with another.
COUNTRY = "^(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[2-9][0-9]{2})"
ANY = "|".join(SHAPES.values())


def _let(value: Column, body) -> Column:
    """body(value), with value worked out once however often body has it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def secret(spark: SparkSession, key: str) -> Column:
    """struct(inner, outer): the two padded keys of HMAC-SHA-256, as the value of a subquery over one row.

    No plan, page of the web UI or event log shows a value of that row, as it would a literal's.
    """
    raw = key.encode()
    raw = (hashlib.sha256(raw).digest() if len(raw) > 64 else raw).ljust(64, b"\0")
    pads = [bytes(b ^ pad for b in raw) for pad in (0x36, 0x5C)]
    return spark.createDataFrame([(pads[0], pads[1])], "inner binary, outer binary").select(F.struct("inner", "outer").alias("pads")).scalar()


def _hash(key: Column, kind: str, nth: Column, half: Column) -> Column:
    """HMAC-SHA-256, in hexadecimal, of what a round depends on."""
    message = F.concat_ws("|", F.lit(kind), nth.cast("string"), half.cast("string")).cast("binary")
    return F.sha2(F.concat(key["outer"], F.unhex(F.sha2(F.concat(key["inner"], message), 256))), 256)


def permute(value: Column, left: int, right: int, key: Column, kind: str) -> Column:
    """A keyed permutation of 0 .. left * right - 1."""
    draw = lambda nth, half, size: F.pmod(F.conv(F.substring(_hash(key, kind, nth, half), 1, 15), 16, 10).cast("long"), F.lit(size).cast("long"))
    value = value.cast("long")
    return F.aggregate(
        F.sequence(F.lit(0), F.lit(ROUNDS - 1)),
        F.struct(F.floor(value / right).cast("long").alias("a"), F.pmod(value, F.lit(right).cast("long")).alias("b")),
        lambda x, nth: F.when(nth % 2 == 0, F.struct(F.pmod(x["a"] + draw(nth, x["b"], left), F.lit(left).cast("long")).alias("a"), x["b"].alias("b"))).otherwise(
            F.struct(x["a"].alias("a"), F.pmod(x["b"] + draw(nth, x["a"], right), F.lit(right).cast("long")).alias("b"))
        ),
        lambda x: x["a"] * right + x["b"],
    )


def _padded(value: Column, width: Column | int) -> Column:
    return F.lpad(value.cast("string"), width, "0")


def _shifted(text: Column, stream: Column) -> Column:
    """Each letter and digit of text moved on within its class by its byte of the stream (64 hexadecimal digits, used again and again)."""
    by = lambda i, n: F.conv(F.substring(stream, (i % 32) * 2 + 1, F.lit(2)), 16, 10).cast("int") % n
    move = lambda c, i, first, n: F.char(F.lit(first) + F.pmod(F.ascii(c) - first + by(i, n), F.lit(n)))
    moved = lambda c, i: F.when(c.between("a", "z"), move(c, i, 97, 26)).when(c.between("A", "Z"), move(c, i, 65, 26)).when(c.between("0", "9"), move(c, i, 48, 10)).otherwise(c)
    return F.array_join(F.transform(F.split(text, ""), moved), "")


def permute_string(text: Column, key: Column, kind: str) -> Column:
    """A keyed permutation of the strings with the same pattern of letters, digits and other characters."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.aggregate(
        F.sequence(F.lit(0), F.lit(ROUNDS - 1)),
        F.struct(F.substring(text, F.lit(1), half).alias("a"), F.substring(text, half + 1, F.length(text)).alias("b")),
        lambda x, nth: F.when(nth % 2 == 0, F.struct(_shifted(x["a"], _hash(key, kind, nth, x["b"])).alias("a"), x["b"].alias("b"))).otherwise(
            F.struct(x["a"].alias("a"), _shifted(x["b"], _hash(key, kind, nth, x["a"])).alias("b"))
        ),
        lambda x: F.concat(x["a"], x["b"]),
    )


def _laid_out(digits: Column, shape: Column) -> Column:
    """shape with its digits replaced, in order, by digits."""
    step = lambda x, c: F.when(c.rlike("[0-9]"), F.struct((x["k"] + 1).alias("k"), F.concat(x["out"], F.substring(digits, x["k"] + 1, F.lit(1))).alias("out"))).otherwise(F.struct(x["k"].alias("k"), F.concat(x["out"], c).alias("out")))
    return F.aggregate(F.split(shape, ""), F.struct(F.lit(0).alias("k"), F.lit("").alias("out")), step, lambda x: x["out"])


def _card(digits: Column, key: Column) -> Column:
    """All digits but the first and the last by a permutation of halves, the last by the Luhn rule."""
    n = F.length(digits) - 2
    body = F.concat(F.substring(digits, 1, 1), permute_string(F.substring(digits, F.lit(2), n), key, "card"))
    total = F.aggregate(
        F.split(F.reverse(body), ""),
        F.struct(F.lit(0).alias("k"), F.lit(0).alias("sum")),
        lambda x, c: F.struct((x["k"] + 1).alias("k"), (x["sum"] + F.when(x["k"] % 2 == 0, c.cast("int") * 2 - F.when(c > "4", 9).otherwise(0)).otherwise(c.cast("int"))).alias("sum")),
        lambda x: x["sum"],
    )
    return F.concat(body, F.pmod(-total, F.lit(10)).cast("string"))


def _mod97(text: Column) -> Column:
    """The number that digits and letters (10 to 35) spell, modulo 97."""
    step = lambda x, c: F.when(c <= "9", x * 10 + F.ascii(c) - 48).otherwise(x * 100 + F.ascii(c) - 55) % 97
    return F.aggregate(F.split(text, ""), F.lit(0), step)


def _is_iban(text: Column) -> Column:
    """Whether the check digits are those that the rest asks for: one pair from 02 to 98."""
    plain = F.replace(text, F.lit(" "), F.lit(""))
    return F.substring(plain, 3, 2).between("02", "98") & (_mod97(F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, 1, 4))) == 1)


def _iban(text: Column, key: Column) -> Column:
    """The country stays, what is behind the check digits is permuted within its letters and digits, and new check digits are set."""
    plain = F.replace(text, F.lit(" "), F.lit(""))
    new = lambda x: F.concat(x["c"], _padded(98 - _mod97(F.concat(x["b"], x["c"], F.lit("00"))), 2), x["b"])
    whole = _let(F.struct(F.substring(plain, 1, 2).alias("c"), permute_string(F.substring(plain, F.lit(5), F.length(plain)), key, "iban").alias("b")), new)
    return F.when(F.contains(text, F.lit(" ")), F.regexp_replace(whole, "(.{4})(?=.)", "$1 ")).otherwise(whole)


def _phone(text: Column, key: Column) -> Column:
    held = F.replace(text, F.lit("(0)"), F.lit("(\u0001)"))  # a trunk zero is no part of the number
    digits = F.regexp_replace(held, "[^0-9]", "")
    code = F.regexp_extract(digits, COUNTRY, 0)
    abroad = F.concat(code, permute_string(F.substring(digits, F.length(code) + 1, F.length(digits)), key, "phone"))
    ours = ~text.startswith("+") | (text.startswith("+1") & (F.length(digits) == 11))
    return F.replace(_laid_out(F.when(ours, _ten_digits(digits, key)).otherwise(abroad), held), F.lit("\u0001"), F.lit("0"))


def _ten_digits(digits: Column, key: Column) -> Column:
    """The last ten digits permuted; what stands before them stays."""
    area, exchange, line = (F.substring(F.right(digits, F.lit(10)), at, n).cast("long") for at, n in ((1, 3), (4, 3), (7, 4)))
    number = lambda value, first: (F.floor(value / first) + 200) * 10_000_000 + F.pmod(value, F.lit(first).cast("long"))
    low = 200 * 10_000_000  # of the others, 200 areas x 10 million, then 800 areas x 2 million
    valid = lambda x: number(permute((x["a"] - 200) * 8_000_000 + (x["e"] - 200) * 10_000 + x["l"], 800, 8_000_000, key, "phone"), 8_000_000) + 2_000_000
    nth = lambda x: F.when(x["a"] < 200, x["a"] * 10_000_000 + x["e"] * 10_000 + x["l"]).otherwise(low + (x["a"] - 200) * 2_000_000 + x["e"] * 10_000 + x["l"])
    invalid = lambda x: _let(permute(nth(x), 60_000, 60_000, key, "phone"), lambda y: F.when(y < low, y).otherwise(number(y - low, 2_000_000)))
    chosen = lambda x: F.when((x["a"] >= 200) & (x["e"] >= 200), _let(x, valid)).otherwise(invalid(x))
    new = _let(F.struct(area.alias("a"), exchange.alias("e"), line.alias("l")), chosen)
    return F.concat(F.substring(digits, F.lit(1), F.length(digits) - 10), _padded(new, 10))


def _ssn(digits: Column, key: Column) -> Column:
    area, group, serial = (F.substring(digits, at, n).cast("long") for at, n in ((1, 3), (4, 2), (6, 4)))
    size = 99 * 9999
    value = permute((area - 1 - (area > 666).cast("long")) * size + (group - 1) * 9999 + serial - 1, 898, size, key, "ssn")
    first, rest = F.floor(value / size) + 1, F.pmod(value, F.lit(size).cast("long"))
    return F.concat(_padded(first + (first > 665).cast("long"), 3), _padded(F.floor(rest / 9999) + 1, 2), _padded(F.pmod(rest, F.lit(9999).cast("long")) + 1, 4))


def _ip(text: Column, key: Column) -> Column:
    parts = F.split(text, r"\.")
    value = F.aggregate(parts, F.lit(0).cast("long"), lambda x, p: x * 256 + p.cast("long"))
    out = permute(value, 65_536, 65_536, key, "ip")
    return F.concat_ws(".", *(F.pmod(F.floor(out / 256**k), F.lit(256).cast("long")).cast("string") for k in (3, 2, 1, 0)))


def _domain(text: Column) -> Column:
    """Whether a domain has, behind labels that aren't empty, one that begins with two letters."""
    labels = F.split(F.substring_index(text, "@", -1), r"\.")
    empty = F.array_position(labels, "")
    known = F.when(empty > 0, F.slice(labels, F.lit(1), F.greatest(empty.cast("int") - 1, F.lit(0)))).otherwise(labels)
    return F.exists(F.slice(known, F.lit(2), F.greatest(F.size(known) - 1, F.lit(0))), lambda x: x.rlike("^[A-Za-z]{2}"))


def _date(text: Column) -> Column:
    """struct(day, order, short): the day (null if there is none), how it is written (ymd, dmy, mdy), whether its year has two digits."""
    first = text.rlike("^[0-9]{4}")

    def read(parts: Column) -> Column:
        one, two, three = (F.get(parts, F.lit(i)) for i in range(3))
        short = ~first & (F.length(three) == 2)
        year = F.when(short, F.concat(F.when(three < "50", "20").otherwise("19"), three)).when(first, one).otherwise(three)
        day = lambda m, d: F.to_date(F.try_to_timestamp(F.concat_ws("-", year, F.lpad(m, 2, "0"), F.lpad(d, 2, "0")), F.lit("yyyy-MM-dd")))
        return F.struct(day(two, F.when(first, three).otherwise(one)).alias("usual"), F.when(~first, day(one, two)).alias("turned"), short.alias("short"))

    order = lambda x: F.when(first, "ymd").when(x["usual"].isNotNull(), "dmy").otherwise("mdy")
    return _let(_let(F.split(text, "[-/.]"), read), lambda x: F.struct(F.coalesce(x["usual"], x["turned"]).alias("day"), order(x).alias("order"), x["short"].alias("short")))


def _days(day: Column, first: str, days: int, key: Column, kind: str) -> Column:
    """A keyed permutation of the days from a first one on."""
    left = next(k for k in range(2, days) if days % k == 0)
    start = F.to_date(F.lit(first))
    return F.date_add(start, permute(F.datediff(day, start), left, days // left, key, kind).cast("int"))


def _new_date(text: Column, date: Column, key: Column) -> Column:
    new = F.when(date["short"], _days(date["day"], "1950-01-01", 36_525, key, "date2")).otherwise(_days(date["day"], "1900-01-01", 73_049, key, "date"))
    bare = text.rlike("(?<![0-9])[0-9](?![0-9])")  # a day or month of one digit
    part = lambda n: F.when(bare, n.cast("string")).otherwise(_padded(n, 2))
    year = lambda n: F.when(date["short"], _padded(F.year(n) % 100, 2)).otherwise(F.year(n).cast("string"))
    parts = _let(new, lambda n: F.struct(part(F.dayofmonth(n)).alias("d"), part(F.month(n)).alias("m"), year(n).alias("y")))
    laid = lambda x: F.when(date["order"] == "ymd", F.array(x["y"], x["m"], x["d"])).when(date["order"] == "dmy", F.array(x["d"], x["m"], x["y"])).otherwise(F.array(x["m"], x["d"], x["y"]))
    sign = F.regexp_extract(text, "[-/.]", 0)
    return F.aggregate(_let(parts, laid), F.lit(""), lambda x, y: F.concat(x, F.when(x == "", "").otherwise(sign), y))


def _tagged(text: Column, key: Column) -> Column:
    """(kind, pseudonym) of a match of ANY; kind is null if it fails validation."""
    digits = F.regexp_replace(text, "[^0-9]", "")
    whole = lambda kind: text.rlike(f"^(?:{SHAPES[kind]})$")
    pair = lambda kind, out: F.struct(F.lit(kind).alias("kind"), out.alias("out"))
    plain = F.struct(F.lit(None).cast("string").alias("kind"), text.alias("out"))
    return (
        F.when(whole("email") & _domain(text), pair("email", F.concat(permute_string(F.substring_index(text, "@", 1), key, "email"), F.lit("@"), F.substring_index(text, "@", -1))))
        .when(whole("iban") & _is_iban(text), pair("iban", _iban(text, key)))
        .when(whole("phone"), pair("phone", _phone(text, key)))
        .when(whole("ip") & F.forall(F.split(text, r"\."), lambda p: p.cast("int") <= 255), pair("ip", _ip(text, key)))
        .when(whole("card") & F.call_function("luhn_check", digits), pair("card", _laid_out(_card(digits, key), text)))
        .when(whole("ssn"), pair("ssn", _laid_out(_ssn(digits, key), text)))
        .when(whole("date"), _let(_date(text), lambda d: F.when(d["day"].isNotNull(), pair("date", _new_date(text, d, key))).otherwise(plain)))
        .otherwise(plain)
    )


def pseudonymise(docs: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """docs with text_col pseudonymised and n_pii and n_<kind> added. The key is in no plan."""
    p = unused_prefix(docs)
    text = column(text_col)
    results = {"n_pii", *(f"n_{kind}" for kind in SHAPES)}
    some = F.rlike(text, F.lit("[0-9@]")) & F.rlike(text, F.lit(ANY))
    nothing = F.array().cast("array<struct<kind:string,out:string>>")
    found = F.when(some, F.transform(F.regexp_extract_all(text, F.lit(ANY), F.lit(0)), lambda m: _tagged(m, F.col(f"{p}key")))).otherwise(nothing)
    held = F.col(f"{p}found")
    count = lambda kind: F.size(F.filter(held, lambda x: x["kind"] == kind)).cast("long")
    put = F.when(F.size(held) > 0, F.array_join(F.flatten(F.zip_with(F.split(text, ANY, -1), held["out"], lambda gap, out: F.array(gap, F.coalesce(out, F.lit(""))))), "")).otherwise(text)
    return docs.withColumn(f"{p}key", secret(docs.sparkSession, key)).withColumn(f"{p}found", found).select(
        *(put.alias(c) if c == text_col else column(c) for c in docs.columns if c.lower() not in results),
        F.size(F.filter(held, lambda x: x["kind"].isNotNull())).cast("long").alias("n_pii"),
        *(count(kind).alias(f"n_{kind}") for kind in SHAPES),
    )
