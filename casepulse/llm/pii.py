"""Format-preserving pseudonyms for personal values, in column expressions only.

Card numbers, telephone numbers, bank account numbers, social security numbers, internet and
mail addresses and dates are found by one pattern, checked by the rules of their kind and
replaced by a keyed permutation of all values of the same format. The permutation is a Feistel
network over two parts of the value, of which each round adds a keyed hash of the one to the
other. So equal values get equal pseudonyms in every document, different values different ones,
check digits stay right, and punctuation and lengths stay as they were. In the number formats
the network is wrapped round a step by one, which makes the permutation a single cycle: no value
stands for itself.

Values that fail their check (a number whose check digit is wrong or that no card network
issues, a month 13) are not touched. What is shaped like an account number but is none is
searched again for the other kinds. The key is the caller's to choose and to keep: with it the
permutation can be undone. Of mail names letters of the common scripts move within their script,
others of the basic plane within their block of 128, those beyond it stay. Null stays null and a text without values stays as it is.
The expression is evaluated row by row: repeated rows, hot sources and other columns do not
matter, and nothing is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ROUNDS = 4

# Lengths of bank account numbers by country.
ACCOUNT_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA",
    30: "JO KW MU", 31: "MT SC", 32: "LC", 33: "RU",
}


def _accounts() -> str:
    """Account numbers of exactly their country's length, in one piece or in groups of four."""
    by_length = []
    for length, countries in ACCOUNT_LENGTHS.items():
        fours, rest = divmod(length - 4, 4)
        tail = f" ?[A-Z0-9]{{{rest}}}" if rest else ""
        by_length.append(rf"(?:{'|'.join(countries.split())})\d{{2}}(?: ?[A-Z0-9]{{4}}){{{fours}}}{tail}")
    return rf"(?<![\p{{L}}\p{{N}}])(?:{'|'.join(by_length)})(?![\p{{L}}\p{{N}}])"


# The shapes of values, by kind, in the order in which they are tried.
SHAPES = {
    "mail": r"[\p{L}\p{N}][\p{L}\p{N}._%+-]{0,63}@[A-Za-z0-9](?:[A-Za-z0-9-]{0,62}\.){1,8}[A-Za-z]{2,24}",
    "iban": _accounts(),
    # No more digits than a number can have, and a group of digits wholly or not at all.
    "phone": r"(?<![\p{L}\p{N}+])(?:\+\d(?:[ .()-]{0,2}\d){7,14}|\(\d{3}\) ?\d{3}-\d{4}|\d{3}-\d{3}-\d{4}"
    r"|[2-9]\d{2}(?:\.\d{3}\.| \d{3} )\d{4})(?![\d.]\d|\d)",
    "ip": r"(?<![\d.])\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?!\d|\.\d)",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "date": r"(?<![\d./-])(?:\d{4}-\d{2}-\d{2}|\d{4}/\d{2}/\d{2}|\d{1,2}\.\d{1,2}\.\d{4}|\d{1,2}/\d{1,2}/\d{4})(?![\d/-]|\.\d)",
    "card": r"(?<![\p{L}\d])(?=[2-6])(?:\d{13,19}|\d{4} \d{4} \d{4} \d{4}|\d{4}-\d{4}-\d{4}-\d{4}|\d{4} \d{6} \d{5}|\d{4}-\d{6}-\d{5})(?![\p{L}\d])",
}
PATTERN = "|".join(f"(?:{shape})" for shape in SHAPES.values())
#: What is looked for in an account number that fails its check.
WITHIN = "|".join(f"(?:{shape})" for kind, shape in SHAPES.items() if kind != "iban")
#: Card networks: leading digits and lengths.
CARDS = (
    r"4(?:\d{12}|\d{15}|\d{18})|5[1-5]\d{14}|2(?:22[1-9]|2[3-9]\d|[3-6]\d\d|7[01]\d|720)\d{12}"
    r"|3[47]\d{13}|3(?:0[0-5]|[68]\d)\d{11}|6(?:011|5\d\d|4[4-9]\d)\d{12}|35(?:2[89]|[3-8]\d)\d{12}"
)


def _number(key: str, domain: Column, turn: int, part: Column, below: Column) -> Column:
    """A keyed hash of one part as a number below a bound."""
    digest = F.sha2(F.concat_ws("|", F.lit(key), domain, F.lit(str(turn)), part.cast("string")), 256)
    return F.pmod(F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint"), below)


def permute(value: Column, low: Column, high: Column, domain: Column, key: str) -> Column:
    """A keyed permutation without fixed points of the numbers below ``low * high``.

    A number is ``left * high + right``. One round adds to the left part modulo ``low``, the
    next to the right modulo ``high``; undoing them, the step by one, and doing them again is a
    cycle.
    """

    def pair(left: Column, right: Column) -> Column:
        return F.struct(left.alias("l"), right.alias("r"))

    def one(state: Column, turn: int, sign: int) -> Column:
        left, right = state["l"], state["r"]
        if turn % 2:
            return pair(left, F.pmod(right + sign * _number(key, domain, turn, left, high), high))
        return pair(F.pmod(left + sign * _number(key, domain, turn, right, low), low), right)

    turns = [*((t, -1) for t in reversed(range(ROUNDS))), None, *((t, 1) for t in range(ROUNDS))]
    state = pair(F.call_function("div", value, high), F.pmod(value, high))
    # A fold over the list of rounds evaluates each state once.
    steps = F.array(*(F.struct(F.lit(-1 if t is None else t[0]).alias("t"), F.lit(0 if t is None else t[1]).alias("s")) for t in turns))

    def step(held: Column, turn: Column) -> Column:
        following = held["l"] * high + held["r"] + 1
        following = F.when(following >= low * high, F.lit(0).cast("bigint")).otherwise(following)
        moved = pair(F.call_function("div", following, high), F.pmod(following, high))
        chosen = F.when(turn["s"] == 0, moved)
        for t in range(ROUNDS):
            for sign in (-1, 1):
                chosen = chosen.when((turn["t"] == t) & (turn["s"] == sign), one(held, t, sign))
        return chosen

    return F.aggregate(steps, state, step, lambda held: held["l"] * high + held["r"])


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _chars(value: Column) -> Column:
    return F.split(value, "")


def _fill(form: Column, digits: Column) -> Column:
    """The form with its digits replaced in order."""

    def step(held: Column, char: Column) -> Column:
        digit = F.struct(
            F.concat(held["out"], F.substr(digits, held["at"], F.lit(1))).alias("out"), (held["at"] + 1).alias("at")
        )
        other = F.struct(F.concat(held["out"], char).alias("out"), held["at"].alias("at"))
        return F.when(char.between("0", "9") & (char != ""), digit).otherwise(other)

    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("at"))
    return F.aggregate(_chars(form), start, step, lambda held: held["out"])


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0), lambda a, x: a + x)


def _luhn(digits: Column) -> Column:
    """The sum whose last digit is 0 for a number with the right check digit."""

    def weigh(char: Column, i: Column) -> Column:
        digit = F.coalesce(F.try_to_number(char, F.lit("9")).cast("int"), F.lit(0))
        twice = digit * 2 - F.when(digit > 4, 9).otherwise(0)
        return F.when(i % 2 == 1, twice).otherwise(digit)

    return _sum(F.transform(_chars(F.reverse(digits)), weigh))


def _mod97(value: Column) -> Column:
    """Remainder of an account number with letters as 10 to 35, country and check digits moved to its end."""
    turned = F.concat(F.substr(value, F.lit(5)), F.substr(value, F.lit(1), F.lit(4)))

    def step(rest: Column, char: Column) -> Column:
        code = F.ascii(char)
        return F.when(char == "", rest).when(code < 58, (rest * 10 + code - 48) % 97).otherwise((rest * 100 + code - 55) % 97)

    return F.aggregate(_chars(turned), F.lit(0), step)


def _power(k: Column) -> Column:
    return F.element_at(F.array(*(F.lit(10**i).cast("bigint") for i in range(10))), (k + 1).cast("int"))


def _country_code(value: Column) -> Column:
    """The digits of a telephone number that stay: those before the first mark, or the first one."""
    return _digits(F.regexp_extract(value, r"^\+\d{1,3}(?!\d)|^\+\d", 0))


def _account(value: Column) -> Column:
    """The digits of a bank account number behind country and check digits."""
    return _digits(F.substr(F.regexp_replace(value, " ", ""), F.lit(5)))


def _moving(value: Column, kind: Column) -> Column:
    """The digits that are permuted: up to 18. Of an account the last 16, of a card all but network and check digit."""
    digits = _digits(value)
    card = F.substr(digits, F.lit(5), F.length(digits) - 5)
    iban = F.substr(_account(value), F.greatest(F.length(_account(value)) - 16, F.lit(0)) + 1)
    phone = F.substr(digits, F.length(_country_code(value)) + 1)
    return F.when(kind == "card", card).when(kind == "iban", iban).when(kind == "phone", phone).when(kind == "ssn", digits)


def _card(value: Column, moved: Column) -> Column:
    body = F.concat(F.substr(_digits(value), F.lit(1), F.lit(4)), moved)
    check = F.pmod(-_luhn(F.concat(body, F.lit("0"))), F.lit(10))
    return _fill(value, F.concat(body, check.cast("string")))


def _iban(value: Column, moved: Column) -> Column:
    plain = F.regexp_replace(value, " ", "")
    tail = F.concat(F.substr(_account(value), F.lit(1), F.greatest(F.length(_account(value)) - 16, F.lit(0))), moved)
    open_ = F.concat(F.substr(plain, F.lit(1), F.lit(2)), F.lit("00"), _fill(F.substr(plain, F.lit(5)), tail))
    check = F.lpad((98 - _mod97(open_)).cast("string"), 2, "0")
    return _fill(value, F.concat(check, tail))


def _octets(value: Column) -> Column:
    return F.transform(F.split(value, r"\."), lambda x: x.try_cast("bigint"))


def _ip(moved: Column) -> Column:
    parts = F.transform(
        F.array(*(F.lit(1 << s).cast("bigint") for s in (24, 16, 8, 0))),
        lambda unit: F.pmod(F.call_function("div", moved, unit), F.lit(256)).cast("string"),
    )
    return F.array_join(parts, ".")


def _date_parts(value: Column) -> tuple[Column, Column, Column, Column]:
    """Whether the day comes first, and year, month and day. With strokes the month comes first if it can."""
    parts = F.transform(F.split(value, "[./-]"), lambda x: x.try_cast("int"))
    a, b, c = (F.element_at(parts, i) for i in (1, 2, 3))
    year_first, dotted = value.rlike("^[0-9]{4}"), value.contains(".")
    day_first = dotted | (~year_first & (a > 12))
    month = F.when(year_first | day_first, b).otherwise(a)
    return day_first, F.when(year_first, a).otherwise(c), month, F.when(year_first, c).when(day_first, a).otherwise(b)


def _day(value: Column) -> Column:
    """The day a value names; NULL if there is none in the four centuries from 1800."""
    _, year, month, day = _date_parts(value)
    padded = [F.lpad(x.cast("string"), n, "0") for x, n in ((year, 4), (month, 2), (day, 2))]
    named = F.try_to_date(F.concat_ws("-", *padded), "yyyy-MM-dd")
    return F.when(F.year(named).between(1800, 2199), named)


def _date(value: Column, moved: Column) -> Column:
    """A day of the four centuries by its number, written as the value is."""
    day = F.date_add(F.lit("1800-01-01").cast("date"), moved.cast("int"))
    text = lambda form: F.date_format(day, form)
    slashed = F.when(value.rlike("^[0-9]{4}"), text("yyyy/MM/dd")).when(_date_parts(value)[0], text("dd/MM/yyyy"))
    slashed = slashed.otherwise(text("MM/dd/yyyy"))
    return F.when(value.contains("-"), text("yyyy-MM-dd")).when(value.contains("."), text("dd.MM.yyyy")).otherwise(slashed)


# First code point and number of the letters of a script, digits among them.
SCRIPTS = (
    (0x61, 26), (0x41, 26), (0x30, 10), (0xE0, 23), (0xC0, 23), (0x430, 32), (0x410, 32), (0x3B1, 25), (0x391, 17),
    (0x5D0, 27), (0x627, 20), (0x905, 53), (0xE01, 46), (0x3041, 86), (0x30A1, 90), (0x4E00, 20992), (0xAC00, 11172),
)


def _shift(key: str, text: Column, other: Column, turn: Column) -> Column:
    """Each letter and digit moved within its script by a keyed hash of another text."""
    digest = F.sha2(F.concat_ws("|", F.lit(key), F.lit("mail"), turn.cast("string"), other), 256)

    def move(char: Column, i: Column) -> Column:
        step = F.conv(F.substr(digest, (i % 32) * 2 + 1, F.lit(2)), 16, 10).cast("int")
        code = F.ascii(char)
        moved = F.when(code < 128, F.lit(None).cast("int"))  # marks stay
        for first, size in reversed(SCRIPTS):
            inside = code.between(first, first + size - 1)
            moved = F.when(inside, (code - first + step) % size + first).otherwise(moved)
        block = code - code % 128
        beyond = (code >= 0x250) & (code < 0xD800)
        moved = F.coalesce(moved, F.when(beyond, block + (code % 128 + step) % 128))
        written = F.decode(F.unhex(F.lpad(F.hex(moved), 4, "0")), "UTF-16BE")
        return F.coalesce(F.when(char != "", written), char)

    return F.array_join(F.transform(_chars(text), move), "")


def _mail(key: str, value: Column) -> Column:
    """The part before the sign is permuted among all of its length and character classes; the host stays."""
    at = F.instr(value, "@")
    local = F.substr(value, F.lit(1), at - 1)
    half = F.floor(F.length(local) / 2).cast("int")
    start = F.struct(F.substr(local, F.lit(1), half).alias("l"), F.substr(local, half + 1).alias("r"))

    def step(held: Column, turn: Column) -> Column:
        left = F.struct(_shift(key, held["l"], held["r"], turn).alias("l"), held["r"].alias("r"))
        right = F.struct(held["l"].alias("l"), _shift(key, held["r"], held["l"], turn).alias("r"))
        return F.when(turn % 2 == 0, left).otherwise(right)

    turns = F.array(*(F.lit(t) for t in range(ROUNDS)))
    moved = F.aggregate(turns, start, step, lambda held: F.concat(held["l"], held["r"]))
    return F.concat(moved, F.substr(value, at))


def _of_kind(value: Column) -> Column:
    """The kind of a match by its shape, NULL if it fails its check."""
    digits = _digits(value)
    plain = F.regexp_replace(value, " ", "")
    octets = F.forall(_octets(value), lambda x: x <= 255)
    social = ~value.rlike("^(?:000|666|9)|-00-|-0000$")
    shaped = lambda kind: value.rlike(f"^(?:{SHAPES[kind]})$")
    kind = F.when(value.contains("@"), F.lit("mail"))
    kind = kind.when(value.rlike("^[A-Z]"), F.when(_mod97(plain) == 1, F.lit("iban")))
    kind = kind.when(shaped("phone"), F.when(F.length(digits).between(8, 15), F.lit("phone")))
    kind = kind.when(shaped("ip"), F.when(octets, F.lit("ip")))
    kind = kind.when(shaped("ssn"), F.when(social, F.lit("ssn")))
    kind = kind.when(shaped("date"), F.when(_day(value).isNotNull(), F.lit("date")))
    issued = digits.rlike(f"^(?:{CARDS})$") & (_luhn(digits) % 10 == 0)
    return kind.when(issued, F.lit("card"))


def _pieces(text: Column) -> Column:
    """The text in pieces ``v``, of which those with ``m`` have the shape of a value."""
    piece = lambda v, m: F.struct(F.coalesce(v, F.lit("")).alias("v"), F.lit(m).alias("m"))

    def cut(whole: Column, pattern: str, inner) -> Column:
        gaps, matches = F.split(whole, pattern, -1), F.regexp_extract_all(whole, F.lit(pattern), F.lit(0))
        return F.flatten(F.zip_with(gaps, matches, lambda gap, m: F.concat(F.array(piece(gap, False)), inner(m))))

    def again(match: Column) -> Column:
        no_account = match.rlike("^[A-Z]") & ~match.contains("@") & (_mod97(F.regexp_replace(match, " ", "")) != 1)
        return F.when(no_account, cut(match, WITHIN, lambda m: F.array(piece(m, True)))).otherwise(F.array(piece(match, True)))

    return cut(text, PATTERN, again)


def _kinds(text: Column) -> Column:
    """The pieces with their kind ``k``, NULL for what stays."""
    return F.transform(_pieces(text), lambda p: F.struct(p["v"].alias("v"), F.when(p["m"] & (p["v"] != ""), _of_kind(p["v"])).alias("k")))


def _replaced(kinds: Column, key: str) -> Column:
    """Each piece's pseudonym, or the piece itself if it has no kind.

    In steps, each over the fields that the step before has made: the number and its domain, the
    permuted number, the text.
    """
    first = F.lit("1800-01-01").cast("date")
    parts = F.transform(kinds, lambda x: F.struct(x["v"].alias("v"), x["k"].alias("k"), _moving(x["v"], x["k"]).alias("d")))

    def domain(x: Column) -> Column:
        ip, date, n = x["k"] == "ip", x["k"] == "date", F.length(x["d"])
        address = F.aggregate(_octets(x["v"]), F.lit(0).cast("bigint"), lambda a, octet: a * 256 + octet)
        number = F.when(ip, address).when(date, F.datediff(_day(x["v"]), first).cast("bigint"))
        square, half = F.lit(1 << 16).cast("bigint"), F.floor(n / 2)
        low = F.when(ip, square).when(date, F.lit(189).cast("bigint")).otherwise(_power(half))
        high = F.when(ip, square).when(date, F.lit(773).cast("bigint")).otherwise(_power(n - half))
        return F.struct(
            *(x[name].alias(name) for name in ("v", "k", "d")),
            number.otherwise(F.when(n > 0, x["d"].try_cast("bigint"))).alias("number"),
            low.alias("low"),
            high.alias("high"),
            F.concat_ws("", x["k"], n.cast("string")).alias("domain"),
        )

    def moved(x: Column) -> Column:
        found = F.when(x["number"].isNotNull(), permute(x["number"], x["low"], x["high"], x["domain"], key))
        digits = F.coalesce(F.lpad(found.cast("string"), F.length(x["d"]), F.lit("0")), F.lit(""))
        return F.struct(x["v"].alias("v"), x["k"].alias("k"), found.alias("p"), digits.alias("q"))

    def written(x: Column) -> Column:
        kind = x["k"]
        out = F.when(kind == "mail", _mail(key, x["v"])).when(kind == "card", _card(x["v"], x["q"]))
        out = out.when(kind == "iban", _iban(x["v"], x["q"])).when(kind == "ip", _ip(x["p"]))
        out = out.when(kind == "phone", _fill(x["v"], F.concat(_country_code(x["v"]), x["q"])))
        out = out.when(kind == "ssn", _fill(x["v"], x["q"])).when(kind == "date", _date(x["v"], x["p"]))
        return out.otherwise(x["v"])

    return F.transform(F.transform(F.transform(parts, domain), moved), written)


def _may_hold(text: Column) -> Column:
    """A quick look: most texts have neither a digit nor an at sign."""
    return text.rlike("[0-9@]")


def pseudonymise(text: Column, key: str) -> Column:
    """The text with its personal values replaced under a key."""
    return F.when(_may_hold(text), F.array_join(_replaced(_kinds(text), key), "")).otherwise(text)


def count(text: Column) -> Column:
    """How many values of a text are replaced; 0 for NULL."""
    found = F.size(F.filter(_kinds(text), lambda piece: piece["k"].isNotNull()))
    return F.when(_may_hold(text), found).otherwise(0).cast("bigint")
