"""Personal data replaced by format-preserving pseudonyms (operator 5); DataFrame functions only.

Mail addresses, card numbers, account numbers, phone numbers, national ids, IPv4 addresses, dates and secret keys are found by one
pattern, validated (check digits, number ranges, calendar) and run through a keyed Feistel network inside their own format: a
digit stays a digit, a letter a letter of the same case, separators stay in place, check digits are computed anew, a date becomes
another valid date in the same notation. The network is a bijection, so equal values get equal pseudonyms in all documents,
however they are punctuated, and different values stay different. A date with slashes is read as MM/dd/yyyy; where there is no such
day, as dd/MM/yyyy, so 05/06/1990 is the 6th of May in every document and 25/12/1987 the 25th of December. Letters beyond a-z move
among those of their class and their 256 code points. Of a mail address the local part moves, of a phone number all behind a
country code, of a long IP address all behind its first group; a national phone number is not linked with its international form.

Defined results: a null text stays null and counts nothing; an empty text stays empty; texts are read whole; what fails its
validation is left as it is; equal rows get equal results; an empty table gives an empty result; further columns are not read
by ``pseudonymized`` and pass unchanged through ``cleaned``.
"""

from __future__ import annotations

import secrets
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyflow.llm.frames import let

ROUNDS = 8
FIRST_DAY = "1900-01-01"  # to 2099-12-31

# The length of an account number behind its check digits, by country (ISO 13616).
ACCOUNT_LENGTHS = {
    11: "NO", 12: "BE", 14: "DK FI FO FK GL NL SD", 15: "MK SI", 16: "AT BA EE KZ LT LU MN XK", 17: "CH CR HR LI LV", 18: "BG BH DE GB GE IE ME NI RS VA",
    19: "AE GI IL IQ OM SO TL", 20: "AD CZ DZ ES MD PK RO SA SE SK TN VG YE", 21: "AO CV LY MZ PT ST", 22: "IR IS TR", 23: "BF BI CF CG CM DJ FR GA GQ GR HN IT KM MC MG MR SM TD TG",
    24: "AL AZ BJ BY CI CY DO GT GW HU LB MA ML NE PL SN SV", 25: "BR EG PS QA UA", 26: "JO KW MU", 27: "MT SC", 28: "LC", 29: "RU",
}
ACCOUNTS = "|".join(f"(?:{'|'.join(c.split())})[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{{n // 4}}}" + (f" ?[A-Z0-9]{{{n % 4}}}" if n % 4 else "") for n, c in ACCOUNT_LENGTHS.items())

# A local part is a whole run of its characters, so that no text is scanned twice. Where words are not set apart by spaces, it
# begins at the last change of script, unless its last letter is of such a script itself.
_UNSPACED = r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsHangul}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}"
_SPACED = rf"[A-Za-z0-9._%+\-[\p{{L}}\p{{N}}&&[^{_UNSPACED}]]]"
_ANY_LOCAL = r"[A-Za-z0-9._%+\-\p{L}\p{N}]"
_LOCAL = rf"(?:(?<!{_SPACED}){_SPACED}++(?<=[\p{{L}}\p{{N}}_%+\-])|(?<!{_ANY_LOCAL}){_ANY_LOCAL}++(?<=[{_UNSPACED}]))"
_HEAD = r"(?:(?:sk|pk|rk)-|gh[oprsu]_|AKIA|eyJ)"

# Words that announce a secret or a phone number, in the four languages of the documents.
SECRET_WORDS = "password|passwd|passwort|passphrase|kennwort|mot de passe|contraseña|contrasena|pwd|api[_ \\-]?key|access[_ \\-]?key|secret"
PHONE_WORDS = "telephone|telefon|teléfono|telefono|téléphone|tel|tél|tfno|phone|mobile|móvil|movil|handy|portable|fax"

# The notations that are looked for, in order of precedence.
PATTERNS = {
    "email": rf"{_LOCAL}@[\p{{L}}\p{{N}}\-]{{1,63}}(?:\.[\p{{L}}\p{{N}}\-]{{1,63}}){{0,6}}\.\p{{L}}{{2,63}}",
    "secret": (
        r"(?<![\p{L}\p{N}])(?:[0-9A-Fa-f]{32,}+(?![\p{L}\p{N}])|AKIA[0-9A-Z]{16}(?![\p{L}\p{N}])|eyJ[A-Za-z0-9_\-]{8,}+\.[A-Za-z0-9_\-]{8,}+\.[A-Za-z0-9_\-]{8,}+|(?:sk|pk|rk)-[A-Za-z0-9_\-]{16,}+|gh[oprsu]_[A-Za-z0-9]{20,}+"
        rf"|(?=[pPkKmMcCaAsS])(?iu:{SECRET_WORDS})[\"']?[ \t]*+[:=][ \t]*+[\"']?(?!{_HEAD}|[0-9A-Fa-f]{{32}})(?=[^\s\"'<>,;]*[0-9])[^\s\"'<>,;]{{5,}}[\p{{L}}\p{{N}}])"
    ),
    "iban": rf"(?<![\p{{L}}\p{{N}}])(?:(?=[A-Za-z]{{2}}[0-9])(?i:{ACCOUNTS})|[A-Z]{{2}}[0-9]{{2}}[A-Z0-9]{{8,32}})(?![\p{{L}}\p{{N}}])",
    "ip": (
        r"(?:(?<![\p{L}\p{N}.])(?:(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])(?![\p{L}\p{N}]|\.[0-9])"
        r"|(?<![\p{L}\p{N}:.])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?:[23][0-9A-Fa-f]{3}|[Ff][CcDdEeFf][0-9A-Fa-f]{2})(?::[0-9A-Fa-f]{1,4}){0,5}::(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,5})?+)(?![\p{L}\p{N}:]|\.[0-9]))"
    ),
    "date": r"(?<![\p{L}\p{N}./\-])(?:(?:19|20)[0-9]{2}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}(?:\.[0-9]{1,2}\.|/[0-9]{1,2}/)(?:19|20)[0-9]{2})(?![\p{L}\p{N}]|[./\-][0-9])",
    "ssn": r"(?<![\p{L}\p{N}\-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\p{L}\p{N}]|-[0-9])",
    "phone": (
        r"(?:\+[0-9]{1,3}[ .\-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})(?:[ .\-]?[0-9]{2,4}){2,4}|(?<![\p{L}\p{N}])\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}|(?<![\p{L}\p{N}\-])[0-9]{3}[.\-][0-9]{3}[.\-][0-9]{4}"
        r"|(?<![\p{L}\p{N}.,/\-])(?:0[1-9](?:[ .\-][0-9]{2}){4}|\(?0[1-9][0-9]{1,3}\)?[ /\-][0-9]{5,9})(?![.,/\-][0-9])"
        rf"|(?<![\p{{L}}\p{{N}}])(?=[tTpPmMhHfF])(?iu:{PHONE_WORDS})\.?:?[ \t]*+[0-9](?:[ .\-/]?[0-9]){{7,13}})(?![\p{{L}}\p{{N}}])"
    ),
}
# A whole run of digit groups, as cards stand beside other numbers; no group in it is the start of another kind.
PATTERNS["card"] = rf"(?<![\p{{L}}\p{{N}}])(?=[0-9](?:[ \-]?[0-9]){{12}})[0-9]++(?![\p{{L}}\p{{N}}])(?:[ \-](?!{'|'.join(PATTERNS.values())})[0-9]++(?![\p{{L}}\p{{N}}]))*+"
KINDS = list(PATTERNS)
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())


# small column helpers


def _chars(s: Column) -> Column:
    return F.split(s, "")


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _number(hex_text: Column) -> Column:
    """A non-negative number of 60 bits from keyed hex digits."""
    return F.conv(F.substring(hex_text, 1, 15), 16, 10).cast("long")


def _keyed(key: str, kind: str, turn: Column, half: Column) -> Column:
    return F.sha2(F.concat(F.lit(f"{key}|{kind}|"), turn.cast("string"), F.lit("|"), half.cast("string"), F.lit(f"|{key}")), 512)


def _letters(low: str, c: Column, h: Column, n: int) -> Column:
    return F.char(F.lit(ord(low)) + (F.ascii(c) - ord(low) + h) % n)


def _written_from(code: Column) -> Column:
    return F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")


def _among_its_like(c: Column, h: Column) -> Column:
    """A letter or digit beyond ASCII moved among those of its class (capitals, small letters, others) in its 256 code points."""
    like = lambda x: F.when(x.rlike(r"^\p{Lu}$"), 1).when(x.rlike(r"^\p{Ll}$"), 2).when(x.rlike(r"^\p{L}$"), 3).when(x.rlike(r"^\p{N}$"), 4).otherwise(0)
    first = F.floor(F.ascii(c) / 256).cast("int") * 256
    every = F.transform(F.sequence(F.greatest(first, F.lit(128)), first + 255), lambda k: _written_from(k.cast("long")))
    among = lambda kind: let(F.filter(every, lambda x: like(x) == kind), lambda a: F.element_at(a, ((F.array_position(a, c) - 1 + h) % F.size(a) + 1).cast("int")))
    return let(like(c), lambda kind: F.when(kind == 0, c).otherwise(among(kind)))


def _moved(half: Column, noise: Column, alphabet: str) -> Column:
    """Each character moved inside its class by one byte of the noise; what is neither letter nor digit stays.

    ``alphabet``: ``hex`` takes 0-9 and a-f as one class, ``mixed hex`` has digits, a-f and A-F apart, ``text`` all letters.
    """
    letters = 6 if alphabet == "mixed hex" else 26

    def one(c: Column, i: Column) -> Column:
        h = F.conv(F.substring(noise, i % 64 * 2 + 1, F.lit(2)), 16, 10).cast("int")
        if alphabet == "hex":
            return F.lower(F.conv(((F.conv(c, 16, 10).cast("int") + h) % 16).cast("string"), 10, 16))
        moved = F.when(c.between("0", "9"), ((F.ascii(c) - 48 + h) % 10).cast("string")).when(c.between("a", "z"), _letters("a", c, h, letters)).when(c.between("A", "Z"), _letters("A", c, h, letters))
        return moved.when(c > "\x7f", _among_its_like(c, h)).otherwise(c) if alphabet == "text" else moved.otherwise(c)

    return F.when(F.length(half) > 0, F.array_join(F.transform(_chars(half), one), "")).otherwise(half)


def feistel_text(s: Column, key: str, kind: str, alphabet: str = "text") -> Column:
    """Balanced Feistel network on the two halves of a text; classes of characters keep their places."""
    cut = F.floor(F.length(s) / 2).cast("int")
    start = F.struct(F.substring(s, F.lit(1), cut).alias("l"), F.substring(s, cut + 1, F.length(s)).alias("r"))

    def turn(acc: Column, k: Column) -> Column:
        return F.struct(acc["r"].alias("l"), _moved(acc["l"], _keyed(key, kind, k, acc["r"]), alphabet).alias("r"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, turn, lambda acc: F.concat(acc["l"], acc["r"]))


def feistel_number(left: Column, right: Column, sizes: tuple[int, int], key: str, kind: str) -> Column:
    """Feistel network on a pair of numbers below ``sizes``, as a struct l, r."""
    start = F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))

    def turn(acc: Column, k: Column) -> Column:
        l_ = (acc["l"] + _number(_keyed(key, kind + "l", k, acc["r"]))) % sizes[0]
        return F.aggregate(
            F.array(l_), F.struct(acc["l"].alias("l"), acc["r"].alias("r")), lambda a, x: F.struct(x.alias("l"), ((a["r"] + _number(_keyed(key, kind + "r", k, x))) % sizes[1]).alias("r"))
        )

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, turn)


def _refill(mask: Column, digits: Column) -> Column:
    """The digits put one by one where the mask has its own."""
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("i"))

    def step(acc: Column, c: Column) -> Column:
        is_digit = c.between("0", "9")
        return F.struct(F.concat(acc["out"], F.when(is_digit, F.substring(digits, acc["i"], F.lit(1))).otherwise(c)).alias("out"), (acc["i"] + is_digit.cast("int")).alias("i"))

    return F.aggregate(_chars(mask), start, step, lambda acc: acc["out"])


def luhn_sum(digits: Column, doubled_first: bool) -> Column:
    """Sum of the digits from the right, every second one doubled; ``doubled_first``: as if a check digit stood behind them."""
    n = F.length(digits)

    def step(acc: Column, i: Column) -> Column:
        d = F.substring(digits, n - i, F.lit(1)).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return acc + F.when((i + int(doubled_first)) % 2 == 1, twice).otherwise(d)

    return F.when(n > 0, F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), step)).otherwise(F.lit(0))


def mod97(s: Column) -> Column:
    """Remainder of an account number written as digits and capital letters (A is 10)."""

    def step(acc: Column, c: Column) -> Column:
        return F.when(c.between("0", "9"), (acc * 10 + F.ascii(c) - 48) % 97).otherwise((acc * 100 + F.ascii(c) - 55) % 97)

    return F.aggregate(F.filter(_chars(s), lambda c: c != ""), F.lit(0), step)


# kinds


def _card(m: Column, key: str) -> Column:
    d = _digits(m)
    moved = feistel_text(F.substring(d, F.lit(1), F.length(d) - 1), key, "card", "mixed hex")
    check = (10 - luhn_sum(moved, True) % 10) % 10
    return _refill(m, F.concat(moved, check.cast("string")))


def _phone(m: Column, key: str) -> Column:
    """A country code and a word before the number stay; the other digits move."""
    code = F.regexp_extract(m, r"^(?:\+[0-9]{1,3}|\p{L}[^0-9]*+)", 0)
    rest = F.substring(m, F.length(code) + 1, F.length(m))
    return F.concat(code, _refill(rest, feistel_text(_digits(rest), key, "phone")))


def _iban(given: Column, key: str) -> Column:
    """Small letters denote the same account: it is moved in capitals and written as it was."""
    m = F.upper(given)
    plain = F.replace(m, F.lit(" "), F.lit(""))
    land, body = F.substring(plain, 1, 2), F.substring(plain, F.lit(5), F.length(plain))
    moved = feistel_text(body, key, "iban")
    check = F.lpad((98 - mod97(F.concat(moved, land, F.lit("00")))).cast("string"), 2, "0")
    letters = F.concat(land, check, moved)
    step = lambda acc, c: F.struct(F.concat(acc["out"], F.when(c == " ", c).otherwise(F.substring(letters, acc["i"], F.lit(1)))).alias("out"), (acc["i"] + (c != " ").cast("int")).alias("i"))
    out = F.aggregate(_chars(m), F.struct(F.lit("").alias("out"), F.lit(1).alias("i")), step, lambda acc: acc["out"])
    return F.when(given == m, out).otherwise(F.lower(out))


def _ip(m: Column, key: str) -> Column:
    return F.when(m.contains(":"), _long_ip(m, key)).otherwise(_short_ip(m, key))


def _long_ip(m: Column, key: str) -> Column:
    """Eight groups of four hex digits, written in full as a shortened form has no room; the first group stays, it tells the range."""
    sides = F.split(F.lower(m), "::")
    groups = lambda side: F.filter(F.split(side, ":"), lambda g: g != "")
    missing = F.greatest(F.lit(8) - F.size(groups(m)), F.lit(0))
    every = F.concat(groups(sides[0]), F.array_repeat(F.lit("0"), missing), F.coalesce(groups(F.get(sides, F.lit(1))), F.array().cast("array<string>")))
    hexed = F.array_join(F.transform(every, lambda g: F.lpad(g, 4, "0")), "")
    moved = feistel_text(F.substring(hexed, 5, 28), key, "ip6", "hex")
    return F.regexp_replace(F.concat(F.substring(hexed, 1, 4), moved), "(.{4})(?=.)", "$1:")


def _short_ip(m: Column, key: str) -> Column:
    o = F.transform(F.split(m, r"\."), lambda x: x.cast("long"))
    moved = feistel_number(o[0] * 256 + o[1], o[2] * 256 + o[3], (65536, 65536), key, "ip")
    return F.concat_ws(".", *[F.floor(moved[h] / 256 if first else moved[h] % 256).cast("string") for h in "lr" for first in (True, False)])


def _month_first(m: Column) -> Column:
    return F.try_to_timestamp(m, F.lit("M/d/yyyy"))


def _day(m: Column) -> Column:
    """The date a text denotes, null where there is no such day. With slashes the month stands first, unless only the day can."""
    iso = m.rlike(r"^[0-9]{4}-")
    slashed = F.coalesce(_month_first(m), F.try_to_timestamp(m, F.lit("d/M/yyyy")))
    return F.when(iso, F.try_to_timestamp(m, F.lit("yyyy-MM-dd"))).when(m.contains("."), F.try_to_timestamp(m, F.lit("d.M.yyyy"))).otherwise(slashed).cast("date")


def _moved_day(month: Column, day: Column, first: int, days: int, sizes: tuple[int, int], key: str, kind: str) -> Column:
    """A permutation of the days from the ``first`` to the last of ``days`` places of each of 2,400 months: beyond a month's end it walks on."""
    start = F.lit(FIRST_DAY).cast("date")
    month_of = lambda i: F.add_months(start, F.floor(i / days).cast("int"))
    day_of = lambda i: (i % days + first).cast("int")

    def walk(acc: Column, k: Column) -> Column:
        inner = feistel_number(F.floor(acc / sizes[1]), acc % sizes[1], sizes, key, kind)
        return F.when((k > 1) & (day_of(acc) <= F.dayofmonth(F.last_day(month_of(acc)))), acc).otherwise(inner["l"] * sizes[1] + inner["r"])

    moved = F.aggregate(F.sequence(F.lit(1), F.lit(16)), (month * days + day - first).cast("long"), walk)
    return let(moved, lambda i: F.date_add(month_of(i), day_of(i) - 1))


def _date(m: Column, key: str) -> Column:
    """A permutation of all days of two centuries that keeps days up to the 12th among themselves and those behind.

    A date is written as it was read, and one with the day first and slashes still cannot be read with the month first.
    """

    def moved(day: Column) -> Column:
        month = (F.year(day) - 1900) * 12 + F.month(day) - 1
        early = _moved_day(month, F.dayofmonth(day), 1, 12, (160, 180), key, "date")
        return F.when(F.dayofmonth(day) <= 12, early).otherwise(_moved_day(month, F.dayofmonth(day), 13, 19, (200, 228), key, "date13"))

    def written(new: Column) -> Column:
        full = F.length(m) == 10
        two = lambda short, long: F.when(full, F.date_format(new, long)).otherwise(F.date_format(new, short))
        slashed = F.when(_month_first(m).isNotNull(), two("M/d/yyyy", "MM/dd/yyyy")).otherwise(two("d/M/yyyy", "dd/MM/yyyy"))
        return F.when(m.rlike(r"^[0-9]{4}-"), F.date_format(new, "yyyy-MM-dd")).when(m.contains("."), two("d.M.yyyy", "dd.MM.yyyy")).otherwise(slashed)

    return let(let(_day(m), moved), written)


ANNOUNCED = rf"^(?iu:{SECRET_WORDS})[\"']?[ \t]*+[:=][ \t]*+[\"']?"


def _secret(m: Column, key: str) -> Column:
    """Hex digits stay hex digits of the same case; other keys keep their prefix, and the word that announces one stays."""
    head = F.regexp_extract(m, rf"^{_HEAD}|{ANNOUNCED}", 0)
    hexed = lambda: feistel_text(F.lower(m), key, "hex", "hex")
    rest = feistel_text(F.substring(m, F.length(head) + 1, F.length(m)), key, "secret")
    hexes = F.when(F.lower(m) == m, hexed()).when(F.upper(m) == m, F.upper(hexed())).otherwise(feistel_text(m, key, "mixed", "mixed hex"))
    return F.when(head != "", F.concat(head, rest)).otherwise(hexes)


def _email(m: Column, key: str) -> Column:
    """The local part moves; marks before it are not of it."""
    head, at = F.regexp_extract(m, r"^[._%+\-]*+", 0), F.instr(m, "@")
    return F.concat(head, feistel_text(F.substring(m, F.length(head) + 1, at - 1 - F.length(head)), key, "email"), F.substring(m, at, F.length(m)))


MAKERS: dict[str, Callable[[Column, str], Column]] = {
    "email": _email, "secret": _secret, "iban": _iban, "ip": _ip, "date": _date, "phone": _phone, "card": _card,
    "ssn": lambda m, key: _refill(m, feistel_text(_digits(m), key, "ssn")),
}


def kind_of(m: Column) -> Column:
    """Which kind a match is, null where it fails the validation of its kind; a run of digit groups is for ``_cards``."""
    is_ = {k: m.rlike(f"^(?:{p})$") for k, p in PATTERNS.items() if k != "card"}
    plain = F.upper(F.replace(m, F.lit(" "), F.lit("")))
    turned = F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, 1, 4))
    valid = {
        "iban": mod97(turned) == 1,
        "date": _day(m).isNotNull(),
        "ssn": ~m.rlike(r"^(?:000|666|9[0-9]{2})|-00-|-0000$"),
    }
    out = None
    for k in is_:
        then = F.when(valid[k], F.lit(k)) if k in valid else F.lit(k)
        out = F.when(is_[k], then) if out is None else out.when(is_[k], then)
    return out.when(m.rlike(RUN), F.lit("run"))


RUN = r"^[0-9]++(?:[ \-][0-9]++)*+$"
MOST = 19
# A letter before each digit group says how many groups a card takes from there on: A none, B one, C two.
TAKEN = "|".join([r"(?:A[^A-T]*+)++", *[rf"{chr(65 + n)}[^A-T]*+(?:[A-T][^A-T]*+){{{n - 1}}}" for n in range(1, MOST + 1)]])


def _is_card(digits: Column) -> Column:
    return F.length(digits).between(13, MOST) & (luhn_sum(digits, False) % 10 == 0)


def _groups_of_card(window: Column) -> Column:
    """How many digit groups from the first on are a card, at most; 0 where none are.

    A card is one group, or several of at least four digits before the last, and does not hold a group that is one by itself.
    """

    def fits(groups: Column) -> Callable[[Column], Column]:
        def one(n: Column) -> Column:
            mine = F.slice(groups, F.lit(1), n)
            split = F.forall(F.slice(groups, F.lit(1), n - 1), lambda g: F.length(g) >= 4)
            return split & let(F.array_join(mine, ""), _is_card) & ((n == 1) | ~F.exists(mine, _is_card))

        return one

    return let(F.split(window, r"[ \-]"), lambda g: F.coalesce(F.array_max(F.filter(F.sequence(F.lit(1), F.size(g)), fits(g))), F.lit(0)))


def _plain(m: Column, kind: Column) -> Column:
    return F.struct(m.alias("m"), kind.cast("string").alias("kind"))


def _cards(run: Column) -> Column:
    """A run of digit groups as pieces, each a card or what stands between cards.

    Where no card stands on its own, the longest beginning of up to 19 digits counts, however it is grouped.
    """
    windows = F.regexp_extract_all(run, F.lit(rf"(?<![0-9])(?=([0-9]+(?:[ \-][0-9]+){{0,{MOST - 1}}}))"), F.lit(1))
    groups = F.regexp_extract_all(run, F.lit(r"[ \-]?[0-9]+"), F.lit(0))

    def pieces(taken: Column) -> Column:
        lettered = F.array_join(F.zip_with(taken, groups, lambda n, g: F.concat(F.char(n + 65), g)), "")
        tokens = F.regexp_extract_all(lettered, F.lit(TAKEN), F.lit(0))
        return F.transform(tokens, lambda t: _plain(F.regexp_replace(t, "[A-T]", ""), F.when(~t.startswith("A"), "card")))

    def whole(head: Column) -> Column:
        rest = F.substring(run, F.length(head) + 1, F.length(run))
        return F.when(_is_card(_digits(head)), F.array(_plain(head, F.lit("card")), _plain(rest, F.lit(None)))).otherwise(F.array(_plain(run, F.lit(None))))

    head = F.regexp_extract(run, r"^[0-9](?:[ \-]?[0-9]){12,18}(?![0-9])", 0)
    return let(F.transform(windows, _groups_of_card), lambda taken: F.when(F.exists(taken, lambda n: n > 0), pieces(taken)).otherwise(let(head, whole)))


def _pieces(m: Column) -> Column:
    """A match as pieces, each with its kind; groups of digits in what failed as an account number may still be cards."""
    digits = F.regexp_extract(m, r"^[A-Za-z]{2}[0-9]{2} ([0-9]++(?: [0-9]++)*+)$", 1)

    def of_kind(kind: Column) -> Column:
        inside = F.concat(F.array(_plain(F.substring(m, 1, 5), F.lit(None))), _cards(digits))
        return F.when(kind == "run", _cards(m)).when(kind.isNull() & (digits != ""), inside).otherwise(F.array(_plain(m, kind)))

    return let(kind_of(m), of_kind)


def _matches(text: Column) -> Column:
    """The matches, each as its pieces."""
    return F.transform(F.regexp_extract_all(text, F.lit(ANY), F.lit(0)), _pieces)


def _replaced(found: Column, around: Column, key: str) -> Column:
    def pseudonym(x: Column) -> Column:
        out = None
        for k in KINDS:
            made = MAKERS[k](x["m"], key)
            out = F.when(x["kind"] == k, made) if out is None else out.when(x["kind"] == k, made)
        return out.otherwise(x["m"])

    new = F.transform(found, lambda pieces: F.array_join(F.transform(pieces, pseudonym), ""))
    return F.concat(around[0], F.array_join(F.zip_with(new, F.slice(around, F.lit(2), F.size(found)), lambda a, b: F.concat(a, b)), ""))


def with_pseudonyms(df: DataFrame, key: str, text_col: str, made_col: str) -> DataFrame:
    """The rows with ``made_col``: a struct of the new text and the kinds found. Texts without a digit or an @ are not searched."""
    text = F.col(f"`{text_col}`").cast("string")
    made = lambda found: F.struct(
        F.when(F.size(found) > 0, let(F.split(text, ANY, -1), lambda around: _replaced(found, around, key))).otherwise(text).alias("text"), F.transform(F.flatten(found), lambda x: x["kind"]).alias("kinds")
    )
    plain = F.struct(text.alias("text"), F.array().cast("array<string>").alias("kinds"))
    worth = F.when(F.coalesce(text.rlike("[0-9@]"), F.lit(False)), let(_matches(text), made)).otherwise(plain)
    # a generator keeps the result together: a plain column would be computed anew by each use
    return df.select("*", F.explode(F.array(worth)).alias(made_col))


def pseudonymized(df: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``text`` with pseudonyms, ``n_found`` and one count for each kind."""
    out = with_pseudonyms(df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), key, "text", "made")
    kinds = F.col("made.kinds")
    counts = [F.size(F.array_compact(kinds)).cast("long").alias("n_found")]
    counts += [(F.size(kinds) - F.size(F.filter(kinds, _is_not(kind)))).cast("long").alias(f"n_{kind}") for kind in KINDS]
    return out.select("doc_id", F.col("made.text").alias("text"), *counts)


def _is_not(kind: str) -> Callable[[Column], Column]:
    return lambda k: ~k.eqNullSafe(F.lit(kind))


def cleaned(df: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """The same rows and columns with pseudonyms in the text."""
    names = df.columns
    made = "made_" + "_" * max(map(len, names))  # longer than any name, so it is none of them
    return with_pseudonyms(df, key, text_col, made).select(*[F.col(f"`{made}`.text").alias(c) if c == text_col else F.col(f"`{c}`") for c in names])


def key_of(spark: SparkSession, name: str) -> str:
    """The key that the session carries as ``name``; where there is none, one is drawn and kept for the session.

    So nothing can be undone by whoever knows this code, and pseudonyms link within a session; a run that is to link with another one,
    or to be taken up after the driver is lost, must set the key. It stands in the plans: event logs need the care that the key needs.
    """
    if not spark.conf.get(name, ""):
        spark.conf.set(name, secrets.token_hex(32))
    return spark.conf.get(name)
