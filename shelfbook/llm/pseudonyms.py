"""Format-preserving pseudonyms for personal data, in SQL functions only.

E-mail names, telephone, card, account and identity numbers, IP addresses, dates and credentials are found by patterns and
validated (check digits, octets, calendar). The variable places of a value are units with a radix each: digits, letters of
one case, octets, or the two parts of a day number. A keyed Feistel network runs over them: in turn, the units of one parity
are shifted by a hash of key, round, place and the units of the other parity. That is a permutation within the format, so
equal values stay linked across documents and different ones stay different. Check digits are worked out anew.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8

_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_NAMED = r"(?i:password|passwd|token|secret|api_key) ?[=:] ?[\"']?"
#: Every value holds one of these, so texts without them need no search.
_HINT = r"[0-9@]|AKIA|(?i:password|passwd|token|secret|api_key)"
#: In order: where two match at one place, the first counts.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}(?![A-Za-z0-9-])",
    "secret": r"(?<![A-Za-z0-9])AKIA[0-9A-Z]{16}(?![0-9A-Za-z])"
    rf"|\b{_NAMED}[A-Za-z0-9+/_-]{{8,}}+",
    "ip": rf"(?<![\w.]){_OCTET}(?:\.{_OCTET}){{3}}(?!\w|\.\d)",
    "date": r"(?<![\w.-])(?:(?:1[89]|20|21)\d\d-\d\d-\d\d|\d\d[./]\d\d[./](?:1[89]|20|21)\d\d)(?:(?![\w-])|(?=T\d))",
    "identity": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "account": r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)",
    "card": "",
    "phone": r"(?<![\w+])(?:\+\d{1,3}[ .-]?)?(?:(?:\(\d{3}\) ?|\d{3}[.-])\d{3}[.-]|(?:\(\d{3}\) ?|\d{3} )\d{3} )\d{4}(?!\w)"
    r"|(?<![\w+])\+\d{1,3}(?:[ .-]\d{2,4}){2,5}(?!\w)|(?<![\w+])\+\d{8,15}(?!\w)",
}
# a whole run of digit groups up to where a value of another kind begins; the cards are looked for within it
_OTHER = "|".join(f"(?:{PATTERNS[kind]})" for kind in ("email", "ip", "date", "identity", "phone"))
PATTERNS["card"] = rf"(?<![\w-])(?=\d(?:[ -]?\d){{12}})(?:(?:(?<=\d)[ -])?(?!{_OTHER})\d++(?!\w|-(?!\d)))++"
_ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())

#: digits, capitals, small letters, and digits of base 16 as they are written in small letters
ALPHABET = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789abcdef"
_UNIT = "array<struct<v:int,r:int,lo:int,k:int,c:string>>"
# 400 years of the calendar repeat after 146,097 days
_ERA, _PARTS = 146_097, (189, 773)


def _unit(v: Column, r: Column | int, lo: Column | int, k: Column | int, c: Column) -> Column:
    as_int = lambda x: x.cast("int") if isinstance(x, Column) else F.lit(x)
    return F.struct(as_int(v).alias("v"), as_int(r).alias("r"), as_int(lo).alias("lo"), as_int(k).alias("k"), c.alias("c"))


def permuted(units: Column, kind: str, key: str) -> Column:
    """The Feistel network over the units with a radix above one; k numbers these and gives their parity."""

    def turn(state: Column, r: Column) -> Column:
        other = F.array_join(F.transform(F.filter(state, lambda u: (u["k"] + r) % 2 == 1), lambda u: u["v"].cast("string")), ",")

        def shifted(u: Column) -> Column:
            text = F.concat_ws("|", F.lit(key), F.lit(kind), r.cast("string"), u["k"].cast("string"), other)
            noise = F.conv(F.substring(F.sha2(text, 256), 1, 12), 16, 10).cast("long")
            moved = u.withField("v", ((u["v"] + noise) % u["r"]).cast("int"))
            return F.when((u["r"] > 1) & ((u["k"] + r) % 2 == 0), moved).otherwise(u)

        return F.transform(state, shifted)

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), units.cast(_UNIT), turn)


def _shown(units: Column) -> Column:
    letter = lambda u: F.when(u["r"] > 1, F.substring(F.lit(ALPHABET), u["lo"] + u["v"] + 1, F.lit(1))).otherwise(u["c"])
    return F.array_join(F.transform(units, letter), "")


def _places(value: Column, free: Callable[[Column, Column], Column], hexadecimal: str = "") -> Column:
    """Units of the characters of ``value``; those for which ``free``(character, characters from it on) fails stay.
    ``hexadecimal`` is a for digits of base 16 with small letters, A for those with capitals.

    Units count from the end, so that separators and a prefix make no difference.
    """

    def unit(i: Column) -> Column:
        c, rest = F.substring(value, i, F.lit(1)), F.substring(value, i, F.length(value))
        behind = F.length(F.regexp_replace(F.substring(value, i + 1, F.length(value)), "[^A-Za-z0-9]", ""))
        at = F.instr(F.lit(ALPHABET), c)
        moves = (at > 0) & free(c, rest)
        radix = F.when(c.rlike("[0-9]"), 10).otherwise(26)
        low = F.when(c.rlike("[0-9]"), 0).when(c.rlike("[A-Z]"), 10).otherwise(36)
        if hexadecimal:
            skipped = F.when(c.rlike("[a-f]"), 26).otherwise(0)
            return F.when(moves, _unit(at - 1 - skipped, 16, 62 if hexadecimal == "a" else 0, behind, c)).otherwise(_unit(F.lit(0), 1, 0, behind, c))
        return F.when(moves, _unit(at - 1 - low, radix, low, behind, c)).otherwise(_unit(F.lit(0), 1, 0, behind, c))

    return F.transform(F.sequence(F.lit(1), F.length(value)), unit)


def _luhn(digits: Column) -> Column:
    """Sum of a digit string whose last digit counts once, modulo 10."""

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, -i, F.lit(1)).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return total + F.when(i % 2 == 0, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10


def _mod97(text: Column) -> Column:
    def add(rest: Column, i: Column) -> Column:
        v = F.instr(F.lit(ALPHABET), F.substring(text, i, F.lit(1))) - 1
        return (rest * F.when(v > 9, 100).otherwise(10) + v) % 97

    return F.aggregate(F.sequence(F.lit(1), F.length(text)), F.lit(0), add)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, r"\D", "")


def _cards(value: Column) -> Column:
    """(p, l), in order of places: where the cards of a run of digit groups begin, and their lengths. A card is some whole
    groups with 13 to 19 digits and a right check digit; of overlapping ones the longest counts, then the first."""

    def within(groups: Column) -> Column:
        n = F.size(groups)
        joined = lambda i, k, by: F.array_join(F.slice(groups, i + 1, k), by)
        spans = F.flatten(
            F.transform(
                F.sequence(F.lit(0), n - 1),
                lambda i: F.transform(F.sequence(F.lit(1), F.least(F.lit(19), n - i)), lambda k: F.struct(i.alias("i"), k.alias("k"), joined(i, k, "").alias("digits"))),
            )
        )
        valid = F.filter(spans, lambda s: F.length(s["digits"]).between(13, 19) & (_luhn(s["digits"]) == 0))
        begin = lambda i: F.when(i > 0, F.length(joined(F.lit(0), i, " ")) + 2).otherwise(1)
        placed = F.transform(
            valid,
            lambda s: F.struct((-F.length(s["digits"])).alias("size"), begin(s["i"]).alias("p"), F.length(joined(s["i"], s["k"], " ")).alias("l")),
        )
        meets = lambda c, s: (c["p"] < s["p"] + s["l"]) & (s["p"] < c["p"] + c["l"])
        chosen = F.aggregate(
            F.transform(F.array_sort(placed), lambda s: F.struct(s["p"].alias("p"), s["l"].alias("l"))),
            F.array().cast("array<struct<p:int,l:int>>"),
            lambda so_far, s: F.when(F.exists(so_far, lambda c: meets(c, s)), so_far).otherwise(F.concat(so_far, F.array(s))),
        )
        return F.array_sort(chosen)

    return F.get(F.transform(F.array(F.regexp_extract_all(value, F.lit(r"\d+"), F.lit(0))), within), 0)


def _one_card(value: Column, key: str) -> Column:
    moved = _shown(permuted(_places(value, lambda c, rest: F.length(_digits(rest)) > 1), "card", key))
    body = F.substring(moved, F.lit(1), F.length(moved) - 1)
    check = (10 - _luhn(F.concat(_digits(body), F.lit("0")))) % 10
    return F.concat(body, check.cast("string"))


def _card(value: Column, key: str) -> Column:
    def add(state: Column, c: Column) -> Column:
        before = F.substring(value, state["at"], c["p"] - state["at"])
        card = _one_card(F.substring(value, c["p"], c["l"]), key)
        return F.struct(F.concat(state["out"], before, card).alias("out"), (c["p"] + c["l"]).alias("at"))

    begin = F.struct(F.lit("").alias("out"), F.lit(1).alias("at"))
    rest = lambda state: F.concat(state["out"], F.substring(value, state["at"], F.length(value)))
    return F.aggregate(_cards(value), begin, add, rest)


def _account(value: Column, key: str) -> Column:
    plain = F.replace(value, F.lit(" "), F.lit(""))
    valid = _mod97(F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, 1, 4))) == 1
    tail = F.substring(value, F.lit(5), F.length(value))
    moved = _shown(permuted(_places(tail, lambda c, rest: F.lit(True)), "account", key))
    country = F.substring(value, 1, 2)
    check = 98 - _mod97(F.concat(F.replace(moved, F.lit(" "), F.lit("")), country, F.lit("00")))
    return F.when(valid, F.concat(country, F.lpad(check.cast("string"), 2, "0"), moved)).otherwise(value)


def _ip(value: Column, key: str) -> Column:
    octets = F.split(value, r"\.")
    units = F.transform(octets, lambda o, i: _unit(o.cast("int"), 256, 0, 3 - i, o))
    return F.array_join(F.transform(permuted(units, "ip", key), lambda u: u["v"].cast("string")), ".")


def _date(value: Column, key: str) -> Column:
    """Day of the calendar within its 400 years; not a date, not changed. The month comes first only in what is no date otherwise."""
    iso = value.rlike(r"^\d{4}-")
    part = lambda at: F.substring(value, at, 2)
    as_day = lambda text: F.try_to_timestamp(text, F.lit("yyyy-MM-dd")).cast("date")
    written = lambda month, day: as_day(F.concat_ws("-", F.substring(value, 7, 4), part(month), part(day)))
    day = F.when(iso, as_day(value)).otherwise(written(4, 1))
    turned = F.when(~iso & day.isNull(), written(1, 4))
    first = F.to_date(F.lit("1800-01-01"))  # years 1800 to 2199

    def moved(day: Column) -> Column:
        number = F.datediff(day, first)
        units = F.array(
            _unit(F.floor(number / _PARTS[1]), _PARTS[0], 0, 1, F.lit("")), _unit(number % _PARTS[1], _PARTS[1], 0, 0, F.lit(""))
        )
        out = permuted(units, "date", key)
        return F.date_add(first, (F.get(out, 0)["v"] * _PARTS[1] + F.get(out, 1)["v"]).cast("int"))

    # on until the month comes first here, too: different dates stay different (two days in five take another step)
    again = F.aggregate(F.sequence(F.lit(1), F.lit(64)), moved(turned), lambda d, _: F.when(F.dayofmonth(d) > 12, d).otherwise(moved(d)))
    dotted = F.substring(value, 3, 1) == "."
    shown = lambda d, form: F.when(dotted, F.date_format(d, form)).otherwise(F.date_format(d, form.replace(".", "/")))
    known = lambda d: d.isNotNull() & F.datediff(d, first).between(0, _ERA - 1)
    return (
        F.when(iso & known(day), F.date_format(moved(day), "yyyy-MM-dd"))
        .when(known(day), shown(moved(day), "dd.MM.yyyy"))
        .when(known(turned), shown(again, "MM.dd.yyyy"))
        .otherwise(value)
    )


def _email(value: Column, key: str) -> Column:
    return _shown(permuted(_places(value, lambda c, rest: F.instr(rest, "@") > 0), "email", key))


def _secret(value: Column, key: str) -> Column:
    """The name before a credential, or the fixed beginning of a key, stays."""
    name = F.regexp_extract(value, f"^(?:AKIA|{_NAMED})", 0)
    body = F.substring(value, F.length(name) + 1, F.length(value))
    free = lambda c, rest: F.lit(True)
    base_16 = lambda a: _shown(permuted(_places(body, free, hexadecimal=a), "hex", key))
    moved = F.when(body.rlike("^[0-9a-f]+$"), base_16("a")).when((name != "AKIA") & body.rlike("^[0-9A-F]+$"), base_16("A"))
    return F.concat(name, moved.otherwise(_shown(permuted(_places(body, free), "secret", key))))


def _number(kind: str, last: int) -> Callable[[Column, str], Column]:
    """Digits but for those before the ``last`` ones: a telephone's country code stays."""
    return lambda value, key: _shown(
        permuted(_places(value, lambda c, rest: c.rlike("[0-9]") & (F.length(_digits(rest)) <= last)), kind, key)
    )


_HOW: dict[str, Callable[[Column, str], Column]] = {
    "email": _email, "secret": _secret, "ip": _ip, "date": _date, "identity": _number("identity", 9), "account": _account, "card": _card,
    "phone": _number("phone", 10),
}


def pseudonym(value: Column, key: str) -> Column:
    """What stands for one found value; a value that fails its validation stays as it is."""
    out = value
    for kind in reversed(_HOW):
        out = F.when(value.rlike(f"^(?:{PATTERNS[kind]})$"), _HOW[kind](value, key)).otherwise(out)
    return out


def _rewritten(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` as __row, with the new __text and how many values it replaces."""
    rows = docs.select(F.struct("*").alias("__row"), F.col("text").cast("string").alias("text"))
    hinted = F.col("text").rlike(_HINT)
    rows = rows.withColumns(
        {"found": F.when(hinted, F.regexp_extract_all("text", F.lit(_ANY), F.lit(0))), "between": F.when(hinted, F.split("text", _ANY))}
    )
    rows = rows.withColumn("other", F.transform("found", lambda v: pseudonym(v, key)))
    joined = F.array_join(F.flatten(F.zip_with("between", "other", lambda a, b: F.array(a, F.coalesce(b, F.lit(""))))), "")
    count = lambda a, b: F.when(a == b, 0).when(a.rlike(f"^(?:{PATTERNS['card']})$"), F.size(_cards(a))).otherwise(1)
    changed = F.aggregate(F.zip_with("found", "other", count), F.lit(0), lambda n, x: n + x)
    some = F.coalesce(F.size("found") > 0, F.lit(False))
    return rows.select(
        "__row", F.when(some, joined).otherwise(F.col("text")).alias("__text"),
        F.when(some, changed).otherwise(0).cast("long").alias("n_replaced"),
    )


def pseudonymised(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with pseudonyms in ``text``; null stays null, and no row is added or lost. ``key`` is a secret of the caller's."""
    return _rewritten(docs, key).select(F.col("__row").withField("text", F.col("__text")).alias("__row")).select("__row.*")


def pseudonym_report(docs: DataFrame, key: str) -> DataFrame:
    """(doc_id, text, n_replaced) for every row."""
    return _rewritten(docs.select("doc_id", "text"), key).select(
        F.col("__row.doc_id").cast("long").alias("doc_id"), F.col("__text").alias("text"), "n_replaced"
    )
