"""Format-preserving pseudonyms for personal numbers, dates and identifiers.

Values found in a text are checked (Luhn digit, octets, calendar, number
ranges) and permuted within their own format by a keyed Feistel network: a
value always gets the same pseudonym under one key, so equal values stay linked
across documents, two values never share one, and the key's holder can invert
it. Separators, lengths and check digits stay as they have to be.

Only DataFrame operations: no Python on the executors.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from podium.operators import free_name

ROUNDS = 8  # even, so that the halves end where they began
_DIGITS = "0123456789"
_HEX = "0123456789abcdef"
_BOTH_CASES = _HEX + "ABCDEF"
_NAME = "0123456789abcdefghijklmnopqrstuvwxyz"
# Days of the Gregorian cycle of 400 years: 146097 = 189 * 773. The dates of
# the cycle from here on are permuted among each other.
_FIRST_DAY, _DAYS = "1800-01-01", (189, 773)
# Areas 001 to 899 without 666, groups 01 to 99, serials 0001 to 9999.
_SOCIAL = (898 * 99, 9999)
# Characters that one hash has noise for.
_BLOCK = 64
# Steps of a walk; one in two or more ends inside, so that none gets this far.
_STEPS = 64


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _rounds(left: Column, right: Column, step: Callable, invert: bool) -> Column:
    """Run the network: each round adds noise from one half to the other and swaps them."""
    order = F.sequence(F.lit(0), F.lit(ROUNDS - 1))

    def round_(halves: Column, number: Column) -> Column:
        if invert:
            kept = halves["l"]
            return F.struct(step(halves["r"], kept, number).alias("l"), kept.alias("r"))
        kept = halves["r"]
        return F.struct(kept.alias("l"), step(halves["l"], kept, number).alias("r"))

    start = F.struct(left.alias("l"), right.alias("r"))
    return F.aggregate(F.reverse(order) if invert else order, start, round_)


def feistel_text(text: Column, alphabet: str, key: str, tag: str, invert: bool = False) -> Column:
    """Permute the strings of one length over ``alphabet``.

    Each character of a half is shifted by two digits of noise from the other
    half; noise beyond 64 characters comes from further hashes.
    """
    base, letters = len(alphabet), F.lit(alphabet)

    def step(target: Column, other: Column, number: Column) -> Column:
        seed = F.concat(
            F.lit(f"{key}|{tag}|{base}|"), F.length(text), F.lit("|"), number, F.lit("|"), other
        )

        def shifted(part: Column, noise: Column, i: Column) -> Column:
            byte = F.conv(F.substr(noise, 2 * i - 1, F.lit(2)), 16, 10).cast("int")
            at = F.position(F.substr(part, i, F.lit(1)), letters) - 1
            place = F.pmod(at - byte if invert else at + byte, F.lit(base))
            return F.substr(letters, place + 1, F.lit(1))

        def block(first: Column, number: Column) -> Column:
            noise = F.when(number == 0, first).otherwise(F.sha2(F.concat(first, F.lit("|"), number), 512))
            part = F.substr(target, number * _BLOCK + 1, F.lit(_BLOCK))
            return _let(
                F.struct(part.alias("part"), noise.alias("noise")),
                lambda b: F.array_join(
                    F.transform(
                        F.sequence(F.lit(1), F.length(b["part"])), lambda i: shifted(b["part"], b["noise"], i)
                    ),
                    "",
                ),
            )

        last = F.floor((F.greatest(F.length(target), F.lit(1)) - 1) / _BLOCK).cast("int")
        new = _let(
            F.sha2(seed, 512),
            lambda first: F.array_join(
                F.transform(F.sequence(F.lit(0), last), lambda number: block(first, number)), ""
            ),
        )
        return F.when(F.length(target) > 0, new).otherwise(target)

    half = F.floor(F.length(text) / 2).cast("int")
    ends = _rounds(
        F.substr(text, F.lit(1), half), F.substr(text, half + 1, F.length(text)), step, invert
    )
    any_ = F.length(text) > 0
    return F.when(any_, _let(ends, lambda e: F.concat(e["l"], e["r"]))).otherwise(text)


def feistel_number(
    number: Column, sides: tuple[int, int], key: str, tag: str, invert: bool = False
) -> Column:
    """Permute the numbers from 0 below the product of ``sides``."""
    a, b = sides

    def step(target: Column, other: Column, turn: Column) -> Column:
        seed = F.concat(F.lit(f"{key}|{tag}|"), turn, F.lit("|"), other)
        noise = F.conv(F.substring(F.sha2(seed, 256), 1, 15), 16, 10).cast("bigint")
        side = F.when(turn % 2 == 0, F.lit(a)).otherwise(F.lit(b)).cast("bigint")
        return F.pmod(target - noise if invert else target + noise, side)

    number = number.cast("bigint")
    ends = _rounds(F.floor(number / b).cast("bigint"), F.pmod(number, F.lit(b)), step, invert)
    return _let(ends, lambda e: e["l"] * b + e["r"])


def _walk(start: Column, step: Callable[[Column], Column], inside: Callable[[Column], Column]) -> Column:
    """Take steps of a permutation from ``start``, which is inside, until inside again.

    So the values inside are permuted among each other, and walked back by the
    steps of the inverse.
    """

    def on(state: Column, _: Column) -> Column:
        next_ = _let(step(state["x"]), lambda x: F.struct(x.alias("x"), inside(x).alias("ok")))
        return F.when(state["ok"], state).otherwise(next_)

    first = F.struct(start.alias("x"), F.lit(False).alias("ok"))
    ends = F.aggregate(F.sequence(F.lit(1), F.lit(_STEPS)), first, on)
    return _let(ends, lambda e: F.when(e["ok"], e["x"]))


def _filled(shape: Column, characters: str, values: Column) -> Column:
    """``shape`` with its characters of the class ``characters`` replaced, in order, by ``values``."""

    def fill(new: Column, state: Column, c: Column) -> Column:
        takes = c.rlike(f"[{characters}]")
        return F.struct(
            F.concat(
                state["out"], F.when(takes, F.substr(new, state["i"], F.lit(1))).otherwise(c)
            ).alias("out"),
            (state["i"] + takes.cast("int")).alias("i"),
        )

    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("i"))
    return _let(
        values,
        lambda new: F.aggregate(F.split(shape, ""), start, lambda state, c: fill(new, state, c))["out"],
    )


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn_digit(payload: Column) -> Column:
    def add(total: Column, i: Column) -> Column:
        d = F.substr(payload, F.length(payload) - i, F.lit(1)).cast("int")
        doubled = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when(i % 2 == 0, doubled).otherwise(d)

    places = F.sequence(F.lit(0), F.length(payload) - 1)
    return F.pmod(-F.aggregate(places, F.lit(0), add), F.lit(10)).cast("string")


def _card(value: Column, key: str, invert: bool) -> Column:
    digits = _digits(value)
    payload = F.substr(digits, F.lit(1), F.length(digits) - 1)
    new = feistel_text(payload, _DIGITS, key, "card", invert)
    made = _filled(value, "0-9", _let(new, lambda digits: F.concat(digits, _luhn_digit(digits))))
    return F.when(F.call_function("luhn_check", digits), made)


def _phone(value: Column, key: str, invert: bool) -> Column:
    prefix = F.regexp_extract(value, r"^\+\d{1,3}(?=[ .(-])", 0)
    rest = F.substr(value, F.length(prefix) + 1, F.length(value))
    new = feistel_text(_digits(rest), _DIGITS, key, "phone", invert)
    made = F.concat(prefix, _filled(rest, "0-9", new))
    return F.when(F.length(_digits(value)).between(8, 15), made)


def _address(value: Column, key: str, invert: bool) -> Column:
    octets = F.split(value, r"\.")
    pairs = F.transform(octets, lambda o: F.lpad(F.lower(F.conv(o, 10, 16)), 2, "0"))
    new = feistel_text(F.array_join(pairs, ""), _HEX, key, "address", invert)
    places = F.sequence(F.lit(1), F.lit(7), F.lit(2))
    parts = _let(
        new, lambda h: F.transform(places, lambda i: F.conv(F.substr(h, i, F.lit(2)), 16, 10))
    )
    return F.when(F.forall(octets, lambda o: o.cast("int") <= 255), F.array_join(parts, "."))


def _social(value: Column, key: str, invert: bool) -> Column:
    area, group, serial = (F.split(value, "-")[i].cast("int") for i in range(3))
    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    place = area - F.when(area > 666, 2).otherwise(1)
    number = (place * 99 + group - 1).cast("bigint") * 9999 + serial - 1

    def written(new: Column) -> Column:
        first = F.floor(new / (99 * 9999))
        return F.format_string(
            "%03d-%02d-%04d",
            (first + F.when(first >= 665, 2).otherwise(1)).cast("int"),
            (F.pmod(F.floor(new / 9999), F.lit(99)) + 1).cast("int"),
            (F.pmod(new, F.lit(9999)) + 1).cast("int"),
        )

    return F.when(valid, _let(feistel_number(number, _SOCIAL, key, "social", invert), written))


def _date(form: str) -> Callable[[Column, str, bool], Column]:
    def dated(value: Column, key: str, invert: bool) -> Column:
        day = F.date_diff(F.try_to_date(value, form), F.lit(_FIRST_DAY).cast("date"))
        inside = day.between(0, _DAYS[0] * _DAYS[1] - 1)
        new = feistel_number(day, _DAYS, key, "date", invert)
        made = F.date_add(F.lit(_FIRST_DAY).cast("date"), new.cast("int"))
        return F.when(inside, F.date_format(made, form))

    return dated


def _slash_date(value: Column, key: str, invert: bool) -> Column:
    """MM/dd/yyyy, or else dd/MM/yyyy: then the day is above 12, and stays so."""
    origin = F.lit(_FIRST_DAY).cast("date")
    day = F.date_diff(F.try_to_date(value, "dd/MM/yyyy"), origin).cast("bigint")

    def date_of(number: Column) -> Column:
        return F.date_add(origin, number.cast("int"))

    new = _walk(
        day,
        lambda x: feistel_number(x, _DAYS, key, "date", invert),
        lambda x: F.dayofmonth(date_of(x)) > 12,
    )
    late = day.between(0, _DAYS[0] * _DAYS[1] - 1) & (F.dayofmonth(date_of(day)) > 12)
    made = F.when(late, F.date_format(date_of(new), "dd/MM/yyyy"))
    return F.coalesce(_date("MM/dd/yyyy")(value, key, invert), made)


def _mail(value: Column, key: str, invert: bool) -> Column:
    local, domain = F.split(F.lower(value), "@")[0], F.split(value, "@")[1]
    new = feistel_text(F.regexp_replace(local, "[^a-z0-9]", ""), _NAME, key, "mail", invert)
    return F.concat(_filled(local, "a-z0-9", new), F.lit("@"), domain)


def _secret(value: Column, key: str, invert: bool) -> Column:
    """Capitals as small letters, and back; both cases together are an alphabet of their own."""

    def permuted(start: Column, alphabet: str, *looks: str) -> Column:
        inside = "^" + "".join(f"(?=.*{look})" for look in looks)
        return _walk(
            start,
            lambda x: feistel_text(x, alphabet, key, "secret", invert),
            lambda x: x.rlike(inside),
        )

    one_case = _let(
        permuted(F.lower(value), _HEX, "[0-9]", "[a-f]"),
        lambda new: F.when(value.rlike("[A-F]"), F.upper(new)).otherwise(new),
    )
    both = permuted(value, _BOTH_CASES, "[0-9]", "[a-f]", "[A-F]")
    return F.when(value.rlike("[a-f]") & value.rlike("[A-F]"), both).otherwise(one_case)


@dataclass(frozen=True)
class Kind:
    """What to look for, and its pseudonym: NULL for a value that fails its check."""

    pattern: str
    pseudonym: Callable[[Column, str, bool], Column]


# In order of precedence where several match at one place.
KINDS = (
    Kind(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]*+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", _mail),
    Kind(r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?!\.?[0-9])", _address),
    Kind(r"(?<![0-9-])[0-9]{4}-[0-9]{2}-[0-9]{2}(?!-?[0-9])", _date("yyyy-MM-dd")),
    Kind(r"(?<![0-9.])[0-9]{2}\.[0-9]{2}\.[0-9]{4}(?!\.?[0-9])", _date("dd.MM.yyyy")),
    Kind(r"(?<![0-9/])[0-9]{2}/[0-9]{2}/[0-9]{4}(?!/?[0-9])", _slash_date),
    Kind(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?!-?[0-9])", _social),
    Kind(r"\+[0-9]{1,3}[ .-]?\(?[0-9]{1,4}\)?(?:[ .-]?[0-9]{2,4}){2,4}(?![0-9])", _phone),
    Kind(r"(?<![0-9A-Za-z])[0-9](?:[ -]?[0-9]){12,18}(?![0-9A-Za-z])", _card),
    Kind(
        r"(?<![0-9A-Za-z])(?=[0-9]*[A-Fa-f])(?=[A-Fa-f]*[0-9])[0-9A-Fa-f]{16,}+(?![0-9A-Za-z])", _secret
    ),
)
# Only mail addresses and secrets begin with a letter; the looks ahead pass over most others.
_ANY = (
    f"(?:{KINDS[0].pattern})|(?=[0-9+])(?:"
    + "|".join(f"(?:{kind.pattern})" for kind in KINDS[1:-1])
    + f")|(?=[0-9A-Fa-f])(?:{KINDS[-1].pattern})"
)


def _pseudonym(value: Column, key: str, invert: bool) -> Column:
    """The first kind whose pattern is the whole value decides; NULL if its check fails."""
    kinds = iter(KINDS)
    first = next(kinds)
    out = F.when(value.rlike(f"^(?:{first.pattern})$"), first.pseudonym(value, key, invert))
    for kind in kinds:
        out = out.when(value.rlike(f"^(?:{kind.pattern})$"), kind.pseudonym(value, key, invert))
    return out


def pseudonymise(docs: DataFrame, key: str, *, invert: bool = False) -> DataFrame:
    """``docs`` with every valid personal value of ``text`` replaced by its pseudonym.

    Mail addresses (the part before the @, in lower case), IPv4 addresses, dates from
    1800 to 2199, social security numbers, phone numbers with a country code,
    payment cards (check digit verified and made anew) and hexadecimal secrets.
    Values that fail their check stay. ``n_found`` counts the values replaced;
    a column of that name is replaced, all others are kept. A null text stays
    null with none found. ``invert`` restores what the same key replaced. One
    pass, no exchange; each row is treated alone, so repeats do not matter.
    """
    columns = [c for c in docs.columns if c != "n_found"]
    new_text, new_count = (free_name(docs.columns, c) for c in ("_text", "_n_found"))
    may_hold = F.coalesce(F.col("text").rlike("[0-9]|@"), F.lit(False))
    found = F.when(may_hold, F.regexp_extract_all("text", F.lit(_ANY), F.lit(0)))

    def replaced(made: Column) -> Column:
        gaps = F.split("text", _ANY, -1)
        joined = F.zip_with(
            gaps, made, lambda gap, m: F.concat(gap, F.coalesce(m["p"], m["v"], F.lit("")))
        )
        n_found = F.size(F.filter(made, lambda m: m["p"].isNotNull()))
        any_ = F.coalesce(F.size(made) > 0, F.lit(False))
        return F.struct(
            F.when(any_, F.array_join(joined, "")).otherwise(F.col("text")).alias(new_text),
            F.when(any_, n_found).otherwise(F.lit(0)).cast("bigint").alias(new_count),
        )

    # Lambdas over arrays of one element name what is used more than once, so
    # that each value is searched for, and permuted, once.
    pairs = F.transform(
        F.array(found),
        lambda values: F.transform(
            values, lambda v: F.struct(v.alias("v"), _pseudonym(v, key, invert).alias("p"))
        ),
    )
    rows = docs.select(
        *[F.col(f"`{c}`") for c in columns], F.inline(F.transform(pairs, replaced))
    )
    return rows.select(
        *[F.col(new_text).alias("text") if c == "text" else F.col(f"`{c}`") for c in columns],
        F.col(new_count).alias("n_found"),
    )
