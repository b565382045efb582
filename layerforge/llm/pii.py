"""Format-preserving pseudonyms for personal numbers, by keyed Feistel permutations.

Every value is checked first (Luhn digits, octet ranges, real calendar dates, ...)
and then permuted within its format: the permutation of a kind is keyed, one to
one, and the same in all documents, so equal values stay linked and a pseudonym
passes the check its value passed. Text around the values is left as it is.

A value is a list of digits with a radix each (10 for decimal digits, 16 for hex,
36 for letters and digits). A Feistel round
adds a keyed hash of one half to the other half, digit by digit modulo its
radix, which is invertible for any mix of radices. All steps are Column functions.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerforge.llm.columns import let

ROUNDS = 8
_ALPHABET = "0123456789abcdefghijklmnopqrstuvwxyz"
# 400 Gregorian years have 146,097 = 189 * 773 days, so a date is two digits of these radices.
_FIRST_DAY, _DATE_RADICES = "1800-01-01", (189, 773)


def _added(half: Column, radices: Column, other: Column, key: Column, label: Column, sign: int) -> Column:
    """`half` plus (or minus) the keyed hash of `other`, digit by digit; 8 hash bytes serve 8 digits."""

    def digit(x: Column, i: Column) -> Column:
        block = F.sha2(F.concat_ws("|", key, label, F.floor(i / 8).cast("string"), F.array_join(other.cast("array<string>"), ",")), 256)
        noise = F.conv(F.substr(block, (i % 8) * 8 + 1, F.lit(8)), 16, 10).cast("bigint")
        return F.pmod(x + F.lit(sign) * noise, F.get(radices, i))

    return F.transform(half, digit)


def permuted(digits: Column, radices: Column, key: Column, inverse: bool = False) -> Column:
    """A keyed permutation of digit lists with the given radices; `inverse` undoes it.

    Lists of fewer than two digits are shifted by the key alone.
    """
    size = F.size(digits)
    cut = F.floor(size / 2).cast("int")

    def halves(d: Column) -> Column:
        # The left half may be empty; the right one has the rest.
        return F.struct(F.slice(d, F.lit(1), cut).alias("l"), F.slice(d, cut + 1, size - cut).alias("r"))

    order = range(ROUNDS - 1, -1, -1) if inverse else range(ROUNDS)
    sign = -1 if inverse else 1

    def rounds(r: Column) -> Column:
        left, right = r["l"], r["r"]

        def one(state: Column, k: Column) -> Column:
            name = k.cast("string")
            return F.when(
                k % 2 == 0,
                F.struct(
                    state["l"].alias("l"), _added(state["r"], right, state["l"], key, name, sign).alias("r")
                ),
            ).otherwise(
                F.struct(
                    _added(state["l"], left, state["r"], key, name, sign).alias("l"), state["r"].alias("r")
                )
            )

        return F.aggregate(F.array(*[F.lit(k) for k in order]), halves(digits), one)

    return let(let(halves(radices), rounds), lambda s: F.concat(s["l"], s["r"]))


def _numbers(text: Column) -> Column:
    """Values of the characters 0-9 and a-z."""
    return F.transform(F.split(text, ""), lambda c: (F.instr(F.lit(_ALPHABET), c) - 1).cast("bigint"))


def _text(numbers: Column) -> Column:
    return F.array_join(F.transform(numbers, lambda n: F.substr(F.lit(_ALPHABET), n.cast("int") + 1, F.lit(1))), "")


def _radices(n: Column, radix: int) -> Column:
    return F.array_repeat(F.lit(radix).cast("bigint"), n)


def _mixed(key: Column, text: Column, radix: int, inverse: bool) -> Column:
    return _text(permuted(_numbers(text), _radices(F.length(text), radix), key, inverse))


def luhn_sum(digits: Column) -> Column:
    """Luhn sum of a digit string that has its check digit last; valid if it is a multiple of ten."""
    values = F.transform(
        F.reverse(_numbers(digits)),
        lambda d, i: F.when(i % 2 == 0, d).otherwise(d * 2 - F.when(d > 4, 9).otherwise(0)),
    )
    return F.aggregate(values, F.lit(0).cast("bigint"), lambda a, x: a + x)


def _put_back(value: Column, digits: Column, pattern: str) -> Column:
    """`value` with its characters that match `pattern` replaced by those of `digits` in turn."""
    pieces = F.split(value, pattern, -1)
    return let(
        F.split(digits, ""),
        lambda d: F.array_join(F.transform(pieces, lambda p, i: F.concat(p, F.coalesce(F.get(d, i), F.lit("")))), ""),
    )


def _card(value: Column, key: Column, inverse: bool) -> Column:
    digits = F.regexp_replace(value, "[ -]", "")
    body = _mixed(key, F.substr(digits, F.lit(1), F.length(digits) - 1), 10, inverse)
    made = let(body, lambda b: F.concat(b, F.pmod(-luhn_sum(F.concat(b, F.lit("0"))), F.lit(10)).cast("string")))
    return F.when((luhn_sum(digits) % 10 == 0) & (digits.rlike("[1-9]")), _put_back(value, made, "[0-9]"))


def mod97(text: Column) -> Column:
    """Remainder of a text of digits and letters (a is 10, z is 35) read as one number."""
    return F.aggregate(
        _numbers(F.lower(text)),
        F.lit(0).cast("bigint"),
        lambda a, x: (a * F.when(x < 10, 10).otherwise(100) + x) % 97,
    )


def _account(value: Column, key: Column, inverse: bool) -> Column:
    """International account numbers: country and length stay, letters stay letters, check digits are made anew."""
    compact = F.replace(value, F.lit(" "), F.lit(""))
    country, body = F.substr(compact, F.lit(1), F.lit(2)), F.lower(F.substr(compact, F.lit(5)))
    numbers = _numbers(body)
    radices = F.transform(numbers, lambda x: F.when(x < 10, F.lit(10)).otherwise(26).cast("bigint"))
    low = F.transform(numbers, lambda x: F.when(x < 10, F.lit(0)).otherwise(10).cast("bigint"))
    made = let(
        permuted(F.zip_with(numbers, low, lambda x, m: x - m), radices, key, inverse),
        lambda d: F.upper(_text(F.zip_with(d, low, lambda x, m: x + m))),
    )
    whole = let(
        made,
        lambda b: F.concat(country, F.lpad((98 - mod97(F.concat(b, country, F.lit("00")))).cast("string"), 2, "0"), b),
    )
    valid = mod97(F.concat(F.substr(compact, F.lit(5)), F.substr(compact, F.lit(1), F.lit(4)))) == 1
    # Check digits are 02 to 98; 00, 01 and 99 may have the right remainder, too, but would not come back.
    digits = F.substr(compact, F.lit(3), F.lit(2)).cast("bigint")
    return F.when(valid & digits.between(2, 98), _put_back(value, whole, "[0-9A-Z]"))


def _address(value: Column, key: Column, inverse: bool) -> Column:
    octets = F.transform(F.split(value, r"\."), lambda x: x.cast("bigint"))
    digits = F.flatten(F.transform(octets, lambda x: F.array(F.floor(x / 16), x % 16)))
    made = permuted(digits, _radices(F.lit(8), 16), key, inverse)
    joined = let(
        made,
        lambda d: F.concat_ws(".", *[(F.get(d, F.lit(2 * k)) * 16 + F.get(d, F.lit(2 * k + 1))).cast("string") for k in range(4)]),
    )
    # An octet with a leading zero is no valid one, and its zeros would be lost.
    return F.when(F.forall(octets, lambda x: x <= 255) & ~value.rlike(r"(?:^|\.)0[0-9]"), joined)


def _phone(value: Column, key: Column, inverse: bool) -> Column:
    """Numbers of area, exchange and line, of any digits; a country code 1 before them stays."""
    prefix = F.regexp_extract(value, r"^(.*?)\(?[0-9]{3}\)?[ .-]?[0-9]{3}[ .-][0-9]{4}$", 1)
    return F.concat(prefix, _permuted_digits(F.substr(value, F.length(prefix) + 1), key, inverse))


def _permuted_digits(value: Column, key: Column, inverse: bool) -> Column:
    return _put_back(value, _mixed(key, F.regexp_replace(value, "[^0-9]", ""), 10, inverse), "[0-9]")


def _international(value: Column, key: Column, inverse: bool) -> Column:
    """A country code that is set off stays; of a number without separators the first digit stays."""
    prefix = F.regexp_extract(value, r"^\+(?:[0-9]{1,3}(?=[ .(-])|[0-9])", 0)
    return F.concat(prefix, _permuted_digits(F.substr(value, F.length(prefix) + 1), key, inverse))


def _social(value: Column, key: Column, inverse: bool) -> Column:
    """Areas 001 to 899 without 666, groups from 01, serials from 0001."""
    area, group, serial = (F.substr(value, F.lit(a), F.lit(n)).cast("bigint") for a, n in ((1, 3), (5, 2), (8, 4)))
    place = area - F.when(area < 666, 1).otherwise(2)
    radices = F.array(*[F.lit(r).cast("bigint") for r in (898, 99, 9999)])

    def shown(d: Column) -> Column:
        first = F.get(d, F.lit(0)) + 1
        parts = (first + F.when(first >= 666, 1).otherwise(0), F.get(d, F.lit(1)) + 1, F.get(d, F.lit(2)) + 1)
        return F.format_string("%03d-%02d-%04d", *parts)

    return let(permuted(F.array(place, group - 1, serial - 1), radices, key, inverse), shown)


def _date(form: str) -> Callable[[Column, Column, bool], Column]:
    def run(value: Column, key: Column, inverse: bool) -> Column:
        day = F.datediff(F.try_to_date(value, form), F.lit(_FIRST_DAY).cast("date")).cast("bigint")
        a, b = _DATE_RADICES
        radices = F.array(F.lit(a).cast("bigint"), F.lit(b).cast("bigint"))
        made = let(
            day, lambda d: let(
                permuted(F.array(F.floor(d / b), d % b), radices, key, inverse),
                lambda p: F.date_format(
                    F.date_add(F.lit(_FIRST_DAY).cast("date"), (F.get(p, F.lit(0)) * b + F.get(p, F.lit(1))).cast("int")), form
                ),
            )
        )
        return F.when((day >= 0) & (day < a * b), made)

    return run


def _mail(value: Column, key: Column, inverse: bool) -> Column:
    """Letters and digits of the local part; its other characters and the domain stay."""
    local = F.lower(F.substring_index(value, "@", 1))
    plain = F.regexp_replace(local, "[^0-9a-z]", "")
    made = _put_back(local, _mixed(key, plain, 36, inverse), "[0-9a-z]")
    return F.concat(made, F.substr(value, F.instr(value, "@")))


@dataclass(frozen=True)
class Kind:
    """Where a value may be (a regular expression without groups), and its checked pseudonym or NULL."""

    name: str
    pattern: str
    pseudonym: Callable[[Column, Column, bool], Column]


KINDS = (
    Kind("mail", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}", _mail),
    Kind(
        "account",
        r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)(?![A-Za-z0-9])",
        _account,
    ),
    Kind("card", r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{4,5})(?![0-9])", _card),
    Kind("phone", r"(?<![0-9])(?:\+?1[ .-]?)?(?:\([0-9]{3}\)[ .-]?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])", _phone),
    # What kind a number is depends on its shape alone, so both kinds of phone numbers stay one to one.
    Kind(
        "international",
        r"(?<![0-9A-Za-z])\+[1-9](?:[ .-]?[0-9]|[ .-]?\([0-9]{1,5}\)(?=[ .-]?[0-9])){6,14}(?![0-9])",
        _international,
    ),
    Kind("social", r"(?<![0-9])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9])", _social),
    Kind("address", r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9])", _address),
    Kind("date", r"(?<![0-9])[0-9]{4}-[0-9]{2}-[0-9]{2}(?![0-9])", _date("yyyy-MM-dd")),
    Kind("dotted_date", r"(?<![0-9.])[0-9]{2}\.[0-9]{2}\.[0-9]{4}(?![0-9])", _date("dd.MM.yyyy")),
    Kind("slashed_date", r"(?<![0-9/])[0-9]{2}/[0-9]{2}/[0-9]{4}(?![0-9/])", _date("MM/dd/yyyy")),
)


def pseudonym(value: Column, key: str, kinds: tuple[Kind, ...] = KINDS, inverse: bool = False) -> Column:
    """`kind, made` of one found value; `made` is NULL where no kind's check holds."""
    out = F.lit(None).cast("struct<kind: string, made: string>")
    for kind in reversed(kinds):
        own = F.lit(f"{key}|{kind.name}")
        made = kind.pseudonym(value, own, inverse)
        out = F.when(
            value.rlike(f"^(?:{kind.pattern})$"), F.struct(F.lit(kind.name).alias("kind"), made.alias("made"))
        ).otherwise(out)
    return out


def pseudonymised(
    docs: DataFrame, key: str, kinds: tuple[Kind, ...] = KINDS, inverse: bool = False
) -> DataFrame:
    """`docs` with `text` pseudonymised and `pii`, the number of replaced values per kind.

    All other columns stay, also ones named like the helpers here; `pii` is
    replaced if there is one. A null text stays null, a text without values is
    unchanged, and its `pii` is an empty map. Values that fail their check
    (no Luhn number, no real date) are left alone. Repeated rows stay.
    """
    pattern = "|".join(k.pattern for k in kinds)
    text = F.col("text")

    def rebuilt(found: Column) -> Column:
        made = F.transform(found, lambda v: pseudonym(v, key, kinds, inverse))

        def joined(m: Column) -> Column:
            pieces = F.split(text, pattern, -1)
            new = F.zip_with(
                pieces,
                F.zip_with(found, m, lambda v, p: F.coalesce(p["made"], v)),
                lambda piece, v: F.concat(piece, F.coalesce(v, F.lit(""))),
            )
            done = F.filter(m, lambda p: p["made"].isNotNull())
            names = F.transform(done, lambda p: p["kind"])
            counts = F.map_from_entries(
                F.transform(
                    F.array_distinct(names),
                    lambda n: F.struct(n.alias("key"), F.size(F.filter(names, lambda x: x == n)).cast("long").alias("value")),
                )
            )
            return F.struct(F.array_join(new, "").alias("text"), counts.alias("pii"))

        return let(made, joined)

    none = F.struct(text.alias("text"), F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<bigint>")).alias("pii"))
    made = let(
        F.coalesce(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.array().cast("array<string>")),
        lambda found: F.when(F.size(found) > 0, rebuilt(found)).otherwise(none),
    )
    rest = [F.col(f"d.`{c}`") for c in docs.columns if c not in ("text", "pii")]
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("d"), made.alias("m"))
    return packed.select(*rest, "m.text", "m.pii")
