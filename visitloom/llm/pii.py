"""Format-preserving pseudonyms of personal numbers and dates, in DataFrame expressions only.

A value is found by its shape and validated (check digit, ranges, calendar). Its digits, letters or parts become
symbols, each with a number of values of its own; a keyed Feistel network permutes such lists: in each round, one half is
shifted, symbol by symbol, by hashes of the key, the kind and the other half. So equal values have equal pseudonyms in all
documents, different values have different ones, and a pseudonym is a valid value of the same format.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitloom.llm.batches import free_name

ROUNDS = 8

# Shapes of the kinds, tried in this order.
SHAPES = {
    "email": r"[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "ip": r"(?<![0-9][.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![.][0-9])",
    "phone": r"(?:\+1[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}",
    "ssn": r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
    "date": r"(?:19|20)[0-9]{2}-[0-9]{2}-[0-9]{2}|(?<![0-9][.])[0-9]{1,2}(?:/[0-9]{1,2}/|\.[0-9]{1,2}\.)(?:19|20)[0-9]{2}",
    "card": r"[0-9]{13,19}|[0-9]{4}(?:-[0-9]{4}){3}|[0-9]{4}(?: [0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5}",
}
_ANY = r"(?<![A-Za-z0-9])(?:" + "|".join(SHAPES.values()) + r")(?![A-Za-z0-9])"
# Days from 1900-01-01 to 2099-12-31: 73,049 = 319 * 229 pairs of symbols.
FIRST_DAY, DAY_SIZES = "1900-01-01", (319, 229)
_LOWER, _UPPER = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _symbols(chars: str) -> str:
    """The digits and letters of a list of characters as symbols (v of m values)."""
    return f"""transform(filter({chars}, c -> c RLIKE '[A-Za-z0-9]'), c -> CASE
        WHEN c RLIKE '[0-9]' THEN named_struct('v', CAST(c AS int), 'm', 10)
        WHEN c RLIKE '[a-z]' THEN named_struct('v', ascii(c) - 97, 'm', 26)
        ELSE named_struct('v', ascii(c) - 65, 'm', 26) END)"""


def _digit_sum(digits: str) -> str:
    """The sum of a card number's digits, every second one from the right doubled."""
    return f"""aggregate(transform(reverse({digits}), (d, i) -> CASE WHEN i % 2 = 0 THEN CAST(d AS int)
        WHEN CAST(d AS int) > 4 THEN 2 * CAST(d AS int) - 9 ELSE 2 * CAST(d AS int) END), 0, (s, d) -> s + d)"""


def _parsed(value: str) -> str:
    """Kind and symbols of a value of one of the shapes; the kind is null if it is not valid."""
    digits = f"filter(split({value}, ''), c -> c RLIKE '[0-9]')"
    local = f"split(substring_index({value}, '@', 1), '')"
    day = f"""CASE WHEN {value} LIKE '%-%' THEN try_to_date({value}, 'yyyy-MM-dd')
        WHEN {value} LIKE '%.%' THEN try_to_date({value}, 'd.M.yyyy')
        ELSE coalesce(try_to_date({value}, 'M/d/yyyy'), try_to_date({value}, 'd/M/yyyy')) END"""
    area, group, serial = (f"CAST(substring({value}, {a}, {n}) AS int)" for a, n in ((1, 3), (5, 2), (8, 4)))
    return f"""CASE
        WHEN {value} LIKE '%@%' THEN named_struct('kind', 'email', 'symbols', {_symbols(local)})
        WHEN {value} RLIKE '^{_sql(SHAPES["ip"])}$' THEN CASE
            WHEN forall(split({value}, '[.]'), p -> CAST(p AS int) < 256 AND (p = '0' OR p NOT LIKE '0%'))
            THEN named_struct('kind', 'ip', 'symbols',
                transform(split({value}, '[.]'), p -> named_struct('v', CAST(p AS int), 'm', 256))) END
        WHEN {value} RLIKE '^(?:{_sql(SHAPES["phone"])})$' THEN named_struct('kind', 'phone', 'symbols',
            transform(slice({digits}, -10, 10), (d, i) -> CASE WHEN i NOT IN (0, 3)
                THEN named_struct('v', CAST(d AS int), 'm', 10) WHEN d < '2'
                THEN named_struct('v', CAST(d AS int), 'm', 2) ELSE named_struct('v', CAST(d AS int) - 2, 'm', 8) END))
        WHEN {value} RLIKE '^{_sql(SHAPES["ssn"])}$' THEN CASE
            WHEN {area} BETWEEN 1 AND 899 AND {area} <> 666 AND {group} > 0 AND {serial} > 0
            THEN named_struct('kind', 'ssn', 'symbols', array(
                named_struct('v', {area} - CASE WHEN {area} > 666 THEN 2 ELSE 1 END, 'm', 898),
                named_struct('v', {group} - 1, 'm', 99), named_struct('v', {serial} - 1, 'm', 9999))) END
        WHEN {value} RLIKE '^(?:{_sql(SHAPES["date"])})$' THEN CASE WHEN ({day}) IS NOT NULL
            THEN named_struct('kind', 'date', 'symbols', array(
                named_struct('v', datediff({day}, DATE'{FIRST_DAY}') div {DAY_SIZES[1]}, 'm', {DAY_SIZES[0]}),
                named_struct('v', datediff({day}, DATE'{FIRST_DAY}') % {DAY_SIZES[1]}, 'm', {DAY_SIZES[1]}))) END
        WHEN {_digit_sum(digits)} % 10 = 0 THEN named_struct('kind', 'card', 'symbols',
            transform(slice({digits}, 1, size({digits}) - 1), d -> named_struct('v', CAST(d AS int), 'm', 10)))
        END"""


def _sql(pattern: str) -> str:
    return pattern.replace("\\", "\\\\")


def _permuted(kind: str, symbols: str, key: str) -> str:
    """The list of symbol values after ROUNDS rounds."""
    values = f"transform({symbols}, s -> CAST(s.v AS int))"
    half = f"((size({symbols}) + 1) div 2)"
    # Even rounds shift the first half by the second, odd ones the second by the first.
    other = f"slice(x, CASE WHEN r % 2 = 0 THEN CAST({half} AS int) + 1 ELSE 1 END, size(x))"
    other = f"CASE WHEN r % 2 = 0 THEN {other} ELSE slice(x, 1, CAST({half} AS int)) END"
    seed = f"concat_ws('|', {key}, {kind}, size(x), r, array_join({other}, ','), i)"
    shift = f"CAST(conv(substring(sha2({seed}, 256), 1, 12), 16, 10) AS bigint)"
    return f"""aggregate(sequence(0, {ROUNDS - 1}), {values}, (x, r) -> transform(x, (v, i) ->
        CASE WHEN (i < {half}) = (r % 2 = 0) THEN CAST((v + {shift}) % {symbols}[i].m AS int) ELSE v END))"""


def _refilled(chars: str, values: str) -> str:
    """Characters with their digits and letters replaced, in order, by the values of symbols."""
    at = f"size(filter(slice({chars}, 1, i), c -> c RLIKE '[A-Za-z0-9]'))"
    return f"""array_join(transform({chars}, (c, i) -> CASE
        WHEN c RLIKE '[0-9]' THEN CAST({values}[{at}] AS string)
        WHEN c RLIKE '[a-z]' THEN substring('{_LOWER}', {values}[{at}] + 1, 1)
        WHEN c RLIKE '[A-Z]' THEN substring('{_UPPER}', {values}[{at}] + 1, 1) ELSE c END), '')"""


def _written(value: str, kind: str, symbols: str, x: str) -> str:
    """The pseudonym of a value, from the permuted symbol values."""
    digit_count = f"length(regexp_replace({value}, '[^0-9]', ''))"
    # The check digit makes the sum a multiple of 10; it stands at the last place, which is not doubled.
    card_digits = f"transform({x}, d -> CAST(d AS string))"
    check = f"CAST((10 - {_digit_sum(f'concat({card_digits}, array(' + chr(39) + '0' + chr(39) + '))')} % 10) % 10 AS int)"
    # The first digits of area and exchange stay among 0 and 1, or among 2 to 9.
    phone = f"transform({x}, (d, i) -> CASE WHEN i IN (0, 3) AND {symbols}[i].m = 8 THEN d + 2 ELSE d END)"
    country = f"CASE WHEN {digit_count} > 10 THEN array(1) ELSE array() END"
    ssn = f"""concat_ws('-', lpad(CAST({x}[0] + CASE WHEN {x}[0] > 664 THEN 2 ELSE 1 END AS string), 3, '0'),
        lpad(CAST({x}[1] + 1 AS string), 2, '0'), lpad(CAST({x}[2] + 1 AS string), 4, '0'))"""
    day = f"date_add(DATE'{FIRST_DAY}', {x}[0] * {DAY_SIZES[1]} + {x}[1])"
    date_format = f"""CASE WHEN {value} LIKE '%-%' THEN 'yyyy-MM-dd'
        WHEN {value} LIKE '%.%' THEN CASE WHEN {value} RLIKE '^[0-9]{{2}}[.][0-9]{{2}}[.]' THEN 'dd.MM.yyyy' ELSE 'd.M.yyyy' END
        WHEN try_to_date({value}, 'M/d/yyyy') IS NOT NULL
            THEN CASE WHEN {value} RLIKE '^[0-9]{{2}}/[0-9]{{2}}/' THEN 'MM/dd/yyyy' ELSE 'M/d/yyyy' END
        WHEN {value} RLIKE '^[0-9]{{2}}/[0-9]{{2}}/' THEN 'dd/MM/yyyy' ELSE 'd/M/yyyy' END"""
    return f"""CASE {kind}
        WHEN 'email' THEN concat({_refilled(f"split(substring_index({value}, '@', 1), '')", x)}, '@',
            substring_index({value}, '@', -1))
        WHEN 'ip' THEN array_join({x}, '.')
        WHEN 'phone' THEN {_refilled(f"split({value}, '')", f"concat({country}, {phone})")}
        WHEN 'card' THEN {_refilled(f"split({value}, '')", f"concat({x}, array({check}))")}
        WHEN 'ssn' THEN {ssn}
        WHEN 'date' THEN date_format({day}, {date_format})
        ELSE {value} END"""


def _pseudonym(value: str, key: str) -> str:
    """(value, kind, pseudonym) of a value found by its shape; an invalid one has no kind and stays.

    Each step is a list of one element, so that it is written, and computed, once.
    """
    parsed = f"transform(array({_parsed(value)}), p -> named_struct('kind', p.kind, "
    parsed += f"'symbols', p.symbols, 'x', {_permuted('p.kind', 'p.symbols', key)}))"
    return f"""transform({parsed}, q -> named_struct('value', {value}, 'kind', q.kind,
        'pseudonym', {_written(value, 'q.kind', 'q.symbols', 'q.x')}))[0]"""


def pseudonymise(documents: DataFrame, key: str, text: str = "text", found: str = "pii") -> DataFrame:
    """`documents` with the valid personal values in their texts replaced, and `found`: (value kind, pseudonym) in order.

    Kinds: card numbers of 13 to 19 digits with a right check digit, kept right; IPv4 addresses; phone numbers of ten
    digits in groups, with or without +1; social security numbers; dates from 1900 to 2099 in the calendar, as 2024-01-31, 31.1.2024 or
    1/31/2024 (31/1/2024 where the first number can be no month); the local part of e-mail addresses. Blanks, dashes and
    brackets stay. One key gives one value the same pseudonym in all documents, a date also in all its formats of
    writing. A null text stays null and has no list; values that are not valid stay. The column is named `found`, with underscores
    added if that name is taken. All rows and other columns stay.
    """
    name = free_name(documents, found)
    gaps, hits = (free_name(documents, x) for x in ("pii_gaps", "pii_hits"))
    quoted = "'" + key.replace("\\", "\\\\").replace("'", "\\'") + "'"
    values = f"regexp_extract_all(`{text}`, '{_sql(_ANY)}', 0)"
    replaced = documents.withColumn(hits, F.expr(f"transform({values}, v -> {_pseudonym('v', quoted)})"))
    replaced = replaced.withColumn(gaps, F.split(F.col(text), _ANY, -1))
    whole = F.expr(f"""CASE WHEN size(`{hits}`) > 0 THEN array_join(flatten(zip_with(`{gaps}`, `{hits}`,
        (g, h) -> array(g, coalesce(h.pseudonym, '')))), '') ELSE `{text}` END""")
    valid = f"filter(`{hits}`, h -> h.kind IS NOT NULL)"
    listed = F.expr(f"transform({valid}, h -> named_struct('kind', h.kind, 'pseudonym', h.pseudonym))")
    columns = [whole.alias(c) if c == text else F.col(f"`{c}`") for c in documents.columns]
    return replaced.select(*columns, listed.alias(name))

