"""Text columns: comma lists and `k=v|k=v` records."""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def is_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit("")) == ""


def is_not_empty(text: Column) -> Column:
    return ~is_empty(text)


def trim_comma(text: Column) -> Column:
    """Without one leading and one trailing comma."""
    return F.regexp_replace(text, "^,|,\\z", "")


def two_digits(text: Column) -> Column:
    """A text of length 2 as it is, any other with a 0 before it."""
    return F.when(F.length(text) == 2, text).otherwise(F.concat(F.lit("0"), text))


def id_texts(text: Column) -> Column:
    """The non-empty items of a comma list."""
    return F.filter(F.split(text, ","), lambda item: item != "")


def id_list(text: Column) -> Column:
    """The ids of a comma list as longs; items that are no number are left out."""
    return F.array_compact(F.transform(id_texts(text), lambda item: item.try_cast("bigint")))


def words(text: Column) -> Column:
    """Words between single spaces; empty words at the end do not count."""
    stripped = F.rtrim(text)
    blank = (stripped == "") & (text != "")
    return F.when(blank, F.array().cast("array<string>")).otherwise(F.split(stripped, " "))


def record_field(record: Column, field: str) -> Column:
    """Value of the first `field=value` in a `k=v|k=v` record.

    An entry counts only with a non-empty value that holds no further `=`
    (trailing ones are ignored); with no such entry the result is NULL.
    """
    entries = F.filter(
        F.split(record, "[|]"),
        lambda entry: entry.rlike("^[^=]*=[^=]+=*\\z")
        & (F.split_part(entry, F.lit("="), F.lit(1)) == field),
    )
    return F.split_part(F.get(entries, F.lit(0)), F.lit("="), F.lit(2))


def set_record_field(record: Column, field: str, value: Column) -> Column:
    """The record with the first entry named `field` replaced by `field=value`.

    Empty entries at the end are left out.
    """
    entries = F.split(F.regexp_replace(record, "[|]+\\z", ""), "[|]")
    names = F.transform(entries, lambda entry: F.split_part(entry, F.lit("="), F.lit(1)))
    at = F.array_position(names, field)
    changed = F.concat(F.lit(f"{field}="), value)
    return F.array_join(
        F.transform(entries, lambda entry, i: F.when(i + 1 == at, changed).otherwise(entry)), "|"
    )


def record(**fields: Column) -> Column:
    """A `k=v|k=v` record; NULL values are written as empty."""
    return F.concat_ws(
        "|",
        *(
            F.concat(F.lit(f"{name}="), F.coalesce(value.cast("string"), F.lit("")))
            for name, value in fields.items()
        ),
    )


def record_fields(record: Column, names: Sequence[str]) -> Column:
    """A struct of texts with what `record_field` gives for each of the names, in one pass over the entries."""
    valid = F.filter(F.split(record, "[|]"), lambda entry: entry.rlike("^[^=]*=[^=]+=*\\z"))
    pairs = F.transform(
        valid,
        lambda e: F.struct(
            F.split_part(e, F.lit("="), F.lit(1)).alias("name"), F.split_part(e, F.lit("="), F.lit(2)).alias("value")
        ),
    )
    nothing = F.struct(*(F.lit(None).cast("string").alias(n) for n in names))

    def first_wins(found: Column, pair: Column) -> Column:
        return F.struct(
            *(
                F.when(found[n].isNull() & (pair["name"] == n), pair["value"]).otherwise(found[n]).alias(n)
                for n in names
            )
        )

    return F.aggregate(pairs, nothing, first_wins)


def typed_record(record: Column, schema: T.StructType, empty: Mapping[str, object] | None = None) -> Column:
    """A struct of `schema` from a record: texts that are no value of a field's type are NULL.

    A record writes a NULL and an empty value alike; both are read as NULL, or as what `empty` has for the field.
    """
    texts = record_fields(record, schema.names)
    given = empty or {}
    return F.transform(
        F.array(texts),
        lambda t: F.struct(
            *(F.coalesce(t[f.name].try_cast(f.dataType), F.lit(given.get(f.name)).cast(f.dataType)).alias(f.name) for f in schema.fields)
        ),
    )[0]


def contains(text: Column, part: str | Column) -> Column:
    return F.contains(text, part if isinstance(part, Column) else F.lit(part))
