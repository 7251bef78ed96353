"""Text, JSON and array expressions."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F


def _accent_table() -> tuple[str, str]:
    """Accented Latin letters and their base letters, by Unicode decomposition."""
    accented, plain = [], []
    for code in range(0xC0, 0x250):
        base = unicodedata.normalize("NFD", chr(code))[0]
        if base != chr(code) and base.isascii():
            accented.append(chr(code))
            plain.append(base)
    return "".join(accented), "".join(plain)


_ACCENTED, _PLAIN = _accent_table()


def unaccent(c: Column) -> Column:
    return F.translate(c, _ACCENTED, _PLAIN)


def slugify(c: Column) -> Column:
    """Lower-case slug: quotes dropped, other character runs to one dash, ends trimmed.

    The reference's kept set, read literally, is a-z 0-9 and the four characters
    from backslash to underscore; the dash itself is not in it.
    """
    text = F.regexp_replace(F.lower(unaccent(c)), "['\"]+", "")
    text = F.regexp_replace(text, r"[^a-z0-9\\\]^_]+", "-")
    return F.regexp_replace(F.regexp_replace(text, "-+$", ""), "^-", "")


def split_ingest_id(c: Column) -> Column:
    """`source-id-parameter` to struct; the middle may hold dashes, `N/A` when absent."""
    parts = F.split(c, "-")
    n = F.size(parts)
    middle = F.when(n < 3, F.lit("N/A")).otherwise(
        F.array_join(F.slice(parts, F.lit(2), F.greatest(n - 2, F.lit(0))), "-")
    )
    return F.struct(
        F.get(parts, F.lit(0)).alias("source_name"),
        middle.alias("source_id"),
        F.get(parts, n - 1).alias("parameter"),
    )


def json_elements(c: Column) -> Column:
    """Elements of a JSON array, each as JSON text."""
    return F.transform(F.from_json(c, "array<variant>"), lambda x: F.to_json(x))


JSON_MEMBERS = "map<string,variant>"


def json_members(c: Column) -> Column:
    """Members of a JSON object by name, as variants; none for NULL or anything else."""
    return F.coalesce(F.from_json(c, JSON_MEMBERS), F.from_json(F.lit("{}"), JSON_MEMBERS))


def members_over(base: Column, top: Column) -> Column:
    """All members, those of `top` where both have one."""
    return F.map_concat(F.map_filter(base, lambda k, v: ~F.map_contains_key(top, k)), top)


def members_without_null(members: Column) -> Column:
    """The members but JSON nulls (nested objects stay as they are)."""
    return F.map_filter(members, lambda k, v: v.isNotNull() & ~F.is_variant_null(v))


def members_text(members: Column) -> Column:
    """JSON text of an object, members in the order of their names."""
    names = F.array_sort(F.map_keys(members))
    return F.to_json(F.map_from_entries(F.transform(names, lambda k: F.struct(k.alias("key"), members[k].alias("value")))))


def member_string(members: Column, name: str) -> Column:
    """A member as text: strings unquoted, NULL for JSON null."""
    return F.try_variant_get(members[name], "$", "string")


def array_to_json_elements(c: Column) -> Column:
    """Each array element as JSON text."""

    def as_json(x: Column) -> Column:
        listed = F.to_json(F.array(x))
        return F.substring(listed, F.lit(2), F.length(listed) - 2)

    return F.transform(c, as_json)


def objects_with_key(key: str, c: Column) -> Column:
    """JSON array of `{key: element}` objects."""
    return F.to_json(F.transform(c, lambda x: F.struct(x.alias(key))))


def int_array(c: Column) -> Column:
    """JSON integer array to array<int>."""
    return F.from_json(c, "array<int>")


def distinct_elements(c: Column, ignore_nulls: bool = False) -> Column:
    return F.array_distinct(F.array_compact(c) if ignore_nulls else c)


def json_number(c: Column, field: str) -> Column:
    """Field holding only digits, as a number; NULL for any other text."""
    text = F.get_json_object(c, f"$.{field}")
    return F.when(text.rlike(r"^\d+$"), text.try_cast("bigint"))


def imatch(c: Column, pattern: str) -> Column:
    """Case-insensitive regular expression match."""
    return c.rlike("(?i)" + pattern)
