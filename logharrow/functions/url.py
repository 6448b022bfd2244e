"""URL functions as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from logharrow.config import Url

#: An escape that isn't one: its percent sign is itself escaped before decoding.
LONE_PERCENT = "%(?![0-9A-Fa-f]{2})"


def _decoded(value: Column) -> Column:
    return F.try_url_decode(F.regexp_replace(value, LONE_PERCENT, "%25"))


def decode(value: Column) -> Column:
    """Percent-decoding that leaves plus signs and malformed escapes as they are."""
    return F.coalesce(_decoded(F.regexp_replace(value, r"\+", "%2B")), value)


def decode_form(value: Column) -> Column:
    """Percent-decoding of form data: a plus sign is a blank."""
    return F.coalesce(_decoded(value), value)


def endpoint_group(stem: Column, config: Url = Url()) -> Column:
    """Canonical endpoint: decoded, lower case, no slashes at the end, templates for numbers (and ids if asked)."""
    path = decode(stem)
    path = F.lower(path) if config.lowercase else path
    if config.strip_trailing_slash:
        path = F.when(F.length(path) > 1, F.regexp_replace(path, "/+$", "")).otherwise(path)
    if config.numeric_template:
        path = F.regexp_replace(path, r"/\d+(?=/|$)", "/{num}")
    if config.aggressive_template:
        path = F.regexp_replace(path, r"(?i)/[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}(?=/|$)", "/{guid}")
        path = F.regexp_replace(path, r"(?i)/[0-9a-f]{16,}(?=/|$)", "/{hex}")
    return path


def extension(stem: Column) -> Column:
    """Lower-case text after the last dot of the path, null if there is none or a slash follows the dot."""
    path = F.element_at(F.split(F.lower(decode(stem)), r"\?"), 1)
    return F.when(path.rlike(r"\.[^./]*$"), F.regexp_extract(path, r"\.([^./]*)$", 1))


def _stripped(path: Column) -> Column:
    return F.regexp_replace(path, "^/+|/+$", "")


def path_depth(stem: Column) -> Column:
    path = _stripped(decode(stem))
    return F.when(path == "", 0).otherwise(F.size(F.split(path, "/")))


def path_tokens(stem: Column) -> Column:
    path = _stripped(F.lower(decode(stem)))
    return F.when(path == "", F.array().cast("array<string>")).otherwise(F.split(path, "/"))


def query_stats(query: Column) -> Column:
    """Struct: key_set, key_count, value_count, mean_value_len, max_value_len, special_char_ratio, decoded_len."""
    blank = query.isNull() | query.isin("", "-")
    text = decode(F.when(~blank, query))
    fields = F.filter(F.split(text, "&"), lambda p: p != "")
    keys = F.transform(fields, lambda p: decode_form(F.substring_index(p, "=", 1)))
    sizes = F.transform(fields, lambda p: F.when(F.instr(p, "=") > 0, F.length(decode_form(F.substr(p, F.instr(p, "=") + 1)))).otherwise(0))
    key_set = F.array_sort(F.array_distinct(keys))
    special = F.length(F.regexp_replace(text, r"[\p{L}\p{N}=&_.\-]", ""))
    mean = F.aggregate(sizes, F.lit(0), lambda a, x: a + x) / F.greatest(F.size(sizes), F.lit(1))
    return F.struct(
        F.coalesce(key_set, F.array().cast("array<string>")).alias("key_set"),
        F.coalesce(F.size(key_set), F.lit(0)).alias("key_count"),
        F.when(blank, 0).otherwise(F.size(fields)).alias("value_count"),
        F.coalesce(mean, F.lit(0.0)).alias("mean_value_len"),
        F.coalesce(F.array_max(sizes), F.lit(0)).alias("max_value_len"),
        F.coalesce(F.bround(special / F.greatest(F.length(text), F.lit(1)), 4), F.lit(0.0)).alias("special_char_ratio"),
        F.coalesce(F.length(text), F.lit(0)).alias("decoded_len"),
    )
