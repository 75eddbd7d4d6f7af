"""VARIANT building blocks for whole JSON documents held in one string column."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def allow_duplicate_keys(spark: SparkSession) -> None:
    """Let a repeated JSON key keep its last value instead of failing the parse."""
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")


def parse_in_array(raw: Column) -> Column:
    """Parse ``[raw]``: the document is element 0 of the resulting variant."""
    return F.try_parse_json(F.concat(F.lit("["), raw, F.lit("]")))


def is_one_json_value(in_array: Column, raw: Column) -> Column:
    """True when ``raw`` is exactly one JSON value with nothing after it.

    ``try_parse_json`` stops at the end of the first value, so text such as
    ``[1] x`` or ``1], [2`` would slip through one parse. Text that closes the
    surrounding array early cannot also be well-formed inside an object, so the
    two wrappings together admit only a single value. The second one is a plain
    token scan (``json_object_keys``) and builds no variant.
    """
    alone = variant_at(in_array, "$[0]").isNotNull() & variant_at(in_array, "$[1]").isNull()
    in_object = F.json_object_keys(F.concat(F.lit('{"d":'), raw, F.lit("}")))
    return F.coalesce(alone & (F.size(in_object) == 1), F.lit(False))


# JSON as the source's own parser reads it: strings of any length, NaN and Infinity.
READ_AS_TEXT = {"maxStringLen": "2147483647", "allowSingleQuotes": "false"}
_SPACE = r"[ \t\r\n]*"


def _well_formed(before: str, raw: Column, after: str) -> Column:
    """A token scan that copies nothing."""
    wrapped = F.concat(F.lit(before), raw, F.lit(after))
    return F.from_json(wrapped, "_corrupt_record string", READ_AS_TEXT)["_corrupt_record"].isNull()


def with_page_parts(frame: DataFrame, raw: str = "raw_text", whole: bool = True) -> DataFrame:
    """Add ``_is_json``, ``_is_pair``, ``_metadata``, ``_records`` and ``_evidence``.

    A page is an array of two: metadata (a variant; NULL if the parts are read one by one and it
    is no object) and records (an array of variants, NULL if it is no array). ``_evidence`` is
    the whole document as compact text. Numbers JSON does not know, such as ``NaN``, and strings
    of any length are read like all others, so no record's outcome depends on its neighbours.

    A document larger than any variant (128 MiB), or all of them if ``whole`` is false, is cut
    into the texts of its two parts, and each record is read into a variant of its own, of which
    the kind and the members are those that the document as a whole gives. Only numbers of more
    than 17 digits come out as doubles there, and ``NaN`` as text. The text of a part that is a
    string comes without its quotes, so kinds are told by the brackets around the parts.
    """
    text = F.col(raw)
    in_array = F.from_json(F.concat(F.lit("["), text, F.lit("]")), "array<variant>", READ_AS_TEXT)
    one = F.col("_in_array") if whole else F.lit(None).cast("array<variant>")
    value = F.when(F.size(one) == 1, F.get(one, F.lit(0)))
    # A null may be all of the document; an array of nothing is what blank text gives.
    is_blank = text.rlike(rf"\A{_SPACE}\z")
    ends = _well_formed('{"d":', text, "}")
    parsed = frame.withColumns({"_in_array": in_array, "_one": ends & ~is_blank}).withColumns(
        {"_value": value, "_cut": F.col("_one") & F.coalesce(F.size(one) < 0, F.lit(True))}
    )
    # For the two scans that admit a single value only see is_one_json_value.
    cut = F.col("_cut") & _well_formed('{"d":[', text, "]}")
    parts = F.from_json(F.concat(F.lit("["), text, F.lit("]")), "array<array<string>>", READ_AS_TEXT)
    parsed = parsed.withColumn("_cut", F.coalesce(cut, F.lit(False)))
    parsed = parsed.withColumn("_parts", F.when(F.col("_cut"), F.get(parts, F.lit(0))))
    held = F.col("_one") & (F.size(one) == 1)
    value = F.col("_value")
    is_pair = (
        is_array_at(value, "$")
        & variant_at(value, "$[1]").isNotNull()
        & variant_at(value, "$[2]").isNull()
    )
    null = F.parse_json(F.lit("null"))
    records = F.from_json(F.get("_parts", F.lit(1)), "array<variant>", READ_AS_TEXT)
    records = F.transform(records, lambda item: F.coalesce(item, null))
    metadata = F.from_json(F.get("_parts", F.lit(0)), "variant", READ_AS_TEXT)
    starts_with_object = text.rlike(rf"\A{_SPACE}\[{_SPACE}\{{")
    ends_in_array = _without_end(text).endswith("]")
    two = F.col("_cut") & (F.size("_parts") == 2)
    return parsed.withColumns(
        {
            "_is_json": F.coalesce(held | F.col("_cut"), F.lit(False)),
            "_is_pair": F.coalesce(F.when(F.col("_cut"), two).otherwise(held & is_pair), F.lit(False)),
            "_metadata": F.when(~F.col("_cut"), variant_at(value, "$[0]")).when(two & starts_with_object, metadata),
            "_records": F.when(~F.col("_cut"), array_at(value, "$[1]")).when(two & ends_in_array, records),
            "_evidence": F.when(held, F.to_json(F.coalesce(value, null))).otherwise(text),
        }
    ).drop("_in_array", "_one", "_value", "_cut", "_parts")


def _without_end(raw: Column) -> Column:
    """The text before the last bracket or brace, without white space at its end."""
    space = F.lit(" \t\r\n")
    trimmed = F.rtrim(raw, space)
    return F.rtrim(F.left(trimmed, F.char_length(trimmed) - 1), space)


def whole_number(value: Column) -> Column:
    """A JSON number, boolean or text of a whole number as bigint, NULL for anything else.

    Numbers are cut to whole ones, booleans count as 0 and 1, and text may have
    white space around it and single underscores between digits.
    """
    kind, text = F.schema_of_variant(value), whole_text(value)
    amount = F.try_variant_get(value, "$", "decimal(38,0)")
    cut = F.try_variant_get(value, "$", "double")
    number = F.coalesce(
        F.when(kind == "BIGINT", F.try_variant_get(value, "$", "bigint")),
        F.when(cut >= 0, F.floor(cut)).otherwise(F.ceil(cut)).try_cast("bigint"),
        amount.try_cast("bigint"),
    )
    return (
        F.when(is_json_number(value), number)
        .when(kind == "BOOLEAN", F.try_variant_get(value, "$", "boolean").cast("bigint"))
        .when(text.isNotNull(), F.replace(text, F.lit("_"), F.lit("")).try_cast("bigint"))
    )


def whole_text(value: Column) -> Column:
    """The trimmed text of a JSON string that spells a whole number, else NULL."""
    text = F.trim(F.regexp_replace(F.try_variant_get(value, "$", "string"), r"\s", " "))
    spells = (F.schema_of_variant(value) == "STRING") & text.rlike(r"\A[+-]?[0-9](_?[0-9])*\z")
    return F.when(spells, text)


def variant_at(value: Column, path: str) -> Column:
    """The variant at ``path``; JSON null stays a non-NULL variant."""
    return F.try_variant_get(value, path, "variant")


def array_at(value: Column, path: str) -> Column:
    """Elements of the JSON array at ``path``; NULL for any other kind."""
    return F.try_variant_get(value, path, "array<variant>")


def is_array_at(value: Column, path: str) -> Column:
    """True for a JSON array at ``path``, without unpacking a non-empty one."""
    return variant_at(value, f"{path}[0]").isNotNull() | array_at(value, path).isNotNull()


def object_at(value: Column, path: str = "$") -> Column:
    """Members of the JSON object at ``path``; NULL for any other kind."""
    return F.try_variant_get(value, path, "map<string,variant>")


def text_at(value: Column, path: str) -> Column:
    """Scalar as text, object or array as compact sorted JSON, JSON null as NULL."""
    return F.try_variant_get(value, path, "string")


def is_json_string(value: Column) -> Column:
    """True for a JSON string, false for every other kind and for SQL NULL."""
    return F.coalesce(F.schema_of_variant(value) == "STRING", F.lit(False))


def is_json_number(value: Column) -> Column:
    """True for a JSON number (booleans are not numbers)."""
    kind = F.schema_of_variant(value)
    numeric = kind.isin("BIGINT", "DOUBLE", "FLOAT") | kind.startswith("DECIMAL")
    return F.coalesce(numeric, F.lit(False))


def unexpected_keys(members: Column, expected: Iterable[str]) -> Column:
    """Keys of a map outside ``expected``."""
    return F.array_except(F.map_keys(members), F.array(*[F.lit(name) for name in expected]))


def with_prefix(names: Column, prefix: str) -> Column:
    """``prefix`` in front of every name, for names of any content.

    Works on the JSON text of the array, where an unescaped quote after ``[`` or
    ``,`` can only open an element. Unlike ``transform`` with a lambda this keeps
    the projection inside whole-stage code generation, and callers reach it only
    for rows that do have unexpected names.
    """
    text = F.to_json(names)
    opened = F.replace(text, F.lit('["'), F.lit(f'["{prefix}'))
    return F.from_json(F.replace(opened, F.lit('","'), F.lit(f'","{prefix}')), "array<string>")
