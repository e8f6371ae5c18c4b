"""HTML character references in texts, as column expressions."""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# What a reference looks like. A name is read as far as it may go; how much of it counts is found by the table.
_NUMBER = "#[0-9]+;?|#[xX][0-9a-fA-F]+;?"
_REFERENCE = rf"&({_NUMBER}|[^\t\n\f <&#;]{{1,32}};?)"


def _names() -> Column:
    """First two letters -> name -> text, as one constant of the plan."""
    table: dict[str, dict[str, str]] = {}
    for name, text in html5.items():
        table.setdefault(name[:2], {})[name] = text
    return F.from_json(F.lit(json.dumps(table)), "map<string, map<string, string>>")


def _open_names() -> str:
    """Pattern of the names that count without a semicolon, longest first."""
    return "|".join(sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n)))


def _windows_letters() -> dict[int, str]:
    """Numbers 128 to 159 mean letters of code page 1252, where it has one."""
    out = {}
    for n in range(128, 160):
        try:
            out[n] = bytes([n]).decode("cp1252")
        except UnicodeDecodeError:
            out[n] = chr(n)
    return out


def _letter(code: Column) -> Column:
    """The character with a code point."""
    return F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")


def _code_point(number: Column) -> Column:
    """The code point that ``#123;`` or ``#x7b;`` names; beyond the largest one where the number is too long."""
    hexadecimal = F.lower(F.substring(number, 2, 1)) == "x"
    digits = F.regexp_replace(F.regexp_replace(number, "^#[xX]?0*", ""), ";$", "")
    too_long = F.length(digits) > F.when(hexadecimal, 6).otherwise(7)
    code = F.when(hexadecimal, F.conv(digits, 16, 10)).otherwise(digits).try_cast("long")
    return F.when(too_long, F.lit(0x110000).cast("long")).otherwise(F.coalesce(code, F.lit(0).cast("long")))


def _number_text(code: Column) -> Column:
    """The text that a code point stands for."""
    windows = F.element_at(F.from_json(F.lit(json.dumps(_windows_letters())), "map<string, string>"), code.cast("string"))
    control = code.between(1, 8) | (code == 11) | code.between(14, 31) | (code == 127)
    no_character = code.between(0xFDD0, 0xFDEF) | (code.bitwiseAND(F.lit(0xFFFE).cast("long")) == 0xFFFE)
    return (
        F.when((code == 0) | code.between(0xD800, 0xDFFF) | (code > 0x10FFFF), F.lit("\ufffd"))
        .when(code.between(128, 159), windows)
        .when(control | no_character, F.lit(""))
        .otherwise(_letter(code))
    )


def unescape(text: Column) -> Column:
    """Turn the character references of a text into the characters they name, once, by HTML's rules.

    The text is cut at its references, each is looked up, and all is joined
    again: the whole name's text, else that of its longest known beginning, else
    the reference as it is. A text without ``&`` is passed as it is. Each step
    binds its value for the next, so that none is worked out twice.
    """
    names, start_of_name = _names(), f"^(?:{_open_names()})"

    def known(name: Column) -> Column:
        return F.element_at(F.element_at(names, F.substring(name, 1, 2)), name)

    def looked_up(name: Column) -> Column:
        is_number = F.substring(name, 1, 1) == "#"
        return F.struct(
            name.alias("name"),
            F.when(is_number, _code_point(name)).alias("code"),
            F.when(~is_number, known(name)).alias("known"),
        )

    def with_start(entry: Column) -> Column:
        unknown = entry["code"].isNull() & entry["known"].isNull()
        start = F.when(unknown, F.nullif(F.regexp_extract(entry["name"], start_of_name, 0), F.lit("")))
        return F.struct(entry["name"].alias("name"), entry["code"].alias("code"), entry["known"].alias("known"), start.alias("start"))

    def resolved(entry: Column) -> Column:
        start = entry["start"]
        rest = F.substring(entry["name"], F.length(start) + 1, F.lit(40))
        return (
            F.when(entry["code"].isNotNull(), _number_text(entry["code"]))
            .when(entry["known"].isNotNull(), entry["known"])
            .when(start.isNotNull(), F.concat(known(start), rest))
            .otherwise(F.concat(F.lit("&"), entry["name"]))
        )

    entries = F.transform(F.regexp_extract_all(text, F.lit(_REFERENCE), F.lit(1)), looked_up)
    references = F.transform(F.transform(entries, with_start), resolved)
    between = F.split(text, _REFERENCE, -1)
    pieces = F.zip_with(between, references, lambda a, b: F.concat(a, F.coalesce(b, F.lit(""))))
    return F.when(F.contains(text, F.lit("&")), F.array_join(pieces, "")).otherwise(text)
