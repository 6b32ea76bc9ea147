"""Text helpers: canonical row hash, log shortening, titles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Control characters whose JSON escape holds a hex letter.
_HEX_LETTER_ESCAPES = ("0B", "0E", "0F", "1A", "1B", "1C", "1D", "1E", "1F")


def canonical_json(columns: Sequence[str]) -> Column:
    """A row of text cells as JSON: keys sorted, ``", "`` and ``": "`` between parts.

    Few rows hold a character that JSON escapes, so the text is put together directly
    and only those rows go through the JSON writer.
    """
    names = sorted(columns)
    cells = [F.col(f"`{name}`") for name in names]
    parts: list[Column] = []
    for i, (name, cell) in enumerate(zip(names, cells)):
        parts += [F.lit(f'{", " if i else "{"}"{name}": "'), cell, F.lit('"')]
    direct = F.concat(*parts, F.lit("}"))
    return F.when(F.concat(*cells).rlike(r'["\\\x00-\x1f]'), _escaped_json(names)).otherwise(direct)


def _escaped_json(names: Sequence[str]) -> Column:
    """The same text from the JSON writer.

    Quotes inside a value are always escaped, so a quote followed by a key and
    ``":"`` is a field boundary and nothing else; the spaces go in with a regex.
    Hex letters of control escapes are lowered where such an escape occurs.
    """
    row = F.to_json(
        F.struct(*[F.col(f"`{name}`") for name in names]), {"ignoreNullFields": "false"}
    )
    spaced = F.regexp_replace(row, r'","([a-z_][a-z0-9_]*)":"', r'", "$1": "')
    spaced = F.regexp_replace(spaced, r'^\{"([a-z_][a-z0-9_]*)":"', r'{"$1": "')
    lowered = spaced
    for code in _HEX_LETTER_ESCAPES:
        lowered = F.regexp_replace(
            lowered, rf"(?<!\\)((?:\\\\)*)\\u00{code}", rf"$1\\u00{code.lower()}"
        )
    return F.when(spaced.rlike(r"\\u00(0[BEF]|1[A-F])"), lowered).otherwise(spaced)


def row_hash(columns: Sequence[str]) -> Column:
    """sha256 of the canonical JSON of a row; every cell must be non-null text."""
    return F.sha2(canonical_json(columns), 256)


def summarize_text(column: Column, limit: int = 160) -> Column:
    """One-line summary: whitespace runs become one space, long text ends in ``...``."""
    line = F.regexp_replace(column, r"(?U)[\s\x1c-\x1f]+", " ")
    line = F.trim(line)
    return (
        F.when(line == "", "<empty>")
        .when(F.char_length(line) <= limit, line)
        .otherwise(F.concat(F.substring(line, 1, limit - 3), F.lit("...")))
    )


def title_words(column: Column) -> Column:
    """``error_rate`` to ``Error Rate``."""
    return F.initcap(F.replace(column, F.lit("_"), F.lit(" ")))


def two_decimals(value: Column) -> Column:
    """A number with two decimals, rounded half-even on its exact binary value.

    ``bround`` and ``format_string`` round the shortest decimal form of a double, which
    turns values just below a tie into ties.
    """
    return F.call_function("format_number", value, F.lit("0.00"))
