"""Lines, maps and rendered text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from rowsentry.functions.names import as_col


def csv_line(*cols: str | Column) -> Column:
    """Plain values joined by commas, without quoting; a null becomes an empty field."""
    parts = [F.coalesce(as_col(c).cast("string"), F.lit("")) for c in cols]
    return F.concat_ws(",", *parts)


def quoted(text: Column) -> Column:
    """A CSV field: in quotes, with quotes doubled, if it holds a comma, a quote or a line break."""
    return F.when(text.rlike('[,"\r\n]'), F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(text)


def record_to_map(line: str | Column) -> Column:
    """``"a,b"`` to ``{"00": "a", "01": "b"}``; keys have two digits or more."""
    fields = F.split(as_col(line), ",", -1)

    def entry(value: Column, i: Column) -> Column:
        digits = i.cast("string")
        padded = F.when(F.length(digits) < 2, F.lpad(digits, 2, "0")).otherwise(digits)
        return F.struct(padded.alias("key"), value.alias("value"))

    return F.map_from_entries(F.transform(fields, entry))


#: Stand for line breaks inside quotes while a body is cut into lines (private-use characters).
_KEPT = {"\r": "\ue00d", "\n": "\ue00a"}


def _replaced(text: Column, pairs: dict[str, str]) -> Column:
    for old, new in pairs.items():
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def body_lines(body: str | Column) -> Column:
    """The lines of a request body that are not blank; line breaks inside quotes do not end a line."""
    text = as_col(body)
    held = F.array_join(F.transform(F.split(text, '"', -1), lambda x, i: F.when(i % 2 == 1, _replaced(x, _KEPT)).otherwise(x)), '"')
    whole = F.when(F.contains(text, F.lit('"')), held).otherwise(text)
    lines = F.filter(F.split(whole, "\r?\n"), lambda line: F.trim(line) != "")
    back = {v: k for k, v in _KEPT.items()}
    return F.when(F.contains(text, F.lit('"')), F.transform(lines, lambda line: _replaced(line, back))).otherwise(lines)


def field_count(line: str | Column) -> Column:
    """Number of CSV fields, commas inside quotes not counted."""

    def commas(text: Column) -> Column:
        return F.length(text) - F.length(F.replace(text, F.lit(","), F.lit("")))

    text = as_col(line)
    return 1 + F.when(F.contains(text, F.lit('"')), commas(F.regexp_replace(text, '"[^"]*"', ""))).otherwise(commas(text))


def drop_trailing_label(fields: str | Column, expected: int) -> Column:
    """Cut an array that has exactly one value too many; leave any other as it is."""
    arr = as_col(fields)
    return F.when(F.size(arr) == expected + 1, F.slice(arr, 1, expected)).otherwise(arr)
