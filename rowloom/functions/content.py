"""One text per row: a column, a template, or the row's keys and values.

Templates are read once on the driver and become a ``concat`` of literals and
columns, so a scan reads only the columns the template names.
"""

from __future__ import annotations

import re
from string import Formatter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowloom.functions.text import safe_str

# The layout used when a table has both of these columns.
ARTICLE_COLUMN = "article"
COMMENT_COLUMN = "comment"
ARTICLE_HEAD = "Article:\n"
COMMENT_HEAD = "\n\nComment:\n"

_STRING_SPEC = re.compile(
    r"(?:(?P<fill>.)?(?P<align>[<>^]))?(?P<zero>0)?(?P<width>\d+)?(?:\.(?P<precision>\d+))?s?",
    re.DOTALL,
)


def need_columns(df: DataFrame, names: list[str], what: str) -> None:
    """Refuse at plan time when the table lacks one of the columns."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"{what}: no column {missing[0]!r}; the table has {df.columns}")


def _with_spec(text: Column, spec: str) -> Column:
    """Apply a string format spec: cut to a precision, then pad to a width."""
    if not spec:
        return text
    format("", spec)  # Python's own check of the spec
    parts = _STRING_SPEC.fullmatch(spec)
    if parts is None:
        raise ValueError(f"unsupported format spec {spec!r}")
    if parts["precision"] is not None:
        text = F.substring(text, 1, int(parts["precision"]))
    width = int(parts["width"] or 0)
    if not width:
        return text
    fill = parts["fill"] or ("0" if parts["zero"] else " ")
    gap = F.greatest(F.lit(width) - F.length(text), F.lit(0))
    before = {">": gap, "^": F.floor(gap / 2).cast("int")}.get(parts["align"], F.lit(0))
    return F.concat(
        F.repeat(F.lit(fill), before), text, F.repeat(F.lit(fill), gap - before)
    )


def template_text(df: DataFrame, template: str) -> Column:
    """Render ``template``, whose ``{column}`` fields are null-safe text; ``{{``/``}}`` are braces."""
    pieces: list[Column] = []
    for literal, field, spec, conversion in Formatter().parse(template):
        if literal:
            pieces.append(F.lit(literal))
        if field is None:
            continue
        if not field or field.isdigit():
            raise ValueError(f"template field {{{field}}} has no column name")
        if conversion:
            raise ValueError(f"template field {field!r}: conversions are not supported")
        if "{" in spec:
            raise ValueError(f"template field {field!r}: nested format specs are not supported")
        if re.search(r"[.\[]", field):
            raise ValueError(f"template field {field!r}: only plain column names are supported")
        need_columns(df, [field], "template")
        pieces.append(_with_spec(safe_str(df, field), spec))
    return F.concat(*pieces) if pieces else F.lit("")


def article_comment_text(df: DataFrame, article: str = ARTICLE_COLUMN, comment: str = COMMENT_COLUMN) -> Column:
    need_columns(df, [article, comment], "article and comment")
    return F.concat(
        F.lit(ARTICLE_HEAD), safe_str(df, article), F.lit(COMMENT_HEAD), safe_str(df, comment)
    )


def key_value_text(df: DataFrame) -> Column:
    """``name: value`` for every column in table order, one per line."""
    lines = [F.concat(F.lit(f"{name}: "), safe_str(df, name)) for name in df.columns]
    return F.concat_ws("\n", *lines)


def user_text(df: DataFrame, text_col: str | None = None, template: str | None = None) -> Column:
    """The row's text: a named column, else a template, else the layout its columns call for."""
    if text_col is not None:
        need_columns(df, [text_col], "text column")
        return safe_str(df, text_col)
    if template:
        return template_text(df, template)
    if ARTICLE_COLUMN in df.columns and COMMENT_COLUMN in df.columns:
        return article_comment_text(df)
    return key_value_text(df)
