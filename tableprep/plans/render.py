"""Template rendering (I5): fill ``{name}`` placeholders from columns.

Mirrors ``str.format``: the template is cut into text and placeholders once,
``{{`` and ``}}`` are braces, and filled values are never filled again.  When
a placeholder names a column the table does not have, the template is
returned unformatted.  One projection fills the whole table.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import col


def render_expr(template: str, columns) -> Column:
    parts = [(text, name) for text, name, _, _ in string.Formatter().parse(template)]
    if any(name is not None and name not in columns for _, name in parts):
        return F.lit(template)
    out = [F.lit("")]
    for text, name in parts:
        out.append(F.lit(text))
        if name is not None:
            out.append(F.coalesce(col(name).cast("string"), F.lit("None")))
    return F.concat(*out)


def render(df: DataFrame, templates: dict, keep=()) -> DataFrame:
    """One row per (input row, template): ``(*keep, template_id, prompt)``."""
    arr = F.array(*[F.struct(F.lit(t).alias("template_id"), render_expr(s, df.columns).alias("prompt"))
                    for t, s in templates.items()])
    return df.select(*[col(k) for k in keep], F.inline(arr))
