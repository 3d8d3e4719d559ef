"""Text helpers as Column expressions (display formatting of the reference).

* ``money``: ``$`` + whole dollars with thousands separators, rounded half to
  even on the binary value (``format_number`` does exactly that);
* ``pct1``: percentage with one decimal and no grouping;
* ``r4``: round half to even to 4 decimals (Python's ``round``);
* ``display_name``: 'LAST, FIRST' -> 'First Last', capitalising only words
  that are all upper case;
* ``slug``: lower case, runs of anything but [a-z0-9] -> '-', trimmed.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def money(x) -> Column:
    return F.concat(F.lit("$"), F.format_number(_c(x).cast("double"), 0))


def pct1(x) -> Column:
    v = F.lit(100.0) * _c(x).cast("double")
    return F.concat(F.regexp_replace(F.format_number(v, 1), ",", ""), F.lit("%"))


def r4(x) -> Column:
    return F.bround(_c(x).cast("double"), 4)


def display_name(name) -> Column:
    n = _c(name)
    parts = F.split(n, ",", 2)
    swapped = F.trim(F.concat_ws(" ", F.trim(F.element_at(parts, 2)),
                                 F.trim(F.element_at(parts, 1))))
    s = F.when(F.instr(n, ",") > 0, swapped).otherwise(n)
    words = F.split(F.trim(s), r"\s+")
    fixed = F.transform(words, lambda w: F.when(
        (w == F.upper(w)) & (w != F.lower(w)),
        F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substring(w, 2, 1 << 20)))
    ).otherwise(w))
    out = F.array_join(F.filter(fixed, lambda w: w != ""), " ")
    return F.when(n.isNull() | (n == ""), n).otherwise(out)


def slug(text) -> Column:
    s = F.regexp_replace(F.lower(_c(text)), "[^a-z0-9]+", "-")
    return F.regexp_replace(s, "^-+|-+$", "")


def zfill2(x) -> Column:
    v = F.coalesce(_c(x), F.lit("None"))
    return F.when(F.length(v) < 2, F.lpad(v, 2, "0")).otherwise(v)


def lookup(mapping: dict, key) -> Column:
    """Value of a small fixed dict for ``key`` (NULL when absent)."""
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.try_element_at(m, _c(key)) if mapping else F.lit(None)
