"""Column expressions with the reference's null semantics.

Everything here returns a plain ``Column`` built from Spark's own functions,
so it stays inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def if_else(cond: Column, yes, no) -> Column:
    """Strict two-way conditional (X1): a NULL condition gives NULL.

    Unlike ``when(c, a).otherwise(b)``, which sends NULL conditions to ``b``.
    """
    yes = yes if isinstance(yes, Column) else F.lit(yes)
    no = no if isinstance(no, Column) else F.lit(no)
    return F.when(cond, yes).when(~cond, no)


def case_when(*branches: tuple[Column, object], default=None) -> Column:
    """Multi-branch case (X2): a NULL condition falls through to the next."""
    if not branches:
        raise ValueError("case_when needs at least one branch")
    out = None
    for cond, val in branches:
        val = val if isinstance(val, Column) else F.lit(val)
        out = F.when(cond, val) if out is None else out.when(cond, val)
    if default is not None:
        out = out.otherwise(default if isinstance(default, Column) else F.lit(default))
    return out


def recode(c: Column | str, mapping: Mapping[str, str]) -> Column:
    """Value recode with the input kept as default."""
    c = F.col(c) if isinstance(c, str) else c
    out = None
    for k, v in mapping.items():
        out = F.when(c == F.lit(k), F.lit(v)) if out is None else out.when(c == F.lit(k), F.lit(v))
    return c if out is None else out.otherwise(c)


def log_flagged(value: Column, flag: Column) -> Column:
    """Natural log where ``flag == 1`` (X4); a NULL flag gives NULL.

    Spark's ``ln`` returns NULL for values <= 0 where R gives -Inf/NaN (G6).
    """
    return if_else(flag == 1, F.ln(value), value)


def min_max_score(value: Column, lo: Column, hi: Column, inverted: Column) -> Column:
    """Min-max scaling to 0..100.

    Inverted indicators score ``100*(hi-v)/(hi-lo)``, normal ones
    ``100*(v-lo)/(hi-lo)``. A degenerate (``lo == hi``) or missing reference
    gives 0, not NULL (G14), because NULL conditions fall through.
    """
    span = hi - lo
    return case_when(
        ((inverted == 1) & (lo != hi), F.lit(100.0) * ((hi - value) / span)),
        ((inverted == 0) & (lo != hi), F.lit(100.0) * ((value - lo) / span)),
        default=F.lit(0.0),
    )


# Whitespace and line-end classes written out so that the JVM regex engine
# and other engines (the SQL oracle) agree on them.
WS = r" \t\n\x0B\f\r"
# what str_squish collapses beside these: the separators (no-break space, line separator, ideographic space, ...)
SEPARATORS = r"\x{85}\p{Z}"
NOT_EOL = r"[^\n\r\x{85}\x{2028}\x{2029}]"


def squish(c: Column) -> Column:
    """Trim and collapse internal whitespace runs, Unicode's separators
    included, to one space (X14)."""
    return F.regexp_replace(F.regexp_replace(c, f"[{WS}{SEPARATORS}]+", " "), "^ +| +$", "")


def cut_after_dash(c: Column) -> Column:
    """Drop everything from the first ``" - "`` on."""
    return F.regexp_replace(c, " - .*", "")


def paste(*parts: Column, sep: str = " ", na: str = "NA") -> Column:
    """R's ``paste``: NULL parts print as ``"NA"``."""
    return F.concat_ws(sep, *[F.coalesce(p.cast("string"), F.lit(na)) for p in parts])


def ensure_period(c: Column) -> Column:
    """Append a full stop unless empty, NULL or already ending with one."""
    return F.when(c.isNotNull() & (c != "") & ~c.endswith("."), F.concat(c, F.lit("."))).otherwise(c)
