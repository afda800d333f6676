"""Scalar column builders (P*, F*, T3-T6, N2/N4/N6/N7, NULL-strict GREATEST/LEAST).

All return ``Column`` expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

__all__ = [
    "c_", "typed", "clean_text", "classify", "fill", "ratio", "parse_date_any", "from_epoch",
    "local_date", "scale_unit", "signed", "duration", "band", "make_key", "parse_hhmm",
    "exclude", "eq_ns", "in_array", "period", "week_start", "fiscal_year_start",
    "snapshot_date", "greatest_strict", "least_strict", "json_any", "json_concat_text",
    "json_array_len", "extract_all", "round_money", "rnd",
]


def c_(x) -> Column:
    """Accept a column name or a Column."""
    return F.col(x) if isinstance(x, str) else x


# --- P1/P2 typed projection -------------------------------------------------
def typed(df: DataFrame, spec: dict, safe: bool = False) -> DataFrame:
    """``spec = {out_name: (source_col, spark_type)}``; ``safe`` -> try_cast."""
    cols = []
    for out, (src, typ) in spec.items():
        c = c_(src)
        cols.append((c.try_cast(typ) if safe else c.cast(typ)).alias(out))
    return df.select(*cols)


# --- P3 blank normalise ------------------------------------------------------
def clean_text(c, case: str | None = None) -> Column:
    """Trim, empty string -> NULL, optional upper / lower case."""
    v = F.nullif(F.trim(c_(c)), F.lit(""))
    if case == "upper":
        v = F.upper(v)
    elif case == "lower":
        v = F.lower(v)
    return v


# --- P5 classify -------------------------------------------------------------
def classify(rules: list, default=None) -> Column:
    """P5: ordered CASE: ``rules = [(condition Column, value), ...]``; first match wins."""
    expr = None
    for cond, val in rules:
        v = val if isinstance(val, Column) else F.lit(val)
        expr = F.when(cond, v) if expr is None else expr.when(cond, v)
    d = default if isinstance(default, Column) else F.lit(default)
    return d if expr is None else expr.otherwise(d)


# --- P6 default fill ---------------------------------------------------------
def fill(df: DataFrame, values: dict) -> DataFrame:
    """NULL -> default value / label per column."""
    return df.withColumns({k: F.coalesce(F.col(k), F.lit(v)) for k, v in values.items()})


# --- P7 safe ratio -----------------------------------------------------------
def ratio(num, den, scale: float = 1, digits: int | None = None) -> Column:
    """NULL when the denominator is 0 or NULL, never 0 and never an error."""
    n = c_(num).cast("double")
    if scale != 1:
        n = n * F.lit(float(scale))
    r = F.try_divide(n, F.nullif(c_(den).cast("double"), F.lit(0.0)))
    return rnd(r, digits) if digits is not None else r


def rnd(c, digits: int = 2) -> Column:
    """Half-up rounding of a double on its decimal value (via decimal(38,9)).

    Rounding the binary double directly makes x.xx5 values fall either way
    depending on the engine; going through a decimal makes the result
    engine-independent and turns -0.0 into 0.0.
    """
    return F.round(c_(c).cast("decimal(38,9)"), digits).cast("double")


def round_money(c, digits: int = 2) -> Column:
    return rnd(c, digits)


# --- P8 multi-format date parse ---------------------------------------------
def parse_date_any(c, fmts: list[str]) -> Column:
    """The first format that parses wins, else NULL."""
    return F.coalesce(*[F.try_to_timestamp(c_(c), F.lit(f)).cast("date") for f in fmts])


# --- P9 epoch conversion -----------------------------------------------------
def from_epoch(c, unit: str = "s", finer: int = 1) -> Column:
    """S / ms / us ticks -> timestamp; ``finer`` integer-divides a finer tick count first."""
    v = c_(c).cast("long")
    if finer != 1:
        v = F.floor(v / F.lit(finer)).cast("long")
    fn = {"s": F.timestamp_seconds, "ms": F.timestamp_millis, "us": F.timestamp_micros}[unit]
    return fn(v)


# --- P10 localise then date --------------------------------------------------
def local_date(ts, zone=None, offset_seconds=None) -> Column:
    """P10: instant -> local date; ``zone`` is a literal or a per-row column; or a fixed offset."""
    t = c_(ts).cast("timestamp")
    if offset_seconds is not None:
        return F.to_date(t + F.make_dt_interval(secs=c_(offset_seconds)))
    if zone is None:
        return F.to_date(t)
    z = zone if isinstance(zone, Column) else F.lit(zone)
    return F.to_date(F.from_utc_timestamp(t, z))


# --- P11 unit scaling --------------------------------------------------------
def scale_unit(c, divisor: float) -> Column:
    """Minor units / micros / ms -> major unit."""
    return c_(c).cast("double") / F.lit(float(divisor))


# --- P12 signed amount -------------------------------------------------------
def signed(c, negative_when: Column) -> Column:
    """Apply the sign of the document type."""
    return F.when(negative_when, -c_(c)).otherwise(c_(c))


# --- P13 duration ------------------------------------------------------------
def duration(start, end, unit: str = "SECOND", as_of=None) -> Column:
    """Whole units between start and end (truncating); open ends run to ``as_of``."""
    e = c_(end)
    if as_of is not None:
        e = F.coalesce(e, as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp"))
    return F.timestamp_diff(unit, c_(start), e)


# --- P14 band ----------------------------------------------------------------
def band(c, edges: list, labels: list, null_label: str | None = None):
    """Ordered bands: value <= edges[i] -> labels[i]; beyond the last edge -> labels[-1].

    Returns ``(label, order)`` Columns; NULL input gets ``null_label`` and order len(labels)+1.
    """
    v = c_(c)
    lab = F.when(v.isNull(), F.lit(null_label))
    order = F.when(v.isNull(), F.lit(len(labels) + 1))
    for i, e in enumerate(edges):
        lab = lab.when(v <= F.lit(e), F.lit(labels[i]))
        order = order.when(v <= F.lit(e), F.lit(i + 1))
    return lab.otherwise(F.lit(labels[-1])), order.otherwise(F.lit(len(labels)))


# --- P15 surrogate key -------------------------------------------------------
def make_key(*cols, sep: str = ":") -> Column:
    """Surrogate key from the key parts."""
    return F.concat_ws(sep, *[c_(c).cast("string") for c in cols])


# --- P16 parse clock text ----------------------------------------------------
def parse_hhmm(c) -> Column:
    """Digits, a colon and one or two digits -> minutes (``1:5``, ``1000:00`` and ``12:75``
    count as written); anything else -> NULL."""
    v, clock = c_(c), r"^\s*(\d+):(\d{1,2})\s*$"
    return F.regexp_extract(v, clock, 1).try_cast("int") * 60 + F.regexp_extract(v, clock, 2).try_cast("int")


# --- F2 / F3 / F6 predicates -------------------------------------------------
def exclude(c, values: list) -> Column:
    """``NOT IN`` that keeps NULL rows (a plain NOT IN filter loses them)."""
    return c_(c).isNull() | ~c_(c).isin(values)


def eq_ns(a, b) -> Column:
    """IS NOT DISTINCT FROM."""
    return c_(a).eqNullSafe(c_(b))


def in_array(x, arr) -> Column:
    """membership in an array column (NULL array -> false)."""
    return F.coalesce(F.array_contains(c_(arr), c_(x)), F.lit(False))


# --- T3-T6 calendar helpers --------------------------------------------------
def period(c, unit: str = "month") -> Column:
    """Truncate to day / week (ISO, Monday) / month / quarter / year; returns a DATE."""
    u = unit.lower()
    if u == "day":
        return F.to_date(c_(c))
    if u in ("week", "isoweek"):
        return F.to_date(F.date_trunc("week", c_(c)))
    return F.to_date(F.date_trunc(u, c_(c)))


def week_start(c, dow: int = 2) -> Column:
    """T4: week start on a configurable weekday (Spark dayofweek numbering, 1=Sunday)."""
    d = F.to_date(c_(c))
    dw = dow if isinstance(dow, Column) else F.lit(dow)
    return F.date_sub(d, F.pmod(F.dayofweek(d) - dw, F.lit(7)).cast("int"))


def fiscal_year_start(c, start_month: int = 1) -> Column:
    """T5: first day of the fiscal year containing the date."""
    d = F.to_date(c_(c))
    m = start_month if isinstance(start_month, Column) else F.lit(start_month)
    y = F.year(d) - F.when(F.month(d) < m, 1).otherwise(0)
    return F.make_date(y, m, F.lit(1))


def snapshot_date(p, as_of) -> Column:
    """Month end capped at ``as_of``."""
    a = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("date")
    return least_strict(F.last_day(c_(p)), a)


def greatest_strict(*cols) -> Column:
    """GREATEST with warehouse semantics: NULL if any input is NULL (Spark skips NULLs)."""
    cs = [c_(c) for c in cols]
    anynull = reduce(lambda a, b: a | b, [c.isNull() for c in cs])
    return F.when(~anynull, F.greatest(*cs))


def least_strict(*cols) -> Column:
    cs = [c_(c) for c in cols]
    anynull = reduce(lambda a, b: a | b, [c.isNull() for c in cs])
    return F.when(~anynull, F.least(*cs))


# --- JSON / regex helpers (N2, N4, N6, N7) -----------------------------------
def json_any(c, paths: list[str]) -> Column:
    """First non-NULL of several JSON paths (alternate key spellings)."""
    return F.coalesce(*[F.get_json_object(c_(c), p) for p in paths])


def json_concat_text(c, path: str = "$[*].plain_text", sep: str = "") -> Column:
    """Concatenate a text field of every element of a JSON array."""
    field = path.rsplit(".", 1)[-1]
    parts = F.from_json(c_(c), f"array<struct<{field}:string>>")
    return F.array_join(F.transform(parts, lambda x: x[field]), sep)


def json_array_len(c) -> Column:
    """Length of a JSON array held as text (NULL when not an array)."""
    return F.json_array_length(c_(c))


def extract_all(c, pattern: str, group: int = 1) -> Column:
    """Every regex match (capture group) as an array."""
    return F.regexp_extract_all(c_(c), F.lit(pattern), group)
