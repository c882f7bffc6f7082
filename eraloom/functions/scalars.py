"""Scalar column functions; all stay inside generated code, none is a UDF."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Coefficients of Wichura's algorithm AS 241 (PPND16), highest power first.
_CENTRAL = (
    [2509.0809287301226727, 33430.575583588128105, 67265.770927008700853, 45921.953931549871457, 13731.693765509461125, 1971.5909503065514427, 133.14166789178437745, 3.387132872796366608],
    [5226.495278852854561, 28729.085735721942674, 39307.89580009271061, 21213.794301586595867, 5394.1960214247511077, 687.1870074920579083, 42.313330701600911252, 1.0],
)
_MIDDLE = (
    [7.7454501427834140764e-4, 0.0227238449892691845833, 0.24178072517745061177, 1.27045825245236838258, 3.64784832476320460504, 5.7694972214606914055, 4.6303378461565452959, 1.42343711074968357734],
    [1.05075007164441684324e-9, 5.475938084995344946e-4, 0.0151986665636164571966, 0.14810397642748007459, 0.68976733498510000455, 1.6763848301838038494, 2.05319162663775882187, 1.0],
)
_TAIL = (
    [2.01033439929228813265e-7, 2.71155556874348757815e-5, 0.0012426609473880784386, 0.026532189526576123093, 0.29656057182850489123, 1.7848265399172913358, 5.4637849111641143699, 6.6579046435011037772],
    [2.04426310338993978564e-15, 1.4215117583164458887e-7, 1.8463183175100546818e-5, 7.868691311456132591e-4, 0.0148753612908506148525, 0.1369298809227358053, 0.59983220655588793769, 1.0],
)


def _ratio(table: tuple[list[float], list[float]], x: Column) -> Column:
    top, bottom = (reduce(lambda acc, k: acc * x + F.lit(k), part[1:], F.lit(part[0])) for part in table)
    return top / bottom


def norm_tail(p: Column) -> Column:
    """The tail variable of ``norm_ppf``; large plans compute it as a column of its own."""
    return F.sqrt(-F.log(F.when(p <= 0.5, p).otherwise(1 - p)))


def norm_ppf(p: Column, tail: Column | None = None) -> Column:
    """Quantile of the standard normal distribution for 0 < p < 1, else null."""
    q = p - 0.5
    r = norm_tail(p) if tail is None else tail
    outer = F.when(r <= 5, _ratio(_MIDDLE, r - 1.6)).otherwise(_ratio(_TAIL, r - 5))
    value = F.when(F.abs(q) <= 0.425, q * _ratio(_CENTRAL, F.lit(0.180625) - q * q)).otherwise(F.signum(q) * outer)
    return F.when((p > 0) & (p < 1), value)


def era_to_int(era: Column, strict: bool = True) -> Column:
    """First run of digits of a label; without one an error, or null if not strict."""
    label = era.cast("string")
    number = F.nullif(F.regexp_extract(label, r"(\d+)", 1), F.lit("")).try_cast("int")
    if not strict:
        return number
    return F.when(label.isNull(), F.lit(None).cast("int")).otherwise(F.coalesce(number, F.raise_error(F.concat(F.lit("no era number in "), label)).cast("int")))


def signed_power(x: Column, power: float = 1.5) -> Column:
    return F.signum(x) * F.pow(F.abs(x), F.lit(power))


def feature_list_hash(names: Column, separator: str = "\n") -> Column:
    """First 16 hex digits of the SHA-256 of the joined names (newline or ``|``)."""
    return F.substring(F.sha2(F.array_join(names, separator), 256), 1, 16)


def to_double(x: Column) -> Column:
    return x.try_cast("double")


def to_int(x: Column) -> Column:
    """Whole number; null from text that is not one."""
    return x.try_cast("int")


def to_bool(x: Column) -> Column:
    """True for true/1/yes/y in any case, and for numbers other than 0."""
    text = F.lower(F.trim(x.cast("string")))
    return F.coalesce(text.isin("1", "true", "yes", "y") | F.coalesce(text.try_cast("double") != 0, F.lit(False)), F.lit(False))


def pick(record: Column, names: list[str]) -> Column:
    """Value of the first present key of a map with lower-case keys; a present null stops the search."""
    out = F.lit(None)
    for name in reversed(names):
        out = F.when(F.map_contains_key(record, name.lower()), F.element_at(record, F.lit(name.lower()))).otherwise(out)
    return out


# Values of JSON records are structs (kind, text): the type of the value and its text.


def kind_of(schema: Column) -> Column:
    """text, number, flag or other, from the schema of a VARIANT value; null for a null."""
    return F.when(schema == "STRING", "text").when(schema == "BOOLEAN", "flag").when(schema.rlike("^(BIGINT|INT|SMALLINT|TINYINT|DECIMAL|DOUBLE|FLOAT)"), "number").when(schema != "VOID", "other")


def json_value(v: Column) -> Column:
    """A VARIANT value as its kind (text, number, flag, other; null for a null) and its text."""
    return F.struct(kind_of(F.schema_of_variant(v)).alias("kind"), F.variant_get(v, "$", "string").alias("text"))


def json_number(v: Column) -> Column:
    """A number, from numbers, flags (0 or 1) and text that is one."""
    flag = F.when(v["text"] == "true", F.lit(1.0)).otherwise(0.0)
    return F.when(v["kind"].isin("text", "number"), F.trim(v["text"]).try_cast("double")).when(v["kind"] == "flag", flag)


def json_whole(v: Column) -> Column:
    """A whole number: truncated from numbers, from flags, and from text of a whole number."""
    number = json_number(v)
    cut = F.when(number < 0, F.ceil(number)).otherwise(F.floor(number)).try_cast("int")
    return F.when(v["kind"] == "text", F.trim(v["text"]).try_cast("int")).otherwise(cut)


def json_text(v: Column) -> Column:
    """Text; null if empty, null or not a plain value."""
    return F.when((v["kind"] != "other") & (v["text"] != ""), v["text"])


def missing_to_null(x: Column) -> Column:
    return F.nullif(x, F.lit(float("nan")))


def invalid_number(x: Column) -> Column:
    """NaN or infinite."""
    return F.isnan(x) | (F.abs(x) == F.lit(float("inf")))


def scan_points(last: Column, period: int) -> Column:
    """Every ``period``-th iteration up to ``last``, and ``last`` itself."""
    steps = F.when(last >= period, F.sequence(F.lit(period), F.greatest(last, F.lit(period)), F.lit(period))).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.concat(steps, F.array(last)))


def clip(x: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), x))
