"""Column expressions shared by the operators.  All are built-in Spark expressions
(whole-stage codegen friendly); none is a Python UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "c", "alt_ft", "on_ground", "clean_callsign", "has_callsign", "epoch_seconds", "epoch_micros",
    "ntz_from_micros",
    "epoch_to_local", "year_int", "decade", "decade_label", "age", "week_ending",
    "week_start", "platform_label", "engines_label", "power_label", "size_class",
    "path_label", "pct", "round6", "half_even_div", "avg_half_up", "nav_modes_csv", "split_pair", "WHITESPACE",
]

# Characters Python's str.strip() removes for ASCII text (fixed value).
WHITESPACE = " \t\n\r\x0b\x0c"


def c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def alt_ft(col="alt_baro") -> Column:
    """Altitude text -> integer feet.  'ground' / junk -> NULL; '27975.0' -> 27975.

    A plain try_cast to INT rejects '27975.0' in Spark while the reference engine accepts it,
    so go through DOUBLE and round."""
    return F.round(c(col).try_cast("double")).cast("int")


def on_ground(col="alt_baro") -> Column:
    return c(col) == F.lit("ground")


def clean_callsign(col="flight") -> Column:
    """strip(); '' and NULL -> NULL; an all-blank callsign becomes ''."""
    x = c(col)
    return F.when(x.isNull() | (x == ""), F.lit(None).cast("string")).otherwise(F.btrim(x, F.lit(WHITESPACE)))


def has_callsign(col="flight", mode: str = "length") -> Column:
    """Three spellings used by the reports: 'not_null' keeps '', 'not_empty' (<> ''), 'length' (LENGTH>0)."""
    x = c(col)
    if mode == "not_null":
        return x.isNotNull()
    if mode == "not_empty":
        return x != ""
    return F.length(x) > 0


def epoch_micros(ts="observation_time") -> Column:
    """Microseconds since 1970-01-01 00:00 of a TIMESTAMP_NTZ read as UTC wall time.

    Built from the calendar fields of the NTZ value (date, hour, minute, second with
    fraction), so no session time zone is involved -- a cast to TIMESTAMP would be."""
    t = c(ts)
    days = F.unix_date(F.to_date(t)).cast("long")
    secs = days * 86400 + F.hour(t).cast("long") * 3600 + F.minute(t).cast("long") * 60
    frac = (F.date_part(F.lit("SECOND"), t) * 1000000).cast("long")
    return secs * 1000000 + frac


def epoch_seconds(ts="observation_time") -> Column:
    """Epoch seconds (DOUBLE) of a TIMESTAMP_NTZ read as UTC wall time -- zone independent."""
    return epoch_micros(ts) / F.lit(1e6)


def ntz_from_micros(micros: Column) -> Column:
    """TIMESTAMP_NTZ for epoch microseconds (UTC wall time), without any session zone."""
    return F.timestamp_add("MICROSECOND", micros, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def epoch_to_local(epoch="observation_epoch", tz: str = "UTC") -> Column:
    """Epoch seconds -> receiver-local wall time (TIMESTAMP_NTZ) for an explicit zone."""
    utc_ntz = ntz_from_micros(F.round(c(epoch) * 1000000).cast("long"))
    if tz.upper() == "UTC":
        return utc_ntz
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), utc_ntz)


def year_int(col="manufacture_year") -> Column:
    return c(col).try_cast("int")


def decade(year: Column) -> Column:
    return (F.floor((year - 1900) / 10) * 10 + 1900).cast("int")


def decade_label(year: Column) -> Column:
    return F.concat(decade(year).cast("string"), F.lit("s"))


def age(year: Column, ref_year: int) -> Column:
    return F.lit(ref_year) - year


def week_ending(d) -> Column:
    """Sunday that ends the Monday-Sunday week containing date d (d itself when Sunday)."""
    d = c(d)
    return F.date_add(d, F.pmod(F.lit(8) - F.dayofweek(d), F.lit(7)).cast("int"))


def week_start(d) -> Column:
    return F.date_sub(week_ending(d), 6)


# Type-code labels (fixed values of the registry's three-character short type).
PLATFORM = {"L": "Land Airplane", "H": "Helicopter", "A": "Amphibian", "G": "Gyrocopter"}
ENGINES = {"0": "0 (glider)", "1": "1", "2": "2", "3": "3", "4": "4", "8": "8"}
POWER = {"P": "Piston", "J": "Jet", "T": "Turboprop", "E": "Electric", "-": "None"}
SIZE = {"1": "Small (1 engine)", "2": "Medium (2 engines)", "3": "Large (3 engines)", "4": "Large (4 engines)"}


def _lookup(code: Column, table: dict, default: Column | None) -> Column:
    expr = None
    for k, v in table.items():
        expr = F.when(code == k, F.lit(v)) if expr is None else expr.when(code == k, F.lit(v))
    return expr.otherwise(default if default is not None else code)


def platform_label(short_type="short_type") -> Column:
    code = F.substring(c(short_type), 1, 1)
    return _lookup(code, PLATFORM, None)


def engines_label(short_type="short_type") -> Column:
    code = F.substring(c(short_type), 2, 1)
    return _lookup(code, ENGINES, None)


def power_label(short_type="short_type") -> Column:
    code = F.substring(c(short_type), 3, 1)
    return _lookup(code, POWER, None)


def size_class(short_type="short_type") -> Column:
    return _lookup(F.substring(c(short_type), 2, 1), SIZE, F.lit("Other"))


def path_label(flight="flight", hex_col="hex") -> Column:
    f = F.btrim(c(flight), F.lit(WHITESPACE))
    return F.when(F.length(f) > 0, f).otherwise(c(hex_col))


def pct(part: Column, total: Column, digits: int = 2) -> Column:
    return F.round(F.try_divide(F.lit(100.0) * part, total), digits)


def half_even_div(s: Column, d: Column) -> Column:
    """Integer nearest to s / d (d > 0), ties to even, computed exactly with integer
    arithmetic (no floating-point rounding of the quotient)."""
    r = F.pmod(s, d)
    q = ((s - r) / d).cast("long")
    twice = r * 2
    up = (twice > d) | ((twice == d) & (F.pmod(q, F.lit(2)) == 1))
    return q + F.when(up, F.lit(1)).otherwise(F.lit(0))


def avg_half_up(x, digits: int = 1) -> Column:
    """Mean of an integer column rounded half away from zero to ``digits`` decimals, exactly: the
    sum is an integer, so the tie is decided by integer division.  NULL when there is no value."""
    scale = 10 ** digits
    total, n = F.sum(c(x).cast("long")), F.count(c(x))
    twice = F.abs(total) * (2 * scale) + n
    units = F.floor((twice - F.pmod(twice, 2 * n)) / (2 * n))
    return F.when(n > 0, F.signum(total) * units / F.lit(float(scale)))


def round6(x: Column) -> Column:
    return F.round(x, 6)


def nav_modes_csv(col="nav_modes") -> Column:
    return F.array_join(c(col), ",")


def split_pair(col, i: int) -> Column:
    return F.get(c(col), i)
