"""Column functions that turn text-typed public-sector fields into typed values (Column to Column, no UDFs)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

Named = Column | str


def _c(col: Named) -> Column:
    return F.col(col) if isinstance(col, str) else col


# --- numbers ------------------------------------------------------------------------------------------------


def parse_financial(col: Named) -> Column:
    """Money text to decimal(15,2).

    Layouts: zero-padded ``0000034679700,00``, ``34.679.700,00``, ``34679700,00`` and ``34679700.00``. Null,
    blank, ``None`` and anything with ``NaN`` give 0.00; other text that is no number gives null.
    """
    c = _c(col)
    text = F.trim(c)
    comma = text.contains(",")
    plain = (
        F.when(text.rlike(r"^0+\d+,\d+$"), F.replace(F.ltrim(text, F.lit("0")), F.lit(","), F.lit(".")))
        .when(comma & text.contains("."), F.replace(F.replace(text, F.lit("."), F.lit("")), F.lit(","), F.lit(".")))
        .when(comma, F.replace(text, F.lit(","), F.lit(".")))
        .otherwise(text)
    )
    empty = c.isNull() | text.isin("", "None") | text.contains("NaN")
    return F.when(empty, F.lit(0).cast("decimal(15,2)")).otherwise(plain.try_cast("decimal(15,2)"))


#: What a cast to a whole number takes; of other text each failed cast would make an exception, which costs twenty times as much.
_WHOLE = r"^[\x00-\x20\x7F]*[+-]?[0-9]+[\x00-\x20\x7F]*$"


def parse_int(col: Named) -> Column:
    """Integer text; blank, ``None`` and text that is no integer give null."""
    text = _c(col).cast("string")
    return F.when(text.rlike(_WHOLE), text.try_cast("int"))


def parse_numeric(col: Named, kind: str = "decimal(38,10)") -> Column:
    """Number with a comma or dot decimal, as ``kind``; blank, ``None`` and bad text give null."""
    return F.replace(clean_text(col, none=True), F.lit(","), F.lit(".")).try_cast(kind)


def num_br(col: Named, kind: str = "double") -> Column:
    """Brazilian number: dots group thousands, the comma is decimal; blank, ``-`` and bad text give null."""
    text = F.trim(_c(col))
    plain = F.replace(F.replace(text, F.lit("."), F.lit("")), F.lit(","), F.lit("."))
    return F.when(~text.isin("", "-"), plain).try_cast(kind)


def null_sentinels(col: Named, values: Sequence[str] = ("-", "..", "...")) -> Column:
    """Statistical sentinels become null, other text stays."""
    c = _c(col)
    return F.when(~F.trim(c).isin(*values), c)


def safe_ratio(n: Named, d: Named, scale: float = 1.0, default: float | None = 0.0, digits: int | None = None) -> Column:
    """``n / d * scale`` where ``d`` is positive, else ``default``; rounded to ``digits`` if given."""
    value = F.try_divide(_c(n).cast("double"), _c(d).cast("double")) * scale
    value = F.round(value, digits) if digits is not None else value
    return F.when(_c(d) > 0, value).otherwise(F.lit(default).cast("double"))


def scale_round(col: Named, divisor: float, digits: int = 1) -> Column:
    """Change of unit, rounded half away from zero."""
    return F.round(_c(col).cast("decimal(38,6)") / F.lit(divisor).cast("decimal(20,3)"), digits).cast("double")


def scaled_floor(col: Named, factor: float = 3.3) -> Column:
    """``floor(col * factor)`` as a whole number (people per housing unit)."""
    return F.floor(_c(col).cast("double") * factor).cast("long")


def sum_components(*cols: Named) -> Column:
    """Sum in which null components count as 0."""
    return reduce(lambda a, b: a + b, [F.coalesce(_c(c), F.lit(0)) for c in cols])


# --- dates --------------------------------------------------------------------------------------------------


def parse_date_br(col: Named) -> Column:
    """``DD/MM/YYYY``, ``YYYYMMDD`` or text that starts with ``YYYY-MM-DD``; anything else, and impossible dates, null."""
    c = _c(col)
    iso = lambda year, month, day: F.concat_ws("-", F.substring(c, year, 4), F.substring(c, month, 2), F.substring(c, day, 2))
    text = (
        F.when((F.substring(c, 3, 1) == "/") & c.rlike(r"^\d{2}/\d{2}/\d{4}\z"), iso(7, 4, 1))
        .when((F.length(c) == 8) & c.rlike(r"^\d{8}\z"), iso(1, 5, 7))
        .when(c.rlike(r"^\d{4}-\d{2}-\d{2}"), F.left(c, F.lit(10)))
    )
    return text.try_cast("date")  # a pattern's parser takes several times as long


def parse_date_ddmmyyyy(col: Named) -> Column:
    """Eight digits ``DDMMYYYY``, else null."""
    c = F.trim(_c(col))
    return F.when(c.rlike(r"^\d{8}$"), F.try_to_date(c, "ddMMyyyy"))


#: Period layouts by name: the text to prepend, and the pattern.
PERIODS = {"yyyymm": ("", "yyyyMM"), "yyyymm01": ("", "yyyyMMdd"), "mm/yyyy": ("01/", "dd/MM/yyyy")}


def period_to_date(col: Named, layout: str = "yyyymm") -> Column:
    """First day of a period given as ``YYYYMM``, ``YYYYMM01`` or ``MM/YYYY``; bad text gives null."""
    prefix, pattern = PERIODS[layout]
    text = F.trim(_c(col))
    if layout == "yyyymm":  # a day makes the parser strict
        return F.try_to_date(F.concat(text, F.lit("01")), "yyyyMMdd")
    return F.try_to_date(F.concat(F.lit(prefix), text), pattern)


def quarter_start(year: Named, label: Named) -> Column:
    """First day of the quarter whose label starts with its number (``4T2025``)."""
    quarter = F.left(F.trim(_c(label)), F.lit(1)).try_cast("int")
    return F.when(quarter.between(1, 4), F.make_date(_c(year).cast("int"), quarter * 3 - 2, F.lit(1)))


def month_start(year: Named, month: Named) -> Column:
    """First day of a month; months beyond 1 to 12 give null."""
    m = _c(month).cast("int")
    return F.when(m.between(1, 12), F.make_date(_c(year).cast("int"), m, F.lit(1)))


def quarter_of(month: Named) -> Column:
    """Quarter number of a month number."""
    return F.ceil(_c(month) / 3).cast("int")


def year_of_period(col: Named) -> Column:
    return F.left(F.trim(_c(col)), F.lit(4)).try_cast("int")


def month_of_period(col: Named) -> Column:
    return F.right(F.trim(_c(col)), F.lit(2)).try_cast("int")


def null_date_sentinel(col: Named, sentinel: str = "1900-01-01") -> Column:
    return F.nullif(_c(col), F.lit(sentinel).cast("date"))


def null_dms(degrees: Named, minutes: Named, seconds: Named) -> Column:
    """Decimal degrees of a degrees-minutes-seconds triple; null where all three are 0 or any is null."""
    d, m, s = (_c(x).cast("double") for x in (degrees, minutes, seconds))
    return F.when(~((d == 0) & (m == 0) & (s == 0)), F.signum(F.when(d == 0, 1.0).otherwise(d)) * (F.abs(d) + m / 60 + s / 3600))


def date_labels(col: Named) -> dict[str, Column]:
    """Text labels of a date: ``year_month``, ``month_year``, ``year``, ``quarter`` (first day)."""
    c = _c(col)
    return {
        "year_month": F.date_format(c, "yyyy-MM"),
        "month_year": F.date_format(c, "MM/yyyy"),
        "year": F.date_format(F.date_trunc("year", c), "yyyy-MM-dd"),
        "quarter": F.date_format(F.date_trunc("quarter", c), "yyyy-MM-dd"),
    }


def days_between(end: Named, start: Named, sentinel: str = "1900-01-01") -> Column:
    """Whole days from ``start`` to ``end``; null if either is null or the sentinel."""
    return F.datediff(null_date_sentinel(_c(end).cast("date"), sentinel), null_date_sentinel(_c(start).cast("date"), sentinel))


def local_run_time(col: Named, zone: str = "America/Sao_Paulo") -> Column:
    """A UTC timestamp as wall-clock time of ``zone``."""
    return F.from_utc_timestamp(_c(col), zone)


# --- keys and text ------------------------------------------------------------------------------------------


def digits(col: Named) -> Column:
    """Digits only; null if none are left."""
    return F.nullif(F.regexp_replace(_c(col), "[^0-9]", ""), F.lit(""))


def normalize_key(col: Named, width: int = 8, compat: bool = False) -> Column:
    """Contract key of ``width`` digits from ``0626780-03``, longer or shorter digit text; blank gives null.

    The documented intent is the last ``width`` digits, zero-padded. ``compat=True`` keeps the known quirk for
    dashed keys: padding from the left *truncates* them to their first ``width`` characters.
    """
    c = _c(col)
    only = F.regexp_replace(c, "[^0-9]", "")
    key = F.substring(F.concat(F.lit("0" * width), only), -width, width)
    if compat:
        key = F.when(c.contains("-"), F.lpad(F.replace(c, F.lit("-"), F.lit("")), width, "0")).otherwise(key)
    return F.when(F.trim(c) != "", key)


def pad_cnpj(col: Named) -> Column:
    """Tax id of 14 digits, zero-padded; blank gives null."""
    return F.lpad(digits(col), 14, "0")


def format_cnpj(col: Named) -> Column:
    """Tax id as ``NN.NNN.NNN/NNNN-NN``."""
    return F.regexp_replace(pad_cnpj(col), r"^(\d{2})(\d{3})(\d{3})(\d{4})(\d{2})$", "$1.$2.$3/$4-$5")


def clean_text(col: Named, none: bool = False) -> Column:
    """Trimmed text; blank, and ``None`` if asked, give null."""
    text = F.nullif(F.trim(_c(col)), F.lit(""))
    return F.nullif(text, F.lit("None")) if none else text


def flag_s(col: Named) -> Column:
    """True for ``S``, false for anything else, null included."""
    return F.coalesce(F.trim(_c(col)) == "S", F.lit(False))


def upper_trim(col: Named) -> Column:
    return F.upper(F.trim(_c(col)))


def decode(col: Named, mapping: Mapping[str, str], default: str | None = "OUTRO ({})", missing: str = "N/A") -> Column:
    """Label of a code. Unknown codes give ``default`` with ``{}`` filled by the code, or ``missing`` for null."""
    c = _c(col).cast("string")
    out = F
    for code, label in mapping.items():
        out = out.when(c == code, label)
    if default is None:
        return out
    before, mark, after = default.partition("{}")
    filled = F.concat(F.lit(before), F.coalesce(c, F.lit(missing)), F.lit(after)) if mark else F.lit(default)
    return out.otherwise(filled)


def bucket(col: Named, groups: Mapping[str, Iterable[str]], default: str | None = None) -> Column:
    """Name of the first group that lists the value."""
    out = F
    for name, members in groups.items():
        out = out.when(_c(col).isin(*members), name)
    return out.otherwise(default)


def search_label(key: Named, city: Named, state: Named, name: Named) -> Column:
    """``KEY - City/ST - NAME``; null parts are left empty."""
    part = [F.coalesce(_c(x).cast("string"), F.lit("")) for x in (key, city, state, name)]
    return F.concat(part[0], F.lit(" - "), part[1], F.lit("/"), part[2], F.lit(" - "), F.upper(part[3]))


def iso_state(col: Named, country: str = "BR") -> Column:
    """ISO 3166-2 code; null stays null."""
    return F.concat(F.lit(country + "-"), _c(col))


def split_control_number(col: Named) -> Column:
    """Struct of ``cnpj``, ``kind``, ``sequence`` and ``year`` of ``cnpj-digit-seq/year``; null unless all are there."""
    c = _c(col)
    pattern = r"^(\d+)-(\d+)-(\d+)/(\d{4})$"
    part = lambda i: F.regexp_extract(c, pattern, i)
    fields = F.struct(part(1).alias("cnpj"), part(2).alias("kind"), part(3).cast("int").alias("sequence"), part(4).cast("int").alias("year"))
    return F.when(c.rlike(pattern), fields)


def split_note_number(col: Named) -> Column:
    """Struct of ``year`` (first four characters) and ``number`` (last six) of a note number; null if shorter than ten."""
    c = F.trim(_c(col))
    return F.when(F.length(c) >= 10, F.struct(F.left(c, F.lit(4)).alias("year"), F.right(c, F.lit(6)).alias("number")))


def register_sql_functions(spark: SparkSession) -> None:
    """``parse_date_br`` and ``normalize_apf`` as temporary SQL functions, for users of plain SQL."""
    spark.sql(
        r"""create or replace temporary function parse_date_br(t string) returns date return
        case when t rlike '^\\d{2}/\\d{2}/\\d{4}$' then cast(try_to_timestamp(t, 'dd/MM/yyyy') as date)
             when t rlike '^\\d{8}$' then cast(try_to_timestamp(t, 'yyyyMMdd') as date)
             when t rlike '^\\d{4}-\\d{2}-\\d{2}' then cast(try_to_timestamp(left(t, 10), 'yyyy-MM-dd') as date) end"""
    )
    spark.sql(
        r"""create or replace temporary function normalize_apf(t string) returns string return
        case when trim(t) <> '' then case when length(regexp_replace(t, '[^0-9]', '')) >= 8
             then right(regexp_replace(t, '[^0-9]', ''), 8) else lpad(regexp_replace(t, '[^0-9]', ''), 8, '0') end end"""
    )
