"""Deterministic readings of the extraction rules; all are optional post-processing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Confidences of an extracted field.
CONFIDENCES = ("EXTRAIDO_DIRECTO", "EXTRAIDO_INFERIDO", "NO_EXTRAIDO")
# Which document's disbursements win.
SOURCE_ORDER = ("ROP", "INI", "DEC")
# Fields that may come from the administrative system.
SYSTEM_FIELDS = ("estado_informe_SSC", "informe_auditoria_externa_se_entrego_SSC", "fecha_vencimiento_SSC", "fecha_cambio_estado_informe_SSC", "status_auditoria_SSC")


def coverage(confidence: Column | str) -> Column:
    """Share of values that were extracted."""
    c = F.col(confidence) if isinstance(confidence, str) else confidence
    return F.avg((c != "NO_EXTRAIDO").cast("double"))


def gated(value: Column, confidence: Column) -> Column:
    """A value whose confidence says that it wasn't extracted is null."""
    return F.when(confidence != "NO_EXTRAIDO", value)


# Phrases of opinions and report states, in the order in which they are tried.
OPINIONS = (
    ("Favorable", "sin salvedades|no reveló deficiencias significativas"),
    ("Desfavorable", "se sostienen deficiencias|incumplimiento|desfavorable|adversa"),
    ("Favorable con reservas", "excepto por|con salvedades|con reservas|calificada"),
    ("Favorable", "favorable|razonablemente|limpia"),
)
STATES = (
    ("No requerido", "no requerid|no aplica"),
    ("Pendiente", "pendiente|en trámite|aún no"),
    ("No disponible", "no disponible|vencid|dispensad|no entregad"),
    ("Disponible", "disponible|entregad|existe"),
)
DATA_TYPES = (("pendiente", "pendiente|por definir"), ("proyectado", "proyectad|programad|estimad|previst"), ("realizado", "realizad|alcanzad|ejecutad|logrado"))
UNITS = ("%", "km", "personas", "m²", "m³", "horas", "hectáreas", "kVA", "MVA", "l/s", "galones", "miles gal/día", "toneladas", "cantidad/año", "miles m²")


def _first(text: Column | str, table: tuple[tuple[str, str], ...]) -> Column:
    t = F.lower(text)
    out = F.when(t.rlike(table[0][1]), table[0][0])
    for name, pattern in table[1:]:
        out = out.when(t.rlike(pattern), name)
    return out


def opinion(phrase: Column | str) -> Column:
    return F.coalesce(_first(phrase, OPINIONS), F.lit("no se menciona"))


def report_status(phrase: Column | str) -> Column:
    return _first(phrase, STATES)


def allowed_source(field: Column | str, source: Column | str) -> Column:
    return (F.col(source) != "SSC") | F.col(field).isin(*SYSTEM_FIELDS)


def dedup_disbursements(rows: DataFrame, keys: tuple[str, ...] = ("period", "currency", "record_type"), source: str = "source", revised: str = "revised") -> DataFrame:
    """One row per period, currency and record type: the best source's latest revision, of equal ones the greatest by
    its other columns. An aggregate, so no key's rows are gathered."""
    rank = F.coalesce(F.array_position(F.array(*map(F.lit, SOURCE_ORDER)), F.col(source)), F.lit(0))
    rest = [c for c in rows.columns if c not in keys]
    order = F.struct(F.when(rank == 0, -99).otherwise(-rank), F.col(revised), *rest)
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_row")).select(*[F.col(c) if c in keys else F.col("_row")[c].alias(c) for c in rows.columns])


def repeated_keys(rows: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Keys of more than one row: there are none where one row per key is due."""
    return rows.groupBy(*keys).count().where("count > 1")


def amount(text: Column | str) -> Column:
    """Number of an amount in either notation, as decimal; symbols are dropped, nothing is converted."""
    bare = F.regexp_replace(text, r"[^0-9.,-]", "")
    comma_decimal = bare.rlike(r",\d{1,2}$")
    return F.when(comma_decimal, F.replace(F.replace(bare, F.lit("."), F.lit("")), F.lit(","), F.lit("."))).when(bare.rlike(r"^-?\d{1,3}(\.\d{3})+$"), F.replace(bare, F.lit("."), F.lit(""))).otherwise(F.replace(bare, F.lit(","), F.lit(""))).try_cast("decimal(38,6)")


def usd_amount(text: Column | str) -> Column:
    """An amount that says itself that it is in US dollars; others are null, since nothing is converted."""
    c = F.col(text) if isinstance(text, str) else text
    return F.when(c.rlike(r"(?i)US\s?\$|U\$S|\bUSD\b"), amount(c))


def goal(text: Column | str) -> tuple[Column, Column]:
    """Number and unit of a goal such as "1.500 personas", "1,500 personas" or "2,5 ha"."""
    pattern = r"^\s*([0-9][0-9.,]*)\s*(.*?)\s*$"
    raw, unit = F.regexp_extract(text, pattern, 1), F.regexp_extract(text, pattern, 2)
    thousands = raw.rlike(r"^\d{1,3}([.,]\d{3})+$")
    number = F.when(thousands, F.regexp_replace(raw, "[.,]", "")).otherwise(F.replace(raw, F.lit(","), F.lit(".")))
    return number.try_cast("double"), F.when(unit != "", unit)


def goal_unit(unit: Column | str) -> Column:
    """The unit of the catalogue that a unit's text begins with; the longest one counts."""
    u = F.col(unit) if isinstance(unit, str) else unit
    found = F.coalesce(*[F.when(F.startswith(F.lower(u), F.lit(x.lower())), F.lit(x)) for x in sorted(UNITS, key=len, reverse=True)])
    return F.coalesce(found, F.when(u.rlike("^ha($|[^a-z])"), F.lit("hectáreas")))


def data_type(text: Column | str) -> Column:
    return _first(text, DATA_TYPES)


def partial_date(text: Column | str) -> Column:
    """Literal date with its granularity and first day: 2026, Q1 2025, 2025-03, 2025-03-14."""
    year = F.regexp_extract(text, r"(\d{4})", 1)
    quarter = F.regexp_extract(text, r"[QT]([1-4])", 1)
    month = F.regexp_extract(text, r"^\d{4}-(\d{2})", 1)
    day = F.regexp_extract(text, r"^\d{4}-\d{2}-(\d{2})", 1)
    kind = F.when(day != "", "day").when(month != "", "month").when(quarter != "", "quarter").when(year != "", "year")
    m = F.when(month != "", month).when(quarter != "", F.lpad(((quarter.try_cast("int") - 1) * 3 + 1).cast("string"), 2, "0")).otherwise("01")
    start = F.try_to_date(F.concat_ws("-", year, m, F.when(day != "", day).otherwise("01")), "yyyy-MM-dd")
    return F.struct(text if isinstance(text, Column) else F.col(text).alias("text"), kind.alias("granularity"), start.alias("start"))
