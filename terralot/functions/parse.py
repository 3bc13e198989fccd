"""Column expressions for the text fields of transaction lines. No UDFs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMBER = r"^\s*[+-]?(\d+(_\d+)*\.?(\d+(_\d+)*)?|\.\d+(_\d+)*)([eE][+-]?\d+(_\d+)*)?\s*$"
WHOLE = r"^\s*[+-]?\d+(_\d+)*\s*$"
#: Item classes in their order of precedence, and the codes of classes and natures.
PRIORITY = ["immeuble", "maison", "appartement", "local", "dependance"]
TYPE_CODE = {"maison": 1, "appartement": 2, "immeuble": 3, "local": 4, "dependance": 5}
NATURE_CODE = {"vente": 1, "vefa": 2, "adjudication": 3, "echange": 4, "expropriation": 5}


def parse_float(c: Column) -> Column:
    """A finite double, else null: text that is no plain number, infinities, NaN and overflow."""
    value = F.when(c.rlike(NUMBER), F.regexp_replace(F.trim(c), "_", "").try_cast("double"))
    return F.when(F.abs(value) < float("inf"), value)


def half_away(c: Column) -> Column:
    """The nearest whole number, halves away from zero, as floor(x + 1/2) and ceil(x - 1/2)."""
    return F.when(c >= 0, F.floor(c + F.lit(0.5))).otherwise(F.ceil(c - F.lit(0.5)))


def parse_int(c: Column) -> Column:
    """A whole number; else a number rounded half away from zero; else null."""
    whole = F.when(c.rlike(WHOLE), F.regexp_replace(F.trim(c), "_", "").try_cast("long"))
    near = parse_float(c)
    return F.coalesce(whole, F.when(F.abs(near) < 9e18, half_away(near).cast("long")))


def round5(c: Column) -> Column:
    return half_away(c * F.lit(1e5)) / F.lit(1e5)


def code(c: Column, codes: dict[str, int]) -> Column:
    return F.create_map(*[F.lit(x) for kv in codes.items() for x in kv])[c]


def property_class(c: Column) -> Column:
    """Class of an item's label: by the first word found of four, case-sensitively; else null."""
    out = F.lit(None).cast("string")
    for word, name in (("Local", "local"), ("Dépendance", "dependance"), ("Appartement", "appartement"), ("Maison", "maison")):
        out = F.when(F.contains(c, F.lit(word)), F.lit(name)).otherwise(out)
    return out


def nature_class(c: Column) -> Column:
    """Class of a transaction's nature; a sale where nothing says otherwise."""
    out = F.lit("vente")
    for word, name in (("Expropriation", "expropriation"), ("change", "echange"), ("Adjudication", "adjudication"), ("futur", "vefa")):
        out = F.when(F.contains(c, F.lit(word)), F.lit(name)).otherwise(out)
    return out


def priority(cls: Column) -> Column:
    """Place in the order of precedence; unknown classes last."""
    return F.coalesce(code(cls, {c: i for i, c in enumerate(PRIORITY)}), F.lit(len(PRIORITY)))


def compose_address(*parts: Column) -> Column:
    """Parts that aren't empty, with spaces between; null if there are none."""
    return F.nullif(F.concat_ws(" ", *[F.nullif(p, F.lit("")) for p in parts]), F.lit(""))


def dept_of(com: Column) -> Column:
    """Département of a commune: three characters overseas, else two."""
    return F.when(com.startswith("97"), F.substring(com, 1, 3)).otherwise(F.substring(com, 1, 2))


def dept_of_zone(zone: Column) -> Column:
    return F.when(zone.startswith("97") | zone.startswith("98"), F.substring(zone, 1, 3)).otherwise(F.substring(zone, 1, 2))


def year_of(date: Column) -> Column:
    return F.floor(date / 10000).cast("int")


def quarter_of(date: Column) -> Column:
    return (F.floor((F.floor(date / 100) % 100 - 1) / 3) + 1).cast("int")


def display_date(date: Column) -> Column:
    """20240131 as 31/01/2024."""
    return F.regexp_replace(F.lpad(date.cast("string"), 8, "0"), r"^(\d{4})(\d{2})(\d{2})$", "$3/$2/$1")


def price_per_m2(vf: Column, sb: Column) -> Column:
    return F.when((vf > 0) & (sb > 0), vf.cast("double") / sb)
