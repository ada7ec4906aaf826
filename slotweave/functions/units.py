"""Unit spellings and unit conversion factors.

Spellings: a unit string is folded (lower case, no spaces) and looked up in an
alias table, the fixed values below.
"""

from __future__ import annotations

import re
from fractions import Fraction

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slotweave.errors import SpecError
from slotweave.functions.local import local_frame

# Folded spelling -> canonical unit.
UNIT_ALIASES = {
    "percent": "%",
    "%": "%",
    "percentoftotalleukocytes": "%{WBCs}",
    "%{wbcs}": "%{WBCs}",
    "%ofnormal": "%{normal}",
    "%{normal}": "%{normal}",
    "1fruit,1/2cupor5dried": "1/2cup",
    "1/2cupor2-4sticks": "1/2cup",
    "1fruitor1/2cup": "1/2cup",
    "1/2cupofcarrotsor2-3oz.ofjuice": "1/2cup",
    "1/2fruitor1/2cup": "1/2cup",
    "1/2cupvegetables,or1cupofsoup": "1/2cup",
    "1earor1/2cup": "1/2cup",
    "1/2cup": "1/2cup",
    "10^3/mm3": "10*3/mm3",
    "103/mm3": "10*3/mm3",
    "x1000/mm3": "10*3/mm3",
    "th/cmm": "10*3/mm3",
    "10*3/mm3": "10*3/mm3",
    "x10e3/ul": "10*3/uL",
    "thou/ul(thousandspermicroliter)": "10*3/uL",
    "10^3cells/ul": "10*3/uL",
    "thousandspermicroliter": "10*3/uL",
    "x10^3/ul": "10*3/uL",
    "thousands/ul": "10*3/uL",
    "10^3/ul": "10*3/uL",
    "10*3/ul": "10*3/uL",
    "106/mm3": "10*6/mm3",
    "m/cmm": "10*6/mm3",
    "10^6/mm3": "10*6/mm3",
    "10*6/mm3": "10*6/mm3",
    "count,x10e12": "10*6/uL",
    "10^6/ul": "10*6/uL",
    "x10e6/ul": "10*6/uL",
    "millions/ul": "10*6/uL",
    "10*6/ul": "10*6/uL",
    "count,x10e9": "10*9/L",
    "10^9/l": "10*9/L",
    "10*9/l": "10*9/L",
    "3-4oz.": "3-4oz",
    "3-4oz": "3-4oz",
    "c": "Cel",
    "cel": "Cel",
    "litres": "L",
    "liters": "L",
    "l": "L",
    "i.u.": "[IU]",
    "iu": "[IU]",
    "[iu]": "[IU]",
    "iu/l": "[IU]/L",
    "u/l": "[IU]/L",
    "[iu]/l": "[IU]/L",
    "iu/dl": "[IU]/dL",
    "[iu]/dl": "[IU]/dL",
    "iu/ml": "[IU]/mL",
    "[iu]/ml": "[IU]/mL",
    "cup": "[cup_us]",
    "[cup_us]": "[cup_us]",
    "ft": "[ft_us]",
    "feet": "[ft_us]",
    "[ft_us]": "[ft_us]",
    'hu': "[hnsf'U]",
    'hounsfieldunits(hu)': "[hnsf'U]",
    "[hnsf'u]": "[hnsf'U]",
    "inches": "[in_us]",
    "inches,tonextlower1/4inch": "[in_us]",
    "inchestonextlower1/4inch": "[in_us]",
    "in": "[in_us]",
    "tonextlower1/4inch": "[in_us]",
    "[in_us]": "[in_us]",
    "lb": "[lb_av]",
    "lbs": "[lb_av]",
    "pounds": "[lb_av]",
    "pounds,tonearestpound": "[lb_av]",
    "[lb_av]": "[lb_av]",
    "1oz.or1/2cup": "[oz_av]",
    "oz": "[oz_av]",
    "1oz": "[oz_av]",
    "[oz_av]": "[oz_av]",
    "ph": "[pH]",
    "[ph]": "[pH]",
    "tbs": "[tbs_us]",
    "1tbs": "[tbs_us]",
    "[tbs_us]": "[tbs_us]",
    "yearsold": "a",
    "years": "a",
    "year": "a",
    "numberofyearssinceexam1": "a",
    "a": "a",
    "centimeters": "cm",
    "cm": "cm",
    "hundredthsofsecond": "cs",
    "hundredthsofasecond": "cs",
    "hundredthsofasec.": "cs",
    "hundredsofsecond": "cs",
    "cs": "cs",
    "days": "d",
    "dayssinceexam1": "d",
    "numberofdayssinceexam1": "d",
    "d": "d",
    "deciliter": "dL",
    "dl": "dL",
    "decigrams/100ml": "dg/dL",
    "dg/dl": "dg/dL",
    "cmx10": "dm",
    "dm": "dm",
    "femtoliter": "fL",
    "fl": "fL",
    "gm": "g",
    "g": "g",
    "g/day": "g/d",
    "g/24hr": "g/d",
    "g/d": "g/d",
    "gm/dl": "g/dL",
    "g/dl": "g/dL",
    "hrs": "h",
    "hr": "h",
    "hour": "h",
    "hours": "h",
    "h": "h",
    "ml": "mL",
    "ml/day": "mL/d",
    "ml/alcohol/day": "mL/d",
    "ml/d": "mL/d",
    "ml/minper1.73m2": "mL/min/{1.73_m2}",
    "ml/min/1.73m2": "mL/min/{1.73_m2}",
    "ml/min/1.73m^2": "mL/min/{1.73_m2}",
    "ml/min/{1.73_m2}": "mL/min/{1.73_m2}",
    "ml/sec": "mL/s",
    "ml/s": "mL/s",
    "mul": "m[IU]/L",
    "miu/l": "m[IU]/L",
    "mu/l": "m[IU]/L",
    "m[iu]/l": "m[IU]/L",
    "miu/ml": "m[IU]/mL",
    "mu/ml": "m[IU]/mL",
    "amiu/ml": "m[IU]/mL",
    "m[iu]/ml": "m[IU]/mL",
    "meq/liter": "meq/L",
    "meq/l": "meq/L",
    "meq/liter(x100)": "meq/L(x100)",
    "meq/l(x100)": "meq/L(x100)",
    "mg/l": "mg/L",
    "mg/lfeu": "mg/L{FEU}",
    "mg/24hr": "mg/d",
    "mg/day": "mg/d",
    "mg/24hours": "mg/d",
    "mg/d": "mg/d",
    "mgperdl": "mg/dL",
    "mgper100ml": "mg/dL",
    "mg/100ml": "mg/dL",
    "mg/dl": "mg/dL",
    "mg/gcr": "mg/g",
    "mg/g": "mg/g",
    "mg/ml": "mg/mL",
    "minutes": "min",
    "min": "min",
    "mm/hr": "mm/h",
    "mm/h": "mm/h",
    "mm3(10^3/ul)": "mm3(10*3/uL)",
    "mm3(1,000,000/microliter)": "mm3(10*3/uL)",
    "mm3(1,000,000permicroliter)": "mm3(10*3/uL)",
    "tonearest2mm/hg": "mm[Hg]",
    "mm/hg": "mm[Hg]",
    "hgmm": "mm[Hg]",
    "tonearest2mmhg": "mm[Hg]",
    "mmhg": "mm[Hg]",
    "mm[hg]": "mm[Hg]",
    "mmolperl": "mmol/L",
    "mmol/l": "mmol/L",
    "mmoles/dl": "mmol/dL",
    "mmol/dl": "mmol/dL",
    "months": "mo",
    "month": "mo",
    "mo": "mo",
    "msec": "ms",
    "milliseconds": "ms",
    "millisec": "ms",
    "ms": "ms",
    "ng/l": "ng/L",
    "plasmang/ml": "ng/mL",
    "ng/ml": "ng/mL",
    "nmol/min/ml": "nmol/min/mL",
    "numberofsiblings": "none",
    "n/a": "none",
    "codes": "none",
    "numberofkids": "none",
    "pg/ml": "pg/mL",
    "pg/cell": "pg/{cell}",
    "pg/{cell}": "pg/{cell}",
    "pmol/l": "pmol/L",
    "seconds": "s",
    "s": "s",
    "microvolts": "uV",
    "uv": "uV",
    "uiu/ml": "u[IU]/mL",
    "uu/ml": "u[IU]/mL",
    "microu/ml": "u[IU]/mL",
    "u[iu]/ml": "u[IU]/mL",
    "mcg/l": "ug/L",
    "ug/l": "ug/L",
    "ug/dl": "ug/dL",
    "ug/ml": "ug/mL",
    "microm3": "um3",
    "um3(micrometerscubed)": "um3",
    "um3": "um3",
    "num/day": "{#}/d",
    "{#}/d": "{#}/d",
    "num/ml": "{#}/mL",
    "platelets/ml": "{#}/mL",
    "{#}/ml": "{#}/mL",
    "num/ul": "{#}/uL",
    "number/microl": "{#}/uL",
    "{#}/ul": "{#}/uL",
    "beatsperminute": "{beats}/min",
    "beats/minute": "{beats}/min",
    "beats": "{beats}/min",
    "beats/min": "{beats}/min",
    "beatspermin": "{beats}/min",
    "bpm": "{beats}/min",
    "{beats}/min": "{beats}/min",
    "breaths/min": "{breath}/min",
    "{breath}/min": "{breath}/min",
    "kcell/mcl": "{cells}/uL",
    "kcell/ul": "{cells}/uL",
    "cells/ul": "{cells}/uL",
    "{cells}/ul": "{cells}/uL",
    "cigarettesperday": "{cigarettes}/d",
    "cigarette/day": "{cigarettes}/d",
    "cigarettes/day": "{cigarettes}/d",
    "{cigarettes}/d": "{cigarettes}/d",
    "events/hr": "{events}/h",
    "#/hr": "{events}/h",
    "events/hour": "{events}/h",
    "{events}/h": "{events}/h",
    "ratio": "{ratio}",
    "{ratio}": "{ratio}",
    "scale": "{score}",
    "score": "{score}",
    "{score}": "{score}",
    "1serving": "{servings}",
    "drinks": "{servings}",
    "servings": "{servings}",
    "{servings}": "{servings}",
    "servings/day": "{servings}/d",
    "{servings}/d": "{servings}/d",
    "servings/week": "{servings}/wk",
    "drinks/week": "{servings}/wk",
    "servingsperweek": "{servings}/wk",
    "{servings}/wk": "{servings}/wk",
}


def fold(text: str) -> str:
    return text.lower().replace(" ", "")


def unit_aliases() -> dict[str, str]:
    """Folded spelling -> canonical unit."""
    return dict(UNIT_ALIASES)


def alias_table(spark: SparkSession, aliases: dict[str, str] | None = None) -> DataFrame:
    """The alias table as a DataFrame(alias, canonical)."""
    rows = sorted((unit_aliases() if aliases is None else aliases).items())
    return local_frame(spark, rows, "alias string, canonical string")


def folded_unit(c: Column) -> Column:
    """Lower case, no spaces; null reads as empty."""
    return F.replace(F.lower(F.coalesce(c, F.lit(""))), F.lit(" "), F.lit(""))


def normalize_units(df: DataFrame, column: str, aliases: DataFrame | None = None) -> DataFrame:
    """Replace ``column`` by its canonical unit.

    An unknown spelling keeps its folded form; ``none`` means no unit. The
    default alias table is fixed at about 200 rows, so it is broadcast; a
    caller's own table is left to Spark's size check.
    """
    table = F.broadcast(alias_table(df.sparkSession)) if aliases is None else aliases
    table = table.select(F.col("alias").alias("__alias"), F.col("canonical").alias("__canonical"))
    keyed = df.withColumn("__fold", folded_unit(F.col(f"`{column}`")))
    canonical = F.coalesce("__canonical", "__fold")
    value = F.when(canonical == "none", F.lit("")).otherwise(canonical)
    joined = keyed.join(table, keyed["__fold"] == table["__alias"], "left")
    return joined.select(*[value.alias(c) if c == column else F.col(f"`{c}`") for c in df.columns])


# Unit code, dimension, size in the base unit of the dimension,
# and where zero lies (temperatures only). Sizes follow the UCUM tables.
UNIT_SIZES = """
m	length	1
km	length	1000
dm	length	0.1
cm	length	0.01
mm	length	0.001
um	length	0.000001
nm	length	0.000000001
[in_i]	length	0.0254
[ft_i]	length	0.3048
[yd_i]	length	0.9144
[mi_i]	length	1609.344
[in_us]	length	100/3937
[ft_us]	length	1200/3937
g	mass	1
kg	mass	1000
mg	mass	0.001
ug	mass	0.000001
ng	mass	0.000000001
pg	mass	0.000000000001
[lb_av]	mass	453.59237
[oz_av]	mass	28.349523125
L	volume	1
dL	volume	0.1
mL	volume	0.001
uL	volume	0.000001
fL	volume	0.000000000000001
[cup_us]	volume	0.2365882365
[tbs_us]	volume	0.01478676478125
s	time	1
ms	time	0.001
cs	time	0.01
min	time	60
h	time	3600
d	time	86400
wk	time	604800
mo	time	2629800
a	time	31557600
K	temperature	1
Cel	temperature	1	273.15
[degF]	temperature	5/9	2298.35/9
Pa	pressure	1
kPa	pressure	1000
mm[Hg]	pressure	133.322387415
mol	amount	1
mmol	amount	0.001
umol	amount	0.000001
nmol	amount	0.000000001
pmol	amount	0.000000000001
eq	equivalents	1
meq	equivalents	0.001
[IU]	activity	1
m[IU]	activity	0.001
u[IU]	activity	0.000001
V	potential	1
mV	potential	0.001
uV	potential	0.000001
{ratio}	share	1
%	share	0.01
"""
# Everyday spellings accepted in a conversion.
CONVERSION_SPELLINGS = {"in": "[in_i]", "ft": "[ft_i]", "lb": "[lb_av]", "lbs": "[lb_av]", "oz": "[oz_av]"}


def _fraction(text: str) -> Fraction:
    top, _, bottom = text.partition("/")
    return Fraction(top) / Fraction(bottom or 1)


def _unit_sizes() -> dict[str, tuple[str, Fraction, Fraction]]:
    table = {}
    for line in UNIT_SIZES.strip().splitlines():
        code, dimension, size, *zero = line.split("\t")
        table[code] = (dimension, _fraction(size), _fraction(zero[0]) if zero else Fraction(0))
    return table


_SIZES = _unit_sizes()


def _size_of(unit: str) -> tuple[str, Fraction, Fraction]:
    unit = CONVERSION_SPELLINGS.get(unit, unit)
    if unit in _SIZES:
        return _SIZES[unit]
    if "/" in unit:
        top, _, bottom = unit.rpartition("/")
        (dim_t, size_t, zero_t), (dim_b, size_b, zero_b) = _size_of(top), _size_of(bottom)
        if not zero_t and not zero_b:
            return f"{dim_t}/{dim_b}", size_t / size_b, Fraction(0)
    power = re.fullmatch(r"(.+?)([23])", unit)
    if power and power[1] in _SIZES and not _SIZES[power[1]][2]:
        dimension, size, _ = _SIZES[power[1]]
        return dimension + power[2], size ** int(power[2]), Fraction(0)
    raise SpecError(f"unknown unit {unit!r}")


def conversion(source: str, target: str) -> tuple[float, float]:
    """(factor, offset) with ``target_value = source_value * factor + offset``."""
    if source == target:
        return 1.0, 0.0
    dim_s, size_s, zero_s = _size_of(source)
    dim_t, size_t, zero_t = _size_of(target)
    if dim_s != dim_t:
        raise SpecError(f"cannot convert {source!r} ({dim_s}) to {target!r} ({dim_t})")
    return float(size_s / size_t), float((zero_s - zero_t) / size_t)


def convert(value: Column, source: str, target: str) -> Column:
    """A double column converted from one unit to another."""
    factor, offset = conversion(source, target)
    scaled = value * F.lit(factor)
    return scaled if offset == 0.0 else scaled + F.lit(offset)
