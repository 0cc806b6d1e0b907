"""Vehicle-limit tag values: classes, units and fixed-point forms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the limit vocabulary.
NO_LIMIT = ("default", "none", "unsigned", "no", "no-limit", "nolimit", "unlimited")
UNKNOWN = ("below_default",)
DROPPED = ("yes", "unknown", "fixme", "null", "nan")
LENGTH_UNITS = {"m": 1.0, "meter": 1.0, "meters": 1.0, "metre": 1.0, "metres": 1.0, "cm": 0.01, "mm": 0.001, "ft": 0.3048, "feet": 0.3048, "'": 0.3048, "in": 0.0254, "inch": 0.0254, "inches": 0.0254, '"': 0.0254}
WEIGHT_UNITS = {"t": 1.0, "ton": 1.0, "tons": 1.0, "tonne": 1.0, "tonnes": 1.0, "mgw": 1.0, "mt": 1.0, "kg": 0.001, "lb": 0.00045359237, "lbs": 0.00045359237, "pound": 0.00045359237, "pounds": 0.00045359237}

FEET, INCHES = ("ft", "feet", "'"), ("", "in", "inch", "inches", '"')


def _pieces(s: Column) -> tuple[Column, Column, Column]:
    """The number that a lower-case value starts with (null if none), the word or quote after it, and what is left."""
    digits = F.regexp_extract(s, r"^-?[0-9][0-9.,]*", 0)
    behind = F.trim(F.substr(s, F.length(digits) + 1))
    unit = F.regexp_extract(behind, r"^[a-z]+|^['\"]+", 0)
    number = F.when(F.right(digits, F.lit(1)).between("0", "9"), F.translate(digits, ",", ".").try_cast("double"))
    return number, unit, F.trim(F.substr(behind, F.length(unit) + 1))


def _measure(s: Column, units: dict[str, float], default: str) -> Column:
    number, unit, left = _pieces(s)
    factors = F.create_map(*[F.lit(x) for kv in units.items() for x in kv])
    return F.when((left == "") & (number > 0), number * F.try_element_at(factors, F.when(unit == "", default).otherwise(unit)))


def _length(s: Column) -> Column:
    """Feet, of either sign, may be followed by inches; any other length is one number above 0 and a unit, metres if none."""
    low = F.lower(s)
    feet, unit, left = _pieces(low)
    inches, mark, more = _pieces(left)
    both = unit.isin(*FEET) & feet.isNotNull() & (inches >= 0) & mark.isin(*INCHES) & (more == "")
    alone = unit.isin(*FEET) & feet.isNotNull() & (left == "") & ~F.contains(low, F.lit(","))
    return F.when(both, feet * LENGTH_UNITS["ft"] + inches * LENGTH_UNITS["in"]).when(alone, feet * LENGTH_UNITS["ft"]).otherwise(_measure(low, LENGTH_UNITS, "m"))


def _weight(s: Column) -> Column:
    return _measure(F.lower(s), WEIGHT_UNITS, "t")


#: Class of a value that is one of the vocabulary's words.
WORDS = {"": "empty"} | dict.fromkeys(NO_LIMIT, "non_numeric_no_limit") | dict.fromkeys(UNKNOWN, "unknown_value") | dict.fromkeys(DROPPED, "unparseable")


def value_class(raw: Column) -> Column:
    """A word of the vocabulary has its class; a value without condition or list that measures something is numeric."""
    s = F.trim(F.coalesce(raw, F.lit("")))
    word = F.try_element_at(F.create_map(*[F.lit(x) for kv in WORDS.items() for x in kv]), F.lower(s))
    plain = ~s.rlike("[@;]") & F.coalesce(_length(s), _weight(s)).isNotNull()
    return F.coalesce(word, F.when(plain, "numeric"), F.lit("unparseable"))


def length_metres(raw: Column) -> Column:
    return F.when(value_class(raw) == "numeric", _length(F.trim(raw)))


def weight_tonnes(raw: Column) -> Column:
    return F.when(value_class(raw) == "numeric", _weight(F.trim(raw)))


def hundredths(value: Column) -> Column:
    """Half-even hundredths in 0..65535: centimetres, or units of 10 kg."""
    return F.least(F.greatest(F.bround(value * 100, 0), F.lit(0.0)), F.lit(65535.0)).cast("int")


def limit_columns(tags: dict[str, Column]) -> dict[str, Column]:
    """The six limits, 0 where there is none."""
    out = {f"max_{k}_cm": length_metres(tags[f"max{k}"]) for k in ("height", "width", "length")}
    out |= {"max_weight_10kg": weight_tonnes(tags["maxweight"]), "max_axleload_10kg": weight_tonnes(tags["maxaxleload"]), "max_bogie_10kg": weight_tonnes(tags["maxbogieweight"])}
    return {k: F.coalesce(hundredths(c), F.lit(0)) for k, c in out.items()}


def way_class(raws: list[Column]) -> Column:
    """Of all limit tags of a way: numeric, unknown_value, unparseable, then no limit."""
    classes = F.filter(F.array(*[value_class(r) for r in raws]), lambda c: c != "empty")
    has = lambda c: F.array_contains(classes, c)
    return F.when(F.size(classes) == 0, "unparseable").when(has("numeric"), "numeric").when(has("unknown_value"), "unknown_value").when(has("unparseable"), "unparseable").otherwise("non_numeric_no_limit")


def parsed(values: DataFrame, raw: str) -> DataFrame:
    """``values`` with class, length_m and weight_t of a column of strings: ``value_class``, ``length_metres`` and
    ``weight_tonnes``, each piece of a value in a column of its own, so nothing is taken apart twice."""
    df = values.withColumn("__s", F.trim(F.coalesce(F.col(raw), F.lit("")))).withColumn("__low", F.lower("__s"))
    for i, source in (("1", "__low"), ("2", "__left1")):
        c = lambda k, i=i: F.col(f"__{k}{i}")
        df = df.withColumn(f"__digits{i}", F.regexp_extract(source, r"^-?[0-9][0-9.,]*", 0)).withColumn(f"__behind{i}", F.trim(F.substr(source, F.length(c("digits")) + 1)))
        df = df.withColumns({f"__unit{i}": F.regexp_extract(c("behind"), r"^[a-z]+|^['\"]+", 0), f"__number{i}": F.when(F.right(c("digits"), F.lit(1)).between("0", "9"), F.translate(c("digits"), ",", ".").try_cast("double"))})
        df = df.withColumn(f"__left{i}", F.trim(F.substr(c("behind"), F.length(c("unit")) + 1)))
    number, unit, left, inches = F.col("__number1"), F.col("__unit1"), F.col("__left1"), F.col("__number2")

    def measure(units: dict[str, float], default: str) -> Column:
        factors = F.create_map(*[F.lit(x) for kv in units.items() for x in kv])
        return F.when((left == "") & (number > 0), number * F.try_element_at(factors, F.when(unit == "", default).otherwise(unit)))

    both = unit.isin(*FEET) & number.isNotNull() & (inches >= 0) & F.col("__unit2").isin(*INCHES) & (F.col("__left2") == "")
    alone = unit.isin(*FEET) & number.isNotNull() & (left == "") & ~F.contains("__low", F.lit(","))
    length = F.when(both, number * LENGTH_UNITS["ft"] + inches * LENGTH_UNITS["in"]).when(alone, number * LENGTH_UNITS["ft"]).otherwise(measure(LENGTH_UNITS, "m"))
    df = df.withColumns({"length_m": length, "weight_t": measure(WEIGHT_UNITS, "t")})
    word = F.try_element_at(F.create_map(*[F.lit(x) for kv in WORDS.items() for x in kv]), F.col("__low"))
    plain = ~F.col("__s").rlike("[@;]") & F.coalesce("length_m", "weight_t").isNotNull()
    df = df.withColumn("class", F.coalesce(word, F.when(plain, "numeric"), F.lit("unparseable")))
    numeric = lambda k: F.when(F.col("class") == "numeric", F.col(k))
    return df.select(*values.columns, "class", numeric("length_m").alias("length_m"), numeric("weight_t").alias("weight_t"))
