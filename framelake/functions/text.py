"""Small text columns of reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from framelake import fixed
from framelake.functions.messages import taxonomy_map


def millify(n: Column) -> Column:
    """A number by its thousands, rounded half to even: 1500000 as '2 M'."""
    n = n.cast("double")
    power = F.when(n == 0, F.lit(0.0)).otherwise(F.floor(F.log10(F.abs(n)) / 3))
    index = F.greatest(F.lit(0), F.least(F.lit(len(fixed.MAGNITUDES) - 1), power.cast("int")))
    scaled = F.bround(n / F.pow(F.lit(10.0), 3 * index), 0)
    digits = scaled.cast("decimal(38,0)").cast("string")
    sign = F.when((n < 0) & (scaled == 0), F.lit("-")).otherwise(F.lit(""))
    return F.concat(sign, digits, F.get(F.array(*[F.lit(m) for m in fixed.MAGNITUDES]), index))


def state_abbrev(name: Column) -> Column:
    """Two-letter code of a US state name; null for other names."""
    return F.try_element_at(taxonomy_map(fixed.STATE_CODES), name)


def box_label(name: Column, score: Column | None, skip_labels: bool = False, skip_scores: bool = False) -> Column:
    """Label of a box: name with percentage, name only, percentage only, or N/A for an unknown class."""
    shown = F.lit("") if skip_labels else F.coalesce(name, F.lit("N/A"))
    if skip_scores or score is None:
        return shown
    percent = F.concat((score * 100).cast("int").cast("string"), F.lit("%"))
    return percent if skip_labels else F.concat(shown, F.lit(": "), percent)


def box_colour(class_id: Column, is_keyframe: Column) -> Column:
    """Palette colour of a class; red on keyframes."""
    palette = fixed.BOX_COLOURS
    colours = F.array(*[F.lit(c) for c in palette])
    return F.when(is_keyframe, F.lit("Red")).otherwise(F.get(colours, F.pmod(class_id, F.lit(len(palette))).cast("int")))
