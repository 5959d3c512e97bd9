"""Column functions on text."""

from __future__ import annotations

import math
from fractions import Fraction

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridledger.lookup import PLAIN_CHARACTERS, UNSET


def _whole(x: Column, unit: float) -> Column:
    """Whole units below a volume, cut towards zero."""
    return (x * F.lit(unit)).cast("bigint")


def _roundings() -> list[float]:
    """For each tenth from 1.0 on the smallest double that rounds up from it: ties of the exact value go to the even tenth."""
    out = []
    for tenth in range(10, 100):
        middle = Fraction(2 * tenth + 1, 20)
        nearest = float(middle)
        up = Fraction(nearest) > middle or (Fraction(nearest) == middle and tenth % 2 == 1)
        out.append(nearest if up else math.nextafter(nearest, math.inf))
    return out


def one_decimal(x: Column) -> Column:
    """A number from 1 to 10 with one decimal, rounded by its exact binary value."""
    tenths = F.lit(10) + F.size(F.filter(F.array(*[F.lit(t) for t in _roundings()]), lambda t: t <= x))
    return F.format_string("%d.%d", F.floor(tenths / 10).cast("int"), tenths % 10)


def volume_label(x: Column, largest: str = "") -> Column:
    """Readable volume: M below 1e9, G below 1e12, T below 1e15, P below 1e18, else billions with separators.

    ``largest`` is what marks those billions: nothing, or ``B`` in the tables of projects.
    """
    return (
        F.when(x < 1e9, F.concat(_whole(x, 1e-6).cast("string"), F.lit("M")))
        .when(x < 1e12, F.concat(_whole(x, 1e-9).cast("string"), F.lit("G")))
        .when(x < 1e13, F.concat(one_decimal(x * F.lit(1e-12)), F.lit("T")))
        .when(x < 1e15, F.format_string("%3dT", _whole(x, 1e-12)))
        .when(x < 1e18, F.format_string("%3dP", _whole(x, 1e-15)))
        .otherwise(F.concat(F.format_number(x * F.lit(1e-9), 2), F.lit(largest)))
    )


def selection_label(names: Column) -> Column:
    """A single name as it is; several as their sorted two-letter lower-case beginnings joined by dots."""
    short = F.transform(F.array_sort(F.transform(names, F.lower)), lambda n: F.substring(n, 1, 2))
    return F.when(F.size(names) == 1, F.element_at(names, 1)).otherwise(F.array_join(short, "."))


def first_word(text: Column) -> Column:
    """First of several realms."""
    return F.get(F.split(text, " "), F.lit(0))


def frequency_realm(frequency: Column, realm: Column) -> Column:
    return F.concat_ws(".", frequency, first_word(realm))


def plain_text(text: Column, for_script: bool = False) -> Column:
    """Typographic characters in plain form; ``for_script`` also turns quotes and line ends into safe ones."""
    single = {k: v for k, v in PLAIN_CHARACTERS.items() if len(v) == 1}
    out = F.translate(text, "".join(single), "".join(single.values()))
    for k, v in PLAIN_CHARACTERS.items():
        if len(v) > 1:
            out = F.replace(out, F.lit(k), F.lit(v))
    if for_script:
        out = F.replace(F.replace(out, F.lit('"'), F.lit("'")), F.lit("\n"), F.lit(";;"))
    return out


def markup_links(text: Column, base: str) -> Column:
    """``{name}`` becomes a link to the page of that section, ``[http… words]`` a link to that address.

    As in the catalogue pages, the bracket form reaches to the last closing bracket of its line.
    """
    out = F.regexp_replace(text, r"\{([a-zA-Z]*)\}", f"<a href={base}$1.html>$1</a>")
    return F.regexp_replace(out, r"\[(http\S*)\s+(.*)\]", "<a href=$1>$2</a>")


def escape_markup(text: Column) -> Column:
    out = F.replace(text, F.lit('"'), F.lit("&quot;"))
    out = F.replace(out, F.lit("<"), F.lit("&lt;"))
    return F.replace(out, F.lit(">"), F.lit("&gt;"))


def hover_title(description: Column, title: Column, label: Column) -> Column:
    """Description, else title, else label, escaped; blank and unset texts do not count."""
    real = lambda c: F.when(~F.trim(c).isin("", UNSET), c)
    return escape_markup(F.coalesce(real(description), real(title), label))


def reference_link(uid: Column, label: Column, title: Column, folder: str = "./") -> Column:
    return F.concat(F.lit('<span title="'), title, F.lit(f'"><a href="{folder}'), uid.cast("string"),
                    F.lit('.html">'), label, F.lit("</a></span>"))


def section_sort_key(title: Column) -> Column:
    """Sort key of a dotted section number at the start of a title: whole-number parts padded to three digits."""
    parts = F.split(F.get(F.split(F.trim(title), r"\s+"), F.lit(0)), r"\.")
    pad = lambda p: F.when(p.rlike(r"^-?[0-9]+$") & (F.length(p) < 3), F.lpad(p, 3, "0")).otherwise(p)
    return F.when(F.size(parts) == 2, F.transform(parts, pad)).when(
        F.size(parts) == 1, F.array(F.get(parts, F.lit(0)), F.lit("0"))).otherwise(parts)


def table_class(name: Column) -> Column:
    """Order of tables: ordinary ones, then those beginning with em, then the annex ones."""
    long_annex = F.substring(name, 1, 5).isin("CMIP5", "CORDE", "SPECS") & (F.length(name) > 5)
    return F.when(long_annex, 2).when(name.startswith("em") & (F.length(name) > 2), 1).otherwise(0).cast("bigint")
