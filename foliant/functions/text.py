"""Column functions over text, evaluated in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from foliant.functions import rx

MASKED, CUT = "\x01", "\x02"


def sentences(text: Column) -> Column:
    """array<string>: the text cut after . ? ! and closing marks before a capital, digit or
    opening mark, but not after an abbreviation or initial. Null gives null."""
    t = F.regexp_replace(text, rx.MASK_ABBREVIATION, "$1" + MASKED)
    t = F.regexp_replace(t, rx.MASK_INITIAL, "$1" + MASKED)
    t = F.regexp_replace(t, rx.BREAK, "$1" + CUT + "$2")
    t = F.regexp_replace(t, MASKED, ".")
    return F.filter(F.transform(F.split(t, CUT), lambda s: F.trim(s)), lambda s: s != "")


def sentences_sql(text: str) -> str:
    """The same for DuckDB."""
    t = f"regexp_replace({text}, {rx.sql(rx.MASK_ABBREVIATION)}, '\\1' || chr(1), 'g')"
    t = f"regexp_replace({t}, {rx.sql(rx.MASK_INITIAL)}, '\\1' || chr(1), 'g')"
    t = f"regexp_replace({t}, {rx.sql(rx.BREAK)}, '\\1' || chr(2) || '\\2', 'g')"
    t = f"replace({t}, chr(1), '.')"
    return f"list_filter(list_transform(string_split({t}, chr(2)), lambda x: trim(x)), lambda x: x <> '')"


def found(text: Column, pattern: str, group: int = 1) -> Column:
    """array<string>: every match's group."""
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def found_sql(text: str, pattern: str, group: int = 1) -> str:
    return f"regexp_extract_all({text}, {rx.sql(pattern)}, {group})"


def strength(verb: Column) -> Column:
    out: Column | None = None
    for v, s in rx.STRENGTH.items():
        out = F.when(verb == v, s) if out is None else out.when(verb == v, s)
    assert out is not None
    return out


def strength_sql(verb: str) -> str:
    return "case " + verb + " " + " ".join(f"when '{v}' then '{s}'" for v, s in rx.STRENGTH.items()) + " end"


def squash(s: Column) -> Column:
    """Lower case, letters and digits only."""
    return F.regexp_replace(F.lower(s), "[^a-z0-9]", "")


def slug(s: Column) -> Column:
    """Lower case, runs of other signs as '-', cut to 48 and stripped; 'x' if nothing is left."""
    t = F.substring(F.regexp_replace(F.lower(s), "[^a-z0-9]+", "-"), 1, 48)
    t = F.regexp_replace(t, "^-+|-+$", "")
    return F.when(t == "", "x").otherwise(t)


def slug_sql(s: str) -> str:
    t = f"regexp_replace(substr(regexp_replace(lower({s}), '[^a-z0-9]+', '-', 'g'), 1, 48), '^-+|-+$', '', 'g')"
    return f"case when {t} = '' then 'x' else {t} end"


def bare(s: Column) -> Column:
    """A key without blanks, tabs and line ends around it."""
    return F.regexp_replace(s, r"^\s+|\s+$", "")


def bare_sql(s: str) -> str:
    return f"regexp_replace({s}, '^\\s+|\\s+$', '', 'g')"


def joined(a: Column, sep: str = "|") -> Column:
    return F.array_join(a, sep)
