"""Names, labels and keys as built-in column expressions (all inside codegen)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def snake(name: Column) -> Column:
    """AuthService, auth-svc, "Auth Service" in one form: words joined by "_", lower case."""
    s = F.regexp_replace(name, r"([a-z0-9])([A-Z])", "$1_$2")
    s = F.regexp_replace(s, r"([A-Z]+)([A-Z][a-z])", "$1_$2")
    s = F.regexp_replace(s, r"[\s\-/]+", "_")
    return F.lower(F.trim(F.regexp_replace(s, r"_+", "_"), F.lit("_")))


def kebab(name: Column) -> Column:
    return F.translate(snake(name), "_", "-")


#: Modes of canonical names.
MODES: dict[str, Callable[[Column], Column]] = {"snake": snake, "lower": F.lower, "kebab": kebab, "none": lambda c: c}


def canonical(name: Column, mode: str = "snake") -> Column:
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}; one of {', '.join(MODES)}")
    return MODES[mode](name)


def dotted_rollup(name: Column, depth: int | None) -> Column:
    """The first `depth` components of a dotted name, or its last one."""
    parts = F.split(name, r"\.")
    return F.element_at(parts, -1) if depth is None else F.array_join(F.slice(parts, 1, depth), ".")


def module_name(path: Column) -> Column:
    """pkg/sub/mod.py as pkg.sub.mod; a package's own file is the package."""
    s = F.regexp_replace(path, r"\.py$", "")
    return F.translate(F.regexp_replace(s, r"/__init__$", ""), "/", ".")


def zero_id(span_id: Column) -> Column:
    """Whether an id is empty or only zeros, in hex or base64 digits."""
    return F.regexp_like(F.rtrim(F.coalesce(span_id, F.lit("")), F.lit("=")), F.lit("^[0A]*$"))


def bar(value: Column, steps: int = 20) -> Column:
    n = F.least(F.greatest(F.floor(value * steps), F.lit(0)), F.lit(steps)).cast("int")
    return F.concat(F.repeat(F.lit("█"), n), F.repeat(F.lit("░"), F.lit(steps) - n))


def category_label(category: Column) -> Column:
    return F.upper(F.translate(category, "_", " "))


def short(name: Column, width: int = 35) -> Column:
    return F.when(F.length(name) > width, F.concat(F.substring(name, 1, width - 3), F.lit("..."))).otherwise(name)


def edge_set_key(src: Column, dst: Column) -> Column:
    """An aggregate: one key for a set of edges in whatever order, weights aside."""
    return F.sha2(F.to_json(F.sort_array(F.collect_set(F.struct(src.alias("s"), dst.alias("d"))))), 256)
