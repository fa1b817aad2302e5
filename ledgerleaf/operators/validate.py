"""Standard formats, required fields, length limits and per-source rules."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ledgerleaf import schemas
from ledgerleaf.functions import text as X

from .joins import join_reduced


def _label(path: str) -> str:
    return path.rsplit(".", 1)[-1]


@dataclass(frozen=True)
class ValidationRules:
    """Blank ``fatal`` fields make a record invalid, other blank ``required`` ones partial.

    Fields are column paths; error rows name them by their last step.
    """

    fatal: tuple[str, ...] = ("name",)
    required: tuple[str, ...] = ("address.street", "address.city", "contact.phone")
    limits: Mapping[str, int] = field(default_factory=lambda: dict(schemas.LENGTH_LIMITS))

    def status(self) -> Column:
        bad, gap = F.lit(False), F.lit(False)
        for f in self.fatal:
            bad = bad | X.is_blank(f)
        for f in self.required:
            gap = gap | X.is_blank(f)
        return F.when(bad, "invalid").when(gap, "partial").otherwise("valid")

    def errors(self) -> Column:
        """``array<struct<field, code>>`` in a fixed order: missing fields, then long ones."""
        found = [
            F.when(X.is_blank(f), _error(f, "missing")) for f in (*self.fatal, *self.required)
        ] + [F.when(X.too_long(f, n), _error(f, "too_long")) for f, n in self.limits.items()]
        return F.filter(F.array(*found), lambda e: e.isNotNull())


def _error(path: str, code: str) -> Column:
    return F.struct(F.lit(_label(path)).alias("field"), F.lit(code).alias("code"))


def validate(df: DataFrame, rules: ValidationRules = ValidationRules()) -> DataFrame:
    return df.withColumns({"validation_status": rules.status(), "validation_errors": rules.errors()})


def error_rows(df: DataFrame, key: str, rules: ValidationRules) -> DataFrame:
    """One row per (record, field, code)."""
    return df.select(key, F.explode(rules.errors()).alias("_e")).select(key, "_e.field", "_e.code")


def length_rejects(df: DataFrame, key: str, column: str, limit: int) -> DataFrame:
    """Records whose text is longer than the column allows, with its length."""
    n = F.char_length(F.col(column)).cast("bigint")
    return df.select(key, n.alias("length")).where(F.col("length") > limit)


def standardize(df: DataFrame) -> DataFrame:
    """Cleaned records with clean text in every text field and phones in one format."""
    return df.withColumns({
        "name": X.clean_text("name"),
        "category": X.clean_text("category"),
        "address": F.struct(
            X.clean_text("address.street").alias("street"), X.clean_text("address.city").alias("city")
        ),
        "contact": F.struct(
            X.standard_phone("contact.phone").alias("phone"), X.clean_text("contact.hours").alias("hours")
        ),
    })


SourceRules = Mapping[str, Mapping[str, Callable[[Column], Column]]]


def apply_source_rules(df: DataFrame, rules: SourceRules, source: str = "source") -> DataFrame:
    """Per-source column rules: {source name: {column: column -> column}} in one projection."""
    out: dict[str, Column] = {}
    for name, changes in rules.items():
        for c, change in changes.items():
            out[c] = F.when(F.col(source) == name, change(F.col(c))).otherwise(out.get(c, F.col(c)))
    return df.withColumns(out) if out else df


#: What a stored rule may do to a text; ``step`` has the fields ``op``, ``pattern`` and ``value``.
STEPS: Mapping[str, Callable[[Column, Mapping], Column]] = {
    "clean": lambda c, step: X.clean_text(c),
    "upper": lambda c, step: F.upper(c),
    "lower": lambda c, step: F.lower(c),
    "phone": lambda c, step: X.standard_phone(c),
    "replace": lambda c, step: F.regexp_replace(c, step["pattern"] or "", step["value"] or ""),
    "extract": lambda c, step: F.nullif(F.regexp_extract(c, step["pattern"] or "", 0), F.lit("")),
    "constant": lambda c, step: F.lit(step["value"]),
    "default": lambda c, step: F.when(X.is_blank(c), F.lit(step["value"])).otherwise(c),
    "null_if": lambda c, step: F.nullif(c, F.lit(step["value"])),
}
CONFIG = "rules map<string, array<struct<op: string, pattern: string, value: string>>>"


def apply_stored_rules(df: DataFrame, sources: DataFrame, key: str = "source_id", source_key: str = "id",
                       config: str = "config") -> DataFrame:
    """Records with the rules of their source applied, all sources in one projection.

    A source's configuration is JSON text: ``{"rules": {"address.city": [{"op": "clean"}, ...]}}``, a
    list of `STEPS` per text column, in order.  Only the different lists come to the driver, where they
    are compiled to column expressions; which source has which stays a joined column.  Sources without
    readable rules, unknown sources and NULL ones change nothing.  Unknown steps and columns fail
    here, before any row is read.
    """
    rules = F.from_json(F.col(config), CONFIG)["rules"]
    mine = sources.groupBy(F.col(source_key).alias(key)).agg(F.min(config).alias(config)).select(
        key, F.map_filter(rules, lambda c, steps: F.size(steps) > 0).alias("_rules")).where(F.size("_rules") > 0)
    lists = mine.select(F.explode("_rules").alias("path", "steps")).distinct().collect()
    if not lists:
        return df
    texts = _text_paths(df)
    chosen: dict[str, Column] = {}
    for path, steps in sorted(lists):
        wrong = [s["op"] for s in steps if s["op"] not in STEPS]
        if path not in texts or wrong:
            raise ValueError(f"source rules name {f'the step {wrong[0]}' if wrong else f'{path}, which is no text column'}")
        value = F.col(path)
        for step in steps:
            value = STEPS[step["op"]](value, step)
        same = F.array(*[F.struct(*[F.lit(v).cast("string").alias(n) for n, v in s.asDict().items()]) for s in steps])
        chosen[path] = F.when(F.col("_rules")[path] == same, value).otherwise(chosen.get(path, F.col(path)))
    out: dict[str, Column] = {}
    for path, value in chosen.items():
        column, _, inner = path.partition(".")
        out[column] = out.get(column, F.col(column)).withField(inner, value) if inner else value
    return join_reduced(df, mine, key, "left").withColumns(out).select(*df.columns)


def _text_paths(df: DataFrame) -> set[str]:
    """Text columns, and the text fields of struct columns as ``column.field``."""
    texts = {f.name for f in df.schema if isinstance(f.dataType, T.StringType)}
    structs = [f for f in df.schema if isinstance(f.dataType, T.StructType)]
    return texts | {f"{f.name}.{g.name}" for f in structs for g in f.dataType if isinstance(g.dataType, T.StringType)}
