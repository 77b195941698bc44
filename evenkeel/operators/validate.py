"""Input normalisation and rule-table validation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from evenkeel.contract import require_columns
from evenkeel.functions.numeric import nan_to_null


@dataclass(frozen=True)
class Rule:
    """One column's rule. Bounds are inclusive; ``above`` is a strict lower bound."""

    column: str
    low: float | None = None
    high: float | None = None
    above: float | None = None
    domain: tuple[str, ...] | None = None
    required: bool = False
    whole: bool = False

    @property
    def numeric(self) -> bool:
        return self.whole or any(x is not None for x in (self.low, self.high, self.above))

    def failures(self, kind: str) -> list[tuple[str, Column]]:
        """Messages with their conditions for a column of type ``kind``. NaN and empty text are missing."""
        given = F.col(self.column)
        if kind in ("double", "float"):
            given = nan_to_null(given)
        missing = given.isNull() | (F.trim(given.cast("string")) == "") if kind == "string" else given.isNull()
        out = []
        if self.required:
            out.append((f"{self.column}: missing", missing))
        c = given
        if self.numeric and kind == "string":
            c = nan_to_null(given.try_cast("double"))
            nan = F.lower(F.trim(given)) == "nan"
            out.append((f"{self.column}: Must be a number", c.isNull() & ~missing & ~nan))
            if self.required:
                out[0] = (out[0][0], missing | nan)
        if self.low is not None:
            out.append((f"{self.column}: Must be >= {self.low}", c < self.low))
        if self.above is not None:
            out.append((f"{self.column}: Must be > {self.above}", c <= self.above))
        if self.high is not None:
            out.append((f"{self.column}: Must be <= {self.high}", c > self.high))
        if self.whole:
            out.append((f"{self.column}: Must be a whole number", c != F.floor(c)))
        if self.domain is not None:
            out.append((f"{self.column}: Unknown value", ~c.isin(list(self.domain))))
        return out


# Request limits of the scoring interface.
REQUEST_RULES = (
    Rule("bedrooms", low=0, high=20, required=True, whole=True),
    Rule("bathrooms", low=0, high=20, required=True),
    Rule("living_area", above=0, required=True),
    Rule("latitude", low=-90, high=90),
    Rule("longitude", low=-180, high=180),
    Rule("property_type", required=True),
)

# The narrower limits of the entry form.
FORM_RULES = (
    Rule("bedrooms", low=0, high=20, required=True),
    Rule("bathrooms", low=0.0, high=20.0, required=True),
    Rule("living_area", low=100.0, high=20000.0, required=True),
    Rule("latitude", low=35.5, high=36.5),
    Rule("longitude", low=-115.5, high=-114.5),
    Rule("property_type", required=True),
)


def located_rules(latitude: str = "latitude", longitude: str = "longitude") -> tuple[Rule, Rule]:
    """Coordinates required; add these to a rule set that runs after the backfill."""
    return Rule(latitude, required=True), Rule(longitude, required=True)


def rule_messages(df: DataFrame, rules: Sequence[Rule]) -> list[str]:
    """Every message that ``rules`` can give on the columns of ``df``."""
    kinds = dict(df.dtypes)
    return list(dict.fromkeys(message for rule in rules for message, _ in rule.failures(kinds[rule.column])))


def validate_rows(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add ``errors`` (array of messages) and ``valid``; no row is removed.

    A text that should be a number and isn't is an error of its row, never of the job.
    """
    require_columns(df, {r.column for r in rules}, "columns to validate")
    kinds = dict(df.dtypes)
    checks = [
        F.when(F.coalesce(bad, F.lit(False)), F.lit(message))
        for rule in rules
        for message, bad in rule.failures(kinds[rule.column])
    ]
    checked = df.withColumn("errors", F.array_compact(F.array(*checks)))
    return checked.withColumn("valid", F.size("errors") == 0)


def split_valid(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows, quarantined rows with their errors)."""
    good = checked.where("valid").drop("errors", "valid")
    return good, checked.where(~F.col("valid")).drop("valid")


def alias_rename(df: DataFrame, aliases: Mapping[str, str]) -> DataFrame:
    """Legacy names to contract names; where both exist a present contract value wins, then the alias.

    NaN isn't present.
    """
    kinds = dict(df.dtypes)
    for old, new in aliases.items():
        if old not in df.columns:
            continue
        if new in df.columns:
            own = nan_to_null(F.col(new)) if kinds[new] in ("double", "float") else F.col(new)
            df = df.withColumn(new, F.coalesce(own, F.col(old))).drop(old)
        else:
            df = df.withColumnRenamed(old, new)
    return df


def optional_defaults(df: DataFrame, defaults: Mapping[str, float | str]) -> DataFrame:
    """Add an absent optional column, fill a present one where it is missing (NULL or NaN)."""
    filled = {}
    for name, value in defaults.items():
        if name not in df.columns:
            filled[name] = F.lit(value)
        elif dict(df.dtypes)[name] in ("double", "float"):
            filled[name] = F.coalesce(F.nanvl(F.col(name), F.lit(None)), F.lit(value))
        else:
            filled[name] = F.coalesce(F.col(name), F.lit(value))
    return df.withColumns(filled)
