"""Declarative specs: features, composites, rules, bands, presets.

A preset is configuration only; every operator takes the columns it works
on from a spec, so the same operators run on any entity table.
"""

from __future__ import annotations

from dataclasses import dataclass, field


# ---- level-1 features (no fitted state) ----------------------------------

@dataclass(frozen=True)
class Ratio:
    """Safe ratio num / den, undefined -> fill."""
    name: str
    num: str
    den: str
    fill: float = 0.0


@dataclass(frozen=True)
class Log1p:
    """X5 + X6: log(1 + max(x, 0))."""
    name: str
    source: str


@dataclass(frozen=True)
class Abs:
    """|x|."""
    name: str
    source: str


@dataclass(frozen=True)
class Gap:
    """max(a - b, 0), missing stays missing."""
    name: str
    a: str
    b: str


# ---- level-2 features (z-scores of fitted stats) -------------------------

@dataclass(frozen=True)
class ZTerm:
    """One z-scored term. ``source`` may list fallbacks: the first present
    column is used. ``reverse`` = (top, fill) z-scores ``top - fillna(x, fill)``
    (X8) instead of x. ``sign`` -1 negates the term inside a row mean."""
    source: tuple[str, ...]
    sign: float = 1.0
    reverse: tuple[float, float] | None = None

    @staticmethod
    def of(*source: str, sign: float = 1.0, reverse: tuple[float, float] | None = None) -> "ZTerm":
        return ZTerm(tuple(source), sign, reverse)


@dataclass(frozen=True)
class ZIndex:
    """A composite of z-scored terms.

    combine:
      "signed"  X10: mean(positive) - mean(negative), each skipping missing
                terms, an absent side counting as 0;
      "mean"    X4: mean of all (signed) terms skipping missing;
      "pair"    X9: arithmetic mean of all terms, missing propagates.
    require: which inputs must exist for the feature to be built:
      "any" (some term), "positive" (some positive term), "all" (every term).
    """
    name: str
    positive: tuple[ZTerm, ...]
    negative: tuple[ZTerm, ...] = ()
    combine: str = "signed"
    require: str = "any"
    null_if_empty: bool = False  # both sides absent -> NULL column


Feature = Ratio | Log1p | Abs | Gap | ZIndex


@dataclass(frozen=True)
class RuleSpec:
    """M5: a threshold rule producing a driver message. Missing input counts
    as ``absent_as`` (the reference reads absent keys as 0)."""
    column: str
    op: str  # ">" or "<"
    threshold: float
    message: str
    absent_as: float = 0.0


@dataclass(frozen=True)
class BandSpec:
    """M3 / X11: KPI level from thresholds checked in order."""
    name: str
    source: str
    cuts: tuple[tuple[float, str], ...]
    otherwise: str
    descending: bool = True


@dataclass(frozen=True)
class RangeSpec:
    """M8: allowed input range and default."""
    column: str
    low: float
    high: float
    default: float


@dataclass(frozen=True)
class IndicatorPreset:
    key: str
    target: str = "stability_label"
    score: str = "stability_score"
    drop_columns: tuple[str, ...] = ()
    exclude_keys: tuple[str, ...] = ()
    rename_map: tuple[tuple[str, str], ...] = ()
    numeric_groups: tuple[tuple[str, tuple[str, ...]], ...] = ()
    missing_flag_columns: tuple[str, ...] = ()
    features: tuple[Feature, ...] = ()
    score_spec: ZIndex | None = None
    leaky_extra: tuple[str, ...] = ()
    class_labels: tuple[tuple[int, str], ...] = ((0, "Stable"), (1, "Watch"), (2, "At-Risk"))
    class_text: tuple[tuple[int, str], ...] = ()
    rules: tuple[RuleSpec, ...] = ()
    default_drivers: tuple[tuple[int, str], ...] = ()
    bands: tuple[BandSpec, ...] = ()
    ranges: tuple[RangeSpec, ...] = ()
    n_classes: int = 3
    seed: int = 42
    test_fraction: float = 0.2
    n_folds: int = 5
    extras: dict = field(default_factory=dict, hash=False, compare=False)
