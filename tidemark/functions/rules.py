"""Ordered keyword rules compiled into one JVM-side CASE expression.

A rule fires when the text contains *any* of ``any_of``, *all* of
``all_of`` and *none* of ``none_of`` (case-sensitive substrings, i.e.
``LIKE '%kw%'``). The first rule that fires wins; otherwise ``default``.
Compiled rules are plain ``Column`` expressions: they stay inside
whole-stage codegen and need no Python at run time.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numeric import col_


@dataclass(frozen=True)
class Rule:
    value: Any
    any_of: tuple = ()
    all_of: tuple = ()
    none_of: tuple = ()

    def condition(self, text: Column) -> Column:
        cond = None

        def _and(a, b):
            return b if a is None else (a & b)

        if self.any_of:
            anyc = None
            for kw in self.any_of:
                c = text.contains(kw)
                anyc = c if anyc is None else (anyc | c)
            cond = _and(cond, anyc)
        for kw in self.all_of:
            cond = _and(cond, text.contains(kw))
        for kw in self.none_of:
            cond = _and(cond, ~text.contains(kw))
        return F.lit(True) if cond is None else cond


def rule_case(text, rules: Sequence[Rule], default) -> Column:
    """First-match-wins CASE over ``rules``; ``default`` may be a Column."""
    t = col_(text)
    expr = None
    for r in rules:
        v = r.value if isinstance(r.value, Column) else F.lit(r.value)
        expr = F.when(r.condition(t), v) if expr is None else expr.when(r.condition(t), v)
    d = default if isinstance(default, Column) else F.lit(default)
    return d if expr is None else expr.otherwise(d)


def any_contains(text, words: Sequence[str]) -> Column:
    t = col_(text)
    out = F.lit(False)
    for w in words:
        out = out | t.contains(w)
    return out


@dataclass(frozen=True)
class Lexicon:
    """All keyword parameters of the text operators, in rule order."""

    sentiment: tuple              # ((keyword, score), ...)
    theme_ai: str
    theme_cloud: str
    theme_margin: str
    theme_guidance: str
    optimism: tuple
    caution: tuple
    risk: tuple                   # ((category, (kw, kw)), ...)
    polarity: tuple               # ((label, all_of, none_of), ...)
    risk_default: str = "OPERATIONAL"
    polarity_default: str = "NEUTRAL"
    extra: dict = field(default_factory=dict)

    def sentiment_rules(self) -> list[Rule]:
        return [Rule(float(score), any_of=(kw,)) for kw, score in self.sentiment]

    def primary_theme_rules(self) -> list[Rule]:
        return [Rule("AI / ML", any_of=(self.theme_ai,)),
                Rule("Cloud Infrastructure", any_of=(self.theme_cloud,)),
                Rule("Financial Performance", any_of=(self.theme_margin,))]

    def risk_rules(self) -> list[Rule]:
        return [Rule(cat, any_of=tuple(kws)) for cat, kws in self.risk]

    def polarity_rules(self) -> list[Rule]:
        return [Rule(lbl, all_of=tuple(a), none_of=tuple(n)) for lbl, a, n in self.polarity]


# Reference lexicon (fixed values, in rule order).
REFERENCE = Lexicon(
    sentiment=(
        ("record revenue", 0.85),
        ("exceeded expectations", 0.92),
        ("headwinds", -0.35),
        ("challenging environment", -0.55),
        ("strong growth", 0.78),
        ("margin pressure", -0.42),
        ("outlook positive", 0.71),
        ("uncertain", -0.20),
    ),
    theme_ai="AI",
    theme_cloud="cloud",
    theme_margin="margin",
    theme_guidance="guidance",
    optimism=("record revenue", "exceeded expectations", "strong growth"),
    caution=("headwinds", "challenging environment", "margin pressure"),
    risk=(
        ("LITIGATION_RISK", ("litigation", "lawsuit")),
        ("IMPAIRMENT_RISK", ("impairment", "write-down")),
        ("COMPETITIVE_RISK", ("competition", "market share")),
        ("REGULATORY_RISK", ("regulation", "compliance")),
        ("CYBER_RISK", ("cybersecurity", "data breach")),
        ("SUPPLY_CHAIN_RISK", ("supply chain", "disruption")),
    ),
    polarity=(
        ("NEGATIVE", ("substantial", "risk"), ()),
        ("NEGATIVE", ("may adversely",), ()),
        ("POSITIVE", ("growth",), ("risk",)),
        ("POSITIVE", ("innovation",), ()),
    ),
)

# Test lexicon for the shared driver tables, whose invented prose never
# contains the reference keywords; each keyword occurs there so that every
# output class appears (fixed values, in rule order).
FIXTURE = Lexicon(
    sentiment=(
        ("thble", 0.85),
        ("eron", 0.92),
        ("thor", -0.35),
        ("that the", -0.55),
        ("thth", 0.78),
        ("erin", -0.42),
        ("for", 0.71),
        ("que", -0.20),
    ),
    theme_ai="thin",
    theme_cloud="der",
    theme_margin="was",
    theme_guidance="this",
    optimism=("thble", "eron", "thth"),
    caution=("thor", "that the", "erin"),
    risk=(
        ("LITIGATION_RISK", ("thble the", "erblest")),
        ("IMPAIRMENT_RISK", ("thorly", "ndwh")),
        ("COMPETITIVE_RISK", ("inonre", "queaux")),
        ("REGULATORY_RISK", ("thhe", "licheit")),
        ("CYBER_RISK", ("ither", "ción")),
        ("SUPPLY_CHAIN_RISK", ("erst ", "que la")),
    ),
    polarity=(
        ("NEGATIVE", ("thhe", "erst "), ()),
        ("NEGATIVE", ("ither",), ()),
        ("POSITIVE", ("from",), ("thhe",)),
        ("POSITIVE", ("ción",), ()),
    ),
)
