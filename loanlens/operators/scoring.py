"""Deterministic scorecards and batch scoring.

A scorecard is a fixed logistic expression over prepared columns:
``p = round(sigmoid(Σ w·(x − centre) + intercept), 4)``.  It lets every metric
operator run without a trained model and be reproduced in SQL.  Learned
models (``loanlens.operators.learn``) produce the same output columns.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Transformer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanlens.functions.columns import decision, sigmoid


@dataclass(frozen=True)
class Card:
    name: str
    terms: tuple[tuple[str, float, float], ...]   # (column, weight, centre)
    intercept: float
    decimals: int = 4

    def margin(self) -> Column:
        z = None
        for col, w, c in self.terms:
            t = F.lit(w) * (F.col(f"`{col}`") - F.lit(c))
            z = t if z is None else z + t
        return z + F.lit(self.intercept)

    def probability(self) -> Column:
        return F.round(sigmoid(self.margin()), self.decimals)

    def sql(self) -> str:
        """The same expression as SQL text (same association order)."""
        z = " + ".join(f"{w!r}*(\"{col}\" - {c!r})" for col, w, c in self.terms)
        return f"round(1/(1+exp(-(({z}) + {self.intercept!r}))), {self.decimals})"


CHAMPION = Card("champion_scorecard_v1",
                (("sub_grade_encoded", 0.08, 17.0), ("dti_capped", 0.02, 18.0),
                 ("revol_util_capped", 0.01, 50.0)), -0.4)
CHALLENGER = Card("challenger_scorecard_v1",
                  (("sub_grade_encoded", 0.06, 17.0), ("int_rate", 0.03, 15.0),
                   ("dti_capped", 0.015, 18.0), ("term_num", 0.01, 45.0)), -0.3)


class ScorecardModel(Transformer):
    """I8: appends probability, decision, threshold and model version."""

    def __init__(self, card: Card = CHAMPION, threshold: float = 0.47,
                 prob_col: str = "p", keep: tuple[str, ...] | None = None):
        super().__init__()
        self.card, self.threshold, self.prob_col, self.keep = card, threshold, prob_col, keep

    def _transform(self, df: DataFrame) -> DataFrame:
        p = self.card.probability().alias(self.prob_col)
        keep = [c for c in df.columns] if self.keep is None else list(self.keep)
        out = df.select(*keep, p)
        return out.select("*",
                          decision(F.col(self.prob_col), self.threshold).alias("decision"),
                          F.lit(self.threshold).alias("threshold_used"),
                          F.lit(self.card.name).alias("model_version"))
