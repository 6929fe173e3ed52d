"""The instant rules."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from ledgerwatch.functions.columns import text, text_list
from ledgerwatch.schema import HIGH_RISK_CATEGORIES, HIGH_RISK_COUNTRIES, UNKNOWN_DEVICE


@dataclass(frozen=True)
class Rule:
    """A predicate over a transaction, its weight, and the column named with the rule.

    A predicate that is null, because a field is missing, does not fire the rule.
    """

    name: str
    weight: str
    predicate: str
    detail: str | None = None

    def label(self) -> str:
        if self.detail is None:
            return text(self.name)
        return f"concat({text(self.name + ':')}, {self.detail})"

    def points(self) -> str:
        return f"case when {self.predicate} then {self.weight} else 0.0D end"

    def fired(self) -> str:
        return f"case when {self.predicate} then {self.label()} end"


# Names, weights and limits of the rules. Scores are floating-point sums in
# this order; another order gives other last digits.
RULES = [
    Rule("HIGH_AMOUNT_3K", "0.30D", "amount >= 3000D"),
    Rule("VERY_HIGH_AMOUNT_8K", "0.20D", "amount >= 8000D"),
    Rule("HIGH_RISK_MCC", "0.25D", f"merchant_category in ({text_list(HIGH_RISK_CATEGORIES)})", "merchant_category"),
    Rule("HIGH_RISK_COUNTRY", "0.20D", f"country in ({text_list(HIGH_RISK_COUNTRIES)})", "country"),
    Rule("UNKNOWN_DEVICE", "0.10D", f"device_type = {text(UNKNOWN_DEVICE)}"),
    Rule("MICRO_AMOUNT_CARD_TEST", "0.15D", "amount > 0D and amount < 2D"),
    Rule("SUSPICIOUSLY_ROUND_AMOUNT", "0.08D", "amount >= 500D and amount % 100D = 0D"),
]

RULES_BY_NAME = {rule.name: rule for rule in RULES}

RULE_SCORE = f"least({' + '.join(rule.points() for rule in RULES)}, 1D)"

# The texts of the rules that fired, in rule order.
FIRED_RULES = f"array_compact(array({', '.join(rule.fired() for rule in RULES)}))"


def rule_hits(transactions: DataFrame, name: str) -> DataFrame:
    """The transactions on which one rule fires."""
    rule = RULES_BY_NAME[name]
    return transactions.where(rule.predicate).selectExpr(
        "transaction_id", "account_id", "amount", f"{rule.label()} as rule", f"{rule.weight} as weight"
    )
