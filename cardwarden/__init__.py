"""Card-transaction analytics and fraud rules as Spark DataFrame plans."""

from cardwarden.policy import RiskPolicy
from cardwarden.schemas import CARDS, FRAUD_LABELS, MCC_CODES, TRANSACTIONS, USERS

__all__ = ["RiskPolicy", "TRANSACTIONS", "CARDS", "USERS", "MCC_CODES", "FRAUD_LABELS"]
