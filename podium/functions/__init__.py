from podium.functions.classify import Rule, classify, classify_sql, classify_udf, register_classifier
from podium.functions.exact import exact_mean, exact_order, exact_sums
from podium.functions.names import free_name, quoted
from podium.functions.ordering import best_first, best_first_key

__all__ = [
    "Rule",
    "best_first",
    "best_first_key",
    "classify",
    "classify_sql",
    "classify_udf",
    "exact_mean",
    "exact_order",
    "exact_sums",
    "free_name",
    "quoted",
    "register_classifier",
]
