from .scalar import (AGE_LABELS, AGE_UPPER_BOUNDS, age_bucket, age_range, gender_desc, half_up_div,
                     hundredths_to_money, money_from_double, outcome_is, ratio_money, to_int_strict, year_of)
from .aggregates import count_if, pct_of_rows, weighted_mean, weighted_sum

__all__ = ["AGE_LABELS", "AGE_UPPER_BOUNDS", "age_bucket", "age_range", "gender_desc", "half_up_div",
           "hundredths_to_money", "money_from_double", "outcome_is", "ratio_money", "to_int_strict",
           "year_of", "count_if", "pct_of_rows", "weighted_mean", "weighted_sum"]
