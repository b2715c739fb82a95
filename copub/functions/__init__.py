from copub.functions.columns import (
    author_ids,
    clean_id,
    cosine_or_sentinel,
    ratio,
    year_from_text,
)
from copub.functions.periods import Period, as_periods, period_years

__all__ = [
    "Period",
    "as_periods",
    "author_ids",
    "clean_id",
    "cosine_or_sentinel",
    "period_years",
    "ratio",
    "year_from_text",
]
