"""Column expressions. All are built-in Spark functions: no Python worker."""

from hirelake.functions.contract import (classify_contract_time, classify_contract_type,
                                         standardize_code)
from hirelake.functions.keys import category_key, entity_key
from hirelake.functions.salary import (is_salary_available, parse_salary_text, salary_avg,
                                       salary_range, scale_salary)
from hirelake.functions.text import keyword_match, search_text
from hirelake.functions.time import parse_created, parse_updated, to_date_path, to_dt

__all__ = [
    "classify_contract_time", "classify_contract_type", "standardize_code",
    "category_key", "entity_key",
    "is_salary_available", "parse_salary_text", "salary_avg", "salary_range", "scale_salary",
    "keyword_match", "search_text",
    "parse_created", "parse_updated", "to_date_path", "to_dt",
]
