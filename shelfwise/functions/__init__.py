from .grouping import per_column
from .measures import growth_pct, ratio, report, total, total_where
from .ranking import ranked
from .text import city_of, date_key, parse_day, parse_price, parse_price_any, parse_units

__all__ = [
    "city_of", "date_key", "growth_pct", "parse_day", "parse_price", "parse_price_any", "parse_units",
    "per_column", "ranked", "ratio", "report", "total", "total_where",
]
