"""Column functions: payload access, dates, exact numbers."""

from finlake.functions import dates, numbers, payload

__all__ = ["dates", "numbers", "payload"]
