"""Column builders: message rules, mart fields, business dates."""

from . import dates, fields, rules

__all__ = ["dates", "fields", "rules"]
