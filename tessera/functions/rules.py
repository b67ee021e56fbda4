"""Message rules of the card mart as Column expressions (FLT-2, FLT-4, CASE-1).

A rule holds when the message type is in its list, the first two characters
of the processing code equal its prefix and the POS condition code is in its
list.  Rules are data; the filter is the OR of all filter rules and the class
is the first class rule that holds.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values: (message types, processing-code prefix, POS condition codes).
FILTER_RULES = (
    (("0200", "0210"), "00", ("00", "08", "64", "65")),
    (("0200", "0210", "0220", "0230"), "00", ("06", "18")),
    (("0220", "0230"), "20", ("00", "69", "08", "64")),
    (("0200", "0210", "0220"), "20", ("00",)),
)

# Transaction class, first match wins; no match gives NULL.
CLASS_RULES = (
    ("1", (("0200",), "00", ("00", "08", "64", "65"))),
    ("2", (("0200", "0220"), "00", ("06", "18"))),
    ("3", (("0220", "0230"), "20", ("00", "69", "08", "64"))),
    ("3", (("0200", "0210", "0220"), "20", ("00",))),
)


def rule_holds(rule, msg_typ: str = "MSG_TYP", pro_cd: str = "PRO_CD",
               pos_cd: str = "POS_CD") -> Column:
    types, prefix, pos_codes = rule
    return (F.col(msg_typ).isin(*types)
            & (F.substr(F.col(pro_cd), F.lit(1), F.lit(2)) == prefix)
            & F.col(pos_cd).isin(*pos_codes))


def implied_by_rules(rules=FILTER_RULES, msg_typ: str = "MSG_TYP", pro_cd: str = "PRO_CD",
                     pos_cd: str = "POS_CD") -> Column:
    """A condition every rule implies, made only of predicates the parquet
    scan accepts (IN lists and starts-with), so row groups whose statistics
    or dictionaries rule it out are skipped before any row is decoded."""
    types = sorted(set().union(*(r[0] for r in rules)))
    codes = sorted(set().union(*(r[2] for r in rules)))
    prefix = reduce(lambda a, b: a | b,
                    (F.col(pro_cd).startswith(p) for p in sorted({r[1] for r in rules})))
    return F.col(msg_typ).isin(*types) & F.col(pos_cd).isin(*codes) & prefix


def passes_rules(rules=FILTER_RULES, **cols) -> Column:
    """True when any rule holds; NULL inputs make the arm NULL, so the row drops.
    The implied condition goes first: it is pushed into the scan, the exact
    OR of the rules is then checked on the rows that remain."""
    exact = reduce(lambda a, b: a | b, (rule_holds(r, **cols) for r in rules))
    return implied_by_rules(rules, **cols) & exact


def txn_class(rules=CLASS_RULES, **cols) -> Column:
    """'1' / '2' / '3' or NULL: a CASE without ELSE."""
    out = None
    for label, rule in rules:
        cond = rule_holds(rule, **cols)
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return out
