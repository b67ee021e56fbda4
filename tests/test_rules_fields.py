"""Edge rows for the message rules and the mart's scalar columns."""

import itertools

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tessera.functions import fields, rules
from tessera.plans import mart

MSG = ["0200", "0210", "0220", "0230", "0100"]
PRO = ["000000", "200000", "010000"]
POS = ["00", "06", "08", "18", "64", "65", "69", "91"]


# The cells that pass the filter, (message type, code) -> POS code -> class.
CELLS = {
    ("0200", "00"): {"00": "1", "08": "1", "64": "1", "65": "1", "06": "2", "18": "2"},
    ("0210", "00"): {"00": None, "08": None, "64": None, "65": None, "06": None, "18": None},
    ("0220", "00"): {"06": "2", "18": "2"},
    ("0230", "00"): {"06": None, "18": None},
    ("0200", "20"): {"00": "3"},
    ("0210", "20"): {"00": "3"},
    ("0220", "20"): {"00": "3", "08": "3", "64": "3", "69": "3"},
    ("0230", "20"): {"00": "3", "08": "3", "64": "3", "69": "3"},
}


def expected(msg, pro, pos):
    found = CELLS.get((msg, pro[:2]), {})
    return pos in found, found.get(pos)


def test_rule_grid(spark):
    rows = list(itertools.product(MSG, PRO, POS))
    df = spark.createDataFrame(rows, "MSG_TYP string, PRO_CD string, POS_CD string")
    got = {(r.MSG_TYP, r.PRO_CD, r.POS_CD): (r.ok, r.cls) for r in
           df.select("*", rules.passes_rules().alias("ok"),
                     rules.txn_class().alias("cls")).collect()}
    assert len(got) == 120
    for key in rows:
        assert got[key] == expected(*key), key
    # Filter and class disagree on purpose for 0210 purchases: kept, no class.
    assert got[("0210", "000000", "00")] == (True, None)


def test_fee_letters(spark):
    df = spark.createDataFrame(
        [("C00000012",), ("D00000012",), ("000000012",), (None,)], "TXN_PRT_FEE string"
    ).withColumn("GET_FEE", F.lit("5")).withColumn("TKE_FEE", F.lit("5"))
    got = [(r.g, r.t) for r in df.select(
        fields.signed_fee("TXN_PRT_FEE", "GET_FEE", "C").alias("g"),
        fields.signed_fee("TXN_PRT_FEE", "TKE_FEE", "D").alias("t")).collect()]
    assert got == [(17.0, 5.0), (5.0, 17.0), (5.0, 5.0), (5.0, 5.0)]


def test_malformed_fee_tail_is_null(spark):
    df = spark.createDataFrame([("Cxx", "5")], "TXN_PRT_FEE string, GET_FEE string")
    assert df.select(fields.signed_fee("TXN_PRT_FEE", "GET_FEE", "C")).first()[0] is None


def test_strict_int_accepts(spark):
    df = spark.createDataFrame([("12",), ("+5",), ("-7",)], "x string")
    assert [r[0] for r in df.select(fields.strict_int("x")).collect()] == [12, 5, -7]


@pytest.mark.parametrize("bad", [" 5", "12.5", "", None, "2147483648", "12\n", "12\r"])
def test_strict_int_rejects(spark, bad):
    df = spark.createDataFrame([(bad,)], "x string")
    with pytest.raises(PySparkException):
        df.select(fields.strict_int("x")).collect()


def test_status_filter(spark):
    cards = spark.createDataFrame(
        [("A1", "1"), ("A2", "2"), ("A3", None), ("A4", "A"), ("A5", "1.0"), ("A6", "2.9"), ("A7", "1e1")], "CRD_NO string, CRD_STS string"
    ).select("CRD_NO", "CRD_STS", *[F.lit("x").alias(c) for c in
                                     ["CRD_TYP", "AC", "CINO", "OPN_BR"]],
             F.lit("00000058").alias("CRD_KND"))
    assert [r.CRD_NO for r in mart.live_cards(cards).collect()] == ["A1", "A5"]


def test_last_chars_and_flags(spark):
    df = spark.createDataFrame([("00012345", None), ("abc", "T1"), (None, "00010344")],
                               "a string, b string")
    got = df.select(fields.last_chars("a", 4), fields.null_flag("b"),
                    fields.equals_flag("b", "00010344")).collect()
    assert [tuple(r) for r in got] == [("2345", "0", "0"), ("abc", "1", "0"), (None, "1", "1")]
