"""Card-mart inputs, derived from the given star schema.

The mart reads five warehouse tables.  Offline they are built from the given
TPC-H-like tables by the rules below, which are fixed values of the test
fixture (they decide which rows every rule, join and flag sees).  Each input
is a lazy DataFrame; only the columns the mart uses are produced.
"""

from __future__ import annotations

import threading
from concurrent.futures import Future
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.materialize import written
from .manifest import InputManifest
from .tables import read_table


@dataclass(frozen=True)
class CardInputs:
    branches: DataFrame           # v_org_branch
    cards: DataFrame              # o_rps_bad_cardinfo_his
    fee_txn: DataFrame            # m_mmp_fee_txn (the 15 columns the mart uses)
    deposit_accounts: DataFrame   # m_rps_bad_depositacct
    online_history: DataFrame     # m_mp_onltranrechis


# The warehouse table names of the five inputs.
WAREHOUSE_TABLES = {
    "branches": "v_org_branch",
    "cards": "o_rps_bad_cardinfo_his",
    "fee_txn": "m_mmp_fee_txn",
    "deposit_accounts": "m_rps_bad_depositacct",
    "online_history": "m_mp_onltranrechis",
}


def catalog_inputs(spark: SparkSession, database: str) -> CardInputs:
    """The five inputs read as catalog tables of ``database`` (production:
    the mart runs on the warehouse as it is).

    Each table is refreshed first: upstream loads rewrite these tables
    between runs, and a long-lived session (the trigger stream's) would
    otherwise plan over a cached file listing that no longer exists."""
    names = {field: f"{database}.{table}" for field, table in WAREHOUSE_TABLES.items()}
    for name in names.values():
        spark.catalog.refreshTable(name)
    return CardInputs(**{field: spark.table(name) for field, name in names.items()})


def _pad(c: Column, width: int) -> Column:
    return F.lpad(c.cast("string"), width, "0")


def _day_text(ts: Column) -> Column:
    return F.to_date(ts).cast("string")


def derive_branches(supplier: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    # One row per supplier: the branch table repeats its rows, so the mart's
    # distinct (stage A) has real work to do.
    return (
        supplier.select(F.col("s_nationkey").alias("n_nationkey"))
        .join(nation.where(F.col("n_nationkey") != 7), "n_nationkey")
        .join(region.withColumnRenamed("r_regionkey", "n_regionkey"), "n_regionkey")
        .select(
            _pad(F.col("n_nationkey"), 8).alias("org_id"),
            F.col("n_name").alias("org_name"),
            _pad(F.col("n_regionkey") + 900, 8).alias("org_upperid"),
            F.col("r_name").alias("org_uppername"),
        )
    )


def derive_cards(customer: DataFrame) -> DataFrame:
    k = F.col("c_custkey")
    kind = (
        F.when(F.col("c_mktsegment") == "AUTOMOBILE", "00000058")
        .when(F.col("c_mktsegment") == "BUILDING", "00000061")
        .when(F.col("c_mktsegment") == "FURNITURE", "00000067")
        .otherwise("00000068")
    )
    return customer.select(
        _pad(k, 16).alias("CRD_NO"),
        (k % 2).cast("string").alias("CRD_TYP"),
        kind.alias("CRD_KND"),
        F.col("c_mktsegment").alias("CRD_KND_NM"),
        (k % 4).cast("string").alias("CRD_STS"),
        _pad(k, 12).alias("AC"),
        F.col("c_name").alias("CINO"),
        _pad(F.col("c_nationkey"), 8).alias("OPN_BR"),
    )


def derive_fee_txn(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    ok, pk, sk = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey")
    day = _day_text(F.col("o_orderdate"))
    msg_typ = (F.when(ok % 5 == 0, "0200").when(ok % 5 == 1, "0210")
               .when(ok % 5 == 2, "0220").when(ok % 5 == 3, "0230").otherwise("0100"))
    pro_cd = (F.when(pk % 5 == 0, "200000").when(pk % 5 == 1, "010000")
              .when(pk % 5 == 2, "200001").otherwise("000000"))
    pos_cd = (F.when(sk % 7 == 0, "00").when(sk % 7 == 1, "06").when(sk % 7 == 2, "08")
              .when(sk % 7 == 3, "18").when(sk % 7 == 4, "64").when(sk % 7 == 5, "69")
              .otherwise("91"))
    fee_letter = (F.when(F.col("l_returnflag") == "R", "C")
                  .when(F.col("l_returnflag") == "A", "D").otherwise("0"))
    orders_slim = orders.select(
        F.col("o_orderkey").alias("l_orderkey"), "o_orderdate", "o_custkey")
    return (
        lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                        "l_extendedprice", "l_quantity", "l_returnflag",
                        "l_discount", "l_tax")
        .join(orders_slim, "l_orderkey")
        .select(
            day.alias("STL_DT"),
            F.concat(F.substring(F.regexp_replace(day, "-", ""), 5, 4),
                     _pad(F.col("l_linenumber") * 101, 6)).alias("TXN_TM"),
            _pad(F.col("o_custkey"), 16).alias("PAN"),
            _pad(ok, 6).alias("TRC_NO"),
            msg_typ.alias("MSG_TYP"),
            pro_cd.alias("PRO_CD"),
            pos_cd.alias("POS_CD"),
            F.floor("l_extendedprice").cast("bigint").cast("string").alias("TXN_AMT"),
            F.when(ok % 3 == 0, F.lit(None).cast("string"))
            .otherwise(F.concat(F.lit("T"), ok.cast("string"))).alias("TOKEN"),
            F.when(sk % 10 == 0, "00010344").otherwise(_pad(sk, 8)).alias("SED_BR"),
            _pad(sk, 8).alias("ACP_BR"),
            (pk % 50 + 5000).cast("string").alias("MEC_TYP"),
            F.concat(fee_letter, _pad(F.col("l_quantity").cast("int"), 8)).alias("TXN_PRT_FEE"),
            F.round(F.col("l_discount") * 100).cast("int").cast("string").alias("GET_FEE"),
            F.round(F.col("l_tax") * 100).cast("int").cast("string").alias("TKE_FEE"),
        )
    )


def derive_deposit_accounts(customer: DataFrame, orders: DataFrame) -> DataFrame:
    # First order date per customer; aggregated on orders before the join so
    # only one row per customer is shuffled to meet the customer table.
    first_order = (
        orders.where(F.col("o_custkey") % 9 != 0)
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.min("o_orderdate").alias("first_order"))
    )
    return (
        customer.select("c_custkey").where(F.col("c_custkey") % 9 != 0)
        .join(first_order, "c_custkey")
        .select(_pad(F.col("c_custkey"), 12).alias("AC"),
                _day_text(F.col("first_order")).alias("OPN_DT"))
    )


def derive_online_history(fee_txn: DataFrame) -> DataFrame:
    # Keys carry padding so the mart's trimmed join keys matter.
    return (
        fee_txn.where((F.col("MEC_TYP") != "5000")
                      & (F.col("MEC_TYP").cast("int") % 3 != 0))
        .select(
            F.concat(F.col("PAN"), F.lit("   ")).alias("CARDNO"),
            F.concat(F.lit(" "), F.col("TRC_NO")).alias("SRVSTAN"),
            F.concat(F.col("TXN_TM"), F.lit(" ")).alias("DEVTRANSDATETIME"),
            F.concat(F.lit("AD"), F.substr(F.col("TRC_NO"), F.lit(-2))).alias("ADDDATA2"),
            F.concat(F.lit("0"), F.col("POS_CD")).alias("POSINPUTTYPE"),
        )
    )


#: The given tables each warehouse table is derived from.
SOURCES = {
    "branches": ("supplier", "nation", "region"),
    "cards": ("customer",),
    "fee_txn": ("lineitem", "orders"),
    "deposit_accounts": ("customer", "orders"),
    "online_history": ("lineitem", "orders"),
}


def _derive(spark: SparkSession, sf_dir: str, field: str, fee_txn=None) -> DataFrame:
    t = lambda name: read_table(spark, sf_dir, name)
    if field == "branches":
        return derive_branches(t("supplier"), t("nation"), t("region"))
    if field == "cards":
        return derive_cards(t("customer"))
    if field == "deposit_accounts":
        return derive_deposit_accounts(t("customer"), t("orders"))
    if field == "fee_txn":
        return derive_fee_txn(t("lineitem"), t("orders"))
    return derive_online_history(fee_txn if fee_txn is not None else _derive(spark, sf_dir, "fee_txn"))


def card_inputs(spark: SparkSession, sf_dir: str) -> CardInputs:
    """The five inputs derived as they are read, nothing written."""
    fee_txn = _derive(spark, sf_dir, "fee_txn")
    return CardInputs(**{field: fee_txn if field == "fee_txn" else _derive(spark, sf_dir, field, fee_txn)
                         for field in SOURCES})


#: Written tables (or those being written) by application, folder, table and the identity of its files.
_WRITTEN: dict[tuple, Future] = {}
_LOCK = threading.Lock()


class CardWarehouse:
    """The card inputs as written warehouse tables (parquet under the shared folder).

    A table is derived and written when it is first asked for, so a query pays for the tables that
    it reads; the history is derived from the written transactions, so the fact join runs once.  A
    written table is used again only while the files it came from are the same, by one listing of them for
    this object (``InputManifest``).  Of threads that ask for one table at once, one writes it and the others
    wait for it alone; a failed write leaves nothing behind."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._dir = spark, sf_dir
        self._manifest = InputManifest(spark, sf_dir)

    def __getattr__(self, field: str) -> DataFrame:
        if field not in SOURCES:
            raise AttributeError(field)
        spark = self._spark
        key = (spark.sparkContext.applicationId, self._dir, field, self._manifest.identity(SOURCES[field]))
        with _LOCK:
            mine = key not in _WRITTEN
            made = _WRITTEN.setdefault(key, Future())
        if mine:
            try:
                fee_txn = self.fee_txn if field == "online_history" else None
                made.set_result(written(_derive(spark, self._dir, field, fee_txn), f"card_warehouse/{field}"))
            except BaseException as error:
                with _LOCK:
                    del _WRITTEN[key]
                made.set_exception(error)
                raise
        return made.result()


def card_warehouse(spark: SparkSession, sf_dir: str) -> CardWarehouse:
    return CardWarehouse(spark, sf_dir)
