"""A card number holding a third of all transactions: the PAN join of the
mart must be split by AQE skew handling, and no row may be lost."""

from pyspark.sql import functions as F

from tessera.plans import mart

CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "16",
}


def test_hot_card_is_split(spark):
    old = {k: spark.conf.get(k, None) for k in CONF}
    for k, v in CONF.items():
        spark.conf.set(k, v)
    try:
        n = 30_000
        hot = "9999999999999999"
        txn = spark.range(n).select(
            F.when(F.col("id") % 3 == 0, F.lit(hot))
            .otherwise(F.lpad((F.col("id") % 5000).cast("string"), 16, "0")).alias("PAN"),
            F.lit("2020-01-01").alias("STL_DT"), F.lit("0101000101").alias("TXN_TM"),
            F.lpad(F.col("id").cast("string"), 6, "0").alias("TRC_NO"),
            F.lit("0200").alias("MSG_TYP"), F.lit("000000").alias("PRO_CD"),
            F.lit("00").alias("POS_CD"), F.lit("100").alias("TXN_AMT"),
            F.lit(None).cast("string").alias("TOKEN"), F.lit("00000001").alias("SED_BR"),
            F.lit("00000001").alias("ACP_BR"), F.lit("5001").alias("MEC_TYP"),
            F.lit("C00000012").alias("TXN_PRT_FEE"), F.lit("5").alias("GET_FEE"),
            F.lit("5").alias("TKE_FEE"))
        info = spark.range(5000).union(spark.range(9999999999999999, 10**16)).select(
            F.lpad(F.col("id").cast("string"), 16, "0").alias("CRD_NO"),
            F.lit("1").alias("CRD_TYP"), F.lit("00000058").alias("CRD_KND"),
            F.lit("AUTOMOBILE").alias("CRD_KND_NM"), F.lit("a").alias("AC"),
            F.lit("c").alias("CINO"), F.lit("00000001").alias("OPN_BR"))
        out = mart.fee_txn_enriched(txn, info)
        assert out.count() == n                      # every transaction has one card
        rows = out.groupBy("CRD_NO").count().where(F.col("CRD_NO") == hot).first()
        assert rows["count"] == n // 3
        out.collect()                                # runs on out.queryExecution
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan
        assert "skew=true" in plan.replace(" ", "").lower() or "isSkew=true" in plan
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_hot_history_key_is_split_on_the_preserved_side(spark):
    old = {k: spark.conf.get(k, None) for k in CONF}
    for k, v in CONF.items():
        spark.conf.set(k, v)
    try:
        n = 30_000
        hot = F.col("id") % 3 == 0
        cols = {c: F.lit("x") for c in mart.MID_COLS}
        cols.update({
            "CRD_NO": F.when(hot, F.lit("9999")).otherwise(F.col("id").cast("string")),
            "TRC_NO": F.when(hot, F.lit("000001")).otherwise(F.lit("000002")),
            "TXN_TM": F.lit("0101000101"),
            "TXN_AMT": F.lit(1), "GET_FEE": F.lit(1.0), "TKE_FEE": F.lit(1.0),
            # per-row content, so shuffle blocks do not compress to nothing
            # (AQE judges skew by compressed bytes)
            "CINO": F.sha2(F.col("id").cast("string"), 256),
            "AC": F.md5(F.col("id").cast("string")),
        })
        mid = spark.range(n).select(*[cols[c].alias(c) for c in mart.MID_COLS])
        history = spark.range(5000).select(
            F.concat(F.col("id").cast("string"), F.lit(" ")).alias("CARDNO"),
            F.lit(" 000002").alias("SRVSTAN"), F.lit("0101000101 ").alias("DEVTRANSDATETIME"),
            F.lit("AD01").alias("ADDDATA2"), F.lit("000").alias("POSINPUTTYPE")).union(
            spark.createDataFrame([("9999", "000001", "0101000101", "AD09", "018")],
                                  "CARDNO string, SRVSTAN string, DEVTRANSDATETIME string, "
                                  "ADDDATA2 string, POSINPUTTYPE string"))
        out = mart.card_pos_tran(mid, history)
        rows = out.collect()                         # runs on out.queryExecution
        assert len(rows) == n                        # left join: every mart row kept once
        assert sum(r.ADDDATA2 == "AD09" for r in rows) == n // 3
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "LeftOuter" in plan
        assert "skew=true" in plan.replace(" ", "").lower() or "isSkew=true" in plan
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_audit_counts_shuffle_the_transactions_once_whatever_a_card_holds(spark):
    from tessera.plans import audit

    n, hot = 30_000, "9999999999999999"
    cols = {c: F.lit("x") for c in mart.FEE_TXN_COLS}
    cols.update({
        "PAN": F.when(F.col("id") % 3 == 0, F.lit(hot)).when(F.col("id") % 7 == 0, F.lit(None))
        .otherwise(F.lpad((F.col("id") % 500).cast("string"), 16, "0")),
        "TRC_NO": F.col("id").cast("string"),
        "MSG_TYP": F.when(F.col("id") % 2 == 0, "0200").otherwise("0100"), "PRO_CD": F.lit("000000"), "POS_CD": F.lit("00"),
    })
    txn = spark.range(n).select(*[cols[c].alias(c) for c in mart.FEE_TXN_COLS])
    cards = (spark.range(0, 400).select(F.lpad(F.col("id").cast("string"), 16, "0").alias("CRD_NO"))
             .union(spark.createDataFrame([(hot,), (hot,)], "CRD_NO string"))
             .select("CRD_NO", F.lit("0").alias("CRD_TYP"), F.lit("00000058").alias("CRD_KND"), F.lit("A").alias("CRD_KND_NM"),
                     F.lit("1").alias("CRD_STS"), F.lit("a").alias("AC"), F.lit("c").alias("CINO"), F.lit("b").alias("OPN_BR")))
    out = audit.rule_audit_counts(txn.union(txn.where("PAN is null or PAN > '5'")), cards)     # and repeated rows
    plan = out._jdf.queryExecution().executedPlan().toString()
    row = out.first()
    passing = [i for i in range(n) if i % 2 == 0 and (i % 3 == 0 or (i % 7 and i % 500 < 400))]
    assert (row.n_rows, row.n_matched) == (n, len(passing))
    wide = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and "TRC_NO" in line]
    assert len(wide) == 1


def test_audit_counts_of_empty_tables(spark):
    from tessera.plans import audit

    txn = spark.createDataFrame([], ", ".join(f"{c} string" for c in mart.FEE_TXN_COLS))
    cards = spark.createDataFrame([], "CRD_NO string, CRD_TYP string, CRD_KND string, CRD_KND_NM string, CRD_STS string, "
                                      "AC string, CINO string, OPN_BR string")
    assert tuple(audit.rule_audit_counts(txn, cards).first()) == (0, 0)


def test_history_of_spread_keys_is_shuffled_once(spark, small_dir):
    from tessera.sources import card_warehouse

    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in conf}
    inp = card_warehouse(spark, small_dir)
    extra = spark.createDataFrame([("9", "9", "9", "AD", None), (None, " 1", "2 ", "AD", "x"), ("9 ", "9", "9", "AD", None)],
                                  inp.online_history.schema)
    history = inp.online_history.union(inp.online_history.limit(50)).union(extra)
    mid = mart.card_tran_mid(inp)
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        exchanges, rows = [], []
        for spread in (False, True):
            out = mart.card_pos_tran(mid, history, spread)
            rows.append(sorted(map(str, out.collect())))
            plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
            exchanges.append(sum("Exchange hashpartitioning" in line for line in plan.splitlines()))
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert rows[0] == rows[1]
    assert exchanges[1] == exchanges[0] - 1
