"""The card-transaction mart (stages A..I) as DataFrame -> DataFrame steps.

Stage meaning (inputs are the five warehouse tables of ``CardInputs``):

A  branch_dim        distinct branches
B  live_cards        cards not in status 2 and not of kind 00000061
C  kind_dim          distinct (kind, kind name) over *all* cards
D  card_info         B left join C (a kind with several names fans out)
E  fee_txn_kept      transactions passing the message rules whose card is in D
F  fee_txn_enriched  E joined to D, with class, flags and fee columns
G  card_tran_mid     F plus deposit account, branch and the load date
H  history_dim       distinct on-line history
I  card_pos_tran     G left join H on space-trimmed (card, trace no, time)

Plan choices (the semantics are the stage list above):

* E then "E left join D" equals "rules-filtered transactions inner join D":
  the semi join guarantees every kept row has a partner, so the left join
  never produces a NULL side.  F and G use the single inner join, which
  shuffles the transactions once instead of twice.
* Account (join on D.AC) and branch (join on D.OPN_BR) only look at card
  columns, so they are joined to the card side before it meets the
  transactions.  The big side then shuffles once on PAN and once on the
  trimmed history key.
* Kind and branch dimensions are broadcast behind a size check
  (``bounded_broadcast``).  The card side has no bound: it is left to the
  planner, and AQE broadcasts it at run time only when its shuffle output is
  under the adaptive threshold; a hot card number is split by AQE skew join.
* The history distinct keeps its map-side partial aggregation, so a group of
  identical copies is collapsed before it is shuffled.  Where the caller knows
  that no key of the history join is hot (``spread_keys``), the history is dealt
  by its trimmed keys once, made distinct there and joined there.  That saves one
  shuffle of the history, but AQE cannot split a hot key under it: it splits only
  shuffles that stand right under the join's sorts.
* E's membership test reads the live cards' numbers (B): D is B left-joined
  to the kinds, so its card-number set is the same, and E needs no kind
  dimension.
* The rule filter carries an implied IN / starts-with condition that the
  parquet scan accepts (see ``functions.rules.implied_by_rules``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fields, rules
from ..operators import bounded_broadcast, bounded_broadcasts, trimmed_keys
from ..sources.cards import CardInputs

# Fixed values of the mart.
DEFAULT_LOAD_DATE = "2020-02-28"
EXCLUDED_STATUS = 2
EXCLUDED_KIND = "00000061"
HEAD_OFFICE_BRANCH = "00010344"

BRANCH_COLS = ["org_id", "org_name", "org_upperid", "org_uppername"]
CARD_COLS = ["CRD_NO", "CRD_TYP", "CRD_KND", "AC", "CINO", "OPN_BR"]
CARD_INFO_COLS = ["CRD_NO", "CRD_TYP", "CRD_KND", "CRD_KND_NM", "AC", "CINO", "OPN_BR"]
MART_KEYS, HISTORY_KEYS = ("CRD_NO", "TRC_NO", "TXN_TM"), ("CARDNO", "SRVSTAN", "DEVTRANSDATETIME")
HISTORY_COLS = ["CARDNO", "SRVSTAN", "DEVTRANSDATETIME", "ADDDATA2", "POSINPUTTYPE"]
FEE_TXN_COLS = ["STL_DT", "TXN_TM", "PAN", "TRC_NO", "MSG_TYP", "PRO_CD", "POS_CD",
                "TXN_AMT", "TOKEN", "SED_BR", "ACP_BR", "MEC_TYP", "TXN_PRT_FEE",
                "GET_FEE", "TKE_FEE"]
ENRICHED_COLS = ["TX_DT", "TXN_TM", "CRD_NO", "CRD_TYP", "CRD_KND", "CRD_KND_NM", "AC",
                 "CINO", "OPN_BR", "TRC_NO", "MSG_TYP", "TXN_AMT", "TOKEN", "SED_BR",
                 "ACP_BR", "MEC_TYP", "GET_FEE", "TKE_FEE"]
MID_COLS = ["TX_DT", "TXN_TM", "CRD_NO", "CRD_TYP", "CRD_KND", "CRD_KND_NM", "AC", "OPN_DT",
            "CINO", "OPN_BR", "org_name", "org_upperid", "org_uppername", "TRC_NO",
            "MSG_TYP", "TXN_AMT", "TOKEN", "SED_BR", "ACP_BR", "MEC_TYP", "GET_FEE",
            "TKE_FEE", "HIS_DW_DATE"]
MART_COLS = ["HIS_DW_DATE", "TX_DT", "TXN_TM", "CRD_NO", "CRD_TYP", "CRD_KND", "CRD_KND_NM",
             "AC", "OPN_DT", "CINO", "OPN_BR", "ORG_NAME", "ORG_UPPERID", "ORG_UPPERNAME",
             "TRC_NO", "MSG_TYP", "TXN_AMT", "TOKEN", "SED_BR", "ACP_BR", "MEC_TYP",
             "GET_FEE", "TKE_FEE", "ADDDATA2", "POSINPUTTYPE"]


# -- A, B, C, D: dimensions ------------------------------------------------

def branch_dim(branches: DataFrame) -> DataFrame:
    """A: distinct branches (AGG-1, PRJ-1)."""
    return branches.select(*BRANCH_COLS).distinct()


def live_cards(cards: DataFrame) -> DataFrame:
    """B: cards not in the excluded status or kind (FLT-1, PRJ-1)."""
    return (cards.where(fields.status_is_not("CRD_STS", EXCLUDED_STATUS)
                        & (F.col("CRD_KND") != EXCLUDED_KIND))
            .select(*CARD_COLS))


def kind_dim(cards: DataFrame) -> DataFrame:
    """C: distinct (kind, kind name) over all cards (AGG-1)."""
    return cards.select("CRD_KND", "CRD_KND_NM").distinct()


def card_info(cards: DataFrame, kinds: DataFrame | None = None) -> DataFrame:
    """D: B left join C on the kind (JOIN-1).  ``kinds`` is the checked kind
    dimension when the caller has it."""
    kinds = bounded_broadcast(kind_dim(cards)) if kinds is None else kinds
    return live_cards(cards).join(kinds, "CRD_KND", "left").select(*CARD_INFO_COLS)


def checked_dims(inputs: CardInputs) -> tuple[DataFrame, DataFrame]:
    """Kind and branch dimensions, each materialised and size-checked for
    broadcast; the two checks run concurrently."""
    kinds, branches = bounded_broadcasts(kind_dim(inputs.cards), branch_dim(inputs.branches))
    return kinds, branches


def card_numbers(info: DataFrame) -> DataFrame:
    """D's card numbers as a stage (``crd_no_para``; repeats a card once per
    kind name)."""
    return info.select("CRD_NO")


def known_cards(cards: DataFrame) -> DataFrame:
    """The card numbers transactions are checked against.  Same *set* as
    ``card_numbers(card_info(cards))``: D is B left-joined to the kinds, and a
    left join never drops a row of B, so membership needs neither the kind
    dimension nor its size check."""
    return live_cards(cards).select("CRD_NO")


# -- E: rule filter and known-card semi join --------------------------------

def ruled_txn(fee_txn: DataFrame) -> DataFrame:
    return fee_txn.where(rules.passes_rules())


def fee_txn_kept(fee_txn: DataFrame, cards: DataFrame) -> DataFrame:
    """E: rule-passing transactions of a known card, with every column the
    transaction table has (FLT-2, PRD-1, STR-1, JOIN-2); ``cards`` is the raw
    card table.  Consumers' scans are pruned to the columns they use."""
    known = known_cards(cards)
    return (ruled_txn(fee_txn)
            .join(known, F.col("PAN") == known["CRD_NO"], "left_semi")
            .select(*fee_txn.columns))


def fee_sign_digits(kept: DataFrame) -> DataFrame:
    """The printed fee without its sign letter (stage E's unused side view)."""
    return kept.select(fields.tail_from("TXN_PRT_FEE", 2).alias("FEE_DIGITS"))


# -- F, G: enrichment ------------------------------------------------------

def _enriched_columns() -> dict:
    """Stage F's output columns by name, over (transaction + card) rows:
    renames (PRJ-2), class (CASE-1), strict amount (NUM-1, UDF-1), flags
    (PRD-2, PRD-3), last four (STR-3), fees (CASE-2, CASE-3, NUM-2)."""
    return {
        "TX_DT": F.col("STL_DT"),
        "TXN_TM": F.col("TXN_TM"),
        "CRD_NO": F.col("PAN"),
        **{c: F.col(c) for c in ("CRD_TYP", "CRD_KND", "CRD_KND_NM", "AC", "CINO",
                                 "OPN_BR", "TRC_NO")},
        "MSG_TYP": rules.txn_class(),
        "TXN_AMT": fields.strict_int("TXN_AMT", "TXN_AMT"),
        "TOKEN": fields.null_flag("TOKEN"),
        "SED_BR": fields.equals_flag("SED_BR", HEAD_OFFICE_BRANCH),
        "ACP_BR": fields.last_chars("ACP_BR", 4),
        "MEC_TYP": F.col("MEC_TYP"),
        "GET_FEE": fields.signed_fee("TXN_PRT_FEE", "GET_FEE", "C"),
        "TKE_FEE": fields.signed_fee("TXN_PRT_FEE", "TKE_FEE", "D"),
    }


def _named(columns: dict, order: list[str]) -> list:
    return [columns[name].alias(name) for name in order]


def _with_cards(fee_txn: DataFrame, card_side: DataFrame) -> DataFrame:   # JOIN-3
    # Inner join == semi join (E) followed by the reference's left join (F).
    return ruled_txn(fee_txn).join(card_side, F.col("PAN") == card_side["CRD_NO"], "inner")


def fee_txn_enriched(fee_txn: DataFrame, info: DataFrame) -> DataFrame:
    return _with_cards(fee_txn, info).select(*_named(_enriched_columns(), ENRICHED_COLS))


def widened_cards(info: DataFrame, deposit_accounts: DataFrame,
                  branches: DataFrame, checked_branches: DataFrame | None = None) -> DataFrame:
    """D with the account open date (JOIN-4) and the branch attributes (JOIN-5):
    the joins of G that only read card columns."""
    accounts = deposit_accounts.select("AC", "OPN_DT")
    if checked_branches is None:
        checked_branches = bounded_broadcast(branch_dim(branches))
    branch = checked_branches.select(
        F.col("org_id").alias("OPN_BR"), "org_name", "org_upperid", "org_uppername")
    return (info.join(accounts, "AC", "left")
            .join(branch, "OPN_BR", "left"))


def card_tran_mid(inputs: CardInputs, load_date: str = DEFAULT_LOAD_DATE,
                  info: DataFrame | None = None,
                  dims: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    kinds, branches = checked_dims(inputs) if dims is None else dims
    info = card_info(inputs.cards, kinds) if info is None else info
    side = widened_cards(info, inputs.deposit_accounts, inputs.branches, branches)
    cols = _enriched_columns()
    cols.update({c: F.col(c) for c in ("OPN_DT", "org_name", "org_upperid", "org_uppername")})
    cols["HIS_DW_DATE"] = F.lit(load_date)                  # PRJ-3
    return _with_cards(inputs.fee_txn, side).select(*_named(cols, MID_COLS))


# -- H, I: history and the mart --------------------------------------------

def history_dim(history: DataFrame) -> DataFrame:
    """H: distinct on-line history (AGG-1)."""
    return history.select(*HISTORY_COLS).distinct()


def spread_history(history: DataFrame) -> DataFrame:
    """H dealt by its trimmed join keys (``K0..K2``) and made distinct within that dealing, so that a join on
    the keys needs no second shuffle.  For keys of which none holds many rows."""
    keys = [F.trim(c).alias(f"K{i}") for i, c in enumerate(HISTORY_KEYS)]
    return history.select(*HISTORY_COLS, *keys).repartition("K0", "K1", "K2").distinct()


def card_pos_tran(mid: DataFrame, history: DataFrame, spread_keys: bool = False) -> DataFrame:
    """I: G left join H on space-trimmed keys (JOIN-6, STR-4), in the final
    25-column layout (PRJ-4).  ``spread_keys``: no key holds many rows of either side."""
    # No hint: Spark's static size check on the history scan (file statistics
    # against autoBroadcastJoinThreshold) broadcasts it only when small; at
    # scale it is a sort-merge join, where AQE splits a hot mart-side key.
    # (A forced sort-merge join cost 0.7 s more at sf0.1.)
    if spread_keys:
        hist = spread_history(history)
        cond = trimmed_keys(mid, None, zip(MART_KEYS, (hist["K0"], hist["K1"], hist["K2"])))
    else:
        hist = history_dim(history)
        cond = trimmed_keys(mid, hist, zip(MART_KEYS, HISTORY_KEYS))
    return (mid.join(hist, cond, "left")
            .select(
                "HIS_DW_DATE", "TX_DT", "TXN_TM", "CRD_NO", "CRD_TYP", "CRD_KND",
                "CRD_KND_NM", "AC", "OPN_DT", "CINO", "OPN_BR",
                F.col("org_name").alias("ORG_NAME"),
                F.col("org_upperid").alias("ORG_UPPERID"),
                F.col("org_uppername").alias("ORG_UPPERNAME"),
                "TRC_NO", "MSG_TYP", "TXN_AMT", "TOKEN", "SED_BR", "ACP_BR", "MEC_TYP",
                "GET_FEE", "TKE_FEE", "ADDDATA2", "POSINPUTTYPE"))


def build_mart(inputs: CardInputs, load_date: str = DEFAULT_LOAD_DATE, spread_keys: bool = False) -> DataFrame:
    """Stages A..I: the 25-column ``ldm_card_pos_tran`` rows."""
    return card_pos_tran(card_tran_mid(inputs, load_date), inputs.online_history, spread_keys)


def mart_task_job(inputs_of, database: str, load_date: str = DEFAULT_LOAD_DATE, spread_keys: bool = False):
    """The job a matched mart task runs: build the mart from ``inputs_of(spark)``
    and overwrite ``<database>.<table_name>`` (with a load timestamp)."""
    from . import sinks

    def run(spark, table_name):
        rows = sinks.with_load_time(build_mart(inputs_of(spark), load_date, spread_keys))
        sinks.ensure_database(rows.sparkSession, database)
        sinks.overwrite_table(rows, f"{database}.{table_name}")
    return run


@dataclass(frozen=True)
class MartStages:
    # The stages' view names.
    v_org_branch_tmp: DataFrame
    rps_card_info_tmp: DataFrame
    rps_card_knd_tmp: DataFrame
    ldm_card_info_tmp1: DataFrame
    crd_no_para: DataFrame
    m_mmp_fee_txn_tmp: DataFrame
    m_mmp_fee_txn_tmp2: DataFrame
    m_mmp_fee_txn_tmp1: DataFrame
    ldm_card_pos_tran_mid: DataFrame
    mp_onltranrechis_source_tmp: DataFrame
    ldm_card_pos_tran_stage: DataFrame


def mart_stages(inputs: CardInputs, load_date: str = DEFAULT_LOAD_DATE) -> MartStages:
    dims = checked_dims(inputs)
    info = card_info(inputs.cards, dims[0])
    kept = fee_txn_kept(inputs.fee_txn, inputs.cards)
    mid = card_tran_mid(inputs, load_date, info=info, dims=dims)
    return MartStages(
        v_org_branch_tmp=branch_dim(inputs.branches),
        rps_card_info_tmp=live_cards(inputs.cards),
        rps_card_knd_tmp=kind_dim(inputs.cards),
        ldm_card_info_tmp1=info,
        crd_no_para=card_numbers(info),
        m_mmp_fee_txn_tmp=kept,
        m_mmp_fee_txn_tmp2=fee_sign_digits(kept),
        m_mmp_fee_txn_tmp1=fee_txn_enriched(inputs.fee_txn, info),
        ldm_card_pos_tran_mid=mid,
        mp_onltranrechis_source_tmp=history_dim(inputs.online_history),
        ldm_card_pos_tran_stage=card_pos_tran(mid, inputs.online_history),
    )


def register_stages(stages: MartStages) -> list[str]:
    """Publish every stage as a temp view under its stage name, for SQL users
    (MAT-3).  Returns the view names."""
    names = []
    for name, df in vars(stages).items():
        df.createOrReplaceTempView(name)
        names.append(name)
    return names
