"""Schemas of the source tables; readers never infer them."""

from __future__ import annotations

from pyspark.sql.types import (
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

TEXT, LONG, INT, DOUBLE, DATE = StringType(), LongType(), IntegerType(), DoubleType(), DateType()
MONEY = DecimalType(18, 2)


def _columns(**types: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in types.items()])


TABLES: dict[str, StructType] = {
    "FTR_DEAL": _columns(
        ID=LONG, DEAL_NR=TEXT, DEAL_CHNG_SEQ=LONG, DEAL_DT=TEXT, TRDE_MKT_TP_CD=TEXT,
        OFER_RD_TRM_CD=TEXT, OFER_PYMT_TRM_CD=TEXT, OFER_TP_CD=TEXT, OFER_NR=TEXT,
        OFER_CHNG_SEQ=LONG, EMP_NR=TEXT,
    ),
    "FTR_DEAL_CRYR": _columns(ID=LONG, DEAL_NR=TEXT, DEAL_CHNG_SEQ=LONG, OFER_CRYR_CD=TEXT),
    "FTR_DEAL_RTE": _columns(
        ID=LONG, DEAL_NR=TEXT, DEAL_CHNG_SEQ=LONG, OFFER_REG_SEQ=LONG, TRDE_LOC_CD=TEXT,
        TRDE_LOC_TP_CD=TEXT,
    ),
    "FTR_DEAL_LINE_ITEM": _columns(
        ID=LONG, DEAL_NR=TEXT, DEAL_CHNG_SEQ=LONG, BSE_YW=TEXT, DEAL_AMT=MONEY, DEAL_PRCE=MONEY,
        DEAL_QTY=MONEY, OFER_PRCE=MONEY, OFER_QTY=MONEY, OFER_REMN_QTY=MONEY,
    ),
    "FTR_DEAL_RSLT": _columns(ID=LONG, DEAL_NR=TEXT, DEAL_CHNG_SEQ=LONG),
    "MDM_CRYR": _columns(ID=LONG, CRYR_CD=TEXT, CRYR_NM=TEXT),
    "MDM_PORT": _columns(ID=LONG, locCd=TEXT, locNm=TEXT),
    "FTR_OFER": _columns(
        ID=LONG, CRE_USR_ID=TEXT, UPD_USR_ID=TEXT, ALL_YN=TEXT, DEAL_CHNG_SEQ=LONG, DEAL_NR=TEXT,
        DEL_DT=TEXT, DEL_YN=TEXT, EFCT_DT=TEXT, EMP_NR=TEXT, EXPR_YN=TEXT, INPT_SRC=TEXT,
        MSTR_CTRK_NR=TEXT, OFER_CNCL_REQ_DT=TEXT, OFER_CHNG_SEQ=LONG, OFER_DT=TEXT,
        OFER_MAIN_STS_CD=TEXT, OFER_NR=TEXT, OFER_PYMT_TRM_CD=TEXT, OFER_RD_TRM_CD=TEXT,
        OFER_REJT_CD=TEXT, OFER_TX_TP_CD=TEXT, OFER_TP_CD=TEXT, REF_OFER_CHNG_SEQ=LONG,
        REF_OFER_NR=TEXT, TIME_IN_FRC_CD=TEXT, TRDE_CO_CD=TEXT, TRDE_MKT_TP_CD=TEXT,
        TRDE_ROLE_CD=TEXT, VT_GRP_AGRE_YN=TEXT, VT_GRP_OFER_YN=TEXT, WIF_ARGE_YN=TEXT,
    ),
    "FTR_OFER_CRYR": _columns(ID=LONG, OFER_NR=TEXT, OFER_CHNG_SEQ=LONG, OFER_CRYR_CD=TEXT),
    "FTR_OFER_RTE": _columns(
        ID=LONG, OFER_NR=TEXT, OFER_CHNG_SEQ=LONG, OFER_REG_SEQ=LONG, TRDE_LOC_CD=TEXT,
        TRDE_LOC_TP_CD=TEXT,
    ),
    "FTR_OFER_LINE_ITEM": _columns(
        ID=LONG, OFER_NR=TEXT, OFER_CHNG_SEQ=LONG, BSE_YW=TEXT, DEAL_AMT=MONEY, DEAL_PRCE=MONEY,
        DEAL_QTY=MONEY, OFER_PRCE=MONEY, OFER_QTY=MONEY, OFER_REMN_QTY=MONEY,
        TRDE_CONT_TP_CD=TEXT,
    ),
    "INDEX": _columns(
        idxSubject=TEXT, idxCategory=TEXT, idxCd=TEXT, idxNm=TEXT, date=DATE, value=DOUBLE,
        share=TEXT, qtyUnit=TEXT, currency=TEXT,
    ),
    "WEEK_TABLE": _columns(idx=INT, BSE_YW=TEXT, yyyymmdd=TEXT, week2=TEXT),
    "DAY_TABLE": _columns(idx=INT, day=TEXT),
    "MONTH_TABLE": _columns(idx=INT, month=TEXT),
}
