"""Hand-made source tables; unnamed columns get a plain default."""

from decimal import Decimal

from tidelane.schemas import TABLES

DEFAULTS = {
    "DEAL_CHNG_SEQ": 0,
    "TRDE_MKT_TP_CD": "01",
    "OFER_RD_TRM_CD": "01",
    "OFER_PYMT_TRM_CD": "01",
    "OFER_TP_CD": "S",
    "OFFER_REG_SEQ": 1,
    "OFER_REG_SEQ": 1,
    "OFER_CHNG_SEQ": 0,
    "EMP_NR": "U1",
    "ALL_YN": "0",
    "TRDE_CONT_TP_CD": "01",
}


def table(spark, name, rows):
    schema = TABLES[name]

    def value(row, field):
        given = row[field.name] if field.name in row else DEFAULTS.get(field.name)
        if given is not None and field.dataType.typeName().startswith("decimal"):
            return Decimal(str(given))
        return given

    return spark.createDataFrame([tuple(value(r, f) for f in schema.fields) for r in rows], schema)


def deal_tables(spark, deals, carriers=(), names=(("C1", "One"), ("C2", "Two"))):
    """``deals``: rows of (number, time, price, quantity) on route A-B in week 202010,
    or dicts that override ``pol``, ``pod``, ``week`` and ``type``."""
    headers, routes, lines, borne = [], [], [], []
    for nr, deal in enumerate(deals, 1):
        if not isinstance(deal, dict):
            deal = dict(zip(("number", "time", "price", "quantity"), deal))
        number = deal["number"]
        headers.append(
            {"ID": nr, "DEAL_NR": number, "DEAL_DT": deal["time"],
             "OFER_TP_CD": deal.get("type", "S")}
        )
        for kind, place in (("02", deal.get("pol", "A")), ("03", deal.get("pod", "B"))):
            if place is not None:
                routes.append(
                    {"ID": nr, "DEAL_NR": number, "TRDE_LOC_CD": place, "TRDE_LOC_TP_CD": kind}
                )
        weeks = deal.get("week", "202010")
        for week in weeks if isinstance(weeks, list) else [weeks]:
            price, quantity = deal["price"], deal["quantity"]
            lines.append(
                {"ID": nr, "DEAL_NR": number, "BSE_YW": week, "DEAL_PRCE": price,
                 "DEAL_QTY": quantity, "DEAL_AMT": price * quantity}
            )
        for code in carriers:
            borne.append({"ID": nr, "DEAL_NR": number, "OFER_CRYR_CD": code})
    return {
        "FTR_DEAL": table(spark, "FTR_DEAL", headers),
        "FTR_DEAL_RTE": table(spark, "FTR_DEAL_RTE", routes),
        "FTR_DEAL_LINE_ITEM": table(spark, "FTR_DEAL_LINE_ITEM", lines),
        "FTR_DEAL_CRYR": table(spark, "FTR_DEAL_CRYR", borne),
        "FTR_DEAL_RSLT": table(spark, "FTR_DEAL_RSLT", [{"ID": h["ID"]} for h in headers]),
        "MDM_CRYR": table(
            spark, "MDM_CRYR", [{"CRYR_CD": code, "CRYR_NM": name} for code, name in names]
        ),
        "MDM_PORT": table(spark, "MDM_PORT", [{"locCd": "A", "locNm": "Alpha"}]),
    }


def offer_tables(spark, offers, lines, routes=(), carriers=(), deals=()):
    """Offer tables from dict rows, with port A known and B unknown."""
    return {
        "FTR_OFER": table(spark, "FTR_OFER", offers),
        "FTR_OFER_LINE_ITEM": table(spark, "FTR_OFER_LINE_ITEM", lines),
        "FTR_OFER_RTE": table(spark, "FTR_OFER_RTE", routes),
        "FTR_OFER_CRYR": table(spark, "FTR_OFER_CRYR", carriers),
        "FTR_DEAL": table(spark, "FTR_DEAL", deals),
        "MDM_CRYR": table(spark, "MDM_CRYR", [{"CRYR_CD": "C1", "CRYR_NM": "One"}]),
        "MDM_PORT": table(spark, "MDM_PORT", [{"locCd": "A", "locNm": "Alpha"}]),
    }


def time(day, n=0):
    return f"{day}{n:012d}"


def rows(frame, *columns):
    """Rows of the chosen columns, sorted by their text."""
    chosen = frame.select(*columns) if columns else frame
    return sorted((tuple(row) for row in chosen.collect()), key=repr)
