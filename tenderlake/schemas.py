"""Declared schemas: nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 4)
TOTAL = T.DecimalType(38, 4)

# Natural key of a notice, shared by the three silver tables.
KEY = ["notice_no", "unit_id", "modality_id"]

# CSV header of the published files -> column name, per table.
NOTICE_HEADERS = {
    "Número Licitação": "notice_no",
    "Código UG": "unit_id",
    "Nome UG": "unit_name",
    "Código Modalidade Compra": "modality_id",
    "Modalidade Compra": "modality_name",
    "Número Processo": "process_no",
    "Objeto": "subject",
    "Situação Licitação": "status",
    "Código Órgão Superior": "parent_agency_id",
    "Nome Órgão Superior": "parent_agency_name",
    "Código Órgão": "agency_id",
    "Nome Órgão": "agency_name",
    "UF": "state",
    "Município": "city",
    "Data Resultado Compra": "result_date",
    "Data Abertura": "opening_date",
    "Valor Licitação": "value",
}
ITEM_HEADERS = {
    "Número Licitação": "notice_no",
    "Código UG": "unit_id",
    "Código Modalidade Compra": "modality_id",
    "Código Item Compra": "item_code",
    "Descrição": "description",
    "Quantidade Item": "quantity",
    "Valor Item": "unit_value",
    "Código Vencedor": "winner_id",
    "Nome Vencedor": "winner_name",
}
BID_HEADERS = {
    "Número Licitação": "notice_no",
    "Código UG": "unit_id",
    "Código Modalidade Compra": "modality_id",
    "Código Item Compra": "item_code",
    "Código Participante": "bidder_id",
    "Nome Participante": "bidder_name",
    "Flag Vencedor": "is_winner",
}

# Archive member type -> silver table. Other members are not modelled.
MEMBER_TABLES = {
    "Licitação": "notice",
    "ItemLicitação": "item",
    "ParticipantesLicitação": "bid",
}
TABLE_HEADERS = {"notice": NOTICE_HEADERS, "item": ITEM_HEADERS, "bid": BID_HEADERS}

_TYPES = {
    "modality_id": T.IntegerType(),
    "result_date": T.DateType(),
    "opening_date": T.DateType(),
    "value": MONEY,
    "quantity": MONEY,
    "unit_value": MONEY,
    "is_winner": T.BooleanType(),
}


def _silver(headers: dict[str, str]) -> T.StructType:
    fields = [T.StructField(name, _TYPES.get(name, T.StringType())) for name in headers.values()]
    # line_no keeps the order of the source file; period is the partition column.
    return T.StructType(
        fields + [T.StructField("line_no", T.LongType()), T.StructField("period", T.StringType())]
    )


SILVER = {table: _silver(headers) for table, headers in TABLE_HEADERS.items()}


_NAMED = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "money": MONEY,
    "total": TOTAL,
    "score": T.DecimalType(12, 6),
}


def _struct(spec: str) -> T.StructType:
    """Columns as "name type, ..."; unlike a DDL parse this needs no session."""
    pairs = (column.split() for column in spec.split(","))
    return T.StructType([T.StructField(name, _NAMED[kind]) for name, kind in pairs])


# Serving tables. Facts carry the natural key instead of a generated id.
SERVING = {
    "modality": _struct("modality_id int, name string"),
    "agency": _struct("agency_id string, name string, parent_agency_id string"),
    "unit": _struct("unit_id string, name string, state string, city string, agency_id string"),
    "supplier": _struct("supplier_id string, name string"),
    "notice": _struct(
        "notice_no string, unit_id string, modality_id int, process_no string, subject string, "
        "status string, opening_date date, result_date date, value money, period string"
    ),
    "item": _struct(
        "notice_no string, unit_id string, modality_id int, item_code string, description string, "
        "quantity money, unit_value money, winner_id string, period string"
    ),
    "bid": _struct(
        "notice_no string, unit_id string, modality_id int, item_code string, bidder_id string, "
        "is_winner boolean, period string"
    ),
    "ingestion_log": _struct(
        "period string, file string, rows_read bigint, rows_inserted bigint, rows_updated bigint, "
        "rows_rejected bigint, started_at timestamp_ntz, finished_at timestamp_ntz, "
        "status string, error string"
    ),
    "model_run": _struct(
        "run_id string, run_type string, algorithm string, params string, metrics string, "
        "window_start string, window_end string, executed_at timestamp_ntz"
    ),
    "forecast": _struct(
        "run_id string, run_type string, series_key string, target_period string, target string, "
        "predicted total, lower total, upper total"
    ),
    "notice_score": _struct(
        "run_id string, notice_no string, unit_id string, modality_id int, score score, "
        "rank bigint, features string, period string"
    ),
}
