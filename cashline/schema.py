"""Fixed facts about the source system: raw tables, their columns and business keys."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names of each extract table, in file order.
RAW_COLUMNS: dict[str, list[str]] = {
    "KNA1": "MANDT KUNNR NAME1 ORT01 REGIO LAND1 ERDAT".split(),
    "MARA": "MANDT MATNR MTART MATKL MEINS ERSDA LAEDA".split(),
    "MAKT": "MANDT MATNR SPRAS MAKTX".split(),
    "VBAK": "MANDT VBELN AUART ERDAT AUDAT KUNNR WAERK NETWR AEDAT".split(),
    "VBAP": "MANDT VBELN POSNR MATNR KWMENG VRKME NETWR WAERK ABGRU ERDAT AEDAT".split(),
    "VBRK": "MANDT VBELN FKART FKDAT KUNRG WAERK NETWR FKSTO ERDAT AEDAT".split(),
    "VBRP": "MANDT VBELN POSNR AUBEL AUPOS MATNR FKIMG VRKME NETWR ERDAT AEDAT".split(),
    "LIKP": "MANDT VBELN LFART ERDAT LFDAT KUNNR AEDAT".split(),
    "LIPS": "MANDT VBELN POSNR VGBEL VGPOS MATNR LFIMG VRKME ERDAT AEDAT".split(),
    "BSID": "MANDT BUKRS BELNR GJAHR BUZEI KUNNR BLART BUDAT FAEDT ZFBDT ZTERM WRBTR WAERS ZUONR".split(),
    "BSAD": (
        "MANDT BUKRS BELNR GJAHR BUZEI KUNNR BLART BUDAT FAEDT ZFBDT ZTERM WRBTR WAERS ZUONR "
        "AUGDT AUGBL"
    ).split(),
}

# Business key of each extract table.
RAW_KEYS: dict[str, list[str]] = {
    "KNA1": ["KUNNR"],
    "MARA": ["MATNR"],
    "MAKT": ["MATNR", "SPRAS"],
    "VBAK": ["VBELN"],
    "VBAP": ["VBELN", "POSNR"],
    "VBRK": ["VBELN"],
    "VBRP": ["VBELN", "POSNR"],
    "LIKP": ["VBELN"],
    "LIPS": ["VBELN", "POSNR"],
    "BSID": ["BUKRS", "BELNR", "GJAHR", "BUZEI"],
    "BSAD": ["BUKRS", "BELNR", "GJAHR", "BUZEI"],
}

LOADED_AT = "_loaded_at"
SOURCE_FILE = "_source_file"


def text_struct(columns: list[str]) -> T.StructType:
    """A schema in which every column is text."""
    return T.StructType([T.StructField(name, T.StringType()) for name in columns])


def raw_struct(table: str) -> T.StructType:
    """Schema of a raw table: its columns as text, then load time and file name."""
    return (
        text_struct(RAW_COLUMNS[table])
        .add(LOADED_AT, T.TimestampType())
        .add(SOURCE_FILE, T.StringType())
    )


LOAD_LOG = T.StructType(
    [
        T.StructField("file_name", T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("row_count", T.LongType()),
        T.StructField("loaded_at", T.TimestampType()),
    ]
)
