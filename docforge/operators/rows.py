"""Flat rows of extractions, and what may leave the cluster."""

from __future__ import annotations

import json
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docforge.functions import vocab as V
from docforge.session import ship

PRIVATE_KEYS, PAGES_KEY, FLAG = ("text_before_marker", "corrected_text"), "ocr_pages", "sensitive_text_redacted"


def explode_with_default(df: DataFrame, array: str, note: str, default: str, common: Column, out: str = "note") -> DataFrame:
    """A row for each item, or one row with a note where there is none; ``out`` joins the item's and the common note."""
    rows = df.select("*", F.posexplode_outer(array).alias("item_index", "item"))
    own = F.when(F.col("item").isNull(), F.lit(default)).otherwise(F.col(note))
    text = F.array_join(F.filter(F.array(own, common), lambda x: x.isNotNull() & (x != "")), "; ")
    return rows.withColumn(out, F.when(text != "", text))


def concatenated(*frames: DataFrame) -> DataFrame:
    """Rows of several tables one below the other, by column names; a column that a table lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def flat_rows(results: DataFrame) -> DataFrame:
    """The eleven text columns, after the source and the party's index, of validated results (see plans.extract)."""
    rows = explode_with_default(results, "participants", "item.ghi_chu", V.NO_PARTIES_NOTE, F.array_join("warnings", "; "))
    source = {
        "LOẠI ÁN": "case_info.loai_an", "SỐ THỤ LÝ": "case_info.so_thu_ly", "NGÀY THỤ LÝ (DD/MM/YYYY)": "case_info.ngay_thu_ly", "QUAN HỆ PHÁP LUẬT": "case_info.quan_he_phap_luat",
        "TƯ CÁCH TỐ TỤNG": "item.tu_cach_to_tung", "HỌ TÊN ĐƯƠNG SỰ": "item.ho_ten", "NĂM SINH": "item.nam_sinh", "CCCD": "item.cccd", "ĐỊA CHỈ": "item.dia_chi",
        "HỌ TÊN CHỦ TỌA": "case_info.chu_toa", "GHI CHÚ": "note",
    }
    return rows.select("source_file", F.coalesce("item_index", F.lit(0)).alias("row_index"), *(F.col(source[h]).alias(h) for h in V.ROW_HEADERS))


def redact(df: DataFrame, text_columns: list[str], include_sensitive: bool = False) -> DataFrame:
    """Without the values of text columns, and a flag that says so."""
    if include_sensitive:
        return df
    return df.withColumns({c: F.lit(None).cast("string") for c in text_columns} | {"sensitive_text_redacted": F.lit(True)})


def redacted(value: Column, kind: T.DataType) -> Column:
    """``value`` less what is private, at any depth of structs, arrays and maps: an expression made from its type.

    Fields of PRIVATE_KEYS become null, pages give way to a flag, and a struct called metadata says that this was done. Of
    maps, the values of private keys become null and entries of pages go.
    """
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda x: redacted(x, kind.elementType))
    if isinstance(kind, T.MapType):
        kept = F.map_filter(value, lambda k, _: k != PAGES_KEY) if isinstance(kind.keyType, T.StringType) else value
        inside = lambda k, v: F.when(k.isin(*PRIVATE_KEYS), F.lit(None)).otherwise(redacted(v, kind.valueType))
        return F.transform_values(kept, inside if isinstance(kind.keyType, T.StringType) else lambda _, v: redacted(v, kind.valueType))
    if not isinstance(kind, T.StructType):
        return value
    fields, names = [], {f.name for f in kind.fields}
    for f in kind.fields:
        own = value.getField(f.name)
        if f.name == PAGES_KEY:
            own, f = F.lit(True), T.StructField(f"{PAGES_KEY}_redacted", T.BooleanType())  # noqa: PLW2901
        elif f.name in PRIVATE_KEYS:
            own = F.lit(None).cast(f.dataType)
        else:
            own = redacted(own, f.dataType)
            if f.name == "metadata" and isinstance(f.dataType, T.StructType) and FLAG not in f.dataType.names:
                own = F.when(value.getField(f.name).isNotNull(), own.withField(FLAG, F.lit(True)))
        fields.append(own.alias(f.name))
    return F.when(value.isNotNull(), F.struct(*fields)) if names else value


def redact_fields(df: DataFrame) -> DataFrame:
    """``redacted`` on every column of a table, which counts as one struct, and a flag that says so."""
    whole = T.StructType([f for f in df.schema.fields if f.name != FLAG])
    out = df.select(redacted(F.struct(*(F.col(f"`{f.name}`") for f in whole.fields)), whole).alias("_row"))
    return out.select("_row.*", F.lit(True).alias(FLAG))


def redact_typed(df: DataFrame, column: str, schema: str) -> DataFrame:
    """Like ``redact_json`` for JSON of a known schema, without Python: other fields than the schema's are left out."""
    kind = T.StructType.fromDDL(schema)
    return df.withColumn(column, F.to_json(redacted(F.from_json(column, kind), kind), {"ignoreNullFields": "false"}))


def redact_value(value: object) -> object:
    """The same at any depth of a JSON value: texts become null, pages go, metadata says so."""
    if isinstance(value, list):
        return [redact_value(v) for v in value]
    if not isinstance(value, dict):
        return value
    out = {k: None if k in PRIVATE_KEYS else redact_value(v) for k, v in value.items() if k != PAGES_KEY}
    if PAGES_KEY in value:
        out[f"{PAGES_KEY}_redacted"] = True
    if isinstance(out.get("metadata"), dict):
        out["metadata"].setdefault(FLAG, True)
    return out


def redact_json(df: DataFrame, column: str) -> DataFrame:
    """``redact_value`` on JSON text; text that is no JSON becomes null."""
    ship(df.sparkSession)

    @F.pandas_udf("string")
    def run(values: pd.Series) -> pd.Series:
        def one(v: str | None) -> str | None:
            try:
                return None if v is None else json.dumps(redact_value(json.loads(v)), ensure_ascii=False)
            except ValueError:
                return None

        return values.map(one)

    return df.withColumn(column, run(column))
