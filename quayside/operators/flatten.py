"""Nested documents -> flat table rows (FLT-1..4, FLT-10..16).

``explode``/``inline`` run inside the scan's stage (no shuffle); nested
columns stay nested and are rendered as JSON text only on request.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.functions.dates import date_lit, lenient_date, lenient_timestamp, ts_lit
from quayside.functions.ids import asin_from_id, empty_to_null, id_asin, id_marketplace
from quayside.schemas import KEYWORD_METRICS, NESTED_ATTRIBUTES, NULLABLE_INTS

_ZERO = {T.StringType: "", T.BooleanType: False, T.IntegerType: 0}


def _zero(dtype: T.DataType) -> Column | None:
    """Zero value of a scalar type (FLT-4 code path)."""
    if isinstance(dtype, T.DecimalType):
        return F.lit(0).cast(dtype)
    for t, z in _ZERO.items():
        if isinstance(dtype, t):
            return F.lit(z)
    return None


def items(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """FLT-11: one row per item of ``data`` (lateral unnest), with its
    position in the document (``pos``)."""
    keep = keep or []
    return docs.select(*keep, F.posexplode("data").alias("pos", "item"))


SEQ = "seq"


def document_order(docs: DataFrame) -> list[str]:
    """Columns that give the documents' order: all that are carried along,
    in table order (for example file time, file name, line)."""
    return [c for c in docs.columns if c not in ("data", "_corrupt_record")]


def flatten_products(docs: DataFrame, report_date: dt.date, created_at: dt.datetime,
                     defaults: str = "zero", asin_rule: str = "code",
                     order: list[str] | None = None) -> DataFrame:
    """FLT-1: product items -> 42-column snapshot rows.

    ``defaults='zero'`` (FLT-4 code path): absent strings, numbers and flags
    become '', 0 and false, except the four nullable ints. ``'null'``
    (script path): absent stays NULL. ``asin_rule='code'`` uses FLT-5,
    ``'script'`` FLT-6. Dates and RFC 3339 stamps parse leniently (FLT-7/8).
    ``report_date`` and ``created_at`` are parameters (FLT-13). ``order``
    names the columns of the documents' order; the rows then carry ``seq``
    (those columns, then the item's position) for last-wins upserts.
    """
    it = items(docs, order)
    idc = F.col("item.id")
    asin = asin_from_id(idc) if asin_rule == "code" else id_asin(idc)
    cols = [asin.alias("asin"), date_lit(report_date).alias("report_date"), idc.alias("id")]
    attrs = docs.schema["data"].dataType.elementType["attributes"].dataType  # declared or variant form
    for f in attrs.fields:
        c = F.col(f"item.attributes.{f.name}")
        if f.name == "date_first_available":
            c = lenient_date(c)
        elif f.name == "updated_at":
            c = lenient_timestamp(c)
        elif defaults == "zero" and f.name not in NULLABLE_INTS and f.name not in NESTED_ATTRIBUTES:
            z = _zero(f.dataType)
            if z is not None:
                c = F.coalesce(c, z)
        cols.append(c.alias(f.name))
    cols.append(ts_lit(created_at).alias("created_at"))
    if order is not None:
        cols.append(F.struct(*order, "pos").alias(SEQ))
    return it.select(*cols)


SALES_COLUMNS = ["asin", "marketplace", "is_parent", "is_variant", "is_standalone", "parent_asin",
                 "date", "estimated_units_sold", "last_known_price"]


def flatten_sales(docs: DataFrame, marketplace: str | None = None, first_item_only: bool = False,
                  order: list[str] | None = None) -> DataFrame:
    """FLT-2: sales item x daily point -> flat rows.

    Script path (default): every item, marketplace from the id prefix,
    ``parent_asin`` as sent. Code path (``first_item_only=True`` with a
    ``marketplace``): only ``data[0]``, marketplace from the request
    (FLT-14), and an empty parent stored as NULL (FLT-9). ``order`` as in
    :func:`flatten_products`; the point's position comes last.
    """
    if first_item_only:
        it = docs.filter(F.size("data") > 0).select(*(order or []), F.lit(0).alias("pos"),
                                                    F.get(F.col("data"), 0).alias("item"))
    else:
        it = items(docs, order)
    a = "item.attributes"
    mk = F.lit(marketplace) if marketplace is not None else id_marketplace(F.col("item.id"))
    parent = F.col(f"{a}.parent_asin")
    if first_item_only:
        parent = empty_to_null(parent)
    head = it.select(F.col(f"{a}.asin").alias("asin"), mk.alias("marketplace"),
                     F.col(f"{a}.is_parent").alias("is_parent"), F.col(f"{a}.is_variant").alias("is_variant"),
                     F.col(f"{a}.is_standalone").alias("is_standalone"), parent.alias("parent_asin"),
                     *([F.struct(*order, "pos").alias("_doc")] if order is not None else []),
                     F.posexplode(F.col(f"{a}.data")).alias("_point", "p"))
    seq = [F.struct("_doc", "_point").alias(SEQ)] if order is not None else []
    return head.select("asin", "marketplace", "is_parent", "is_variant", "is_standalone", "parent_asin",
                       lenient_date(F.col("p.date")).alias("date"),
                       F.col("p.estimated_units_sold").alias("estimated_units_sold"),
                       F.col("p.last_known_price").alias("last_known_price"), *seq)


def flatten_keywords(docs: DataFrame, order: list[str] | None = None) -> DataFrame:
    """FLT-3: keyword items -> 30 columns (metrics as declared decimals). ``order`` as in :func:`flatten_products`."""
    a = "item.attributes"
    cols = [F.col("item.id").alias("id"), F.col("item.type").alias("type")]
    for c in ("country", "name", "primary_asin"):
        cols.append(F.col(f"{a}.{c}").alias(c))
    rest = {m: F.col(f"{a}.{m}") for m in KEYWORD_METRICS}
    rest["dominant_category"] = F.col(f"{a}.dominant_category")
    rest["updated_at"] = lenient_timestamp(F.col(f"{a}.updated_at"))
    from quayside.schemas import KEYWORD_COLUMNS
    cols += [rest[c].alias(c) for c in KEYWORD_COLUMNS[5:]]
    if order is not None:
        cols.append(F.struct(*order, "pos").alias(SEQ))
    return items(docs, order).select(*cols)


def nested_to_json(df: DataFrame, columns=NESTED_ATTRIBUTES) -> DataFrame:
    """FLT-12: render nested columns as JSON text at the edge. A missing
    list becomes the text ``null`` (not SQL NULL), as the reference's
    marshaller writes it; NULL fields inside objects are kept."""
    opts = {"ignoreNullFields": "false"}
    return df.withColumns({c: F.coalesce(F.to_json(F.col(c), opts), F.lit("null"))
                           for c in columns if c in df.columns})


def subcategory_ranks_long(products: DataFrame) -> DataFrame:
    """FLT-15 long form: one row per (asin, report_date, subcategory rank)."""
    return products.select("asin", "report_date", F.inline("subcategory_ranks"))


FEE_FIELDS = ("fba_fee", "referral_fee", "variable_closing_fee", "total_fees")


def fees_wide(products: DataFrame) -> DataFrame:
    """FLT-15 wide form: the fee object as columns (declared struct, or
    ``variant_get`` with a decimal cast when it was read as a variant)."""
    if isinstance(products.schema["fee_breakdown"].dataType, T.VariantType):
        return products.select("asin", "report_date", *[
            F.variant_get("fee_breakdown", f"$.{n}", "decimal(10,2)").alias(n) for n in FEE_FIELDS])
    return products.select("asin", "report_date", "fee_breakdown.*")


IDENTIFIER_KINDS = ("ean", "isbn", "upc", "gtin")


def identifiers_long(products: DataFrame) -> DataFrame:
    """FLT-16 long form: (asin, report_date, kind, value) for every
    identifier in the four lists; keys with an empty or missing list keep
    one row with NULL value (``explode_outer``). One pass over the input:
    the four lists become an array of (kind, list) pairs, inlined, then
    exploded."""
    pairs = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(f"{k}_list").alias("vals"))
                      for k in IDENTIFIER_KINDS])
    return (products.select("asin", "report_date", F.inline(pairs))
            .select("asin", "report_date", "kind", F.explode_outer("vals").alias("value")))


def json_extract_cast(docs: DataFrame, text_col: str = "doc") -> DataFrame:
    """FLT-10: ad-hoc path extraction with casts, for text that is not
    parsed with a schema: ``->>`` is ``get_json_object``; casts are ANSI
    (a bad value raises). Text that is not JSON gives NULL in every field,
    also where a path would match before the fault; a document without
    items has NULL fields and zero items."""
    whole = F.try_parse_json(F.col(text_col)).isNotNull()

    def path(p: str):
        return F.when(whole, F.get_json_object(text_col, p))

    return docs.select(*[c for c in docs.columns if c != text_col],
                       path("$.data[0].id").alias("first_id"), path("$.data[0].attributes.title").alias("first_title"),
                       path("$.data[0].attributes.price").cast("decimal(12,2)").alias("first_price"),
                       F.json_array_length(path("$.data")).alias("n_items"))
