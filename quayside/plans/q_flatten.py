"""Document source and flattening queries (SRC-1..3/6/7, FLT-1..16, UPS-1/2)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from quayside.functions.dates import lenient_date, lenient_timestamp
from quayside.functions.ids import asin_from_id, empty_to_null, id_asin, id_marketplace
from quayside.operators import flatten as flt
from quayside.operators import upsert as ups
from quayside.plans.registry import query
from quayside.sources import payloads as P
from quayside.sources import standin_docs as D
from quayside.sources.standins import AS_OF

REPORT_DATE = AS_OF.date()
K = "p_partkey"
DOC = f"({K} // {D.ITEMS_PER_PRODUCT_DOC})"


def _products(spark, sf):
    return P.read_product_payloads(D.product_documents(spark, sf))


def _good_products(spark, sf):
    return P.good_documents(_products(spark, sf))


def _flat(spark, sf, defaults="zero", asin_rule="code", created=AS_OF):
    return flt.flatten_products(_good_products(spark, sf), REPORT_DATE, created, defaults, asin_rule)


# --- sources ---------------------------------------------------------------

SRC_PRODUCT_SQL_DOCS = f"""
SELECT {DOC} AS doc_id, CASE WHEN {D.BROKEN_SQL} THEN NULL ELSE CAST(count(*) AS INT) END AS n_items,
       CASE WHEN {D.BROKEN_SQL} THEN 'parse_error' ELSE 'ok' END AS outcome
FROM part GROUP BY 1, {D.BROKEN_SQL}
UNION ALL
SELECT -{K} - 1 AS doc_id, 0 AS n_items, 'empty_response' AS outcome FROM part WHERE {K} % {D.EMPTY_EVERY} = 0"""
SRC_PRODUCT_SQL = f"""
SELECT outcome, count(*) AS documents, CAST(sum(n_items) AS BIGINT) AS items FROM ({SRC_PRODUCT_SQL_DOCS}) d
GROUP BY outcome"""


@query("src_product_payload", SRC_PRODUCT_SQL_DOCS)
def q_src_product_payload(spark, sf):
    return P.document_summary(_products(spark, sf))


@query("src_product_files", SRC_PRODUCT_SQL)
def q_src_product_files(spark, sf):
    """The same documents landed as files (one per line) and read with
    ``spark.read.json`` and the declared schema, as a landing folder is."""
    import uuid
    from quayside.session import ensure_checkpoint_dir
    landing = f"{ensure_checkpoint_dir(spark).rstrip('/')}/landed-products-{uuid.uuid4().hex[:12]}"
    docs = D.product_documents(spark, sf)
    docs.select("doc").write.text(landing)
    parsed = P.read_payload_files(spark, landing, "product")
    # Files carry no document id, so the result is per outcome: documents
    # and items.
    return P.document_summary(parsed.drop("source_file")).groupBy("outcome").agg(
        F.count(F.lit(1)).alias("documents"), F.sum("n_items").alias("items"))


@query("src_sales_payload", """
SELECT DISTINCT l_partkey AS doc_id, CASE WHEN l_partkey % 10 = 0 THEN 2 ELSE 1 END AS n_items, 'ok' AS outcome
FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_returnflag = 'R'""")
def q_src_sales_payload(spark, sf):
    return P.document_summary(P.read_sales_payloads(D.sales_documents(spark, sf)))


@query("src_keyword_payload", """
SELECT doc_id // 50 AS doc_id, CAST(count(*) AS INT) AS n_items, 'ok' AS outcome FROM documents GROUP BY 1""")
def q_src_keyword_payload(spark, sf):
    return P.document_summary(P.read_keyword_payloads(D.keyword_documents(spark, sf)))


@query("src_quarantine", f"""
SELECT DISTINCT {DOC} AS doc_id, 'parse_error' AS reason FROM part WHERE {D.BROKEN_SQL}""")
def q_src_quarantine(spark, sf):
    return P.quarantine(_products(spark, sf)).select("doc_id", "reason")


@query("src_empty_docs", f"""
SELECT -{K} - 1 AS doc_id, 'empty_response' AS reason FROM part WHERE {K} % {D.EMPTY_EVERY} = 0""")
def q_src_empty_docs(spark, sf):
    return P.empty_documents(_products(spark, sf))


# --- flattening --------------------------------------------------------------

@query("flatten_products", D.product_rows_sql("null", "script"))
def q_flatten_products(spark, sf):
    """Script path: absent scalars stay NULL, asin = second id field."""
    return flt.nested_to_json(_flat(spark, sf, "null", "script"))


@query("flatten_zero_defaults", D.product_rows_sql("zero", "code"))
def q_flatten_zero_defaults(spark, sf):
    """Code path: absent scalars become zero values, asin by FLT-5."""
    return flt.nested_to_json(_flat(spark, sf, "zero", "code"))


SALES_PTS = {"pts": D.SALES_POINTS_SQL}


def _with(extra: dict, sql: str) -> str:
    return "WITH " + ",\n".join(f"{n} AS ({b})" for n, b in extra.items()) + "\n" + sql


def _sales_docs(spark, sf):
    return P.good_documents(P.read_sales_payloads(D.sales_documents(spark, sf)))


@query("flatten_sales", _with(SALES_PTS, D.sales_rows_sql(first_item_only=False)))
def q_flatten_sales(spark, sf):
    return flt.flatten_sales(_sales_docs(spark, sf))


@query("flatten_sales_first", _with(SALES_PTS, D.sales_rows_sql(first_item_only=True)))
def q_flatten_sales_first(spark, sf):
    return flt.flatten_sales(_sales_docs(spark, sf), marketplace="us", first_item_only=True)


@query("flatten_keywords", D.keyword_rows_sql())
def q_flatten_keywords(spark, sf):
    return flt.flatten_keywords(P.good_documents(P.read_keyword_payloads(D.keyword_documents(spark, sf))))


def _items(spark, sf):
    return flt.items(_good_products(spark, sf), keep=["doc_id"])


ID_SQL = (f"CASE WHEN {K} % 10 = 0 THEN {D._asin_sql(K)} WHEN {K} % 10 = 1 THEN concat('us/', {D._asin_sql(K)}, '/v2') "
          f"ELSE concat('us/', {D._asin_sql(K)}) END")


@query("json_unnest", f"SELECT {DOC} AS doc_id, {ID_SQL} AS id FROM part WHERE NOT {D.BROKEN_SQL}")
def q_json_unnest(spark, sf):
    return _items(spark, sf).select("doc_id", F.col("item.id").alias("id"))


@query("asin_from_id", f"""
SELECT {ID_SQL} AS id, CASE WHEN {K} % 10 = 1 THEN {ID_SQL} ELSE {D._asin_sql(K)} END AS asin
FROM part WHERE NOT {D.BROKEN_SQL}""")
def q_asin_from_id(spark, sf):
    i = F.col("item.id")
    return _items(spark, sf).select(i.alias("id"), asin_from_id(i).alias("asin"))


@query("id_parts", f"""
SELECT {ID_SQL} AS id, CASE WHEN {K} % 10 = 0 THEN {D._asin_sql(K)} ELSE 'us' END AS marketplace,
       CASE WHEN {K} % 10 = 0 THEN '' ELSE {D._asin_sql(K)} END AS asin
FROM part WHERE NOT {D.BROKEN_SQL}""")
def q_id_parts(spark, sf):
    i = F.col("item.id")
    return _items(spark, sf).select(i.alias("id"), id_marketplace(i).alias("marketplace"), id_asin(i).alias("asin"))


DAY_SQL = f"(DATE '2000-01-01' + CAST({K} % 3000 AS INT))"


@query("lenient_date", f"""
SELECT {ID_SQL} AS id,
       CASE WHEN {K} % 11 = 0 THEN 'unknown' WHEN {K} % 11 = 1 THEN ''
            WHEN {K} % 11 = 2 THEN concat_ws('-', CAST(year({DAY_SQL}) AS VARCHAR), CAST(month({DAY_SQL}) AS VARCHAR),
                                             CAST(day({DAY_SQL}) AS VARCHAR))
            ELSE strftime({DAY_SQL}, '%Y-%m-%d') END AS raw,
       {D.dfa_sql(K)} AS parsed
FROM part WHERE NOT {D.BROKEN_SQL}""")
def q_lenient_date(spark, sf):
    raw = F.col("item.attributes.date_first_available")
    return _items(spark, sf).select(F.col("item.id").alias("id"), raw.alias("raw"), lenient_date(raw).alias("parsed"))


@query("lenient_timestamp", f"""
SELECT {ID_SQL} AS id,
       CASE WHEN {K} % 3 = 0 THEN concat(strftime(DATE '2024-01-01' + CAST({K} % 28 AS INT), '%Y-%m-%d'), 'T10:20:30Z')
            WHEN {K} % 3 = 1 THEN concat(strftime(DATE '2024-01-01' + CAST({K} % 28 AS INT), '%Y-%m-%d'), 'T10:20:30.25+02:00')
            ELSE 'yesterday' END AS raw,
       {D.RFC_SQL.format(k=K)} AS parsed
FROM part WHERE NOT {D.BROKEN_SQL}""")
def q_lenient_timestamp(spark, sf):
    raw = F.col("item.attributes.updated_at")
    return _items(spark, sf).select(F.col("item.id").alias("id"), raw.alias("raw"),
                                    lenient_timestamp(raw).alias("parsed"))


@query("empty_parent_to_null", """
SELECT DISTINCT concat('B', lpad(CAST(l_partkey AS VARCHAR), 9, '0')) AS asin,
       CASE WHEN l_partkey % 4 = 1 THEN concat('B', lpad(CAST(l_partkey + 1 AS VARCHAR), 9, '0'))
            WHEN l_partkey % 4 = 2 THEN '' END AS parent_asin_sent,
       CASE WHEN l_partkey % 4 = 1 THEN concat('B', lpad(CAST(l_partkey + 1 AS VARCHAR), 9, '0')) END AS parent_asin
FROM lineitem WHERE l_returnflag = 'R'""")
def q_empty_parent_to_null(spark, sf):
    a = F.col("item.attributes")
    items = flt.items(_sales_docs(spark, sf))  # every item; listings of one product agree
    return items.select(a.getField("asin").alias("asin"), a.getField("parent_asin").alias("parent_asin_sent"),
                        empty_to_null(a.getField("parent_asin")).alias("parent_asin")).distinct()


NOT_JSON = f"{DOC} % 17 = {D.TRAILING_COMMA}"


@query("json_extract_cast", f"""
SELECT {DOC} AS doc_id, CASE WHEN NOT {NOT_JSON} THEN arg_min({ID_SQL}, {ID_SQL}) END AS first_id,
       CASE WHEN NOT {NOT_JSON} THEN arg_min(p_name, {ID_SQL}) END AS first_title,
       CASE WHEN NOT {NOT_JSON} THEN arg_min(CAST(p_retailprice AS DECIMAL(12,2)), {ID_SQL}) END AS first_price,
       CASE WHEN NOT {NOT_JSON} THEN CAST(count(*) AS INT) END AS n_items
FROM part GROUP BY {DOC}
UNION ALL SELECT -{K} - 1, NULL, NULL, NULL, 0 FROM part WHERE {K} % {D.EMPTY_EVERY} = 0""")
def q_json_extract_cast(spark, sf):
    """Every document: those that are no JSON and those without items too."""
    return flt.json_extract_cast(D.product_documents(spark, sf))


PJ = D.product_json_sql(K)


@query("nested_to_json", f"""
SELECT {D.code_asin_sql(K)} AS asin, {", ".join(f"{v} AS {c}" for c, v in PJ.items())}
FROM part WHERE NOT {D.BROKEN_SQL}""")
def q_nested_to_json(spark, sf):
    return flt.nested_to_json(_flat(spark, sf)).select("asin", *PJ.keys())


@query("subcategory_ranks_long", f"""
SELECT {D.code_asin_sql(K)} AS asin, DATE '2024-02-01' AS report_date, p_type AS subcategory,
       CAST({K} % 500 AS INT) AS rank, concat('c', CAST({K} % 50 AS VARCHAR)) AS id
FROM part WHERE NOT {D.BROKEN_SQL} AND {K} % 10 <> 3""")
def q_subcategory_ranks_long(spark, sf):
    return flt.subcategory_ranks_long(_flat(spark, sf))


FBA, REF = f"CAST({K} % 900 AS DECIMAL(10,2)) / 100", f"CAST({K} % 300 AS DECIMAL(10,2)) / 100"


FEES_SQL = f"""
SELECT {D.code_asin_sql(K)} AS asin, DATE '2024-02-01' AS report_date,
       CASE WHEN {K} % 10 <> 7 THEN CAST({FBA} AS DECIMAL(10,2)) END AS fba_fee,
       CASE WHEN {K} % 10 <> 7 THEN CAST({REF} AS DECIMAL(10,2)) END AS referral_fee,
       CASE WHEN {K} % 10 <> 7 THEN CAST(0 AS DECIMAL(10,2)) END AS variable_closing_fee,
       CASE WHEN {K} % 10 <> 7 THEN CAST({FBA} + {REF} AS DECIMAL(10,2)) END AS total_fees
FROM part WHERE NOT {D.BROKEN_SQL}"""


@query("fees_wide", FEES_SQL)
def q_fees_wide(spark, sf):
    return flt.fees_wide(_flat(spark, sf))


@query("fees_variant", FEES_SQL)
def q_fees_variant(spark, sf):
    """The fee object read as a variant (free map), fields cast on read."""
    docs = P.good_documents(P.read_product_payloads(D.product_documents(spark, sf), free_form="variant"))
    return flt.fees_wide(flt.flatten_products(docs, REPORT_DATE, AS_OF))


@query("identifiers_long", f"""
WITH p AS (SELECT * FROM part WHERE NOT {D.BROKEN_SQL})
SELECT {D.code_asin_sql(K)} AS asin, DATE '2024-02-01' AS report_date, 'ean' AS kind,
       CASE WHEN {K} % 3 <> 0 THEN concat('0', lpad(CAST({K} AS VARCHAR), 12, '0')) END AS value FROM p
UNION ALL SELECT {D.code_asin_sql(K)}, DATE '2024-02-01', 'isbn', CAST(NULL AS VARCHAR) FROM p
UNION ALL SELECT {D.code_asin_sql(K)}, DATE '2024-02-01', 'upc', lpad(CAST({K} * 7 AS VARCHAR), 12, '0') FROM p
UNION ALL SELECT {D.code_asin_sql(K)}, DATE '2024-02-01', 'gtin', CAST(NULL AS VARCHAR) FROM p""")
def q_identifiers_long(spark, sf):
    return flt.identifiers_long(_flat(spark, sf))


# --- product upserts -------------------------------------------------------

OLD_CREATED = dt.datetime(2024, 1, 31)


def _product_upsert(spark, sf, touch_created):
    """Stored snapshot = today's rows of the even documents written earlier
    (older title, id and created_at); fresh = every good document."""
    key = F.regexp_extract("id", r"B([0-9]{9})", 1).cast("bigint")
    old = (_flat(spark, sf, created=OLD_CREATED)
           .filter((key / D.ITEMS_PER_PRODUCT_DOC).cast("bigint") % 2 == 0)
           .withColumns({"title": F.concat("title", F.lit(" (old)")), "id": F.concat("id", F.lit("#old"))}))
    fresh = _flat(spark, sf)
    merged = ups.upsert_products(old, fresh, AS_OF, touch_created=touch_created, partition_by=["report_date"],
                                 on_duplicate="unique")
    return flt.nested_to_json(merged)


def _product_upsert_sql(touch_created: bool) -> str:
    even = f"(_k // {D.ITEMS_PER_PRODUCT_DOC}) % 2 = 0"
    created = "TIMESTAMP '2024-02-01 00:00:00'" if touch_created else \
        f"CASE WHEN {even} THEN TIMESTAMP '2024-01-31 00:00:00' ELSE TIMESTAMP '2024-02-01 00:00:00' END"
    return f"""SELECT * EXCLUDE (_k) REPLACE (CASE WHEN {even} THEN concat(id, '#old') ELSE id END AS id,
    {created} AS created_at),
  CASE WHEN {even} THEN 'updated' ELSE 'inserted' END AS action
FROM ({D.product_rows_sql("zero", "code", with_key=True)}) r"""


@query("upsert_products", _product_upsert_sql(False))
def q_upsert_products(spark, sf):
    return _product_upsert(spark, sf, touch_created=False)


@query("upsert_products_touch_created", _product_upsert_sql(True))
def q_upsert_products_touch_created(spark, sf):
    return _product_upsert(spark, sf, touch_created=True)
