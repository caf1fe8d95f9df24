"""API documents built from the driver tables, and the rows they must give.

Each product of ``part`` becomes one item of a product document (100 items
per document), each returned-item history of ``lineitem`` one sales
document, and every 50 rows of ``documents`` one keyword document. The items
carry the awkward cases the reference meets: ids with 0, 1 and 2 slashes,
absent scalars, NULL lists, empty parent keys, bad and unpadded dates, RFC
3339 stamps with ``Z``, offsets and fractions, items with no points. Some
documents are broken on purpose (trailing comma, a float where an int
belongs) and some are empty.

The ``*_SQL`` strings compute, straight from the tables, what the documents
must flatten to; the DuckDB oracle runs them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.sources.standins import asin_of
from quayside.sources.tables import read_table

ITEMS_PER_PRODUCT_DOC = 100
# Document classes broken on purpose: doc_id % 17 == 5 gets a trailing comma,
# doc_id % 17 == 9 a float where an int belongs. Empty documents come from
# every 250th product key.
TRAILING_COMMA, WRONG_TYPE, EMPTY_EVERY = 5, 9, 250


def _d(c: Column, p: int, s: int) -> Column:
    return c.cast(f"decimal({p},{s})")


def _iso(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd")


def _rfc3339(k: Column) -> Column:
    day = _iso(F.date_add(F.lit("2024-01-01").cast("date"), (k % 28).cast("int")))
    return (F.when(k % 3 == 0, F.concat(day, F.lit("T10:20:30Z")))
            .when(k % 3 == 1, F.concat(day, F.lit("T10:20:30.25+02:00")))
            .otherwise(F.lit("yesterday")))


def product_item(k: Column) -> Column:
    a = asin_of(k)
    price = _d(F.col("p_retailprice"), 12, 2)
    size = F.col("p_size")
    day = F.date_add(F.lit("2000-01-01").cast("date"), (k % 3000).cast("int"))
    unpadded = F.concat_ws("-", F.year(day).cast("string"), F.month(day).cast("string"),
                           F.dayofmonth(day).cast("string"))
    fba, ref = _d(k % 900, 10, 2) / 100, _d(k % 300, 10, 2) / 100
    attrs = F.struct(
        F.col("p_name").alias("title"), price.alias("price"),
        F.when(k % 9 == 4, F.lit(None)).otherwise(size * 7).cast("int").alias("reviews"),
        F.col("p_type").alias("category"), _d((k % 50) / 10, 3, 2).alias("rating"),
        F.concat(F.lit("img/"), a, F.lit(".jpg")).alias("image_url"),
        F.when(k % 4 == 0, F.lit("")).when(k % 4 == 1, asin_of(k + 1)).alias("parent_asin"),
        (k % 4 == 1).alias("is_variant"),
        F.when(k % 3 == 0, "AMZ").when(k % 3 == 1, "FBA").alias("seller_type"),
        F.when(k % 5 == 0, F.lit(None)).otherwise(F.array(asin_of(k + 1), asin_of(k + 2))).alias("variants"),
        F.concat(F.col("p_type"), F.lit(" > "), F.col("p_brand")).alias("breadcrumb_path"),
        (k % 4 >= 2).alias("is_standalone"),
        F.when(k % 13 == 0, F.lit(None)).otherwise(k % 4 == 0).alias("is_parent"),
        (k % 9 != 0).alias("is_available"), F.col("p_brand").alias("brand"),
        F.when(k % 6 == 0, F.lit(None)).otherwise(size * 100 + k % 100).cast("int").alias("product_rank"),
        _d(_d(k % 5000, 8, 3) / 1000, 8, 3).alias("weight_value"), F.lit("pounds").alias("weight_unit"),
        _d(_d(k % 300, 8, 3) / 10, 8, 3).alias("length_value"),
        _d(_d(k % 200, 8, 3) / 10, 8, 3).alias("width_value"),
        _d(_d(k % 100, 8, 3) / 10, 8, 3).alias("height_value"), F.lit("inches").alias("dimensions_unit"),
        F.when(k % 7 == 0, F.lit(None)).otherwise(size % 10).cast("int").alias("listing_quality_score"),
        F.when(k % 8 == 0, F.lit(None)).otherwise(k % 5 + 1).cast("int").alias("number_of_sellers"),
        F.col("p_brand").alias("buy_box_owner"),
        F.concat(F.lit("S"), (k % 1000).cast("string")).alias("buy_box_owner_seller_id"),
        F.when(k % 11 == 0, "unknown").when(k % 11 == 1, "").when(k % 11 == 2, unpadded)
        .otherwise(_iso(day)).alias("date_first_available"),
        (k % 2 == 0).alias("date_first_available_is_estimated"),
        _d(price * size, 14, 2).alias("approximate_30_day_revenue"),
        (size * 3).cast("int").alias("approximate_30_day_units_sold"),
        F.when(k % 10 == 3, F.lit(None)).otherwise(F.array(F.struct(
            F.col("p_type").alias("subcategory"), (k % 500).cast("int").alias("rank"),
            F.concat(F.lit("c"), (k % 50).cast("string")).alias("id")))).alias("subcategory_ranks"),
        F.when(k % 10 == 7, F.lit(None)).otherwise(F.struct(
            _d(fba, 10, 2).alias("fba_fee"), _d(ref, 10, 2).alias("referral_fee"),
            _d(F.lit(0), 10, 2).alias("variable_closing_fee"), _d(fba + ref, 10, 2).alias("total_fees")))
        .alias("fee_breakdown"),
        F.when(k % 3 == 0, F.lit(None)).otherwise(F.array(F.concat(F.lit("0"), F.lpad(k.cast("string"), 12, "0"))))
        .alias("ean_list"),
        F.when(k % 10 == 0, F.array().cast("array<string>")).alias("isbn_list"),
        F.array(F.lpad((k * 7).cast("string"), 12, "0")).alias("upc_list"),
        F.lit(None).cast("array<string>").alias("gtin_list"),
        F.when(k % 5 == 0, F.lit(None)).otherwise(size).cast("int").alias("variant_reviews"),
        _rfc3339(k).alias("updated_at"))
    idc = (F.when(k % 10 == 0, a).when(k % 10 == 1, F.concat(F.lit("us/"), a, F.lit("/v2")))
           .otherwise(F.concat(F.lit("us/"), a)))
    return F.struct(idc.alias("id"), F.lit("product_database_result").alias("type"), attrs.alias("attributes"))


def _break(doc: Column, doc_id: Column) -> Column:
    return (F.when(doc_id % 17 == TRAILING_COMMA, F.regexp_replace(doc, r"\]\}$", ",]}"))
            .when(doc_id % 17 == WRONG_TYPE, F.regexp_replace(doc, r'"reviews":([0-9]+)', '"reviews":$1.5'))
            .otherwise(doc))


PRODUCTS_PER_TASK = 25_000  # a product is some 50 bytes in the table and a kilobyte in its document


def product_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, doc)``: product documents as landed JSON text. The products are dealt by document before their
    items are built: the table is a small file that few tasks read."""
    p = read_table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-p.count() // PRODUCTS_PER_TASK))
    dealt = p.withColumn("doc_id", (k / ITEMS_PER_PRODUCT_DOC).cast("bigint")).repartition(tasks, "doc_id")
    docs = (dealt.groupBy("doc_id")
            .agg(F.array_sort(F.collect_list(product_item(k))).alias("data"))
            .select("doc_id", F.to_json(F.struct("data")).alias("doc")))
    empty = p.filter(k % EMPTY_EVERY == 0).select((-k - 1).alias("doc_id"), F.lit('{"data":[]}').alias("doc"))
    return docs.select("doc_id", _break(F.col("doc"), F.col("doc_id")).alias("doc")).unionByName(empty)


def sales_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, doc)``: one sales document per product with returned items:
    monthly points; every 50th product's item has no points, every 23rd has
    one extra point with a bad date and no numbers; every 10th document
    carries a second item for a ``uk`` listing of the same product."""
    li = read_table(spark, sf_dir, "lineitem").filter(F.col("l_returnflag") == "R")
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_retailprice")
    month = F.date_trunc("month", F.col("l_shipdate")).cast("date")
    pts = (li.join(p, li.l_partkey == p.p_partkey)
           .groupBy(F.col("l_partkey").alias("k"), month.alias("m"))
           .agg(F.sum("l_quantity").cast("int").alias("u"), _d(F.max("p_retailprice") + 1, 10, 2).alias("pr")))
    per_key = pts.groupBy("k").agg(F.array_sort(F.collect_list(F.struct(
        _iso(F.col("m")).alias("date"), F.col("u").alias("estimated_units_sold"),
        F.col("pr").alias("last_known_price")))).alias("points"))
    k = F.col("k")
    a = asin_of(k)
    ptype = per_key.schema["points"].dataType
    bad = F.array(F.struct(F.lit("not-a-date").alias("date"), F.lit(None).cast("int").alias("estimated_units_sold"),
                           F.lit(None).cast("decimal(10,2)").alias("last_known_price"))).cast(ptype)
    points = (F.when(k % 50 == 7, F.array().cast(ptype))
              .when(k % 23 == 0, F.concat(F.col("points"), bad)).otherwise(F.col("points")))

    def item(market: str, asin: Column) -> Column:
        attrs = F.struct(asin.alias("asin"), (k % 4 == 0).alias("is_parent"), (k % 4 == 1).alias("is_variant"),
                         (k % 4 >= 2).alias("is_standalone"),
                         F.when(k % 4 == 1, asin_of(k + 1)).when(k % 4 == 2, F.lit("")).alias("parent_asin"),
                         F.lit(None).cast("array<string>").alias("variants"), points.alias("data"))
        return F.struct(F.concat(F.lit(f"{market}/"), asin).alias("id"),
                        F.lit("sales_estimate_result").alias("type"), attrs.alias("attributes"))
    data = F.when(k % 10 == 0, F.array(item("us", a), item("uk", a))).otherwise(F.array(item("us", a)))
    return per_key.select(k.alias("doc_id"), F.to_json(F.struct(data.alias("data"))).alias("doc"))


def keyword_metric(i: int, doc_id: Column, n_chars: Column) -> Column:
    """Value of the i-th keyword metric (NULL for every 7th key on odd i)."""
    if i == 1:
        v = _d(n_chars, 38, 10)
    elif i == 8:
        v = _d(doc_id % 100, 38, 10)
    else:
        v = _d(_d((n_chars + doc_id * i) % (97 + i), 38, 10) / 100, 38, 10)
    return F.when((doc_id % 7 == 0) & F.lit(i % 2 == 1) & F.lit(i not in (1, 8)), F.lit(None)).otherwise(v)


def keyword_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quayside.schemas import KEYWORD_METRICS
    d = read_table(spark, sf_dir, "documents")
    did, n = F.col("doc_id"), F.col("n_chars")
    attrs = F.struct(F.col("lang").alias("country"), F.col("source").alias("name"),
                     asin_of(did).alias("primary_asin"), F.col("lang").alias("dominant_category"),
                     _rfc3339(did).alias("updated_at"),
                     *[keyword_metric(i, did, n).alias(m) for i, m in enumerate(KEYWORD_METRICS)])
    item = F.struct(F.concat(F.col("lang"), F.lit("/"), did.cast("string")).alias("id"),
                    F.lit("keyword").alias("type"), attrs.alias("attributes"))
    return (d.groupBy((did / 50).cast("bigint").alias("doc_id")).agg(F.array_sort(F.collect_list(item)).alias("data"))
            .select("doc_id", F.to_json(F.struct("data")).alias("doc")))


# --- expected rows, computed from the tables (DuckDB) --------------------

def _asin_sql(k: str) -> str:
    return f"concat('B', lpad(CAST({k} AS VARCHAR), 9, '0'))"


BROKEN_SQL = f"((p_partkey // {ITEMS_PER_PRODUCT_DOC}) % 17 IN ({TRAILING_COMMA}, {WRONG_TYPE}))"

RFC_SQL = """CASE WHEN {k} % 3 = 0 THEN CAST(DATE '2024-01-01' + CAST({k} % 28 AS INT) AS TIMESTAMP) + INTERVAL '10:20:30'
     WHEN {k} % 3 = 1 THEN CAST(DATE '2024-01-01' + CAST({k} % 28 AS INT) AS TIMESTAMP) + INTERVAL '08:20:30.25' END"""


def code_asin_sql(k: str = "p_partkey") -> str:
    """Asin by the code rule (FLT-5) for the generated ids: the 2-slash ids
    are taken whole."""
    a = _asin_sql(k)
    return f"CASE WHEN {k} % 10 = 1 THEN concat('us/', {a}, '/v2') ELSE {a} END"


def dfa_sql(k: str = "p_partkey") -> str:
    """Parsed first-available date: bad and empty text give NULL, and so does
    unpadded text unless month and day have two digits anyway."""
    day = f"(DATE '2000-01-01' + CAST({k} % 3000 AS INT))"
    return (f"CASE WHEN {k} % 11 IN (0, 1) THEN NULL WHEN {k} % 11 = 2 AND (month({day}) < 10 OR day({day}) < 10) "
            f"THEN NULL ELSE {day} END")


def _q(s: str) -> str:
    return f"concat('\"', {s}, '\"')"


def product_json_sql(k: str = "p_partkey", ptype: str = "p_type") -> dict[str, str]:
    """Expected JSON text of the nested product columns (FLT-12 rendering:
    compact, NULL list -> 'null')."""
    fba, ref = f"CAST({k} % 900 AS DECIMAL(10,2)) / 100", f"CAST({k} % 300 AS DECIMAL(10,2)) / 100"
    dv = "CAST(CAST({} AS DECIMAL(10,2)) AS VARCHAR)"
    return {
        "variants": f"CASE WHEN {k} % 5 = 0 THEN 'null' ELSE concat('[', {_q(_asin_sql(k + ' + 1'))}, ',', "
                    f"{_q(_asin_sql(k + ' + 2'))}, ']') END",
        "subcategory_ranks": f"CASE WHEN {k} % 10 = 3 THEN 'null' ELSE concat('[{{\"subcategory\":', {_q(ptype)}, "
                             f"',\"rank\":', CAST({k} % 500 AS VARCHAR), ',\"id\":\"c', CAST({k} % 50 AS VARCHAR), '\"}}]') END",
        "fee_breakdown": f"CASE WHEN {k} % 10 = 7 THEN 'null' ELSE concat('{{\"fba_fee\":', {dv.format(fba)}, "
                         f"',\"referral_fee\":', {dv.format(ref)}, ',\"variable_closing_fee\":0.00,\"total_fees\":', "
                         f"{dv.format(fba + ' + ' + ref)}, '}}') END",
        "ean_list": f"CASE WHEN {k} % 3 = 0 THEN 'null' ELSE concat('[\"0', lpad(CAST({k} AS VARCHAR), 12, '0'), '\"]') END",
        "isbn_list": f"CASE WHEN {k} % 10 = 0 THEN '[]' ELSE 'null' END",
        "upc_list": f"concat('[\"', lpad(CAST({k} * 7 AS VARCHAR), 12, '0'), '\"]')",
        "gtin_list": "'null'",
    }


def product_rows_sql(defaults: str = "zero", asin_rule: str = "code", json: bool = True,
                     with_key: bool = False) -> str:
    """Expected flat product rows over ``part`` (only unbroken documents);
    nested columns as JSON text when ``json``."""
    z = defaults == "zero"
    k = "p_partkey"
    a = _asin_sql(k)

    def dz(expr: str, zero: str) -> str:
        return f"coalesce({expr}, {zero})" if z else expr
    idc = f"CASE WHEN {k} % 10 = 0 THEN {a} WHEN {k} % 10 = 1 THEN concat('us/', {a}, '/v2') ELSE concat('us/', {a}) END"
    if asin_rule == "code":
        asin = f"CASE WHEN {k} % 10 = 1 THEN {idc} ELSE {a} END"
    else:
        asin = f"CASE WHEN {k} % 10 = 0 THEN '' ELSE {a} END"
    day = f"(DATE '2000-01-01' + CAST({k} % 3000 AS INT))"
    fba, ref = f"CAST({k} % 900 AS DECIMAL(10,2)) / 100", f"CAST({k} % 300 AS DECIMAL(10,2)) / 100"
    price = "CAST(p_retailprice AS DECIMAL(12,2))"
    sql = f"""
SELECT {asin} AS asin, DATE '2024-02-01' AS report_date, {idc} AS id,
  p_name AS title, {price} AS price,
  {dz(f"CASE WHEN {k} % 9 = 4 THEN NULL ELSE CAST(p_size * 7 AS INT) END", "0")} AS reviews,
  p_type AS category, CAST(({k} % 50) / 10 AS DECIMAL(3,2)) AS rating,
  concat('img/', {a}, '.jpg') AS image_url,
  {dz(f"CASE WHEN {k} % 4 = 0 THEN '' WHEN {k} % 4 = 1 THEN {_asin_sql(k + ' + 1')} END", "''")} AS parent_asin,
  {k} % 4 = 1 AS is_variant,
  {dz(f"CASE WHEN {k} % 3 = 0 THEN 'AMZ' WHEN {k} % 3 = 1 THEN 'FBA' END", "''")} AS seller_type,
  CASE WHEN {k} % 5 = 0 THEN NULL ELSE [{_asin_sql(k + ' + 1')}, {_asin_sql(k + ' + 2')}] END AS variants,
  concat(p_type, ' > ', p_brand) AS breadcrumb_path, {k} % 4 >= 2 AS is_standalone,
  {dz(f"CASE WHEN {k} % 13 = 0 THEN NULL ELSE {k} % 4 = 0 END", "false")} AS is_parent,
  {k} % 9 <> 0 AS is_available, p_brand AS brand,
  CASE WHEN {k} % 6 = 0 THEN NULL ELSE CAST(p_size * 100 + {k} % 100 AS INT) END AS product_rank,
  CAST(CAST({k} % 5000 AS DECIMAL(8,3)) / 1000 AS DECIMAL(8,3)) AS weight_value, 'pounds' AS weight_unit,
  CAST(CAST({k} % 300 AS DECIMAL(8,3)) / 10 AS DECIMAL(8,3)) AS length_value,
  CAST(CAST({k} % 200 AS DECIMAL(8,3)) / 10 AS DECIMAL(8,3)) AS width_value,
  CAST(CAST({k} % 100 AS DECIMAL(8,3)) / 10 AS DECIMAL(8,3)) AS height_value, 'inches' AS dimensions_unit,
  CASE WHEN {k} % 7 = 0 THEN NULL ELSE CAST(p_size % 10 AS INT) END AS listing_quality_score,
  CASE WHEN {k} % 8 = 0 THEN NULL ELSE CAST({k} % 5 + 1 AS INT) END AS number_of_sellers,
  p_brand AS buy_box_owner, concat('S', CAST({k} % 1000 AS VARCHAR)) AS buy_box_owner_seller_id,
  {dfa_sql(k)} AS date_first_available,
  {k} % 2 = 0 AS date_first_available_is_estimated,
  CAST({price} * p_size AS DECIMAL(14,2)) AS approximate_30_day_revenue,
  CAST(p_size * 3 AS INT) AS approximate_30_day_units_sold,
  CASE WHEN {k} % 10 = 3 THEN NULL ELSE [{{'subcategory': p_type, 'rank': CAST({k} % 500 AS INT),
       'id': concat('c', CAST({k} % 50 AS VARCHAR))}}] END AS subcategory_ranks,
  CASE WHEN {k} % 10 = 7 THEN NULL ELSE {{'fba_fee': CAST({fba} AS DECIMAL(10,2)),
       'referral_fee': CAST({ref} AS DECIMAL(10,2)), 'variable_closing_fee': CAST(0 AS DECIMAL(10,2)),
       'total_fees': CAST({fba} + {ref} AS DECIMAL(10,2))}} END AS fee_breakdown,
  CASE WHEN {k} % 3 = 0 THEN NULL ELSE [concat('0', lpad(CAST({k} AS VARCHAR), 12, '0'))] END AS ean_list,
  CASE WHEN {k} % 10 = 0 THEN CAST([] AS VARCHAR[]) END AS isbn_list,
  [lpad(CAST({k} * 7 AS VARCHAR), 12, '0')] AS upc_list, CAST(NULL AS VARCHAR[]) AS gtin_list,
  CASE WHEN {k} % 5 = 0 THEN NULL ELSE CAST(p_size AS INT) END AS variant_reviews,
  {RFC_SQL.format(k=k)} AS updated_at,
  TIMESTAMP '2024-02-01 00:00:00' AS created_at, p_partkey AS _k, p_type AS _pt
FROM part WHERE NOT {BROKEN_SQL}"""
    drop = "_pt" if with_key else "_k, _pt"
    if json:
        js = product_json_sql("_k", "_pt")
        return (f"SELECT * EXCLUDE ({drop}) REPLACE (" + ", ".join(f"{v} AS {c}" for c, v in js.items())
                + ") FROM (" + sql + ") r")
    return f"SELECT * EXCLUDE ({drop}) FROM ({sql}) r"


SALES_POINTS_SQL = """
SELECT l_partkey AS k, CAST(date_trunc('month', l_shipdate) AS DATE) AS date,
       CAST(sum(l_quantity) AS INT) AS estimated_units_sold,
       CAST(max(p_retailprice) + 1 AS DECIMAL(10,2)) AS last_known_price
FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_returnflag = 'R' GROUP BY 1, 2"""


def sales_rows_sql(first_item_only: bool) -> str:
    """Expected flat sales rows: all items with the id prefix as marketplace,
    or the first item only with the request's marketplace and empty parent
    as NULL."""
    a = _asin_sql("k")
    parent = f"CASE WHEN k % 4 = 1 THEN {_asin_sql('k + 1')} WHEN k % 4 = 2 THEN {'NULL' if first_item_only else chr(39) * 2} END"
    body = f"""SELECT {a} AS asin, '{{m}}' AS marketplace, k % 4 = 0 AS is_parent, k % 4 = 1 AS is_variant,
       k % 4 >= 2 AS is_standalone, {parent} AS parent_asin, date, estimated_units_sold, last_known_price
FROM (SELECT * FROM pts UNION ALL SELECT DISTINCT k, NULL, NULL, NULL FROM pts WHERE k % 23 = 0) p
WHERE k % 50 <> 7"""
    if first_item_only:
        return body.format(m="us")
    return body.format(m="us") + "\nUNION ALL\n" + body.format(m="uk") + " AND k % 10 = 0"


def keyword_rows_sql() -> str:
    from quayside.schemas import KEYWORD_COLUMNS, KEYWORD_METRICS
    vals = {}
    for i, m in enumerate(KEYWORD_METRICS):
        if i == 1:
            v = "CAST(n_chars AS DECIMAL(38,10))"
        elif i == 8:
            v = "CAST(doc_id % 100 AS DECIMAL(38,10))"
        else:
            v = f"CAST(CAST((n_chars + doc_id * {i}) % {97 + i} AS DECIMAL(38,10)) / 100 AS DECIMAL(38,10))"
            if i % 2 == 1:
                v = f"CASE WHEN doc_id % 7 = 0 THEN NULL ELSE {v} END"
        vals[m] = v
    vals.update({"id": "concat(lang, '/', CAST(doc_id AS VARCHAR))", "type": "'keyword'", "country": "lang",
                 "name": "source", "primary_asin": _asin_sql("doc_id"), "dominant_category": "lang",
                 "updated_at": RFC_SQL.format(k="doc_id")})
    return "SELECT " + ",\n  ".join(f"{vals[c]} AS {c}" for c in KEYWORD_COLUMNS) + "\nFROM documents"
