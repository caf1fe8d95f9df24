"""Declared schemas: input documents and the tables kept in step with them.

Documents are never schema-inferred. Every document schema carries a
``_corrupt_record`` column so that a document with bad syntax *or* a value of
the wrong type is kept whole for quarantine instead of being half-parsed.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, I, B, L = T.StringType(), T.IntegerType(), T.BooleanType(), T.LongType()
CORRUPT = "_corrupt_record"


def dec(p: int, s: int) -> T.DecimalType:
    return T.DecimalType(p, s)


def _struct(fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


SUBCATEGORY_RANK = _struct([("subcategory", S), ("rank", I), ("id", S)])
FEE_BREAKDOWN = _struct([("fba_fee", dec(10, 2)), ("referral_fee", dec(10, 2)),
                         ("variable_closing_fee", dec(10, 2)), ("total_fees", dec(10, 2))])
STRINGS = T.ArrayType(S)

# Product attributes in document order (types of the stored snapshot table).
PRODUCT_ATTRIBUTES = _struct([
    ("title", S), ("price", dec(12, 2)), ("reviews", I), ("category", S), ("rating", dec(3, 2)),
    ("image_url", S), ("parent_asin", S), ("is_variant", B), ("seller_type", S), ("variants", STRINGS),
    ("breadcrumb_path", S), ("is_standalone", B), ("is_parent", B), ("is_available", B), ("brand", S),
    ("product_rank", I), ("weight_value", dec(8, 3)), ("weight_unit", S), ("length_value", dec(8, 3)),
    ("width_value", dec(8, 3)), ("height_value", dec(8, 3)), ("dimensions_unit", S),
    ("listing_quality_score", I), ("number_of_sellers", I), ("buy_box_owner", S),
    ("buy_box_owner_seller_id", S), ("date_first_available", S), ("date_first_available_is_estimated", B),
    ("approximate_30_day_revenue", dec(14, 2)), ("approximate_30_day_units_sold", I),
    ("subcategory_ranks", T.ArrayType(SUBCATEGORY_RANK)), ("fee_breakdown", FEE_BREAKDOWN),
    ("ean_list", STRINGS), ("isbn_list", STRINGS), ("upc_list", STRINGS), ("gtin_list", STRINGS),
    ("variant_reviews", I), ("updated_at", S),
])

# Integer attributes whose absence the reference keeps as NULL (pointer ints);
# every other absent scalar becomes its zero value on the code path.
NULLABLE_INTS = ("product_rank", "listing_quality_score", "number_of_sellers", "variant_reviews")
NESTED_ATTRIBUTES = ("variants", "subcategory_ranks", "fee_breakdown", "ean_list", "isbn_list",
                     "upc_list", "gtin_list")


def _doc(attributes: T.StructType) -> T.StructType:
    item = _struct([("id", S), ("type", S), ("attributes", attributes)])
    return _struct([("data", T.ArrayType(item)), (CORRUPT, S)])


PRODUCT_DOC = _doc(PRODUCT_ATTRIBUTES)

# Variant form of the two free maps (the reference keeps them as free JSON):
# unknown keys survive; fields are read with variant_get at use.
FREE_FORM = ("subcategory_ranks", "fee_breakdown")
PRODUCT_ATTRIBUTES_VARIANT = T.StructType([
    T.StructField(f.name, T.VariantType() if f.name in FREE_FORM else f.dataType, True)
    for f in PRODUCT_ATTRIBUTES.fields])
PRODUCT_DOC_VARIANT = _doc(PRODUCT_ATTRIBUTES_VARIANT)

SALES_POINT = _struct([("date", S), ("estimated_units_sold", I), ("last_known_price", dec(10, 2))])
SALES_ATTRIBUTES = _struct([("asin", S), ("is_parent", B), ("is_variant", B), ("is_standalone", B),
                            ("parent_asin", S), ("variants", STRINGS), ("data", T.ArrayType(SALES_POINT))])
SALES_DOC = _doc(SALES_ATTRIBUTES)

# Keyword metrics, all unbounded NUMERIC in the reference (fixed values).
KEYWORD_METRICS = (
    "monthly_trend", "monthly_search_volume_exact", "quarterly_trend", "monthly_search_volume_broad",
    "recommended_promotions", "sp_brand_ad_bid", "ppc_bid_broad", "ppc_bid_exact",
    "ease_of_ranking_score", "relevancy_score", "organic_product_count", "sponsored_product_count",
    "organic_rank", "sponsored_rank", "overall_rank", "organic_ranking_asins_count",
    "sponsored_ranking_asins_count", "avg_competitor_organic_rank", "avg_competitor_sponsored_rank",
    "relative_organic_position", "relative_sponsored_position", "variation_lowest_organic_rank",
    "variation_lowest_sponsored_rank",
)
METRIC = dec(38, 10)
KEYWORD_ATTRIBUTES = _struct([("country", S), ("name", S), ("primary_asin", S), ("dominant_category", S),
                              ("updated_at", S)] + [(m, METRIC) for m in KEYWORD_METRICS])
KEYWORD_DOC = _doc(KEYWORD_ATTRIBUTES)

# Column order of the keyword table (30 columns).
KEYWORD_COLUMNS = ("id", "type", "country", "name", "primary_asin", "monthly_trend",
                   "monthly_search_volume_exact", "quarterly_trend", "monthly_search_volume_broad",
                   "dominant_category", "recommended_promotions", "sp_brand_ad_bid", "ppc_bid_broad",
                   "ppc_bid_exact", "ease_of_ranking_score", "relevancy_score", "organic_product_count",
                   "sponsored_product_count", "updated_at", "organic_rank", "sponsored_rank", "overall_rank",
                   "organic_ranking_asins_count", "sponsored_ranking_asins_count",
                   "avg_competitor_organic_rank", "avg_competitor_sponsored_rank",
                   "relative_organic_position", "relative_sponsored_position",
                   "variation_lowest_organic_rank", "variation_lowest_sponsored_rank")

STATUS_TABLE = _struct([
    ("asin", S), ("has_product_data", B), ("has_sales_data", B), ("error", S),
    ("product_data_synced_at", T.TimestampNTZType()), ("sales_estimate_data_synced_at", T.TimestampNTZType()),
    ("product_fetch_attempted_at", T.TimestampNTZType()), ("created_at", T.TimestampNTZType()),
    ("updated_at", T.TimestampNTZType())])

USAGE_TABLE = _struct([("usage_date", T.DateType()), ("endpoint", S), ("call_count", L),
                       ("created_at", T.TimestampNTZType()), ("updated_at", T.TimestampNTZType())])

SALES_TABLE = _struct([
    ("asin", S), ("marketplace", S), ("is_parent", B), ("is_variant", B), ("is_standalone", B),
    ("parent_asin", S), ("date", T.DateType()), ("estimated_units_sold", I), ("last_known_price", dec(10, 2)),
    ("rank", I), ("created_at", T.TimestampNTZType()), ("updated_at", T.TimestampNTZType())])

# NOT NULL columns of the sales table (rows missing one are rejected, SNK-4).
SALES_REQUIRED = ("asin", "marketplace", "is_parent", "is_variant", "is_standalone", "date")
