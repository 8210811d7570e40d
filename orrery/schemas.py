"""Table layouts: raw files (all text) and the two galaxies (typed)."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "s": T.StringType(),
    "i": T.IntegerType(),
    "l": T.LongType(),
    "m": T.DecimalType(18, 2),
    # Unit prices keep what the raw file says; amounts are rounded once, when they are computed.
    "p": T.DecimalType(26, 8),
    "d": T.DateType(),
}


def _layout(spec: str) -> T.StructType:
    """``"name:type ..."`` where a trailing ``!`` marks a required column."""
    fields = []
    for part in spec.split():
        name, kind = part.split(":")
        fields.append(T.StructField(name, _TYPES[kind.rstrip("!")], not kind.endswith("!")))
    return T.StructType(fields)


# Raw files, with the type each column takes after the no-value tokens are nulled.
RETAIL_RAW = {
    "customers": _layout("customer_id:s full_name:s email:s country:s signup_date:s"),
    "products": _layout("product_id:s product_name:s category:s base_price:p"),
    "orders": _layout("order_id:s customer_id:s order_date:s status:s shipping_fee:m"),
    "order_items": _layout("order_item_id:s order_id:s product_id:s quantity:i unit_price:p"),
    "sessions": _layout(
        "session_id:s customer_id:s session_date:s traffic_source:s device_type:s "
        "pages_viewed:i duration_seconds:i bounced:i converted:i"
    ),
}

AGENCY_RAW = {
    "managers": _layout("manager_id:s name:s region:s target_monthly_revenue:m"),
    "clients": _layout(
        "client_id:s company_name:s industry:s client_tier:s monthly_retainer_fee:m "
        "onboarding_date:d primary_account_manager_id:s"
    ),
    "campaigns": _layout(
        "campaign_id:s client_id:s campaign_name:s marketing_channel:s monthly_ad_budget:m"
    ),
    "ad_performance": _layout(
        "date:d campaign_id:s client_id:s ad_spend:m impressions:l clicks:l conversions:l "
        "client_conversion_revenue:m"
    ),
    "client_billing": _layout(
        "invoice_date:d invoice_id:s client_id:s manager_id:s retainer_billing:m "
        "ad_management_markup:m consulting_billing:m total_billing_amount:m"
    ),
}

# Galaxy tables.
RETAIL = {
    "dim_customers": _layout("customer_id:s full_name:s! email:s country:s signup_date:d!"),
    "dim_products": _layout("product_id:s product_name:s! category:s! base_price:p!"),
    "dim_date": _layout(
        "date_key:d date:d year:i quarter:i quarter_name:s month:i month_name:s month_short:s "
        "day:i day_of_week:i day_name:s is_weekend:i"
    ),
    "fact_sales": _layout(
        "order_item_id:s order_id:s! customer_id:s! product_id:s! order_date:d! quantity:i! "
        "unit_price:p! line_subtotal:m! shipping_fee:m status:s month_index:i"
    ),
    "fact_web_traffic": _layout(
        "session_id:s customer_id:s! session_date:d! traffic_source:s device_type:s "
        "pages_viewed:i duration_seconds:i bounced:i converted:i"
    ),
}

AGENCY = {
    "dim_account_managers": AGENCY_RAW["managers"],
    "dim_clients": AGENCY_RAW["clients"],
    "dim_campaigns": AGENCY_RAW["campaigns"],
    "dim_date": _layout(
        "date_key:d year:i month:i month_name:s quarter:s day_of_week:s is_weekend:i"
    ),
    "fact_ad_performance": AGENCY_RAW["ad_performance"],
    "fact_client_billing": AGENCY_RAW["client_billing"],
}
