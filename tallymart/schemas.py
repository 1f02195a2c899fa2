"""Schemas of the raw tables and the fixed vocabularies of the retail domain."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = "decimal(12,2)"  # one line or one order as delivered
TOTAL = "decimal(18,2)"  # sums of money

# --- raw relational snapshots (column order is the file's column order) -------------
RAW_TABLES: dict[str, str] = {
    "brands": "brand_id string, brand_name string, brand_origin string",
    "category": "category_id int, category_display_name string, category_description string",
    "payment_method": "payment_method_id int, display_name string, type string, provider string",
    "customers": "customer_id bigint, first_name string, last_name string, email string, "
    "phone_number string, gender string, tire string, address string, "
    "created_at timestamp, updated_at timestamp",
    "products": "product_id bigint, product_name string, product_description string, "
    f"price {MONEY}, category_id int, brand_id string, created_at timestamp, updated_at timestamp",
    "orders": f"order_id bigint, customer_id bigint, order_date timestamp, total_amount {MONEY}, "
    "payment_method_id int, created_at timestamp, updated_at timestamp",
    "order_items": "order_item_id bigint, order_id bigint, product_id bigint, quantity int, "
    f"price {MONEY}, discount {MONEY}",
}

# --- raw clickstream record ----------------------------------------------------------
DEVICE = "struct<type:string,os:string,browser:string,version:string>"
LOCATION = "struct<city:string,country:string,coordinates:struct<lat:double,lon:double>>"
ACTIONS = (
    "array<struct<type:string,time_offset:int,page:string,search_term:string,"
    "product_id:bigint,product_name:string,category:string,price:double,order_id:string>>"
)
SESSION_METRICS = (
    "struct<duration_seconds:int,page_views:int,actions_count:int,"
    "has_purchase:boolean,revenue:double>"
)
PROPERTIES = "struct<ab_test:string,language:string,currency:string,is_mobile:boolean>"

CLICKSTREAM = (
    "event_id string, session_id string, timestamp timestamp, user_id bigint, "
    f"user_segment string, device {DEVICE}, location {LOCATION}, referrer string, "
    f"referrer_type string, source string, campaign string, actions {ACTIONS}, "
    f"session_metrics {SESSION_METRICS}, properties {PROPERTIES}"
)


def struct(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


# Action types that get a 0/1 flag of their own.
FLAGGED_ACTIONS = [
    "view", "add_to_cart", "purchase", "search",
    "wishlist", "review", "remove_from_cart", "checkout_view",
]

# Accepted vocabularies.
USER_SEGMENTS = ["new", "returning", "loyal", "churn_risk"]
DEVICE_TYPES = ["mobile", "desktop", "tablet"]
TIERS = ["bronze", "silver", "gold", "platinum"]
GENDERS = ["Nam", "Nu", "Other"]
GENDER_SYNONYMS = {"Nam": ["nam", "male", "m"], "Nu": ["nu", "nữ", "female", "f"]}

# Provinces per macro region; any other address counts as the south.
NORTH = "Miền Bắc"
CENTRAL = "Miền Trung & Tây Nguyên"
SOUTH = "Miền Nam"
REGION_PROVINCES = {
    NORTH: [
        "Hà Nội", "Hải Phòng", "Bắc Ninh", "Quảng Ninh", "Hải Dương", "Hưng Yên",
        "Hà Nam", "Nam Định", "Ninh Bình", "Thái Bình", "Vĩnh Phúc", "Phú Thọ",
        "Thái Nguyên", "Bắc Giang", "Tuyên Quang", "Hà Giang", "Cao Bằng", "Bắc Kạn",
        "Lạng Sơn", "Lào Cai", "Yên Bái", "Hòa Bình", "Sơn La", "Điện Biên", "Lai Châu",
    ],
    CENTRAL: [
        "Đà Nẵng", "Thừa Thiên Huế", "Quảng Trị", "Quảng Bình", "Hà Tĩnh", "Nghệ An",
        "Thanh Hóa", "Quảng Nam", "Quảng Ngãi", "Bình Định", "Phú Yên", "Khánh Hòa",
        "Ninh Thuận", "Bình Thuận", "Kon Tum", "Gia Lai", "Đắk Lắk", "Đắk Nông", "Lâm Đồng",
    ],
}

# Delivery tiers (days, label, provinces); the default is the third tier.
DELIVERY_TIERS = [
    (1.2, "Tier 1 - Same/Next Day", ["Hà Nội", "TP Hồ Chí Minh", "Đà Nẵng"]),
    (1.8, "Tier 2 - Express (48h)",
     ["Hải Phòng", "Bình Dương", "Đồng Nai", "Cần Thơ", "Bắc Ninh"]),
    (3.9, "Tier 4 - Remote (>72h)",
     ["Lai Châu", "Điện Biên", "Hà Giang", "Cao Bằng", "Bắc Kạn", "Kon Tum", "Đắk Nông"]),
]
DELIVERY_DEFAULT = (2.4, "Tier 3 - Standard (72h)")

# The twelve model inputs, in vector order.
FEATURES = [
    "sessions_3d", "total_duration_3d", "avg_session_duration_3d", "total_page_views_3d",
    "total_actions_3d", "total_revenue_3d", "view_count_3d", "add_to_cart_count_3d",
    "purchase_count_3d", "search_count_3d", "checkout_view_count_3d", "cart_conversion_rate_3d",
]
LABEL = "label_purchase_tomorrow"

# Rule score (log-odds weights) and lead tiers
# (lowest probability, segment, action, channel).
RULE_INTERCEPT = -1.8
RULE_WEIGHTS = {
    "sessions_3d": 0.35,
    "total_duration_3d": 0.0002,
    "total_page_views_3d": 0.15,
    "total_revenue_3d": 0.000002,
    "add_to_cart_count_3d": 0.45,
    "checkout_view_count_3d": 0.60,
    "cart_conversion_rate_3d": 0.80,
}
LEAD_TIERS = [
    (0.70, "Hot Lead", "Send Premium Offer SMS", "SMS_AND_PUSH"),
    (0.40, "Medium Intent", "Personalized Email Recommendation", "EMAIL"),
    (None, "Low Intent", "Retargeting Display Ad", "DISPLAY_ADS"),
]
