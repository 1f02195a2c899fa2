"""Hand-made inputs with known answers."""

import datetime as dt
from decimal import Decimal

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from tallymart import schemas
from tallymart.functions.columns import percent, with_audit
from tallymart.operators import (
    campaign, features, incremental, kpis, masking, quality, silver, staging, star,
)
from tallymart.operators.dedup import dedup_latest

D = dt.date
T = dt.datetime


def frame(spark, table, rows):
    return spark.createDataFrame(rows, schemas.struct(schemas.RAW_TABLES[table]))


def staged_customers(spark, *people):
    rows = [
        (i, " An ", "B", " A@B.C ", phone, gender, tier, "Hà Nội", None, T(2024, 1, 1))
        for i, (phone, gender, tier) in enumerate(people)
    ]
    return staging.stage(frame(spark, "customers", rows), staging.STAGING["customers"])


# --- staging and silver --------------------------------------------------------------
def test_staging_trims_lowers_and_nulls_bad_values(spark):
    raw = spark.createDataFrame(
        [("x", "7", "1.5e", "2024-13-01")],
        "order_id string, customer_id string, total_amount string, order_date string",
    ).withColumns({c: F.lit(None) for c in ("payment_method_id", "created_at", "updated_at")})
    row = staging.stage(raw, staging.STAGING["orders"]).first()
    assert row.order_id is None and row.customer_id == 7
    assert row.total_amount is None and row.order_date is None


def test_customer_phone_gender_tier(spark):
    staged = staged_customers(
        spark,
        ("090-123 4567", "Nam", "Gold"), ("12345", "F", "vip"), (None, "Nữ", None),
        ("0901234567", "x", "bronze"), ("0901234567", None, "PLATINUM "),
    )
    out = silver.silver_customers(staged).orderBy("customer_id").collect()
    assert [r.phone_number for r in out[:3]] == ["0901234567", None, None]
    assert [r.gender for r in out] == ["Nam", "Nu", "Nu", "Other", "Other"]
    assert [r.tire for r in out] == ["gold", "bronze", "bronze", "bronze", "platinum"]
    assert out[0].email == "a@b.c" and out[0].first_name == "An"


def test_dedup_is_stable_under_repartitioning(spark):
    rows = [(1, T(2024, 1, 1), "old"), (1, T(2024, 1, 2), "b"), (1, T(2024, 1, 2), "a"),
            (2, None, "z")]
    df = spark.createDataFrame(rows, "id int, updated_at timestamp, v string")
    newest = [F.col("updated_at").desc_nulls_last()]
    for n in (1, 3, 7):
        assert rows_of(dedup_latest(df.repartition(n), ["id"], newest).select("id", "v")) == [
            (1, "a"), (2, "z")
        ]


def items(spark, *rows):
    raw = frame(spark, "order_items", [
        (i, o, p, q, Decimal(str(price)), None if d is None else Decimal(str(d)))
        for i, o, p, q, price, d in rows
    ])
    return staging.stage_order_items(raw)


def test_order_items_floor_and_validity(spark):
    staged = items(
        spark, (1, 1, 1, 1, 10, 15), (2, 1, 1, 0, 10, 0), (3, 1, 1, 1, -1, 0),
        (None, 1, 1, 1, 1, 0), (4, 1, 1, 2, 3, None),
    )
    assert staged.filter("order_item_id = 1").first().line_total_amount == Decimal("-5.00")
    out = {r.order_item_id: r.line_total_amount for r in silver.silver_order_items(staged).collect()}
    assert out == {1: Decimal("0.00"), 4: Decimal("6.00")}


def staged_orders(spark, *rows):
    raw = frame(spark, "orders", [
        (i, c, T(2024, 1, d), Decimal(str(total)), 1, None, None) for i, c, d, total in rows
    ])
    return staging.stage(raw, staging.STAGING["orders"])


def test_fact_order_falls_back_to_the_order_total(spark):
    orders = silver.silver_orders(staged_orders(spark, (1, 7, 5, 42.5), (2, 7, 6, 1)))
    lines = silver.silver_order_items(items(spark, (1, 2, 1, 2, 10, 5), (2, 2, 1, 1, 1, 0)))
    out = {r.order_id: r for r in star.fact_order(orders, lines).collect()}
    assert (out[1].quantity, out[1].price, out[1].discount_amt, out[1].sub_total) == (
        0, Decimal("42.50"), Decimal("0.00"), Decimal("42.50"))
    assert (out[2].quantity, out[2].price, out[2].discount_amt, out[2].sub_total) == (
        3, Decimal("21.00"), Decimal("5.00"), Decimal("16.00"))
    assert out[1].date_key == 20240105


# --- clickstream ---------------------------------------------------------------------
def session_row(sid="s", ts="2024-01-01 23:59:50", user=1, actions="[]", **metrics):
    base = {"duration_seconds": 60, "page_views": 1, "actions_count": 0}
    import json

    return (f"e-{sid}-{ts}", sid, ts, user, '{"type":"mobile"}', '{"coordinates":{"lat":1.5}}',
            actions, json.dumps(base | metrics), '{"language":"vi"}')


def staged_sessions(spark, *rows):
    df = spark.createDataFrame(
        list(rows),
        "event_id string, session_id string, timestamp string, user_id long, device string, "
        "location string, actions string, session_metrics string, properties string",
    )
    extra = ("user_segment", "referrer", "referrer_type", "source", "campaign")
    return staging.stage_clickstream(
        df.withColumns({c: F.lit(None).cast("string") for c in extra})
    )


def test_clickstream_reads_json_text(spark):
    row = staged_sessions(spark, session_row(revenue=3.5, has_purchase=True)).first()
    assert row.device_type == "mobile" and row.latitude == 1.5 and row.is_mobile
    assert row.has_purchase and row.revenue == Decimal("3.50")
    bare = staged_sessions(spark, session_row()).first()
    assert bare.has_purchase is False and bare.revenue == Decimal("0.00")
    assert bare.ingest_date == D(2024, 1, 1)


def test_action_may_fall_on_the_next_day(spark):
    acts = ('[{"type":"view","time_offset":15,"product_id":4,"price":2.0},'
            '{"type":"purchase","time_offset":5,"price":2.0}]')
    out = silver.silver_session_actions(staged_sessions(spark, session_row(actions=acts)))
    a, b = out.orderBy("action_id").collect()
    assert (a.action_id, a.action_type, a.revenue) == ("s-act-1", "purchase", Decimal("2.00"))
    assert (b.action_id, b.is_view, b.revenue) == ("s-act-2", 1, Decimal("0.00"))
    assert b.action_timestamp == T(2024, 1, 2, 0, 0, 5) and b.day == 1


@pytest.mark.parametrize("actions", [None, "[]", "{broken"])
def test_no_actions_no_rows_no_failure(spark, actions):
    assert silver.silver_session_actions(
        staged_sessions(spark, session_row(actions=actions))
    ).count() == 0


def test_session_coherence(spark):
    acts = '[{"type":"view","time_offset":5},{"type":"view","time_offset":3}]'
    bad = staged_sessions(
        spark, session_row(actions=acts, actions_count=3, duration_seconds=4)
    )
    found = {r.violation for r in quality.session_coherence(bad).collect()}
    assert found == {"offsets_decrease", "count_differs", "duration_too_short"}
    good = staged_sessions(spark, session_row(actions=acts.replace("3", "7"), actions_count=2))
    assert quality.session_coherence(good).count() == 0


def test_activity_from_log_equals_the_two_daily_tables(spark):
    acts = ('[{"type":"view","time_offset":2,"product_id":4,"price":2.0},'
            '{"type":"purchase","time_offset":15,"product_id":5,"price":3.0},null,'
            '{"type":"search","time_offset":1}]')
    staged = staged_sessions(
        spark, session_row(actions=acts, has_purchase=True, revenue=3.0),
        session_row("s", "2024-01-01 10:00:00", actions=acts),  # superseded record
        session_row("t", "2024-01-01 08:00:00"), session_row("u", user=None, actions=acts),
        session_row("v", "2024-01-03 08:00:00", user=2, actions=None),
    )
    sessions = silver.silver_user_sessions(staged)
    split = features.daily_activity(
        features.daily_sessions(sessions),
        features.daily_actions(silver.silver_session_actions(staged)),
    )
    fused = features.activity_from_log(silver.latest_sessions(staged))
    order = sorted(split.columns)
    assert rows_of(split.select(order)) == rows_of(fused.select(order))
    joined = features.daily_actions(
        silver.silver_session_actions(staged).drop("user_id"), sessions
    )
    own = features.daily_actions(silver.silver_session_actions(staged))
    assert rows_of(joined) == rows_of(own.select(joined.columns))


# --- features ------------------------------------------------------------------------
def activity(spark, *rows):
    base = spark.createDataFrame(list(rows), "user_id long, activity_date date, sessions long")
    names = ["duration", "page_views", "actions", "purchase_sessions", "view_count",
             "add_to_cart_count", "purchase_count", "search_count", "wishlist_count",
             "checkout_view_count", "distinct_products"]
    return base.withColumns({n: F.col("sessions") for n in names}).withColumns(
        {"revenue": F.col("sessions").cast("decimal(18,2)"),
         "avg_product_price": F.col("sessions").cast("decimal(18,6)")}
    )


def test_rolling_window(spark):
    act = activity(spark, (1, D(2024, 1, 1), 1), (1, D(2024, 1, 2), 2), (1, D(2024, 1, 5), 9),
                   (1, None, 5))
    out = {r.prediction_date: r for r in features.behaviour_features(
        features.rolling_3d(act)).collect()}
    assert out[D(2024, 1, 5)].sessions_3d == 2 and out[D(2024, 1, 2)].sessions_3d == 1
    assert out[D(2024, 1, 5)].avg_product_price_3d == 2.0
    first, undated = out[D(2024, 1, 1)], out[None]
    for row in (first, undated):
        assert row.sessions_3d == 0 and row.total_revenue_3d == 0.0
        assert row.cart_conversion_rate_3d == 0.0 and row.avg_session_duration_3d == 0.0


def test_rolling_window_equals_range_join(spark):
    import random

    rng = random.Random(7)
    days = {(rng.randrange(5), D(2024, 1, 1) + dt.timedelta(rng.randrange(20)))
            for _ in range(60)}
    act = activity(spark, *[(u, d, rng.randrange(9)) for u, d in days])
    joined = act.alias("p").join(
        act.alias("h"),
        F.expr("p.user_id = h.user_id and h.activity_date >= date_sub(p.activity_date, 3) "
               "and h.activity_date < p.activity_date"), "left",
    ).groupBy("p.user_id", "p.activity_date").agg(F.coalesce(F.sum("h.sessions"), F.lit(0)))
    ours = features.rolling_3d(act).select("user_id", "prediction_date", "sessions_3d")
    assert rows_of(joined) == rows_of(ours)


def test_top_spenders_only_on_the_last_day(spark):
    df = spark.createDataFrame(
        [(1, D(2024, 1, 1), 9.0), (2, D(2024, 1, 2), 1.0), (3, D(2024, 1, 2), 5.0)],
        "user_id long, prediction_date date, total_revenue_3d double")
    assert [r.user_id for r in features.top_spenders(df, k=20).collect()] == [3, 2]
    assert [r.user_id for r in features.top_spenders(df, on="2024-01-01").collect()] == [1]


# --- calendar, SCD2 ------------------------------------------------------------------
def test_calendar(spark):
    cal = star.calendar(spark)
    assert cal.count() == 4018
    days = {r.calendar_date: r for r in cal.filter("year = 2024 and month = 1").collect()}
    assert days[D(2024, 1, 6)].is_weekend == 1 and days[D(2024, 1, 8)].is_weekend == 0
    sat = days[D(2024, 1, 6)]
    assert (sat.date_key, sat.month_year, sat.quarter_year, sat.month_name, sat.day_name) == (
        20240106, "01-2024", "Q1-2024", "January", "Saturday")
    with pytest.raises(ValueError):
        star.calendar(spark, "2024-01-02", "2024-01-01")


def test_scd2(spark):
    def snap(*rows):
        return spark.createDataFrame(list(rows), "id int, v string")

    start = snap((1, "a"), (2, "b"), (3, None)).selectExpr(
        "id", "v", "date'2024-01-01' effective_start_date",
        "cast(null as date) effective_end_date", "true is_current")
    once = star.scd2_apply(start, snap((1, "a"), (2, "B"), (3, None), (4, "d")),
                           "id", ["v"], "2024-02-01")
    got = {(r.id, r.v, r.effective_start_date, r.effective_end_date, r.is_current)
           for r in once.collect()}
    assert got == {
        (1, "a", D(2024, 1, 1), None, True), (2, "b", D(2024, 1, 1), D(2024, 2, 1), False),
        (2, "B", D(2024, 2, 1), None, True), (3, None, D(2024, 1, 1), None, True),
        (4, "d", D(2024, 2, 1), None, True)}
    again = star.scd2_apply(once, snap((1, "a"), (2, "B"), (3, None), (4, "d")),
                            "id", ["v"], "2024-02-01")
    assert rows_of(again.select(once.columns)) == rows_of(once)
    fixed = star.scd2_apply(once, snap((2, "BB")), "id", ["v"], "2024-02-01")
    assert {r.v for r in fixed.filter("id = 2").collect()} == {"b", "BB"}


# --- reports -------------------------------------------------------------------------
def test_growth_share_moving_average(spark):
    df = spark.createDataFrame([(1, 100), (2, 0), (3, 50)], "m int, v int")
    out = df.withColumns({"g": kpis.growth("v", ["m"]), "ma": kpis.moving_avg("v", ["m"]),
                          "s": kpis.share("v")}).orderBy("m").collect()
    assert [r.g for r in out] == [None, -100.0, None]
    assert [r.ma for r in out] == [100.0, 50.0, 50.0]
    assert sum(r.s for r in out) == pytest.approx(100, abs=0.05)
    zero = spark.createDataFrame([(0,), (0,)], "v int").select(kpis.share("v").alias("s"))
    assert [r.s for r in zero.collect()] == [None, None]
    assert spark.range(1).select(percent(F.lit(1), F.lit(0)).alias("p")).first().p is None


def test_brand_origin_prefers_live_rows_and_keeps_repeats(spark):
    sold = spark.createDataFrame(
        [(1, 10, 2, Decimal("5.00"), Decimal("10.00")), (2, 20, 1, Decimal("7.00"), Decimal("7.00"))],
        "order_id long, product_key long, quantity int, price decimal(12,2), sub_total decimal(18,2)")
    products = spark.createDataFrame(
        [(10, "n", "c", "Acme", "Unknown"), (20, "m", "c", "Solo", "VN")],
        "product_id long, product_name string, category string, brand_name string, brand_origin string")
    live = spark.createDataFrame([("Acme", "JP"), ("Acme", "JP"), ("Acme", "US")],
                                 "brand_name string, brand_origin string")
    out = {(r.brand_name, r.country_of_origin): (r.total_units_sold, r.distinct_skus_sold)
           for r in kpis.brand_origin(sold, products, live).collect()}
    # a live brand listed twice matches twice, as in a plain left join
    assert out == {("Acme", "JP"): (4, 1), ("Acme", "US"): (2, 1), ("Solo", "VN"): (1, 1)}
    origins = {r.country_of_origin: (r.origin_units_sold, r.origin_orders)
               for r in kpis.origin_share(sold, products, live).collect()}
    assert origins == {"JP": (4, 1), "US": (2, 1), "VN": (1, 1)}


# --- campaign ------------------------------------------------------------------------
def test_segment_boundaries_and_rule(spark):
    df = spark.createDataFrame([(p,) for p in (0.70, 0.6999, 0.40, 0.3999)],
                               "purchase_probability double")
    assert [r.customer_segment for r in campaign.segment(df).collect()] == [
        "Hot Lead", "Medium Intent", "Medium Intent", "Low Intent"]
    zeros = spark.range(1).select(*[F.lit(0).alias(c) for c in schemas.RULE_WEIGHTS])
    scored = campaign.segment(campaign.score_rule(zeros)).first()
    assert scored.purchase_probability == 0.1419 and scored.campaign_channel == "DISPLAY_ADS"
    nulls = spark.range(1).select(
        *[F.lit(None).cast("int").alias(c) for c in schemas.RULE_WEIGHTS])
    assert campaign.score_rule(nulls).first().purchase_probability == 0.1419


# --- incremental ---------------------------------------------------------------------
def test_upsert_is_idempotent_and_deduplicates_its_source(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    source = spark.createDataFrame([(2, "B"), (2, "A"), (3, "c")], "id int, v string")
    once = incremental.upsert(target, source, ["id"], [F.desc("v")])
    assert rows_of(once) == [(1, "a"), (2, "B"), (3, "c")]
    assert rows_of(incremental.upsert(once, source, ["id"], [F.desc("v")])) == rows_of(once)


def test_high_water_mark(spark):
    source = spark.createDataFrame([(1,), (2,), (None,)], "ts int")
    empty = source.limit(0)
    assert incremental.high_water_mark(source, empty, "ts").count() == 3
    loaded = source.filter("ts = 1")
    assert rows_of(incremental.high_water_mark(source, loaded, "ts")) == [(2,)]
    assert incremental.high_water_mark(source, loaded, "ts", inclusive=True).count() == 2


# --- quality -------------------------------------------------------------------------
def test_checks_find_exactly_the_bad_rows(spark):
    df = spark.createDataFrame(
        [(1, "a", 5), (1, "b", 6), (2, None, None), (None, "z", 7)], "id int, v string, fk int")
    counts = {r.column_name: r.violations for r in quality.not_null(df, ["id", "v"]).collect()}
    assert counts == {"id": 1, "v": 1}
    assert rows_of(quality.unique(df, ["id"])) == [(1, 2)]
    assert rows_of(quality.accepted_values(df, "v", ["a", "b"])) == [("z", 1)]
    parent = spark.createDataFrame([(5,), (6,)], "pk int")
    assert rows_of(quality.relationships(df, "fk", parent, "pk")) == [(7, 1)]
    (row,) = quality.relationship_counts([("r", df, "fk", parent, "pk")]).collect()
    assert (row.rows_checked, row.orphans) == (3, 1)
    empty = quality.relationship_counts([("r", df.limit(0), "fk", parent, "pk")]).first()
    assert (empty.rows_checked, empty.orphans) == (0, 0)


def test_negative_money_and_totals(spark):
    fact = spark.createDataFrame([(1, -1, 2), (2, 3, 4)], "id int, price int, net int")
    out = quality.non_negative({"f": (fact, "id"), "g": (fact, "id")}, ["price", "net"])
    assert {(r.model_name, r.record_id) for r in out.collect()} == {("f", 1), ("g", 1)}
    orders = silver.silver_orders(staged_orders(spark, (1, 1, 1, 16), (2, 1, 1, 9)))
    lines = silver.silver_order_items(items(spark, (1, 1, 1, 2, 10, 4), (2, 1, 1, 1, 1, 9)))
    assert [r.order_id for r in quality.order_total_reconcile(orders, lines).collect()] == [2]
    assert quality.temporal_range(orders, "order_id", "order_date", "2024-01-02", "2024-02-01"
                                  ).count() == 2


def test_landing_counts_shows_missing_days(spark):
    landed = spark.createDataFrame([(D(2024, 1, 1),)], "ingest_date date")
    expected = spark.createDataFrame([(D(2024, 1, 1), 1), (D(2024, 1, 2), 4)],
                                     "ingest_date date, expected_rows long")
    out = quality.landing_counts(landed, expected).orderBy("ingest_date").collect()
    assert [(r.landed_rows, r.expected_rows, r.complete) for r in out] == [
        (1, 1, True), (0, 4, False)]


def test_schema_fidelity(spark):
    from tallymart.sources import warehouse

    from conftest import DATA

    raw = warehouse.read_raw(spark, str(DATA))
    for table, ddl in schemas.RAW_TABLES.items():
        expected = schemas.struct(ddl)
        df = raw[table]()
        assert quality.schema_differences(df, expected.names) == {
            "missing": [], "unexpected": [], "order": []}, table
        assert [f.dataType for f in df.schema] == [f.dataType for f in expected], table
    diff = quality.schema_differences(raw["brands"](), ["brand_name", "brand_id", "x"])
    assert diff["missing"] == ["x"] and diff["unexpected"] == ["brand_origin"]


def test_audit_column(spark):
    assert "_ingested_at" in with_audit(spark.range(1), "_ingested_at").columns


# --- masking -------------------------------------------------------------------------
def test_masks(spark):
    df = spark.createDataFrame([("a@b.c", "0901234567"), (None, "12")], "email string, phone string")
    out = masking.mask(df, {"email": masking.HASH, "phone": masking.SHOW_LAST_4}).collect()
    assert out[0].email == "d648b243a3e817eaa3309e00e183483f2867baadf522099f0c2121770536b25a"
    assert (out[0].phone, out[1].email, out[1].phone) == ("xxxxxx4567", None, "xx")
    generic = masking.mask(df, {"email": masking.REDACT, "phone": masking.NULLIFY}).first()
    assert (generic.email, generic.phone) == ("x@x.x", None)


def test_persona_views(spark):
    df = spark.createDataFrame([("a@b.c",)], "email string")
    boss = masking.Subjects.of(["admin"], ["admins"])
    policy = masking.MaskPolicy(
        "email", [(masking.Subjects.of(groups=["analysts"]), masking.NULLIFY)], boss)

    def seen(user, *groups):
        return masking.masked_view(df, [policy], user, groups).first().email

    assert seen("lan", "analysts") is None
    assert seen("admin", "analysts") == "a@b.c"  # exceptions win
    assert seen("lan", "analysts", "admins") == "a@b.c"
    assert seen("guest") == "a@b.c"  # no policy mentions the user
