"""Schemas of the tables the jobs read and write, as DDL strings."""

# Inputs.
VISIT_ACTION = (
    "date STRING, user_id BIGINT, session_id STRING, page_id BIGINT, action_time STRING, "
    "search_keyword STRING, click_category_id BIGINT, click_product_id BIGINT, "
    "order_category_ids STRING, order_product_ids STRING, "
    "pay_category_ids STRING, pay_product_ids STRING, city_id BIGINT"
)
USER_INFO = (
    "user_id BIGINT, username STRING, name STRING, age INT, professional STRING, "
    "city STRING, sex STRING"
)
PRODUCT_INFO = "product_id BIGINT, product_name STRING, extend_info STRING"
PERSON = "id STRING, name STRING, age STRING, addr STRING"
EMPLOYEE = "name STRING, salary BIGINT"
BEHAVIOR = (
    "user_id STRING, item_id STRING, category_id STRING, behavior STRING, timestamp STRING"
)

# Stream state.
USER_CLICKS = "date STRING, userid BIGINT, adid BIGINT, click_count BIGINT"
BLACKLIST = "userid BIGINT"
PLACE_CLICKS = (
    "date STRING, province STRING, city STRING, adid BIGINT, click_count BIGINT"
)
