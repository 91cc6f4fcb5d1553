"""Names, formats and limits that other systems rely on."""

# --- fixed values -----------------------------------------------------------
# topics read
TOPIC_LOG = "topic_log"
TOPIC_DB = "topic_db"
# topics written
DIRTY_TOPIC = "dirty_data"
PAGE_TOPIC = "dwd_traffic_page_log"
START_TOPIC = "dwd_traffic_start_log"
DISPLAY_TOPIC = "dwd_traffic_display_log"
ACTION_TOPIC = "dwd_traffic_action_log"
ERROR_TOPIC = "dwd_traffic_error_log"
UNIQUE_VISITOR_TOPIC = "dwd_traffic_unique_visitor_detail"
USER_JUMP_TOPIC = "dwd_traffic_user_jump_detail"

# change types that reach a dimension table
DIMENSION_CHANGE_TYPES = ("insert", "update", "bootstrap-insert")

# columns of a cart addition, all text
CART_COLUMNS = (
    "id", "user_id", "sku_id", "cart_price", "sku_num", "sku_name", "is_checked",
    "create_time", "operate_time", "is_ordered", "order_time", "source_type", "source_id",
)
CART_TABLE = "cart_info"

# columns of a routing config row
CONFIG_COLUMNS = ("source_table", "sink_table", "sink_columns", "sink_pk", "sink_extend")
DEFAULT_KEY_COLUMN = "id"

# schema of the dictionary used to enrich cart additions
DICTIONARY_SCHEMA = (
    "dic_code string, dic_name string, parent_code string, "
    "create_time timestamp, operate_time timestamp"
)

# text forms of dates; the offset belongs to text -> epoch conversion only
DATE_FORMAT = "yyyy-MM-dd"
SECOND_FORMAT = "yyyy-MM-dd HH:mm:ss"
TEXT_ZONE_OFFSET = "+08:00"

# times, in milliseconds
DAY_MS = 86_400_000
# Times a timestamp of microseconds can hold, and a day before and after them too.
LEAST_MS = -9_223_372_036_854_775 + DAY_MS
MOST_MS = 9_223_372_036_854_775 - DAY_MS
BOUNCE_WITHIN_MS = 10_000
LATENESS_MS = 2_000
VISIT_STATE_MS = 86_400_000
# ----------------------------------------------------------------------------

# One line of input text carries these arrival columns; rows are "earlier" when
# they compare lower on them, in this order.
ARRIVAL = ("timestamp", "partition", "offset")
