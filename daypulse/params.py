"""Query parameters and fixed values.

Fixed values that decide results (band edges, route prefix, result labels)
are stated here together, in plain text."""

from __future__ import annotations

import datetime as _dt

# --- fixed values -----------------------------------------------------------
# Route name of a change row: prefix + upper-case table name.
ROUTE_PREFIX = "ODS_"
# Age bands of the sales shares: under 20, 20 to 30 inclusive, over 30.
AGE_BAND_UNDER_20 = "under 20"
AGE_BAND_20_30 = "20-30"
AGE_BAND_OVER_30 = "over 30"
# KPI rows of the dashboard: (id, name).
KPI_DAU = ("dau", "Daily active devices")
KPI_NEW_MID = ("new_mid", "New devices")
# Province sales bins: width 100, capped at bin 5.
PROVINCE_BIN_WIDTH = 100
PROVINCE_BIN_MAX = 5
# Search page: from 0, size 20.
SEARCH_PAGE_SIZE = 20
# Highlight markers.
HIGHLIGHT_PRE = "<em>"
HIGHLIGHT_POST = "</em>"

# --- topics of the log collector and of the change feed --------------------
RAW_LOG_TOPIC = "app_log"
START_TOPIC = "log_start"
EVENT_TOPIC = "log_event"
CDC_TOPIC = "db_changes"
LOG_PARTITIONS = 4

# --- parameters of the registered queries ----------------------------------
LOG_DAY = _dt.date(2024, 1, 15)          # "today" of the dashboard queries
CORRUPT_EVERY = 97                       # adapter cuts these log lines mid-JSON
NO_COMMON_EVERY = 101                    # adapter drops `common` from these
BAD_CLOCK_EVERY = 103                    # adapter sets these clocks 400 days ahead
HUGE_TS_EVERY = 107                      # adapter writes the largest BIGINT as ts
LOG_MAX_AHEAD_MS = 86_400_000            # ts may lie this far after arrival ...
LOG_MAX_BEHIND_MS = 30 * 86_400_000      # ... and this far before it
LATEST_TS_MS = 4_102_444_800_000         # 2100-01-01, where no arrival is known
ORDER_STATE_CUTOFF = _dt.date(1995, 7, 1)   # users with orders before are known
CDC_ROWS_PER_MESSAGE = 10
SALES_DATE_FROM = _dt.date(1996, 1, 1)
SALES_DATE_TO = _dt.date(1996, 12, 31)
SALES_KEYWORD = "widget"
SALES_PAGE_START = 20
SALES_PAGE_LENGTH = 10
SEARCH_TOKEN = "the"
SEARCH_LANG = "en"
NESTED_ROLE = "assistant"
NESTED_TOKEN = "que"
HIGHLIGHT_TOKEN = "the"
SEARCH_TERM_ROLE = "system"
WEEK_DAYS = 7                            # days of the weekly active devices
FIRST_SEEN_CUTOFF = _dt.date(2024, 1, 24)   # history before; later days are added one by one
STREAM_DELAY = "2 days"
STATE_PARTITIONS = 4                     # fixed for ever at a stream's first start:
                                         # give the cores that the state shall use
UPSERT_BUCKETS = 8                       # folders of a keyed table, by hash of the key:
                                         # about one per 128 MB the table will reach
DETAIL_BUCKETS = 16                      # buckets of orders and details by order key (at
                                         # least the shuffle partitions): 1 per 128 MB
MERGE_EVERY = 16                         # batches between merges of a table's parts
DISORDER_PARTITION = 2                   # collector partition that is always ...
DISORDER_DELAY_MS = 86_400_000           # ... this much late, within STREAM_DELAY
LOG_WINDOW_MS = 5 * 86_400_000          # arrival window of the log replay
ORDER_WINDOW_MS = 365 * 86_400_000      # arrival window of the order replay
AUDIT_BATCH = 500                        # offsets of a partition in an audited micro-batch
HOLE_EVERY, HOLE_SIZE = 7, 20            # every seventh loses its first offsets,
OVERLAP_EVERY, OVERLAP_SIZE = 5, 10      # every fifth is followed by one that reads its last again
REDELIVER_EVERY = 10                     # every tenth change record comes twice
REDELIVER_WITHIN = "1 hour"              # how long the fan-out knows a change
STALL_PARTITION = 3                      # collector partition that stalled ...
STALL_FROM = _dt.date(2024, 1, 10)       # ... for these event days ...
STALL_TO = _dt.date(2024, 1, 11)
STALL_DELAY_MS = 10 * 86_400_000         # ... and delivered this much later
STREAM_DELAY_MS = 2 * 86_400_000         # same as STREAM_DELAY
