"""Text formats that logs and ledgers already use."""

# Metrics block markers and the format version written in them.
BLOCK_MARK = "===A2-METRICS"
BLOCK_VERSION = "2.0"
HEADER_END = "==="
BLOCK_END = "===END==="

# Ledger columns, in file order.
LEDGER_COLUMNS = [
    "stage",
    "resource_id",
    "nodes",
    "phase",
    "predicted_s",
    "wall_s",
    "startup_s",
    "shuffle_write_bytes",
    "task_min_s",
    "task_med_s",
    "task_max_s",
    "cost_usd",
]

# The line a driver logs per executor, and the settings a comparable run has.
EXECUTOR_MARK = "Registered executor"
PINNED_PARTITIONS = 16
LINK_GBIT_PER_S = 12.5

# Whitespace and line breaks as Python's str.strip and str.splitlines see them.
# Splitting uses one character at a time; the empty pieces this leaves carry no pair.
LINE_BREAKS = "\n\r\v\f\x1c\x1d\x1e\x85\u2028\u2029"
BLANKS = (
    " \t\x1f\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000"
)
WHITESPACE = LINE_BREAKS + BLANKS
