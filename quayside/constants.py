"""Values that must equal the reference's behaviour."""

# fixed values
MB = 1024 * 1024
ROLL_MINUTES = 2
INACTIVITY_SECONDS = 30
MAX_PART_BYTES = 10 * MB
DATE_FOLDER_FORMAT = "yyyy-MM-dd"
START_POSITIONS = ("AT_TIMESTAMP", "TRIM_HORIZON", "LATEST")
DEFAULT_START_POSITION = "LATEST"
SKIPPED_OPERATIONS = ("d",)
SNAPSHOT_CHUNK_ROWS = 2000
SNAPSHOT_FETCH_ROWS = 2000
BULK_MAX_ACTIONS = 1000
BULK_MAX_BYTES = 5 * MB
BULK_MAX_RETRIES = 20
BULK_RETRY_WAIT = "500ms"
PRODUCER_SPACING_MS = 10
PRODUCER_ACKS = "all"
PRODUCER_RETRIES = 3
PRODUCER_BATCH_BYTES = 16384
PRODUCER_LINGER_MS = 10
PRODUCER_DELIVERY_TIMEOUT_MS = 10000
PRODUCER_REQUEST_TIMEOUT_MS = 2000
PRODUCER_MAX_BLOCK_MS = 2000
PRODUCER_BUFFER_BYTES = 33554432
PRODUCER_MAX_IDLE_MS = 300000
PRODUCER_RETRY_BACKOFF_MS = 100
PRODUCER_CONNECTION_SETUP_MS = 1500
MESSAGE_TEXT_FORMAT = "Message %d at %d"
PERCENTILES = (0.5, 0.95, 0.99)
LOAD_DURATION_SECONDS = 1200
CSV_COLUMNS = ("client_request_id", "query_type", "user_id", "latency_ms", "result_count",
               "timestamp", "status", "thread_id")
