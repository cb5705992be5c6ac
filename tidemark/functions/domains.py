"""Constants of the capture format."""

# Prefixes of hashed bytes, one for each kind of digest.
PAYLOAD = b"tick-data-platform/source-payload/v1\0"
OBSERVATION = b"tick-data-platform/observation/v1\0"
LEASE = b"tick-data-platform/lease/v1"
CLAIM = b"tick-data-platform/publisher-claim/v1\0"
BATCH = b"tick-data-platform/batch/v1\0"
WAL_ENTRY = b"tick-data-platform/wal-entry/v1\0"
BOUNDARY = b"tick-data-platform/boundary/v1\0"
RAW_DAY = b"tick-data-platform/raw-day-manifest/v1\0"
REPLAY_DAY = b"tick-data-platform/replay-day-manifest/v1\0"
BUNDLE = b"tick-data-platform/replay-publication-bundle/v1\0"
FINAL_OBSERVATION = b"tick-data-platform/replay-publication-final-observation/v1\0"
RAW_SET = b"tick-data-platform/raw-set/v1\0"
SEGMENT = b"tick-data-platform/continuity-segment/v1\0"
ROW = b"tick-data-platform/replay-row/v1\0"
MARKER = b"tick-data-platform/replay-marker/v1\0"
ROW_CHAIN = b"tick-data-platform/replay-row-chain/v1\0"
PART = b"tick-data-platform/part-manifest/v1\0"
PART_SET = b"tick-data-platform/part-set/v1\0"
SCOPE_KEY = b"tick-data-platform/source-symbol-scope/v1\0"
REPLAY_IDENTITY = b"tick-data-platform/replay-identity/v1\0"
PROOF = b"tick-data-platform/retention-proof/v1\0"
VERIFICATION = b"tick-data-platform/retention-verification/v1\0"
CHECKPOINT = b"tick-data-platform/prune-checkpoint/v1\0"
PRUNE_PLAN = b"tick-data-platform/prune-plan/v1\0"
COMPLETION = b"tick-data-platform/prune-completion/v1\0"
CONFIG = b"tick-data-platform/archive-config/v1\0"
EVENT = b"tick-data-platform/replay-publication-event/v1\0"
ACTION_PLAN = b"tick-data-platform/replay-action-plan/v1\0"
SCHEMA_ID = "mt5.mqltick.v1"
FORMAT_ID = "ticks-parquet-v1"

# Limits.
MAX_FRAME, MAX_RECORDS, MAX_STRING, MAX_PATH = 1_048_576, 4096, 255, 1024
HEADER, TRAILER, RECORD = 16, 96, 68
COMMIT = 0x434F4D4D

# Message types, acknowledgement statuses and error codes, in the order of their numbers from 1.
MESSAGES = ("HELLO", "RESUME", "BATCH", "ACK", "ERROR")
STATUSES = (
    "ACCEPTED_ADVANCED",
    "ACCEPTED_NO_ADVANCE",
    "DUPLICATE",
    "DENSE_BOUNDARY_CONTINUE",
    "DENSE_BOUNDARY_UNRESOLVED",
    "RETRYABLE_GATEWAY_ERROR",
    "FATAL_PROTOCOL_ERROR",
    "SOURCE_STATE_CONFLICT",
    "SESSION_LEASE_CONFLICT",
)
ERRORS = (
    "INVALID_FRAME",
    "UNSUPPORTED_PROTOCOL_VERSION",
    "UNKNOWN_MESSAGE_TYPE",
    "TRUNCATED_FRAME",
    "OVERSIZED_FRAME",
    "CRC_MISMATCH",
    "INVALID_FIELD",
    "SOURCE_STATE_CONFLICT",
    "SESSION_LEASE_CONFLICT",
    "INTERNAL_RETRYABLE",
)
UNKNOWN_ERROR = 7

# Marker codes with their reasons.
MARKERS = {
    "SEGMENT_START": "INITIAL",
    "AMBIGUOUS_OVERLAP": "NO_UNIQUE_OVERLAP",
    "SOURCE_HISTORY_CHANGED": "SAME_POSITION_PAYLOAD_CHANGED",
    "SOURCE_ERROR": "SOURCE_REPORTED_ERROR",
    "GAP": "WAL_SEQUENCE_GAP",
    "TIMESTAMP_REGRESSION": "TIME_MSC_REGRESSION",
    "SCOPE_BOUNDARY": "SCOPE_CHANGED",
}
COMPLETENESS = ("provisional", "settled_snapshot", "incomplete_source_error", "incomplete_sync", "incomplete_gateway_outage")
OBSERVED = ("Absent", "Exact", "Different", "Ambiguous", "Oversized", "Unavailable")
ZERO = bytes(32)
