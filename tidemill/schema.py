"""Fixed names and values of the data model."""

# The closed event envelope.
IDENTITY_FIELDS = ("event_id", "device_id", "asset_type", "timestamp")
ENVELOPE_DEFAULTS = {"priority": "normal", "schema_version": "1.0.0", "payload": "{}"}
ENVELOPE_FIELDS = (*IDENTITY_FIELDS, "priority", "schema_version", "payload")
FLAT_ENVELOPE = ("event_id", "device_id", "asset_type", "timestamp", "priority", "schema_version")

# Identifier namespaces.
BRIDGE_NAMESPACE = "6f1b3c2a-6e6a-4b1a-9a7a-2b8f6b8b8a2e"
VALIDATION_NAMESPACE = "9a2f4c6e-3b1d-4a8e-9c7f-1d2e3f4a5b6c"

# Operating modes used by the reports.
AUTONOMOUS_MODE = "EDGE_AUTONOMOUS"
ESCALATION_MODE = "HYBRID"
UNVERSIONED = "unversioned"
NORMAL_LABEL = "normal"

# The feature set.
FEATURES = ("rms", "peak", "crest", "kurtosis", "skew", "variance", "mean_abs")
TREND_FEATURES = ("rms_roll_mean_5", "rms_roll_std_5", "rms_delta_1", "kurtosis_roll_mean_5")
TREND_ROWS = 5
REQUIRED_FEATURE_COLUMNS = (
    *FEATURES,
    "event_id",
    "source_file",
    "ground_truth_label",
    "window_idx",
)
FORBIDDEN_FEATURE_COLUMNS = (
    "mode",
    "rtt_ms",
    "cpu_pct",
    "cloud_reachable",
    "edge_confidence",
    "anomaly",
    "anomaly_score",
    "edge_anomaly",
    "edge_score",
    "cloud_anomaly",
    "cloud_score",
    "agrees_with_edge",
    "infer_ms",
)
FEATURE_SET_VERSION = "bearing-features-v1"

# The split policy.
TRAIN, VALIDATION, TEST = "TRAIN", "VALIDATION", "TEST"
NORMAL_TRAIN_UPTO = 0.6
NORMAL_VALIDATION_UPTO = 0.8
FAULT_VALIDATION_UPTO = 0.5

# Signal windows, scores and limits.
WINDOW_SAMPLES = 2048
SAMPLING_RATE_HZ = 12000
SCORE_STEEPNESS = 5.0
VALIDATION_THRESHOLD = 0.60
HEARTBEAT_SECONDS = 30.0
EVENT_SIZE_LIMIT = 1024 * 1024
EDGE_TREES, CLOUD_TREES = 100, 300
FOREST_SEED = 42
MIN_TRAINING_ROWS = 10

# The recording classes, by file-name prefix.
LABEL_PREFIXES = ("normal", "inner_race", "ball", "outer_race")

# Config type names and their Spark casts.
CONFIG_TYPES = {
    "string": "string",
    "integer": "int",
    "int": "int",
    "long": "bigint",
    "bigint": "bigint",
    "double": "double",
    "float": "float",
    "boolean": "boolean",
    "bool": "boolean",
    "timestamp": "timestamp",
    "date": "date",
}

#: Bronze: hash of the raw line, to tell copies apart.
LINE_HASH = "_line_hash"
