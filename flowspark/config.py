"""Fixed values of the flow-scoring model contract.

Everything in this module is a *fixed value*: it must equal the contract of
the scoring pipeline we re-implement (model input order, transform list,
thresholds).  Nothing here is computed.
"""

from __future__ import annotations

# --- fixed values: model input feature order (78 names, in order) ----------
FEATURE_ORDER: list[str] = [
    "Destination Port", "Flow Duration", "Total Fwd Packets", "Total Backward Packets",
    "Total Length of Fwd Packets", "Total Length of Bwd Packets", "Fwd Packet Length Max",
    "Fwd Packet Length Min", "Fwd Packet Length Mean", "Fwd Packet Length Std",
    "Bwd Packet Length Max", "Bwd Packet Length Min", "Bwd Packet Length Mean",
    "Bwd Packet Length Std", "Flow Bytes/s", "Flow Packets/s", "Flow IAT Mean", "Flow IAT Std",
    "Flow IAT Max", "Flow IAT Min", "Fwd IAT Total", "Fwd IAT Mean", "Fwd IAT Std", "Fwd IAT Max",
    "Fwd IAT Min", "Bwd IAT Total", "Bwd IAT Mean", "Bwd IAT Std", "Bwd IAT Max", "Bwd IAT Min",
    "Fwd PSH Flags", "Bwd PSH Flags", "Fwd URG Flags", "Bwd URG Flags", "Fwd Header Length",
    "Bwd Header Length", "Fwd Packets/s", "Bwd Packets/s", "Min Packet Length",
    "Max Packet Length", "Packet Length Mean", "Packet Length Std", "Packet Length Variance",
    "FIN Flag Count", "SYN Flag Count", "RST Flag Count", "PSH Flag Count", "ACK Flag Count",
    "URG Flag Count", "CWE Flag Count", "ECE Flag Count", "Down/Up Ratio", "Average Packet Size",
    "Avg Fwd Segment Size", "Avg Bwd Segment Size", "Fwd Header Length.1", "Fwd Avg Bytes/Bulk",
    "Fwd Avg Packets/Bulk", "Fwd Avg Bulk Rate", "Bwd Avg Bytes/Bulk", "Bwd Avg Packets/Bulk",
    "Bwd Avg Bulk Rate", "Subflow Fwd Packets", "Subflow Fwd Bytes", "Subflow Bwd Packets",
    "Subflow Bwd Bytes", "Init_Win_bytes_forward", "Init_Win_bytes_backward", "act_data_pkt_fwd",
    "min_seg_size_forward", "Active Mean", "Active Std", "Active Max", "Active Min", "Idle Mean",
    "Idle Std", "Idle Max", "Idle Min",
]

# --- fixed values: columns that get log1p(clip(x, lower=0)) (28 names) -----
LOG1P_COLUMNS: list[str] = [
    "Total Fwd Packets", "Total Backward Packets", "Fwd Packet Length Std",
    "Bwd Packet Length Std", "Flow Bytes/s", "Flow Packets/s", "Flow IAT Min", "Fwd IAT Std",
    "Fwd IAT Min", "Bwd IAT Total", "Bwd IAT Mean", "Bwd IAT Std", "Bwd IAT Max", "Bwd IAT Min",
    "Fwd Header Length", "Fwd Header Length.1", "Subflow Fwd Packets", "Subflow Bwd Packets",
    "Init_Win_bytes_backward", "act_data_pkt_fwd", "Active Mean", "Active Std", "Active Max",
    "Active Min", "Idle Mean", "Idle Std", "Idle Max", "Idle Min",
]

# --- fixed values: thresholds and constants --------------------------------
ATTACK_THRESHOLD = 0.01          # p_attack below this routes BENIGN (batch form)
TRAIN_DECISION_THRESHOLD = 0.5   # training-time binary decision
CLIP_LIMIT = 1e9                 # features clipped to [-1e9, 1e9]
BENIGN = "BENIGN"
ATTACK = "ATTACK"
SEED = 42
AE_SHARDS = 4                    # shards of the autoencoder's local training, at least
AE_SHARD_ROWS = 100_000          # benign rows of a shard, about, where there are more of them
BACKGROUND_ROWS = 200            # explanation background sample size
SMOKE_SAMPLE_ROWS = 20           # smoke-run sample size
VALIDATION_FRACTION = 0.2        # 80/20 splits
CALIBRATION_FRACTION = 0.1       # of the binary model's training rows, for its probabilities
TOP_FEATURES = 15                # explanation rows per flow
PREVIEW_ROWS = 50                # dataset preview
LOG_TAIL_ROWS = 100              # monitor log tail
RESULT_HEAD_ROWS = 20            # smoke-run result head
AE_LAYERS = [48, 24, 12, 24, 48]  # hidden widths; input/output width = #features
AE_LEARNING_RATE = 1e-3
AE_BATCH_SIZE = 1024
AE_MAX_EPOCHS = 15
AE_PATIENCE = 5
GBT_MAX_ROUNDS = 200
GBT_EARLY_STOP = 10
GBT_LEARNING_RATE = 0.05
GBT_MAX_DEPTH = 5                # depth 5 ~ 32 leaves (reference: 31 leaves)
GBT_FEATURE_FRACTION = 0.9
GBT_BAGGING_FRACTION = 0.8

LABEL_NAME = "Label"

LOG1P_SET = frozenset(LOG1P_COLUMNS)


def feature_index(name: str) -> int:
    return FEATURE_ORDER.index(name)
