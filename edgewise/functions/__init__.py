from edgewise.functions.features import (  # noqa: F401
    COUNT_FEATURES, DERIVED_FEATURES, FEATURE_COLUMNS, FEATURE_NAMES, NB_FEATURES,
    SVM_LR_FEATURES, derived_columns, label_value, names, safe_ratio,
)
from edgewise.functions.hashing import (  # noqa: F401
    MODULUS, SEED_SPLIT, SEED_TEST, SEED_TRAIN, pair_hash, pair_hash_sql,
    poisson_copies, poisson_thresholds, threshold,
)
