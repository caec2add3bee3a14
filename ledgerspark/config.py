"""Job settings as a plain dictionary on the driver.

``default_conf()`` gives a fresh copy; callers override the keys they need and
hand the dictionary to the operators.
"""

from __future__ import annotations

import copy
from typing import Any

# Column names, declared types and default parameters of the
# card-transaction data model.  They must equal the published configuration.
TXN_COLUMNS = [
    ("trans_date_trans_time", "str"),
    ("cc_num", "int"),
    ("merchant", "str"),
    ("category", "str"),
    ("amt", "float"),
    ("first", "str"),
    ("last", "str"),
    ("gender", "str"),
    ("street", "str"),
    ("city", "str"),
    ("state", "str"),
    ("zip", "int"),
    ("lat", "float"),
    ("long", "float"),
    ("city_pop", "int"),
    ("job", "str"),
    ("dob", "str"),
    ("trans_num", "str"),
    ("unix_time", "int"),
    ("merch_lat", "float"),
    ("merch_long", "float"),
    ("is_fraud", "int"),
]

# The fields of one record sent for scoring, in order.
RECORD_FIELDS = [
    ("trans_date_trans_time", "str"),
    ("category", "str"),
    ("amt", "float"),
    ("gender", "str"),
    ("city", "str"),
    ("state", "str"),
    ("zip", "int"),
    ("lat", "float"),
    ("long", "float"),
    ("city_pop", "int"),
    ("job", "str"),
    ("dob", "str"),
    ("merch_lat", "float"),
    ("merch_long", "float"),
]

# Model inputs, engineered columns and default model settings.
NUMERIC_FEATURES = [
    "amt", "lat", "long", "merch_lat", "merch_long",
    "hour", "day", "month", "day_of_week", "is_weekend", "age", "geo_distance",
]
ENGINEERED_FEATURES = [
    "amt", "city_pop", "hour", "day", "month", "geo_distance",
    "day_of_week", "age", "category", "gender",
]
GRADIENT_BOOSTING_PARAMS = {
    "max_depth": 6,
    "learning_rate": 0.1,
    "n_estimators": 200,
    "subsample": 0.8,
    "colsample_bytree": 0.8,
    "gamma": 0,
    "reg_alpha": 0,
    "reg_lambda": 1,
    "scale_pos_weight": 10,
    "random_state": 42,
}
GRADIENT_BOOSTING_SEARCH = {
    "max_depth": [3, 10],
    "learning_rate": [0.01, 0.3],
    "n_estimators": [100, 400],
    "subsample": [0.6, 1.0],
    "colsample_bytree": [0.6, 1.0],
    "gamma": [0, 5],
    "reg_alpha": [0, 1],
    "reg_lambda": [0, 5],
}
DECISION_TREE_PARAMS = {
    "max_depth": 6,
    "min_samples_split": 3,
    "min_samples_leaf": 1,
    "criterion": "entropy",
    "class_weight": "balanced",
    "random_state": 42,
}
RANDOM_FOREST_PARAMS = {
    "n_estimators": 100,
    "max_depth": 6,
    "min_samples_split": 5,
    "min_samples_leaf": 2,
    "criterion": "entropy",
    "class_weight": "balanced",
    "random_state": 42,
    "n_jobs": -1,
}

_DEFAULT: dict[str, Any] = {
    "data_source": {
        "raw_path": None,
        "processed_path": None,
        "delimiter": ",",
        "header": 0,
        "encoding": "utf-8",
    },
    "target": "is_fraud",
    "data_split": {"test_size": 0.2, "valid_size": 0.0, "random_state": 42},
    "raw_features": [name for name, _ in RECORD_FIELDS],
    "features": {
        "continuous": ["amt", "city_pop", "age", "geo_distance"],
        "categorical": ["category", "gender"],
        "engineered": ENGINEERED_FEATURES,
    },
    "preprocessing": {
        "label_encode": ["category", "gender"],
        "numeric": NUMERIC_FEATURES,
        "categorical": [],
    },
    "model": {
        "name": "xgboost",
        "params": GRADIENT_BOOSTING_PARAMS,
        "bayesian_optimization": {
            "enabled": True,
            "init_points": 5,
            "n_iter": 20,
            "random_state": 42,
            "search_space": GRADIENT_BOOSTING_SEARCH,
        },
    },
    "data_validation": {
        "enabled": True,
        "action_on_error": "raise",
        "schema": {
            "columns": [
                {"name": name, "dtype": dtype, "required": True}
                for name, dtype in TXN_COLUMNS
            ]
        },
    },
    "inference": {"input_path": None, "output_path": None, "threshold": 0.5},
    "artifacts": {"root": None, "model_path": None},
}


def default_conf(**overrides: Any) -> dict[str, Any]:
    """A fresh copy of the defaults; top-level sections given are merged in."""
    conf = copy.deepcopy(_DEFAULT)
    for key, value in overrides.items():
        if isinstance(value, dict) and isinstance(conf.get(key), dict):
            conf[key] = {**conf[key], **copy.deepcopy(value)}
        else:
            conf[key] = copy.deepcopy(value)
    return conf


def rules_of(conf: dict[str, Any]) -> list[dict[str, Any]]:
    """The column rules of a configuration; empty if none are declared."""
    return conf.get("data_validation", {}).get("schema", {}).get("columns", [])
