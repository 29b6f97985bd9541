"""Loads every module of registered queries."""

from tidemark.plans import q_anomaly, q_capacity, q_evaluate, q_features, q_forecast, q_models, q_profile, q_series  # noqa: F401
from tidemark.plans.registry import ORACLES, QUERIES  # noqa: F401

FLAGSHIP = "anomaly_combined"
