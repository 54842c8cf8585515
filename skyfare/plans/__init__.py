"""What a user calls: ingest, build the models, run the checks."""

from skyfare.plans.check_spec import model_checks
from skyfare.plans.checks import Check, ChecksFailed, enforce_checks, failing_rows, run_checks
from skyfare.plans.ingest import ingest_trips, ingest_weather
from skyfare.plans.models import MODELS, Sources, TableStore, build_models, load_fact

__all__ = [
    "MODELS",
    "Check",
    "ChecksFailed",
    "Sources",
    "TableStore",
    "build_models",
    "enforce_checks",
    "failing_rows",
    "ingest_trips",
    "ingest_weather",
    "load_fact",
    "model_checks",
    "run_checks",
]
