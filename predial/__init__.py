"""Property-data preparation on Spark: profile, clean, complete and publish."""

from predial.contracts import SCHEMAS, ContractError
from predial.plans.jobs import run_cadastre, run_prices, run_profile
from predial.session import build_session, configure

__all__ = [
    "SCHEMAS",
    "ContractError",
    "build_session",
    "configure",
    "run_cadastre",
    "run_prices",
    "run_profile",
]
