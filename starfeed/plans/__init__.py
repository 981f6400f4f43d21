from starfeed.plans.daily import run_daily
from starfeed.plans.load_plan import LOAD_PLAN, LoadStep

__all__ = ["LOAD_PLAN", "LoadStep", "run_daily"]
