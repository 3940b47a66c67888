"""What tests share beyond fixtures; a name of its own, since every test folder may have a conftest."""

import os

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
