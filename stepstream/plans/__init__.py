from stepstream.plans.steps import Step, chain, sql_step, step_exprs

__all__ = ["Step", "chain", "sql_step", "step_exprs"]
