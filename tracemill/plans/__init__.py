"""Registered queries: importing the modules below fills the registry."""


def core():
    from tracemill.plans import batches, evaluation, extras, problems, rollouts, scores, tokenmath, trajectories  # noqa: F401
    from tracemill.plans.registry import CORE

    return CORE
