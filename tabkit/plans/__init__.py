"""Registered queries over the given tables, each with its SQL equivalent where there is one."""

from importlib import import_module

MODULES = ["prepare", "explore", "io", "combine", "evaluate", "learn", "lifecycle"]


def load_all() -> None:
    for name in MODULES:
        import_module(f"{__name__}.{name}")
