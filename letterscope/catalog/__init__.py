"""Named queries over the driver tables, with SQL twins for checking."""

from __future__ import annotations


def _modules():
    from letterscope.catalog import coded_mail, letters, traffic

    return [traffic, letters, coded_mail]


def all_queries() -> dict:
    return {name: q for m in _modules() for name, q in m.QUERIES.items()}


def all_oracles() -> dict[str, str]:
    return {name: sql for m in _modules() for name, sql in m.ORACLE.items()}
