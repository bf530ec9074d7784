"""The operators on the test tables: a query and its SQL side by side.

Each module has ``QUERIES`` (name -> function of session and table folder) and
``ORACLE`` (name -> SQL over the same tables with the same columns). The event
table stands for readings: ``event_type`` is the place, ``value`` the main and
``props.k`` the second measurement.
"""

from . import daily, etl, messages, readers, records, reports, streams, text, windows

_MODULES = (daily, text, windows, streams, messages, records, readers, etl, reports)


def queries():
    return {name: query for module in _MODULES for name, query in module.QUERIES.items()}


def oracle_sql():
    return {name: sql for module in _MODULES for name, sql in module.ORACLE.items()}
