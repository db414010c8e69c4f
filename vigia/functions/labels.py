"""Labels derived from one event column."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..schema import ERROR_LEVELS

# Status-code classes.
STATUS_CLASSES = {2: "2xx OK", 3: "3xx Redireccion", 4: "4xx Cliente", 5: "5xx Servidor"}
OTHER_STATUS = "Otro"


def status_class(code: Column) -> Column:
    """Class of an HTTP-like status code; null and foreign codes are 'Otro'."""
    label = None
    for hundred, text in STATUS_CLASSES.items():
        hit = code.between(hundred * 100, hundred * 100 + 99)
        label = F.when(hit, text) if label is None else label.when(hit, text)
    return label.otherwise(OTHER_STATUS)


def is_error(level: Column) -> Column:
    return level.isin(*ERROR_LEVELS)
