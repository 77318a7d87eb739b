"""Training-data operators. Nothing else in the package imports this subpackage."""

from . import shared, textkit

shared.by_value(shared.__name__)
shared.by_value(textkit.__name__)
