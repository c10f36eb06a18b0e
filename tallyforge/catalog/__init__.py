"""All registered queries."""

from pyspark import cloudpickle

from ..ml import gramian, kernel, neighbours, textmodel
from . import censuses, clicklog, messaging, models, surveys  # noqa: F401
from .registry import QUERIES  # noqa: F401

# The modules with Python tasks travel with them, so workers need no installed package.
for _module in (gramian, kernel, neighbours, textmodel):
    cloudpickle.register_pickle_by_value(_module)
