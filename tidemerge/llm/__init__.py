"""Operators for preparing training data. Nothing else in the library imports this package."""

from __future__ import annotations

import sys

from pyspark import cloudpickle

# Task functions travel with the plan, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
