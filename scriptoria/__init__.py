"""A Spark-first engine for archives of multi-part text publications and for training-data corpora."""

from pyspark import cloudpickle as _cloudpickle

# Functions that run on executors travel with their code: no copy of the package is needed there.
import scriptoria as _self

_cloudpickle.register_pickle_by_value(_self)
